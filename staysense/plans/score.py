"""Score a batch of bookings, choose gifts, feed the reports.

One lineage: read -> join -> dates -> probability -> imputation (one-row
statistics, broadcast) -> gift decision columns.  No positional concat: the
probability is a column of the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staysense.functions import constants as K
from staysense.functions.columns import present
from staysense.operators import gifts as G
from staysense.operators import model as MD
from staysense.operators import prepare as P
from staysense.operators import stats as S
from staysense.operators.scorecard import scorecard_probability


def score_bookings(bookings: DataFrame, hotels: DataFrame, threshold: float = K.DEFAULT_FALLBACK_THRESHOLD,
                   probability: Callable[[DataFrame], DataFrame] = scorecard_probability,
                   prob_col: str = "cancellation_probability") -> DataFrame:
    """Merged inference frame with ``cancellation_probability`` and ``predicted_to_cancel``.
    ``Booked`` and unknown-status rows are kept: they are the ones to score (D11)."""
    df = P.join_hotels(bookings, hotels)
    df = P.parse_dates(df, ["arrival_date", "booking_date"])
    df = P.add_day_diffs(df).drop("days_before_arrival")
    df = P.zero_fill(df, ["required_car_parking_spaces"])
    df = probability(df)
    return G.score_with_threshold(df, threshold, prob_col)


def package_probability(path: str, prob_col: str = "cancellation_probability") -> tuple[Callable[[DataFrame], DataFrame], float]:
    """(probability step for ``score_bookings``, threshold) of a saved training package."""
    model, threshold = MD.load_model_package(path)
    flags = ["parking", "restaurant", "pool_and_spa"]

    def probability(df: DataFrame) -> DataFrame:
        have = present(df, flags)
        kept = df.withColumn("_flags", F.struct(*[F.col(c).alias(c) for c in have])) if have else df
        scored = MD.positive_probability(model.transform(MD.cast_booleans(kept, have)), prob_col)
        return scored.select(*[F.col(f"_flags.{c}").alias(c) if c in have else F.col(c) for c in df.columns], prob_col)

    return probability, threshold


def decide(scored: DataFrame, threshold: float = K.DEFAULT_FALLBACK_THRESHOLD,
           params: G.GiftParams = G.GiftParams(), prob_col: str = "cancellation_probability") -> DataFrame:
    """I11 imputation then G1-G7."""
    imputed = S.impute_for_gifting(scored, params.as_of,
                                   key_cols=("booking_id", prob_col, "predicted_to_cancel"))
    return G.decide_gifts(imputed, threshold, prob_col, params)
