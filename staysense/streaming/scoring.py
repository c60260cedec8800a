"""Structured Streaming variant of the scoring flow (E2 on arriving bookings).

New booking files are read with ``readStream`` (explicit schema), joined to the
static hotel dimension and to a static one-row table of imputation statistics
fitted on history (stream-static joins, both broadcast with a proven size), and
scored with the same Column expressions as the batch flow: probability,
threshold, gift decision.  The query is stateless (no aggregation), so each
micro-batch is independent.  Progress and exactly-once file output are kept in a
checkpoint folder that belongs to the sink (or that the caller names), so a restart
goes on where the last run ended; the file sink skips batch numbers it has committed,
which is why the folder must never change for a sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from staysense.functions import constants as K
from staysense.operators import gifts as G
from staysense.operators import prepare as P
from staysense.operators import stats as S
from staysense.operators.scorecard import scorecard_probability


def scored_stream(stream: DataFrame, hotels: DataFrame, fills: DataFrame | None,
                  threshold: float = K.DEFAULT_FALLBACK_THRESHOLD,
                  params: G.GiftParams = G.GiftParams(), probability=scorecard_probability) -> DataFrame:
    df = P.join_hotels(stream, hotels)
    df = P.parse_dates(df, ["arrival_date", "booking_date"])
    df = P.add_day_diffs(df).drop("days_before_arrival")
    df = P.zero_fill(df, ["required_car_parking_spaces"])
    df = G.score_with_threshold(probability(df), threshold)
    df = S.apply_gift_imputation(df, fills, params.as_of)
    return G.decide_gifts(df, threshold, "cancellation_probability", params)


def start_scoring(spark: SparkSession, source_dir: str, schema, hotels: DataFrame, history: DataFrame,
                  sink_dir: str, threshold: float = K.DEFAULT_FALLBACK_THRESHOLD,
                  params: G.GiftParams = G.GiftParams(), available_now: bool = True,
                  max_files_per_trigger: int = 64, checkpoint_dir: str | None = None) -> StreamingQuery:
    """Start the stream: Parquet files in ``source_dir`` -> decisions in ``sink_dir``.

    ``checkpoint_dir`` defaults to ``_checkpoint`` inside the sink (readers skip names
    that begin with an underscore); use the same one at every start."""
    hist = P.join_hotels(history, hotels)
    fills = S.fit_gift_imputation(hist, key_cols=("booking_id",))
    if fills is not None:
        fills = fills.cache()
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir))
    out = scored_stream(stream, hotels, fills, threshold, params)
    ckpt = checkpoint_dir or sink_dir.rstrip("/") + "/_checkpoint"
    w = out.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", ckpt) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
