"""Campaign reports (R1-R5, O1): each is one aggregate pass over the decided frame.

The reference prints them with one filter per gift / segment; here each report is
a single ``agg`` or ``groupBy`` (partial aggregation map-side, a handful of output
rows).  Money sums use ``sum_exact`` (decimal) so totals do not depend on how the
cluster partitioned the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staysense.functions import constants as K
from staysense.functions.columns import safe_ratio, sum_exact


def _pct(num: Column, den: Column, scale: int = 4) -> Column:
    return F.round(F.try_divide(num.cast("double") * F.lit(100.0), den.cast("double")), scale)


def campaign_economics(decided: DataFrame) -> DataFrame:
    """R1 (+A3/A4): one row."""
    has_gift = F.col("gift").isNotNull()
    agg = decided.agg(
        F.count(F.lit(1)).alias("total_bookings"),
        F.count_if(has_gift).alias("gifts_offered"),
        sum_exact(F.col("ev_no_intervention")).alias("revenue_no_campaign"),
        sum_exact(F.col("final_ev_with_gift_decision")).alias("revenue_with_campaign"),
        sum_exact(F.when(has_gift, F.col("cost_of_selected_gift"))).alias("_cost"),
    )
    cost = F.coalesce(F.col("_cost"), F.lit(0.0))
    net = F.col("revenue_with_campaign") - F.col("revenue_no_campaign")
    return agg.select(
        "total_bookings", "gifts_offered",
        _pct(F.col("gifts_offered"), F.col("total_bookings")).alias("gifts_pct"),
        F.round("revenue_no_campaign", 4).alias("revenue_no_campaign"),
        F.round("revenue_with_campaign", 4).alias("revenue_with_campaign"),
        F.round(cost, 4).alias("total_gift_cost"),
        F.round(net, 4).alias("net_impact"),
        F.when(F.col("gifts_offered") > 0, F.round(cost / F.col("gifts_offered"), 4)).alias("avg_gift_cost"),
        F.when(F.col("gifts_offered") > 0,
               F.round(F.when(cost > 0, net / cost).otherwise(F.lit(0.0)), 6)).alias("roi"),
    )


def gift_distribution(decided: DataFrame, prob_col: str = "cancellation_probability") -> DataFrame:
    """R2 (+A5/A6): count, share, mean probability and mean cost per gift, null group kept."""
    names = F.create_map(*[x for g, n in K.GIFT_NAMES.items() for x in (F.lit(g), F.lit(n))])
    per = decided.groupBy("gift").agg(
        F.count(F.lit(1)).alias("bookings"),
        sum_exact(F.col(prob_col)).alias("_psum"),
        sum_exact(F.col("cost_of_selected_gift")).alias("_csum"))
    # the total is a window over the <= 5 grouped rows, not a second pass over the bookings
    return per.select("*", F.sum("bookings").over(Window.partitionBy()).alias("_total")).select(
        "gift",
        F.coalesce(F.try_element_at(names, F.col("gift")),
                   F.when(F.col("gift").isNull(), F.lit(K.NO_GIFT_NAME)).otherwise(F.lit("Null"))).alias("gift_name"),
        "bookings",
        _pct(F.col("bookings"), F.col("_total")).alias("share_pct"),
        F.when(F.col("gift").isNotNull(), F.round(F.col("_psum") / F.col("bookings"), 6)).alias("avg_probability"),
        F.when(F.col("gift").isNotNull(), F.round(F.col("_csum") / F.col("bookings"), 4)).alias("avg_cost"),
    )


def prediction_stats(scored: DataFrame, pred_col: str = "predicted_to_cancel") -> DataFrame:
    """Total, predicted cancellations and their share."""
    a = scored.agg(F.count(F.lit(1)).alias("total_bookings"),
                   F.coalesce(F.sum(pred_col), F.lit(0)).cast("bigint").alias("predicted_cancellations"))
    return a.select("*", _pct(F.col("predicted_cancellations"), F.col("total_bookings")).alias("predicted_pct"))


def gift_coverage(decided: DataFrame, pred_col: str = "predicted_to_cancel") -> DataFrame:
    """Gifts / predicted cancellations * 100 (null when nothing is predicted)."""
    a = decided.agg(F.coalesce(F.sum(pred_col), F.lit(0)).cast("bigint").alias("predicted_cancellations"),
                    F.count_if(F.col("gift").isNotNull()).alias("gifts_assigned"))
    return a.select("*", F.when(F.col("predicted_cancellations") > 0,
                                _pct(F.col("gifts_assigned"), F.col("predicted_cancellations"), 4))
                    .alias("coverage_pct"))


def segment_bounds(threshold: float) -> list[tuple[float, float]]:
    lows = [threshold] + K.SEGMENT_UPPER_BOUNDS[:-1]
    return list(zip(lows, K.SEGMENT_UPPER_BOUNDS))


def probability_segments(decided: DataFrame, threshold: float, prob_col: str = "cancellation_probability",
                         pred_col: str = "predicted_to_cancel") -> DataFrame:
    """R5 (+A8): bookings and gifts per half-open band [lo, hi); empty bands omitted,
    nothing at all when no cancellation is predicted.  One CASE + one groupBy,
    instead of one filter per band; bands never overlap, p = 1.0 is in none."""
    p = F.col(prob_col)
    band = None
    for i, (lo, hi) in enumerate(segment_bounds(threshold)):
        cond = (p >= F.lit(float(lo))) & (p < F.lit(float(hi)))
        band = F.when(cond, F.lit(i)) if band is None else band.when(cond, F.lit(i))
    bounds = F.array(*[F.struct(F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"))
                       for lo, hi in segment_bounds(threshold)])
    # one pass: the out-of-band rows form the null group, which still feeds "anything
    # predicted?" (a window over the <= 6 grouped rows) and is dropped afterwards
    seg = (decided.select(band.alias("segment"), F.col("gift").isNotNull().cast("int").alias("_g"), F.col(pred_col))
                  .groupBy("segment").agg(F.count(F.lit(1)).alias("bookings"), F.sum("_g").cast("bigint").alias("gifts"),
                                          F.max(pred_col).alias("_anyp")))
    return (seg.select("*", F.max("_anyp").over(Window.partitionBy()).alias("_any"))
               .where(F.col("segment").isNotNull() & (F.col("_any") == 1))
               .select("segment", bounds[F.col("segment")]["lo"].alias("prob_low"),
                       bounds[F.col("segment")]["hi"].alias("prob_high"), "bookings", "gifts",
                       _pct(F.col("gifts"), F.col("bookings")).alias("gift_pct")))


def booked_vs_history(scored_all: DataFrame, prob_col: str = "cancellation_probability",
                      pred_col: str = "predicted_to_cancel", target: str = "target") -> DataFrame:
    """O1: predicted cancellation rate of still-open (``Booked``) bookings next to the
    predicted and actual late-cancellation rates of closed ones.  One groupBy on a
    two-valued cohort column."""
    cohort = F.when(F.col("reservation_status") == "Booked", F.lit("booked")).otherwise(F.lit("history"))
    is_hist = cohort == "history"
    g = scored_all.groupBy(cohort.alias("cohort")).agg(
        F.count(F.lit(1)).alias("bookings"),
        F.sum(pred_col).cast("bigint").alias("predicted_cancellations"),
        F.sum(F.when(is_hist, F.col(target))).cast("bigint").alias("actual_cancellations"),
        sum_exact(F.col(prob_col)).alias("_psum"))
    return g.select("cohort", "bookings", "predicted_cancellations",
                    F.round(safe_ratio(F.col("predicted_cancellations").cast("double"), F.col("bookings").cast("double")), 6)
                    .alias("predicted_rate"),
                    "actual_cancellations",
                    F.round(F.try_divide(F.col("actual_cancellations").cast("double"), F.col("bookings").cast("double")), 6)
                    .alias("actual_rate"),
                    F.round(F.col("_psum") / F.col("bookings"), 6).alias("avg_probability"))
