"""A fixed-coefficient logistic scorecard.

Used where a deterministic probability is needed independently of any training
run (oracle-checkable metrics, gift decisions, reports).  ``p`` is rounded to 6
decimals before use so every engine ranks and thresholds identical values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staysense.operators.prepare import is_foreign

# scorecard coefficients: intercept, lead_time, stay_nights, special_requests, is_foreign
COEFFICIENTS = (-2.0, 0.012, 0.10, -0.30, 0.50)


def scorecard_probability(df: DataFrame, out: str = "cancellation_probability",
                          coefficients=COEFFICIENTS) -> DataFrame:
    b0, b_lead, b_nights, b_req, b_foreign = coefficients
    z = (F.lit(b0)
         + F.lit(b_lead) * F.coalesce(F.col("lead_time"), F.lit(0))
         + F.lit(b_nights) * F.coalesce(F.col("stay_nights"), F.lit(0.0))
         + F.lit(b_req) * F.coalesce(F.col("special_requests"), F.lit(0.0))
         + F.lit(b_foreign) * is_foreign(df))
    return df.withColumn(out, F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 6))
