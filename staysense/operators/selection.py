"""Feature selection as aggregates (M12 variance filter, M13 ANOVA-F top-k).

Vectors are unpivoted with ``posexplode`` to (dimension, value) and reduced with
partially-aggregated ``groupBy``s; the per-dimension tables are tiny (one row
per dimension, or dimension x class), so ranking them is cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staysense.functions import constants as K


def _long(df: DataFrame, vector: str, extra=()) -> DataFrame:
    return df.select(*extra, F.posexplode(vector).alias("dim", "x")).withColumn("x", F.col("x").cast("double"))


def variance_filter(df: DataFrame, vector: str = "embedding", threshold: float = K.VARIANCE_THRESHOLD) -> DataFrame:
    """Population variance per dimension and whether it passes the threshold."""
    v = _long(df, vector).groupBy("dim").agg(F.var_pop("x").alias("variance"))
    return v.select("dim", F.round("variance", 8).alias("variance"), (F.col("variance") >= threshold).alias("kept"))


def anova_f(df: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per dimension: one-way ANOVA F statistic of the values across classes."""
    g = (_long(df, vector, [F.col(label).alias("_y")]).groupBy("dim", "_y")
         .agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("ss")))
    d = g.groupBy("dim").agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"), F.sum("s").alias("S"),
                             F.sum("ss").alias("SS"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between_raw"))
    ssb = F.col("between_raw") - F.col("S") * F.col("S") / F.col("N")
    ssw = F.col("SS") - F.col("between_raw")
    f = F.try_divide(ssb / (F.col("k") - 1), ssw / (F.col("N") - F.col("k")))
    return d.select("dim", f.alias("f_score"))


def anova_top_k(df: DataFrame, vector: str = "embedding", label: str = "label", k: int = K.ANOVA_TOP_K) -> DataFrame:
    """The ``k`` dimensions with the largest F (ties -> lower dimension)."""
    f = anova_f(df, vector, label)
    w = Window.orderBy(F.col("f_score").desc_nulls_last(), F.col("dim"))   # one row per dimension
    return (f.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
             .select("dim", F.round("f_score", 6).alias("f_score"), "rank"))
