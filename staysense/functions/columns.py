"""Column-level helpers: dates, null-guarded arithmetic, deterministic hashing.

All of these return ``Column`` expressions (JVM side, codegen), never UDFs.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

MICROS_PER_DAY = 86_400_000_000


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------------------- dates
def parse_timestamp(df: DataFrame, name: str, fmt: str | None = None, strict: bool = False) -> Column:
    """String -> timestamp_ntz.  ``strict`` raises on garbage (ANSI cast), otherwise null."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, TimestampNTZType):
        return c
    if isinstance(dtype, (TimestampType, DateType)):
        return c.cast("timestamp_ntz")
    if not isinstance(dtype, StringType):
        c = c.cast("string")
    if strict:
        return F.to_timestamp_ntz(c, F.lit(fmt)) if fmt else c.cast("timestamp_ntz")
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz") if fmt else F.expr(
        f"try_cast(`{name}` as timestamp_ntz)")


def day_diff(end: str | Column, start: str | Column) -> Column:
    """Whole elapsed days, floored (so -12h is -1), null if either side is null."""
    micros = F.timestamp_diff("MICROSECOND", col_or(start), col_or(end))
    return F.floor(micros / F.lit(MICROS_PER_DAY))


def weekday_mon0(c: str | Column) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(col_or(c))


# ------------------------------------------------------------------ null semantics
def null_guarded(c: Column, result: Column) -> Column:
    """``result`` where ``c`` is not null, else null (NumPy keeps NaN through clip/max)."""
    return F.when(c.isNull(), F.lit(None)).otherwise(result)


def clip(c: str | Column, lo: Column | float, hi: Column | float) -> Column:
    """Clip to [lo, hi] keeping nulls null (``least``/``greatest`` alone would skip them)."""
    x = col_or(c)
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return null_guarded(x, F.least(F.greatest(x, lo_c), hi_c))


def safe_ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """num / den with 0 / 0 (or null) -> ``default`` instead of an ANSI error."""
    r = F.try_divide(num, den)
    return r if default is None else F.coalesce(r, F.lit(default))


def flag(pred: Column) -> Column:
    """Boolean predicate -> 0/1 int, with null (NaN comparisons) counted as 0."""
    return F.coalesce(pred, F.lit(False)).cast("int")


def sum_exact(c: Column, scale: int = 6) -> Column:
    """Order-independent money sum: round to ``scale`` decimals, sum as DECIMAL, back to double.

    Double sums depend on partitioning; decimal sums give the same answer on any
    cluster layout and in the SQL oracle.
    """
    return F.sum(F.round(c, scale).cast(f"decimal(18,{scale})")).cast("double")


def mean_exact_sql(name: str, scale: int = 12) -> str:
    """Mean as exact DECIMAL sum / count: the same double on every partitioning (and in
    the SQL oracle), unlike a floating-point running sum."""
    return (f"try_divide(CAST(sum(CAST(`{name}` AS DECIMAL(38,{scale}))) AS DOUBLE), "
            f"CAST(count(`{name}`) AS DOUBLE))")


def mean_exact(c: str | Column, scale: int = 12) -> Column:
    x = col_or(c)
    return F.try_divide(F.sum(x.cast(f"decimal(38,{scale})")).cast("double"), F.count(x).cast("double"))


# ----------------------------------------------------------------------- hashing
def hash60(key: str | Column, seed: int) -> Column:
    """Deterministic 60-bit non-negative integer from md5(key || '|' || seed).

    Same value in every engine that has md5 (used for splits, folds, sampling)
    and independent of partitioning, so re-computation after executor loss
    reproduces the same assignment.
    """
    digest = F.md5(F.concat(col_or(key).cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def uniform01(key: str | Column, seed: int) -> Column:
    """Deterministic uniform in [0, 1) from ``hash60``."""
    return hash60(key, seed) / F.lit(float(1 << 60))


# ------------------------------------------------------------------------ misc
def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Keep only the columns that exist (the reference tolerates absent ones)."""
    have = set(df.columns)
    return [n for n in names if n in have]


def lit_array(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])
