"""Fit / transform statistics.

Pattern: *fit* is one aggregate producing a one-row parameters frame (size
bound: one row), *transform* attaches it with a broadcast cross join and applies
Column expressions.  Parameters can be fitted on a training fold and applied to
any other frame, which is how leakage is avoided (D14).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from staysense.functions import constants as K
from staysense.functions.columns import clip, mean_exact_sql, present
from staysense.operators.quantiles import exact_quantile_row, modes


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]


def _attach(df: DataFrame, params: DataFrame) -> DataFrame:
    return df.crossJoin(F.broadcast(params))                    # params: exactly one row


# ------------------------------------------------------------------ I1 / I2 / I3
def fit_outlier_bounds(df: DataFrame, columns: Sequence[str] | None = None, method: str = "iqr",
                       factor: float = K.IQR_FACTOR, quantile_low: float = K.QUANTILE_LOW,
                       quantile_high: float = K.QUANTILE_HIGH) -> DataFrame:
    """Long frame ``(column, lower, upper)``; IQR: Q1 - f*IQR, Q3 + f*IQR; quantile: q_low, q_high.
    Default columns: all numeric ones (as the scoring-side capper does)."""
    if method not in ("iqr", "quantile"):
        raise ValueError(f"outlier bounds are fitted by 'iqr' or 'quantile', not {method!r}")
    cols = present(df, columns) if columns is not None else numeric_columns(df)
    probs = [0.25, 0.75] if method == "iqr" else [quantile_low, quantile_high]
    q = exact_quantile_row(df, {c: probs for c in cols})            # all columns, same passes
    rows = []
    for c in cols:
        a, b = F.col(c)[0], F.col(c)[1]
        if method == "iqr":
            lo, hi = a - F.lit(factor) * (b - a), b + F.lit(factor) * (b - a)
        else:
            lo, hi = a, b
        rows.append(F.struct(F.lit(c).alias("column"), lo.alias("lower"), hi.alias("upper")))
    return q.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def _bounds_row(bounds: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long bounds -> one row with ``{c}__lo`` / ``{c}__hi`` columns."""
    aggs = []
    for c in cols:
        aggs += [F.max(F.when(F.col("column") == c, F.col("lower"))).alias(f"{c}__lo"),
                 F.max(F.when(F.col("column") == c, F.col("upper"))).alias(f"{c}__hi")]
    return bounds.agg(*aggs)


def cap_outliers(df: DataFrame, bounds: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """I1/I2 transform: clip each column to its bounds; nulls stay null (np.clip keeps NaN)."""
    if columns is None:   # names only: <= one row per column
        columns = [r["column"] for r in bounds.select("column").distinct().collect()]
    cols = present(df, columns)
    row = _bounds_row(bounds, cols)
    out = _attach(df, row)
    for c in cols:
        out = out.withColumn(c, clip(c, F.col(f"{c}__lo"), F.col(f"{c}__hi")))
    return out.drop(*[f"{c}__{s}" for c in cols for s in ("lo", "hi")])


def outlier_counts(df: DataFrame, bounds: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column, how many values fall outside the bounds (one pass, all columns)."""
    if columns is None:
        columns = [r["column"] for r in bounds.select("column").collect()]
    cols = present(df, columns)
    row = _bounds_row(bounds, cols)
    x = _attach(df, row)
    counts = x.agg(*[F.count_if((F.col(c) < F.col(f"{c}__lo")) | (F.col(c) > F.col(f"{c}__hi"))).alias(c)
                     for c in cols])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("outliers"))
                                             for c in cols])).alias("s")).select("s.*")


# ------------------------------------------------------------------ I5 / I6 / I7
def fit_imputer(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
                strategy: str = "mean") -> DataFrame:
    """One-row fill values: numeric by ``mean`` or exact ``median``; categorical by mode."""
    numeric, categorical = present(df, numeric), present(df, categorical)
    parts = []
    if numeric:
        if strategy == "mean":
            parts.append(df.agg(*[F.expr(mean_exact_sql(c)).alias(c) for c in numeric]))
        elif strategy == "median":
            q = exact_quantile_row(df, {c: [0.5] for c in numeric})
            parts.append(q.select(*[F.col(c)[0].alias(c) for c in numeric]))
        else:
            raise ValueError(f"unknown strategy {strategy!r}")
    if categorical:
        parts.append(modes(df, categorical))
    row = parts[0]
    for p in parts[1:]:
        row = row.crossJoin(p)
    return row


def apply_imputer(df: DataFrame, fills: DataFrame, suffix: str = "__fill") -> DataFrame:
    """``coalesce(column, fitted value)`` for every column of ``fills``, in one projection."""
    cols = set(fills.columns)
    renamed = fills.selectExpr(*[f"`{c}` AS `{c}{suffix}`" for c in fills.columns])
    out = _attach(df, renamed)
    return out.select(*[F.expr(f"coalesce(`{c}`, `{c}{suffix}`)").alias(c) if c in cols else F.col(f"`{c}`")
                        for c in df.columns])


def impute_constant(df: DataFrame, values: dict) -> DataFrame:
    """Constant fill (``'missing'``, 0, ...)."""
    return df.fillna(values)


# ------------------------------------------------------------------------ I8
def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """I8 fit: mean and *population* std per column (as the reference scaler)."""
    cols = present(df, columns)
    return df.agg(*[a for c in cols for a in (F.avg(c).alias(f"{c}__mu"), F.stddev_pop(c).alias(f"{c}__sd"))])


def apply_scaler(df: DataFrame, params: DataFrame) -> DataFrame:
    """(x - mean) / std; a constant column (std 0) maps to 0."""
    cols = [c[:-4] for c in params.columns if c.endswith("__mu")]
    out = _attach(df, params)
    for c in cols:
        sd = F.col(f"{c}__sd")
        out = out.withColumn(c, F.when(sd == 0, F.lit(0.0)).otherwise((F.col(c) - F.col(f"{c}__mu")) / sd))
    return out.drop(*params.columns)


# ------------------------------------------------------------------------ I9
def one_hot_columns(df: DataFrame, column: str, categories: Sequence[str], prefix: str | None = None) -> DataFrame:
    """I9 in expression form: one 0/1 column per known category, all-zero for unseen / null
    (``handle_unknown='ignore'``).  The pipeline form is ``StringIndexer`` +
    ``OneHotEncoder`` in ``operators.model``."""
    p = prefix or column
    return df.select("*", *[F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{p}_{v}")
                            for v in categories])


# ------------------------------------------------------------------------ I11
GIFT_FIXED_FILL_EXCLUDE = ["stay_nights", "total_guests", "rate", "board", "required_car_parking_spaces",
                           "arrival_date", "booking_date", "lead_time", "hotel_id"]


def fit_gift_imputation(df: DataFrame, key_cols: Sequence[str] = ("booking_id",)) -> DataFrame:
    """I11 fit: one-row frame of means (numeric) and modes (text, boolean, timestamp)
    for every column outside the fixed-default list."""
    skip = set(GIFT_FIXED_FILL_EXCLUDE) | set(key_cols)
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, NumericType):
            num.append(f.name)
        elif isinstance(f.dataType, (StringType, BooleanType, TimestampType, TimestampNTZType, DateType)):
            cat.append(f.name)
    if not (num or cat):
        return None
    fills = fit_imputer(df, num, cat, "mean")
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}      # no value at all: a word for it
    return fills.select(*[F.coalesce(c, F.lit(K.UNKNOWN_TEXT)).alias(c) if c in text else F.col(c) for c in fills.columns])


def apply_gift_imputation(df: DataFrame, fills: DataFrame | None, as_of,
                          nights: int = K.DEFAULT_NIGHTS, guests: int = K.DEFAULT_GUESTS,
                          rate: float = K.DEFAULT_RATE, board: str = K.DEFAULT_BOARD,
                          arrival_days: int = K.ARRIVAL_FALLBACK_DAYS) -> DataFrame:
    """I11 transform: fixed defaults for the decision inputs (nights/guests truncated to
    int), fitted fills for the rest, arrival falls back to ``as_of`` + 30 days.
    Works on a stream too (``fills`` is a static one-row frame)."""
    fixed = {"stay_nights": f"CAST(coalesce(stay_nights, {float(nights)!r}D) AS INT)",
             "total_guests": f"CAST(coalesce(total_guests, {float(guests)!r}D) AS INT)",
             "rate": f"coalesce(CAST(rate AS DOUBLE), {float(rate)!r}D)",
             "board": f"coalesce(board, '{board}')"}
    types = {f.name: f.dataType for f in df.schema.fields}
    if isinstance(types.get("required_car_parking_spaces"), NumericType):     # fillna(0) semantics
        fixed["required_car_parking_spaces"] = "coalesce(required_car_parking_spaces, 0)"
    fallback = f"CAST('{as_of}' AS TIMESTAMP_NTZ) + make_dt_interval({int(arrival_days)})"
    fixed["arrival_date"] = f"coalesce(arrival_date, {fallback})" if "arrival_date" in types else fallback
    out = df.select(*[F.expr(fixed[c]).alias(c) if c in fixed else F.col(f"`{c}`") for c in df.columns],
                    *([] if "arrival_date" in types else [F.expr(fallback).alias("arrival_date")]))
    return apply_imputer(out, fills) if fills is not None else out


def impute_for_gifting(df: DataFrame, as_of, key_cols: Sequence[str] = ("booking_id",), **defaults) -> DataFrame:
    """I11 on one batch: fit on ``df`` itself, then apply (``as_of`` replaces "now")."""
    return apply_gift_imputation(df, fit_gift_imputation(df, key_cols), as_of, **defaults)
