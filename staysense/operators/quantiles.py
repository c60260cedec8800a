"""Exact quantiles and modes without funnelling a column through one task.

``F.percentile`` / ``F.median`` keep every distinct value of the column in the
final aggregation buffer of a single task, which does not survive a 100 TB
column.  ``exact_quantiles`` gets the same numbers (linear interpolation
between the order statistics at ``floor/ceil((n-1)p)``) in bounded memory, for
several columns at once:

1. one pass: per column ``count`` and a ``percentile_approx`` sketch at
   ``p ± margin``; the sketch's rank guarantee brackets each wanted order
   statistic in ``[lo, hi]`` (for large inputs);
2. one pass: rows are histogrammed into ``bins`` equal-width buckets of the
   bracket plus one bucket below and one above it, per (column, quantile)
   (partial aggregation; output <= columns x quantiles x (bins + 2) rows);
3. a tiny running sum over the histogram picks the bucket holding each rank;
4. only rows of those buckets are grouped by value (a hot value collapses to
   one row map-side) and a running count per bucket yields the exact value.

Every intermediate is a partially-aggregated shuffle or a frame bounded by
parameters (columns x quantiles x bins), so broadcasting it is safe.  The
answer is exact even when the bracket misses (then an outer bucket is ranked).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ACCURACY = 10_000
_BINS = 4_096


def lower_bound_index(sorted_values: list[float] | str, n: int, x: str, strict: bool = True) -> Column:
    """Codegen-friendly binary search: number of ``v`` with ``v < x`` (``strict``) or
    ``v <= x`` among ``n`` ascending values — a literal list, or the name of an array
    column.  Emitted as one SQL ``CASE`` tree of depth log2(n) (a single parse on the
    JVM, no per-node Python round trips), instead of an interpreted lambda."""
    def at(i: int) -> str:
        if isinstance(sorted_values, str):
            return f"`{sorted_values}`[{i}]"
        return f"CAST({float(sorted_values[i])!r} AS DOUBLE)"
    op = "<" if strict else "<="

    def go(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {at(mid)} {op} `{x}` THEN {go(mid + 1, hi)} ELSE {go(lo, mid)} END"
    return F.expr(go(0, n))


def exact_quantiles_long(df: DataFrame, columns: Sequence[str], probs: Sequence[float], *,
                         accuracy: int = _ACCURACY, bins: int = _BINS) -> DataFrame:
    """Long result ``(_c, _k, _q)``: column index, quantile index, exact value."""
    probs = [float(p) for p in probs]
    k, m = len(probs), len(columns)
    margin = 3.0 / accuracy
    cells = F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_x"))
                      for i, c in enumerate(columns)])
    base = (df.select(F.explode(cells).alias("_e")).select("_e._c", "_e._x")
              .where(F.col("_x").isNotNull() & ~F.isnan("_x")))

    lows = [max(0.0, p - margin) for p in probs]
    highs = [min(1.0, p + margin) for p in probs]
    stats = base.groupBy("_c").agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_x", F.array(*[F.lit(v) for v in lows + highs]), accuracy).alias("_b"))
    tgt = stats.select("_c", "_n", F.posexplode(F.array(*[F.lit(p) for p in probs])).alias("_k", "_p"), "_b")
    h = (F.col("_n") - 1).cast("double") * F.col("_p")
    tgt = tgt.select("_c", "_k",
                     F.col("_b")[F.col("_k")].alias("_lo"), F.col("_b")[F.col("_k") + k].alias("_hi"),
                     F.floor(h).alias("_r0"), F.ceil(h).alias("_r1"), (h - F.floor(h)).alias("_frac"))
    tgt_b = F.broadcast(tgt)                                     # <= columns x quantiles rows

    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    tgt_j = tgt_b.withColumnRenamed("_c", "_tc")
    # bucket -1 = below the bracket, ``bins`` = above it; for large inputs the wanted ranks
    # always land inside, for tiny inputs (bracket narrower than a rank) an outer bucket is
    # simply picked and ranked exactly like any other.
    binned = (base.join(tgt_j, F.col("_c") == F.col("_tc"))
                  .select("_c", "_k", "_x",
                          F.when(F.col("_x") < F.col("_lo"), F.lit(-1))
                           .when(F.col("_x") > F.col("_hi"), F.lit(bins))
                           .when(width > 0, F.least(F.floor((F.col("_x") - F.col("_lo")) / width), F.lit(bins - 1)))
                           .otherwise(F.lit(0)).alias("_bin")))
    hist = binned.groupBy("_c", "_k", "_bin").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy("_c", "_k").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumn("_cum", F.sum("_cnt").over(w)).withColumn("_before", F.col("_cum") - F.col("_cnt"))
    ranks = tgt.select("_c", "_k", F.explode(F.array(
        F.struct(F.lit(0).alias("_which"), F.col("_r0").alias("_r")),
        F.struct(F.lit(1).alias("_which"), F.col("_r1").alias("_r")))).alias("_t")).select("_c", "_k", "_t.*")
    where = (F.broadcast(ranks).join(hist, ["_c", "_k"])
             .where((F.col("_before") <= F.col("_r")) & (F.col("_r") < F.col("_cum")))
             .select("_c", "_k", "_which", "_r", "_bin", "_before"))

    picked = F.broadcast(where.select("_c", "_k", "_bin").distinct())   # <= 2 x columns x quantiles
    vals = (binned.join(picked, ["_c", "_k", "_bin"])
                  .groupBy("_c", "_k", "_bin", "_x").agg(F.count(F.lit(1)).alias("_vc")))
    wv = Window.partitionBy("_c", "_k", "_bin").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    vals = vals.withColumn("_vcum", F.sum("_vc").over(wv))
    hit = (vals.join(F.broadcast(where), ["_c", "_k", "_bin"])
               .where((F.col("_before") + F.col("_vcum") - F.col("_vc") <= F.col("_r"))
                      & (F.col("_r") < F.col("_before") + F.col("_vcum")))
               .groupBy("_c", "_k").agg(F.min(F.when(F.col("_which") == 0, F.col("_x"))).alias("_v0"),
                                        F.min(F.when(F.col("_which") == 1, F.col("_x"))).alias("_v1")))
    return tgt.join(hit, ["_c", "_k"], "left").select(
        "_c", "_k",
        F.when(F.col("_v0").isNull() | F.col("_v1").isNull(),
               F.raise_error(F.lit("quantile bracket missed its rank"))).otherwise(
            F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.col("_frac")).alias("_q"))


def exact_quantile_row(df: DataFrame, specs: dict[str, Sequence[float]], **kw) -> DataFrame:
    """One row, one array column per input column (``{col: probs}``), all columns in the
    same passes.  Columns without values give nulls."""
    cols = list(specs)
    probs = sorted({float(p) for ps in specs.values() for p in ps})
    long = exact_quantiles_long(df, cols, probs, **kw)
    m = long.agg(F.map_from_entries(F.collect_list(F.struct(F.struct("_c", "_k"), F.col("_q")))).alias("_m"))
    out = []
    for i, c in enumerate(cols):
        idx = [probs.index(float(p)) for p in specs[c]]
        out.append(F.array(*[F.col("_m")[F.struct(F.lit(i).alias("_c"), F.lit(j).alias("_k"))] for j in idx]).alias(c))
    return m.select(*out)


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], *, out: str = "q", **kw) -> DataFrame:
    """One row with ``out`` = array of exact quantiles of ``column``."""
    return exact_quantile_row(df, {column: probs}, **kw).withColumnRenamed(column, out)


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: most frequent non-null value per column, ties -> smallest (pandas ``mode()[0]``).

    All columns in one pass: rows are unpivoted to (column, value-as-text), counted
    with a partially-aggregated ``groupBy`` (a hot value collapses map-side,
    distinct values spread over shuffle partitions), and the best value per
    column is picked by comparing on the original type.
    """
    columns = list(columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = "array(" + ", ".join(f"named_struct('_c', {i}, '_v', CAST(`{c}` AS STRING))"
                                 for i, c in enumerate(columns)) + ")"
    g = (df.select(F.expr(f"inline({cells})")).where("_v IS NOT NULL")
           .groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n")))
    return g.agg(*[F.expr(f"min(CASE WHEN _c = {i} THEN named_struct('_neg', -_n, '_val', "
                          f"CAST(_v AS {types[c].simpleString()})) END)._val").alias(c)
                   for i, c in enumerate(columns)])
