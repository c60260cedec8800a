"""Splits and folds (K1-K4) without sorting the whole table.

Row order comes from ``hash60(key, seed)`` (md5-based, engine independent,
stable under recomputation).  A stratified split or k-fold only needs, per
class, the rows sitting at a few *ranks* of that order.  ``rank_cutoffs``
finds them with a 65,536-bin histogram of the hash (one partially-aggregated
pass), a running sum over the bins (<= 65,536 rows per class) and an exact
ranking of the rows in the few bins that contain a cut.  The assignment itself
is then a map-only comparison against a broadcast list of cut points: the
large table is never shuffled or sorted.  The hash is uniform, so no bin can be
hot even if one class holds most rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staysense.functions import constants as K
from staysense.functions.columns import hash60
from staysense.session import cut_lineage

_BIN_SHIFT = 44          # 60-bit hash -> top 16 bits


def _with_hash(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.withColumn("_h", hash60(key, seed))


def class_histogram(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., _bin, _c, _before, _n): counts per hash bin with running offsets per class."""
    by = list(by)
    hist = df.groupBy(*by, F.shiftright("_h", _BIN_SHIFT).alias("_bin")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    return hist.select(*by, "_bin", "_c", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_before"),
                       F.sum("_c").over(Window.partitionBy(*by)).alias("_n"))


def rank_cutoffs(df: DataFrame, by: Sequence[str], key: str, targets: DataFrame, hist: DataFrame) -> DataFrame:
    """Rows at given 1-based ranks of the (_h, key) order within each class.

    ``targets``: (by..., _t, _rank) — a few rows per class.  Returns (by..., _t, _ch, _ck).
    """
    by = list(by)
    tb = (targets.join(hist, by)
                 .where((F.col("_before") < F.col("_rank")) & (F.col("_rank") <= F.col("_before") + F.col("_c")))
                 .select(*by, "_t", "_bin", (F.col("_rank") - F.col("_before")).alias("_rin")))
    bins = F.broadcast(tb.select(*by, "_bin").distinct())       # <= classes x cuts rows
    inbin = df.withColumn("_bin", F.shiftright("_h", _BIN_SHIFT)).join(bins, by + ["_bin"])
    w = Window.partitionBy(*by, "_bin").orderBy("_h", key)
    ranked = inbin.select(*by, "_bin", "_h", F.col(key).alias("_k"), F.row_number().over(w).alias("_rin"))
    return ranked.join(F.broadcast(tb), by + ["_bin", "_rin"]).select(*by, "_t", F.col("_h").alias("_ch"),
                                                                       F.col("_k").alias("_ck"))


def _at_or_after(cut: Column, key: str) -> Column:
    return (F.col("_h") > cut["_ch"]) | ((F.col("_h") == cut["_ch"]) & (F.col(key) >= cut["_ck"]))


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = K.TEST_FRACTION,
                     seed: int = K.SEED, out: str = "is_test") -> DataFrame:
    """K1: per class exactly round(test_fraction * n_class) rows go to test (0/1 column)."""
    x = _with_hash(df, key, seed)
    hist = class_histogram(x, [label])
    sizes = hist.select(label, "_n").distinct()
    targets = (sizes.select(label, F.lit(0).alias("_t"),
                            (F.round(F.col("_n").cast("double") * F.lit(float(test_fraction)))).cast("bigint").alias("_cnt"))
                    .where(F.col("_cnt") < F.col("_n"))
                    .select(label, "_t", (F.col("_cnt") + 1).alias("_rank")))   # first *train* rank
    cuts = rank_cutoffs(x, [label], key, targets, hist)
    cut = cuts.groupBy(label).agg(F.first(F.struct("_ch", "_ck")).alias("_cut"))
    res = x.join(F.broadcast(cut), label, "left")               # one row per class
    return res.withColumn(out, F.when(F.col("_cut").isNull(), F.lit(1))
                          .otherwise(F.when(_at_or_after(F.col("_cut"), key), F.lit(0)).otherwise(F.lit(1)))) \
              .drop("_cut", "_h")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 3, seed: int = K.SEED,
                     out: str = "fold") -> DataFrame:
    """K3: fold = floor((rank - 1) * k / n_class) on the hash order; fold sizes per class
    differ by at most one."""
    x = _with_hash(df, key, seed)
    hist = class_histogram(x, [label])
    sizes = hist.select(label, "_n").distinct()
    js = F.sequence(F.lit(1), F.lit(k - 1)) if k > 1 else F.array().cast("array<int>")
    targets = (sizes.select(label, "_n", F.explode(js).alias("_t"))
                    .select(label, "_t", "_n", (F.expr(f"(_t * _n + {k} - 1) div {k}") + 1).alias("_rank"))
                    .where(F.col("_rank") <= F.col("_n")).drop("_n"))
    cuts = rank_cutoffs(x, [label], key, targets, hist)
    arr = cuts.groupBy(label).agg(F.collect_list(F.struct("_ch", "_ck")).alias("_cuts"))   # <= k-1 per class
    res = x.join(F.broadcast(arr), label, "left")
    fold = F.size(F.filter(F.coalesce(F.col("_cuts"), F.array().cast("array<struct<_ch:bigint,_ck:bigint>>")),
                           lambda c: _at_or_after(c, key)))
    return res.withColumn(out, fold).drop("_cuts", "_h")


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "_rn") -> DataFrame:
    """Dense 1-based row number over a total order, distributed: range-partitioned sort,
    per-partition counts (one row per partition) -> offsets -> offset + position.
    The sorted frame is checkpointed so both uses read the same materialised rows."""
    s = df.orderBy(*order).withColumn("_pid", F.spark_partition_id()) \
          .withColumn("_mid", F.monotonically_increasing_id())
    s = cut_lineage(s)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    offs = counts.select("_pid", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return s.join(F.broadcast(offs), "_pid").withColumn(out, F.col("_off") + local + 1).drop("_pid", "_mid", "_off")


def stratified_group_folds(df: DataFrame, label: str, group: str, k: int = K.GROUP_FOLDS, seed: int = K.SEED,
                           out: str = "fold") -> DataFrame:
    """K2: every group lands in exactly one fold; groups are dealt serpentine-wise in
    order of (positives desc, size desc, hash) so positives spread evenly.
    Work is on the group-level table; the fold id returns by a join on the group key
    (broadcast only when the group table passes the size check)."""
    from staysense.functions.joins import bounded_broadcast
    groups = df.groupBy(group).agg(F.sum(F.col(label).cast("bigint")).alias("_gpos"),
                                   F.count(F.lit(1)).alias("_gn"))
    groups = groups.withColumn("_gh", hash60(group, seed))
    ranked = global_row_number(groups, [F.col("_gpos").desc(), F.col("_gn").desc(), F.col("_gh"), F.col(group)])
    r0 = F.col("_rn") - 1
    pos = r0 % k
    fold = F.when((F.floor(r0 / k) % 2) == 0, pos).otherwise(F.lit(k - 1) - pos).cast("int")
    gf = ranked.select(group, fold.alias(out))
    return df.join(bounded_broadcast(gf), group, "left")


BATCH_GROUPS = 2_048


def least_deviation_group_folds(df: DataFrame, label: str, group: str, classes: Sequence = (0, 1),
                                k: int = K.GROUP_FOLDS, seed: int = K.SEED, out: str = "fold",
                                batch: int = BATCH_GROUPS) -> DataFrame:
    """K2 by least deviation: groups, the most lopsided class counts first, go one by one to the fold that then leaves
    the class shares most even over the folds (mean over the classes of the standard deviation of a fold's share;
    then the fold with fewer rows, then the lower one).  Ties in the order go by a hash of the group.

    The state is an array of class counts per fold, folded over the ordered group table (rows never move for it).
    ``batch`` groups of neighbouring rank are one fold's work, so that no task holds the whole group table: up to
    ``batch`` groups the rule is applied as a whole; beyond, each batch is evened out by itself against its own totals,
    and its folds are turned by its number, so that what is left over does not pile up in fold 0.
    A null group is a group; rows whose label is none of ``classes`` count in no class and follow their group."""
    from staysense.functions.joins import bounded_broadcast
    classes, c = list(classes), len(classes)
    counts = F.array(*[F.count(F.when(F.col(label) == F.lit(v), F.lit(1))) for v in classes])
    groups = df.groupBy(F.col(group).alias("_g")).agg(counts.alias("_c")).withColumn("_gh", hash60("_g", seed))
    total = " + ".join(f"_c[{i}]" for i in range(c))
    spread = f"{c} * ({' + '.join(f'_c[{i}] * _c[{i}]' for i in range(c))}) - ({total}) * ({total})"
    ranked = global_row_number(groups.withColumn("_spread", F.expr(spread)),
                               [F.col("_spread").desc(), F.col("_gh"), F.col("_g").asc_nulls_first()])
    batches = ranked.groupBy(F.expr(f"CAST((_rn - 1) div {batch} AS BIGINT)").alias("_b")).agg(
        F.sort_array(F.collect_list(F.struct("_rn", "_g", "_c"))).alias("_gs"),           # <= batch groups
        *[F.sum(F.col("_c")[i]).alias(f"_t{i}") for i in range(c)])

    def deviation(i: int) -> str:
        """k squared times the variance of class i over the folds, if fold f takes group x; shares need no more."""
        sums = f"(aggregate(s.n, 0L, (a, r) -> a + r[{i}]) + x._c[{i}])"
        squares = (f"(aggregate(s.n, 0D, (a, r) -> a + CAST(r[{i}] AS DOUBLE) * r[{i}]) + "
                   f"(2D * s.n[f][{i}] + x._c[{i}]) * x._c[{i}])")
        return (f"CASE WHEN _t{i} = 0 THEN 0D ELSE sqrt(greatest({k}D * {squares} - CAST({sums} AS DOUBLE) * {sums}, 0D)) "
                f"/ CAST(_t{i} AS DOUBLE) END")

    even = " + ".join(f"({deviation(i)})" for i in range(c))
    rows = " + ".join(f"s.n[f][{i}]" for i in range(c))
    best = (f"array_min(transform(sequence(0, {k - 1}), f -> struct(CAST(floor(({even}) * 1e9D) AS BIGINT) AS dev, "
            f"{rows} AS held, f AS f))).f")
    zero = f"array_repeat(array_repeat(0L, {c}), {k})"
    took = ", ".join(f"r[{i}] + IF(f = s.best, s.x._c[{i}], 0L)" for i in range(c))
    step = (f"element_at(transform(array(named_struct('x', x, 'n', s.n, 'folds', s.folds, 'best', {best})), s -> "
            f"named_struct('n', transform(s.n, (r, f) -> array({took})), 'folds', concat(s.folds, array(s.best)))), 1)")
    folds = batches.withColumn("_fs", F.expr(
        f"aggregate(_gs, named_struct('n', {zero}, 'folds', CAST(array() AS ARRAY<INT>)), (s, x) -> {step}, s -> s.folds)"))
    gf = folds.select(F.explode(F.expr(f"zip_with(_gs, _fs, (x, f) -> struct(x._g AS _g, "
                                       f"CAST((f + _b) % {k} AS INT) AS {out}))")).alias("_x")).select("_x.*")
    return df.join(bounded_broadcast(gf), F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")


def fold_rows(df: DataFrame, i: int, fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """K4: (train, validation) rows of fold ``i``."""
    return df.where(F.col(fold_col) != i), df.where(F.col(fold_col) == i)
