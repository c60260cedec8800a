"""I4: k-nearest-neighbour imputation with the NaN-aware Euclidean distance, as a fitted step.

Semantics (uniform weights): ``fit`` keeps the training rows as donors and the training column means; ``transform``
fills any rows, those of the training set or new ones.  For a row missing column ``c`` the donors are training rows
where ``c`` is present; the distance uses the coordinates present in both rows, ``sqrt(n / m * sum of squares)``
(``n`` columns, ``m`` shared); the value is the mean of ``c`` over the ``k`` nearest donors with a defined distance
(ties -> smaller key); with no such donor the training mean is used.  Each column is imputed from the original data.
A row is never its own donor: it misses the column that a donor has.

Distributed exactly, without all pairs: rows are grouped by *missing pattern*.
For one (receiver pattern, donor pattern) pair the distance is a plain
Euclidean distance on their shared coordinates times a constant, so rows are
masked to those coordinates and ``knn_grouped`` (cell-pruned, exact) finds the
k nearest donors per pattern pair.  The true top-k for a column lies in the
union of those lists over the donor patterns that have the column; the final
ranking recomputes the scaled distance with one sequential SQL expression.
Only the patterns (at most 2^columns) reach the driver, never rows.

Defined results: rows without any missing value and other columns come back as they are; a training set without
rows, or a column without a value in it, leaves the nulls; ``key`` must be unique in each frame, and a training row
and a new row may share one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staysense.functions import constants as K
from staysense.functions.columns import mean_exact
from staysense.operators.neighbors import knn_grouped
from staysense.session import cut_lineage


def _seq_sq_dist(a: str, b: str, n: int) -> str:
    """Sequential sum of squared differences over the shared (non-null) coordinates."""
    terms = [f"CASE WHEN {a}[{i}] IS NOT NULL AND {b}[{i}] IS NOT NULL "
             f"THEN ({a}[{i}] - {b}[{i}]) * ({a}[{i}] - {b}[{i}]) ELSE CAST(0.0 AS DOUBLE) END" for i in range(n)]
    expr = terms[0]
    for t in terms[1:]:
        expr = f"({expr}) + ({t})"
    return expr


def _vectors(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """(id, v, p): key, values as one array, and the pattern of those present as a bit mask."""
    pat = F.lit(0)
    for i, c in enumerate(columns):
        pat = pat + F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0))
    return df.select(F.col(key).alias("id"), F.array(*[F.col(c).cast("double") for c in columns]).alias("v"),
                     pat.alias("p"))


@dataclass(frozen=True)
class KnnImputer:
    """Donors (id, v, p), the training means (one row, columns ``_m0`` ...) and the settings of a fitted imputer."""

    donors: DataFrame
    means: DataFrame
    columns: tuple[str, ...]
    k: int = K.KNN_NEIGHBORS
    seed: int = K.SEED

    @staticmethod
    def fit(df: DataFrame, columns: Sequence[str], key: str, k: int = K.KNN_NEIGHBORS,
            seed: int = K.SEED) -> KnnImputer:
        donors = cut_lineage(_vectors(df, columns, key).where("p <> 0"))
        means = cut_lineage(donors.select([mean_exact(F.col("v")[i]).alias(f"_m{i}") for i in range(len(columns))]))
        return KnnImputer(donors, means, tuple(columns), k, seed)

    def save(self, path: str) -> None:
        """Three Parquet folders under ``path``."""
        self.donors.write.mode("overwrite").parquet(f"{path}/donors")
        self.means.write.mode("overwrite").parquet(f"{path}/means")
        self.donors.sparkSession.createDataFrame(
            [(list(self.columns), self.k, self.seed)], "columns array<string>, k int, seed long").write.mode(
            "overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> KnnImputer:
        c = spark.read.parquet(f"{path}/settings").first()
        return KnnImputer(spark.read.parquet(f"{path}/donors"), spark.read.parquet(f"{path}/means"),
                          tuple(c["columns"]), c["k"], c["seed"])

    def _nearest(self, gaps: DataFrame) -> DataFrame | None:
        """(q_id, n_id): for each row with a gap its nearest donors per donor pattern; None if no pattern helps."""
        n = len(self.columns)
        have = dict(self.donors.groupBy("p").count().collect())                     # <= 2^n patterns, not rows
        want = [r[0] for r in gaps.select("p").distinct().collect()]
        pairs = [(pr, pd, pr & pd) for pr in sorted(want) for pd in sorted(have) if pd & ~pr and pr & pd]
        if not pairs:
            return None
        spark = gaps.sparkSession
        gt = spark.createDataFrame([(g, *x) for g, x in enumerate(pairs)], "g int, pr int, pd int, s int")
        # a donor appears once per pattern pair: dealt to as many tasks as these rows need
        copies = sum(have[pd] for _, pd, _ in pairs)
        parts = max(min(spark.sparkContext.defaultParallelism, copies // 20_000), -(-copies // 1_000_000))
        donors = self.donors if self.donors.rdd.getNumPartitions() >= parts else self.donors.repartition(parts)

        def masked(rows: DataFrame, side: str) -> DataFrame:
            # nearly all rows have one pattern, so rows never move by pattern: <= patterns^2 rows are broadcast
            j = rows.join(F.broadcast(gt), F.col("p") == F.col(side))
            mv = F.array(*[F.when((F.col("s").bitwiseAND(F.lit(1 << i))) != 0, F.col("v")[i])
                           .otherwise(F.lit(0.0)) for i in range(n)])
            return j.select("g", "id", mv.alias("mv"))

        return knn_grouped(masked(gaps, "pr"), masked(donors, "pd"), self.k, group="g", vec="mv", id_col="id",
                           exclude_self=False, seed=self.seed).select("q_id", "n_id").distinct()

    def transform(self, df: DataFrame, key: str) -> DataFrame:
        """``df`` with the fitted columns filled, as doubles; other columns untouched."""
        n = len(self.columns)
        x = cut_lineage(_vectors(df, self.columns, key))
        gaps = x.where(F.col("p") != (1 << n) - 1)
        lists = self._nearest(gaps)
        out = x.crossJoin(F.broadcast(self.means))             # one row
        if lists is not None:
            lists = cut_lineage(lists)                          # keys only; each column reads them
            a = gaps.select(F.col("id").alias("q_id"), F.col("v").alias("qv"))
            b = self.donors.select(F.col("id").alias("n_id"), F.col("v").alias("nv"))
            cand = lists.join(a, "q_id").join(b, "n_id")
            m = F.lit(0)
            for i in range(n):
                m = m + F.when(F.col("qv")[i].isNotNull() & F.col("nv")[i].isNotNull(), F.lit(1)).otherwise(F.lit(0))
            cand = cand.withColumn("_m", m).withColumn(
                "_d2", F.lit(float(n)) / F.col("_m").cast("double") * F.expr(_seq_sq_dist("qv", "nv", n)))
            fills = None
            for i in range(n):
                ci = (cand.where(F.col("qv")[i].isNull() & F.col("nv")[i].isNotNull())
                          .withColumn("_r", F.row_number().over(Window.partitionBy("q_id").orderBy("_d2", "n_id")))
                          .where(F.col("_r") <= self.k)
                          .groupBy("q_id").agg(F.avg(F.col("nv")[i]).alias(f"_f{i}")))
                fills = ci if fills is None else fills.join(ci, "q_id", "full")
            out = out.join(fills.withColumnRenamed("q_id", "id"), "id", "left")
        res = []
        for i, c in enumerate(self.columns):
            fill = F.coalesce(F.col(f"_f{i}"), F.col(f"_m{i}")) if lists is not None else F.col(f"_m{i}")
            res.append(F.coalesce(F.col("v")[i], fill).alias(c))
        return df.drop(*self.columns).join(out.select(F.col("id").alias(key), *res), key)


def knn_impute(df: DataFrame, columns: Sequence[str], key: str, k: int = K.KNN_NEIGHBORS,
               seed: int = K.SEED) -> DataFrame:
    """``df`` with ``columns`` imputed from its own rows (other columns untouched)."""
    return KnnImputer.fit(df, columns, key, k, seed).transform(df, key)
