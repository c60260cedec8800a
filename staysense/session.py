"""Session construction and lineage cutting.

Library code never hard-codes a checkpoint folder: it reads
``spark.checkpoint.dir`` from the session (the cluster names a shared folder
there) and only a local/test session gets a scratch folder of its own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def build_session(master: str | None = None, app: str = "staysense",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests / bench.  On a cluster use the provided session instead."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = (SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
         .config("spark.driver.memory", "16g")
         # a fused stage (scan -> joins -> imputation -> gift decision -> partial agg) generates one
         # processNext() beyond HotSpot's 8000-byte JIT limit; without this flag it runs interpreted
         .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
         .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a scratch one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="staysense-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the session's shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def dealt(df: DataFrame, rows_per_task: int = 20_000, most_rows: int = 250_000) -> DataFrame:
    """``df`` stored once (``cut_lineage``) and dealt evenly to tasks, for what passes over it many times.

    A join or a scan may leave all rows in one partition.  Here as many tasks as there are cores get about the same
    number of rows, fewer if they would have less than ``rows_per_task``, more if they would have over ``most_rows``.
    """
    n = df.count()
    parts = max(min(df.sparkSession.sparkContext.defaultParallelism, n // rows_per_task), -(-n // most_rows))
    return cut_lineage(df.repartition(parts) if parts > 1 else df)
