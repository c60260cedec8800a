"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staysense.session import ensure_checkpoint_dir

WORD_GAP = r"[\x20\x09-\x0D]+"      # what separates words; everything else is part of a word


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a non-null text, in order."""
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only (``lower()`` would also touch other alphabets)."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_key(*cols: Column) -> Column:
    """64-bit key of a row by content: rows that agree in all of ``cols`` share it."""
    return F.xxhash64(*[F.coalesce(c.cast("string"), F.lit("\x00null")) for c in cols])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the session's shared checkpoint folder, and read again."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
