"""A training-data pipeline over ``documents``: quality rules, line dedup, near-dedup, mixing, tokenising.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns what goes
on.  All but the last return the columns they were given; ``n_chars`` follows the text.

Null, empty and very long texts, ties, repeated rows and null ids have the results that the operators' docstrings
define: quality rules drop null and empty texts, so that later stages see them only when called by themselves.  Extra
columns stay as they are in all stages but the last, whatever their names, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staysense.llm import bpe_tree, line_quality, line_runs, simhash_mih, source_mix
from staysense.llm.common import stored, table


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are mostly boilerplate of their host go, and boilerplate lines of the others."""
    return _counted(line_quality.keep_documents(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are cut out of the texts; documents that had nothing else go."""
    out = line_runs.drop_repeats(docs, removed_col="__removed")
    something = (F.size("__removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _counted(out.where(something).drop("__removed"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the least id stays."""
    return simhash_mih.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each reading of a document that the mix takes."""
    return _counted(source_mix.mixed_documents(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and digests of them and of the text that they decode to."""
    return bpe_tree.encode_decode(docs, bpe_tree.read_spec(), keep=("ids",))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup),
          ("mix_sources", mix_sources), ("tokenize", tokenize)]
ORACLE_SQL = None       # fingerprint components and BPE have no SQL form: tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last returns is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
