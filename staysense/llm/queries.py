"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staysense.llm import (bpe_tree, byte_gru, doc_winnow, fim_wavelet, line_quality, line_runs, merkle, ngram_bloom, pii_spans,
                           secret_scan, simhash_mih, source_mix, url_templates)
from staysense.llm.common import table
from staysense.llm.oracle import ORACLE_SQL  # noqa: F401


def op1_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_quality.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "removed_words")


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
             ("block", "net/fr/")]


def op2_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels beside the rules: a url names its document by number, and ``labels`` has that document's."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(url_templates.host_path(F.col("url"))[1], r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1)
    named = pages.select(F.col("page_id").alias("id"), number.alias("number")).where("number <> ''").select(
        "id", F.col("number").cast("long").alias("doc_id"))
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    out = url_templates.judge(pages, URL_RULES, named.join(labels, "doc_id").select("id", "bad"))
    return out.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "template", "labelled",
                      F.round("bad_share", 9).alias("bad_share"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.taken(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op5_ngram_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_bloom.score(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_mih.group(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_gru.identify(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text after line dedup, and the numbers (from 0) of the lines that went."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_runs.drop_repeats(docs, removed_col="removed")
    return out.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"),
                      F.concat_ws(",", F.transform("removed", lambda x: x.cast("string"))).alias("removed_lines"))


def op9_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe_tree.encode_decode(docs, bpe_tree.read_spec(), keep=())


def op10_doc_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_winnow.digest(doc_winnow.compare_edited(table(spark, sf_dir, "documents")))


def op11_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans.digest(pii_spans.scan(table(spark, sf_dir, "documents")))


def op12_fim_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim_wavelet.transform(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"),
                      F.col("middle_units").alias("middle_chars"), F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim_wavelet.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row (by CRC-32 of its id) is checked with one added to ``n_chars``."""
    docs, columns = table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"]
    other = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in columns]
    seventh = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    rows = merkle.manifest(docs, columns, carry={"tampered": F.when(seventh, merkle.leaf_digest(other))})
    rows = rows.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (
    op1_quality_lines, op2_url_templates, op3_source_mix, op4_secret_scan, op5_ngram_bloom, op6_simhash, op7_byte_gru,
    op8_line_dedup, op9_bpe_tree, op10_doc_fingerprints, op11_pii_spans, op12_fim_wavelet, op13_merkle_manifest)}
