"""Quality rules by cross-document line frequency (operator 1), DataFrame functions only.

Every line is normalised (lower case, runs of blanks to one) and hashed; the distinct
documents that hold it are counted per host.  Lines above the host's limit are boilerplate
and removed; a document that loses too much of itself that way is rejected.

Exact copies of a text on one host count as one document, so a large group of copies does
not turn its own text into boilerplate (a dedup step handles copies).  With ``near_copies`` texts
that only vary the frequent lines count as one, too: what such a text has beside its host's frequent
lines is made of their word pairs, a line with a word changed.  A page of boilerplate with a few words of its own
stays a document of its own, as those words are no variation.  A line stays frequent then only if otherwise
different documents hold it.

Defined results: a null text is an empty text; a null host is a host of its own; rows that
agree in id, host and text get equal results, one per row; an empty table gives no rows;
other columns are ignored, whatever their names.  A text's words and lines are arrays of its row, so
memory follows the longest text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staysense.llm.common import row_key, words
from staysense.session import cut_lineage


@dataclass(frozen=True)
class LineRules:
    """A line is boilerplate on a host when more than ``max(min_docs, share * documents of the
    host)`` distinct documents hold it; a document is depleted when fewer than ``min_words``
    words are left or more than ``max_removed`` of its words went."""

    min_docs: int = 20
    share: float = 0.05
    min_words: int = 20
    max_removed: float = 0.5
    min_varied: float = 0.5         # share of frequent lines' word pairs in the rest of a near copy


WINDOW = 8          # words per window of the repetition count
MIN_WORDS = 20
MAX_REPEAT_PCT = 30


def _normalised_lines(text: Column) -> Column:
    flat = F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(F.split(flat, "\n"), lambda x: F.trim(x))


def base_metrics(docs: DataFrame) -> DataFrame:
    """Per-document counts over the columns ``doc_id, host, text, key``; one map-only pass.

    Repeated windows are found inside the row: hash every window, and only where two hashes
    are equal sort (hash, position) and keep the neighbours that agree.
    """
    t = docs.withColumn("w", words(F.col("text"))).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    t = t.select(
        "doc_id", "host", "key",
        F.size("w").cast("long").alias("n_words"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"CASE WHEN size(w) > {WINDOW} THEN transform(sequence(0, size(w) - {WINDOW}), "
               f"i -> xxhash64(slice(w, i + 1, {WINDOW}))) ELSE array() END").alias("grams"))
    t = t.withColumn("pairs", F.expr(
        "CASE WHEN size(array_distinct(grams)) < size(grams) "
        "THEN sort_array(transform(grams, (h, i) -> struct(h, i))) END"))
    t = t.withColumn("starts", F.expr(
        "CASE WHEN pairs IS NOT NULL THEN sort_array(transform(filter(pairs, (p, j) -> "
        "coalesce(get(pairs, j - 1).h = p.h, false) OR coalesce(get(pairs, j + 1).h = p.h, false)), p -> p.i)) END"))
    covered = F.expr(
        f"CASE WHEN starts IS NULL THEN 0L ELSE {WINDOW} + aggregate(slice(starts, 2, size(starts)), "
        "struct(get(starts, 0) AS prev, 0L AS total), "
        f"(s, x) -> struct(x AS prev, s.total + least({WINDOW}, x - s.prev) AS total), s -> s.total) END")
    t = t.withColumn("n_repeat_words", covered.cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return t.drop("grams", "pairs", "starts").withColumn("base_failed", failed)


def line_rows(docs: DataFrame) -> DataFrame:
    """One row per line with a word: host, hash, words, place (the line's number) and the document it is in."""
    return docs.select("host", "key", F.xxhash64("text").alias("content"),
                       F.posexplode(_normalised_lines(F.col("text"))).alias("pos", "line")).where("line <> ''").select(
        "host", "key", "content", "pos", F.xxhash64("line").alias("line_hash"),
        F.size(F.split("line", " ")).alias("line_words"))


def frequent_lines(docs: DataFrame, rules: LineRules) -> DataFrame:
    """(host, line_hash, n_docs) of the lines above their host's limit."""
    counts = line_rows(docs).groupBy("host", "line_hash").agg(F.countDistinct("content").alias("n_docs"))
    hosts = docs.groupBy("host").agg(F.countDistinct(F.xxhash64("text")).alias("host_docs"))
    counts = counts.where(F.col("n_docs") > rules.min_docs)
    hosts = hosts.withColumnRenamed("host", "h")
    return counts.join(hosts, F.col("host").eqNullSafe(F.col("h"))).where(
        F.col("n_docs") > F.col("host_docs") * F.lit(rules.share)).select("host", "line_hash", "n_docs")


def _without_near_copies(docs: DataFrame, hits: DataFrame, rules: LineRules) -> DataFrame:
    """The ``hits`` (key, host, line_hash, ...) whose line is frequent among otherwise different documents.

    A document's rest are its lines that are not frequent.  It counts as a near copy if at least ``min_varied`` of the
    rest's word pairs occur in frequent lines of its host, or if it has no rest; near copies of one least line count as one.
    """
    hits = cut_lineage(hits.withColumn("line_id", row_key(F.col("host"), F.col("line_hash"))))
    held = hits.groupBy("key").agg(F.collect_set("pos").alias("places"), F.min("line_hash").alias("least"),
                                   F.min("content").alias("content"))
    lines = docs.select("key", "host", "text").join(held.select("key", "places"), "key").select(
        "key", "host", "places", F.posexplode(_normalised_lines(F.col("text"))).alias("pos", "line")).where(
        "line <> ''").select("key", "host", F.array_contains("places", F.col("pos")).alias("hit"),
                             F.split("line", " ").alias("w"))
    pair = F.explode(F.transform("w", lambda x, i: row_key(F.col("host"), F.get("w", i - 1), x))).alias("pair")
    common = lines.where("hit").select(pair).distinct()
    rest = lines.where("NOT hit")
    varied = rest.select("key", pair).join(common, "pair", "left_semi").groupBy("key").agg(F.count("*").alias("varied"))
    # grouped by host too, so that all three read the same columns of one exchange of the texts
    sizes = rest.groupBy("key", "host").agg(F.sum(F.size("w")).alias("rest")).drop("host")
    # near copies of one text share their least frequent line, but for the few that vary that one
    same = F.coalesce("varied", F.lit(0)) >= F.coalesce("rest", F.lit(0)) * F.lit(rules.min_varied)
    content = held.select("key", "least", "content").join(sizes, "key", "left").join(varied, "key", "left").select(
        "key", F.when(same, F.col("least")).otherwise(F.col("content")).alias("as_one"))
    counts = hits.join(content, "key").groupBy("host", "line_id").agg(F.countDistinct("as_one").alias("n_docs")).where(
        F.col("n_docs") > rules.min_docs)
    hosts = docs.groupBy("host").agg(F.countDistinct(F.xxhash64("text")).alias("host_docs")).withColumnRenamed("host", "h")
    still = counts.join(hosts, F.col("host").eqNullSafe(F.col("h"))).where(
        F.col("n_docs") > F.col("host_docs") * F.lit(rules.share)).select("line_id")
    return hits.join(still, "line_id", "left_semi")


def judge(df: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id", host_col: str = "source",
          text_col: str = "text", near_copies: bool = False) -> DataFrame:
    """Base counts, words and lines (numbers from 0, null if none) removed as boilerplate and the verdict, one row
    per input row."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("key", row_key(F.col("doc_id"), F.col("host"), F.col("text")))
    frequent = frequent_lines(docs, rules).select(F.col("host").alias("h"), F.col("line_hash").alias("lh"))
    hits = line_rows(docs).join(frequent, F.col("host").eqNullSafe(F.col("h")) & (F.col("line_hash") == F.col("lh")),
                                "left_semi")
    if near_copies:
        hits = _without_near_copies(docs, hits, rules)
    # distinct places: rows repeating a document don't count its lines twice
    removed = hits.groupBy("key").agg(F.collect_set(F.struct("pos", "line_words")).alias("places")).select(
        F.col("key").alias("k"),
        F.aggregate("places", F.lit(0).cast("long"), lambda a, x: a + x["line_words"]).alias("removed"),
        F.sort_array(F.transform("places", lambda x: x["pos"])).alias("removed_lines"))
    out = base_metrics(docs).join(removed, F.col("key") == F.col("k"), "left").withColumn(
        "removed_words", F.coalesce("removed", F.lit(0).cast("long")))
    depleted = (F.col("removed_words") > 0) & (
        (F.col("n_words") - F.col("removed_words") < rules.min_words)
        | (F.col("removed_words") > F.col("n_words") * F.lit(rules.max_removed)))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & ~depleted).alias("kept"), "removed_words", "host", "key",
                      "removed_lines")


def keep_documents(df: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id",
                   host_col: str = "source", text_col: str = "text", near_copies: bool = True) -> DataFrame:
    """The input rows that pass, their texts without the lines removed as boilerplate; other columns as they came."""
    key = row_key(F.col(id_col), F.col(host_col).cast("string"), F.coalesce(F.col(text_col), F.lit("")))
    found = judge(df, rules, id_col, host_col, text_col, near_copies).where("NOT kept OR removed_lines IS NOT NULL").groupBy(
        F.col("key").alias("__found")).agg(F.first("kept").alias("__kept"), F.first("removed_lines").alias("__lines"))
    rest = F.array_join(F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains("__lines", i)), "\n")
    out = df.withColumn("__key", key).join(found, F.col("__key") == F.col("__found"), "left").where(
        F.coalesce("__kept", F.lit(True)))
    return out.withColumn(text_col, F.when(F.col("__lines").isNull(), F.col(text_col)).otherwise(rest)).select(*df.columns)
