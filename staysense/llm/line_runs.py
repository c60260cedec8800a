"""Line dedup by winnowing over line hashes (operator 8), DataFrame functions only.

A run of consecutive lines of ``min_words`` words or more that some earlier document (or an
earlier place of the same one) also has is deleted; the earliest occurrence stays.

1. Every line with a word has a hash.  From each line on, the shortest window of lines that
   holds ``min_words`` words is taken, and the least line hash in it, the rightmost one on ties,
   is its fingerprint.  Windows of equal lines choose alike, so two places that share a run of
   ``min_words`` words are guaranteed to share a fingerprint.
2. Fingerprints are joined on their hash: only those found at two or more places go on.
3. Around those, matches are extended both ways: the windows that reach from a line down, and
   those that reach from a line up, until they hold ``min_words`` words, are matched by the
   hash of all their lines.  Together they cover a repeated run to its first and last line,
   whichever earlier document each part of it comes from; no pairs of places are formed, so a
   passage that a third of the documents share costs one row per place.
4. Every window but the earliest of its kind (by id, then place) is deleted.

A window has at most ``min_words`` lines, as lines without a word are left out of the runs
(they stay in the text).

Defined results: a null text is kept as it is and has no lines; rows that agree in id and text
are one document; a null id comes before all others; an empty table gives no rows; other
columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staysense.llm.common import row_key, words
from staysense.session import cut_lineage

MIN_WORDS = 50


def _key(id_col: str, text_col: str) -> Column:
    return row_key(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))


def windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per window of ``doc_id, key, text``: first and last line number (of all lines), the hash of
    its lines, and the hash and place of the fingerprint in it."""
    split = F.split("text", "\n")
    t = docs.select("doc_id", "key", F.filter(F.transform(
        split, lambda x, i: F.struct(F.xxhash64(F.trim(x)).alias("h"), F.size(words(x)).alias("n"), i.alias("at"))),
        lambda s: s["n"] > 0).alias("lines"))
    t = t.select("doc_id", "key", F.col("lines.h").alias("h"), F.col("lines.n").alias("n"), F.col("lines.at").alias("at"))
    t = t.withColumn("ends", F.expr(     # words up to and with each line, by a running sum
        "aggregate(n, struct(0L AS sum, CAST(array() AS ARRAY<BIGINT>) AS out), (s, x) -> "
        "struct(s.sum + x AS sum, array_append(s.out, s.sum + x) AS out), s -> s.out)"))
    t = t.withColumn("begins", F.expr("zip_with(ends, n, (e, x) -> e - x)"))
    # lines of the window down from line i (0-based) and up from it; 0 where the text ends before
    t = t.withColumn("down", F.expr(
        f"transform(begins, (b, i) -> 1 + size(filter(slice(ends, i + 1, {min_words}), e -> e < b + {min_words})))"))
    t = t.withColumn("down", F.expr("transform(down, (m, i) -> if(i + m <= size(ends), m, 0))"))
    t = t.withColumn("up", F.expr(
        f"transform(ends, (e, i) -> if(e < {min_words}, 0, 1 + size(filter(slice(begins, greatest(i + 2 - {min_words}, 1), "
        f"least(i + 1, {min_words})), b -> b > e - {min_words}))))"))
    spans = F.expr(
        "filter(concat(transform(down, (m, i) -> struct(i AS a, m AS m)), "
        "transform(up, (m, i) -> struct(i + 1 - m AS a, m AS m))), s -> s.m > 0)")
    # a window up from a line holds the window down from its first line: it has that one's fingerprint
    t = t.withColumn("spans", F.array_distinct(spans)).withColumn("low", F.expr(
        "transform(down, (m, i) -> if(m > 0, array_min(slice(h, i + 1, m)), NULL))"))
    t = t.withColumn("place", F.expr(
        "transform(down, (m, i) -> if(m > 0, i + m - CAST(array_position(reverse(slice(h, i + 1, m)), get(low, i)) AS INT), NULL))"))
    # not explode(): the size filter that the optimizer infers for it would compute the arrays twice
    t = t.select("doc_id", "key", "h", "at", "low", "place", F.explode_outer("spans").alias("s")).where("s IS NOT NULL")
    return t.select(
        "doc_id", "key", F.expr("get(at, s.a)").alias("first"), F.expr("get(at, s.a + s.m - 1)").alias("last"),
        F.expr("xxhash64(slice(h, s.a + 1, s.m))").alias("run"),
        F.expr("get(low, s.a)").alias("low"), F.expr("get(at, get(place, s.a))").alias("place"))


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, spans): the line spans (first, last) that repeat an earlier place, per document."""
    found = cut_lineage(windows(docs, min_words))       # read three times below
    where = F.xxhash64("key", "place")                  # tells places apart; their order is not needed yet
    shared = found.groupBy("low").agg(F.min(where).alias("a"), F.max(where).alias("b")).where("a < b").select(
        F.col("low").alias("shared_low"))
    found = found.join(shared, F.col("low") == F.col("shared_low"), "left_semi")
    at = F.struct("doc_id", "key", "first")
    firsts = found.groupBy(F.col("run").alias("run2")).agg(F.min(at).alias("a"), F.max(at).alias("b")).where("a < b")
    later = found.join(firsts, F.col("run") == F.col("run2")).where(at > F.col("a"))
    return later.groupBy(F.col("key").alias("k")).agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("spans"))


def drop_repeats(df: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
                 removed_col: str | None = None) -> DataFrame:
    """The rows with later repeated runs deleted from the text; ``removed_col`` adds their line numbers."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                     _key(id_col, text_col).alias("key"))
    spans = repeated_spans(docs, min_words).withColumnsRenamed({"k": "__k", "spans": "__spans"})
    out = df.withColumn("__key", _key(id_col, text_col)).join(spans, F.col("__key") == F.col("__k"), "left")
    # overlapping spans become one; then a line stays if it is in none
    merged = F.expr(
        "aggregate(__spans, CAST(array() AS ARRAY<STRUCT<first: INT, last: INT>>), (m, s) -> CASE "
        "WHEN size(m) > 0 AND get(m, size(m) - 1).last >= s.first - 1 THEN concat(slice(m, 1, size(m) - 1), "
        "array(struct(get(m, size(m) - 1).first AS first, greatest(get(m, size(m) - 1).last, s.last) AS last))) "
        "ELSE array_append(m, s) END)")
    out = out.withColumn("__merged", merged)
    edges = F.expr("concat(array(-1), flatten(transform(__merged, s -> array(s.first - 1, s.last))))")
    lines = F.split(F.col(text_col), "\n")
    out = out.withColumn("__edges", edges).withColumn("__lines", F.when(F.col("__merged").isNotNull(), lines))
    kept = F.expr(       # the stretches between the spans
        "flatten(transform(sequence(0, size(__merged)), j -> slice(__lines, get(__edges, 2 * j) + 2, "
        "coalesce(get(__edges, 2 * j + 1), size(__lines) - 1) - get(__edges, 2 * j))))")
    text = F.when(F.col("__merged").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    cols = [text.alias(c) if c == text_col else F.col(c) for c in df.columns]
    if removed_col:
        removed = F.flatten(F.transform("__merged", lambda s: F.sequence(s["first"], s["last"])))
        cols.append(F.coalesce(removed, F.array().cast("array<int>")).alias(removed_col))
    return out.select(*cols)

