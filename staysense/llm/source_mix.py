"""Mixing sources to target weights (operator 3), DataFrame functions only.

The documents of a source are shuffled by a hash into one stream of words that starts anew
when it ends, cut into blocks of equal size.  A low-discrepancy schedule deals the blocks:
slot ``t`` falls at ``frac(t * golden ratio)``, the cumulative target shares map that point to
a source, and the slot's rank within its source names the block it takes.  Every prefix of
the schedule is mixed in the wanted proportions, without any random state: reruns agree.

Sums over a stream and ranks within a source are built in two levels (totals per bucket, then
inside a bucket), so a source that holds a third of all rows is never in one task.

Defined results: a null text has size 0 and is never taken; null is a source of its own, last
in order; rows repeating an id are documents of their own and told apart by their content;
identical rows share the words that their places take; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staysense.llm.common import row_key, words
from staysense.session import cut_lineage

GOLDEN_64 = 11400714819323198485     # fixed value: the golden ratio's fraction in units of 2**-64


@dataclass(frozen=True)
class MixPlan:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)    # dealt to the sources in order, repeating
    share: float = 1.5                              # words of the mix / words there are
    max_epochs: int = 2                             # no source is read more often than that
    block: int = 256                                # words per slot
    bucket_rows: int = 1_000                        # rows of a source that are ordered together
    chunk_slots: int = 4_096                        # slots that are ranked together


def sized(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """doc_id, source, key of the row's content and size in words; texts go no further."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                     content_key(id_col, source_col, text_col).alias("key"),
                     F.size(words(text)).cast("long").alias("size"))


def content_key(id_col: str, source_col: str, text_col: str) -> Column:
    return row_key(F.col(id_col), F.col(source_col), F.coalesce(F.col(text_col), F.lit("")))


def targets(sizes: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """One row per source: rank, weight, total size, target.

    Water filling in closed form: ordered by cap / weight, the first k sources are capped and
    the rest share what is left by weight; the level of the first source that stays under its
    cap holds for all after it.  The table has a row per source, never one per document.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("sr", F.row_number().over(rank) - 1)
    weights = F.array(*[F.lit(float(w)) for w in plan.weights])
    per = per.withColumn("weight", F.get(weights, F.col("sr") % len(plan.weights)))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(plan.max_epochs)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "sr")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    per = per.withColumn("left", F.sum("source_size").over(every) * F.lit(plan.share)
                         - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    per = per.withColumn("level", F.col("left") / F.sum("weight").over(after))
    per = per.withColumn("open", F.min(F.when(
        F.col("level") * F.col("weight") <= F.col("cap"),
        F.struct((F.col("cap") / F.col("weight")).alias("o"), "sr", "level"))).over(every))
    target = F.when(F.col("open").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("open.level") * F.col("weight")))
    return per.select("source", "sr", "weight", "source_size", "n_docs",
                      F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(target).alias("target"))


def streams(sizes: DataFrame, per_source: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """Each document's place in its source's shuffled stream: ``start`` counts the words before it.

    The hash that shuffles also names the bucket (equal ranges of the hash), sized so that a
    bucket holds about ``bucket_rows`` documents of its source.
    """
    src = per_source.select(
        "sr", "source_size", "target", F.col("source").alias("s"),
        F.greatest(F.lit(1), F.ceil(F.col("n_docs") / F.lit(plan.bucket_rows))).alias("buckets"))
    docs = sizes.join(src, F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
    docs = docs.withColumn("place", F.xxhash64(F.lit("mix"), "key")).withColumn(
        "bucket", F.floor((F.col("place") / F.lit(2.0 ** 64) + 0.5) * F.col("buckets")))
    totals = docs.groupBy("sr", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("sr").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("sr", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset"))
    inside = (Window.partitionBy("sr", "bucket").orderBy("place", "key", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    return docs.join(totals, ["sr", "bucket"]).withColumn(
        "start", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))).select(
        "doc_id", "key", "size", "source_size", "target", "sr", "start")


def schedule(spark: SparkSession, per_source: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """The slots (slot, sr, block, words): which block of which source's stream is read when.

    The last slot of a source is cut to what its target leaves and slots beyond it are skipped;
    the few that a source is short of by rounding are put at the end.
    """
    upto = F.sum("goal").over(Window.orderBy("sr"))
    goals = per_source.withColumn("goal", F.round("target").cast("long")).where("goal > 0")
    goals = cut_lineage(goals.select("sr", "goal", (upto - F.col("goal")).alias("lo"), upto.alias("hi")))
    total = goals.agg(F.max("hi")).first()[0] or 0
    n_slots = -(-total // plan.block)
    # golden-ratio points as a Weyl sequence modulo 2**64: exact at any slot number
    point = F.expr(f"CAST((CAST(id AS DECIMAL(18,0)) * {GOLDEN_64}BD) % 18446744073709551616BD AS DOUBLE)")
    slots = spark.range(0, n_slots, 1, max(1, min(-(-n_slots // 65_536), 20_000))).withColumn(
        "point", F.least(F.floor(point / F.lit(2.0 ** 64) * F.lit(float(total))), F.lit(total - 1)).cast("long"))
    # the cumulative shares as ranges of words, cut into cells: an equi-join for any number of sources
    width = -(-max(total, 1) // 4_096)
    ranges = goals.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("lo") / width).cast("long"), F.floor((F.col("hi") - 1) / width).cast("long"))))
    slots = slots.withColumn("cell", F.floor(F.col("point") / width).cast("long"))
    dealt = slots.join(ranges, "cell").where("point >= lo AND point < hi").select(
        F.col("id").alias("slot"), "sr", "goal", F.floor(F.col("id") / plan.chunk_slots).alias("chunk"))
    per_chunk = dealt.groupBy("sr", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("sr").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = per_chunk.select("sr", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("sr", "chunk").orderBy("slot")
    ranked = dealt.withColumn("i", F.row_number().over(within) - 1).join(base, ["sr", "chunk"]).select(
        "slot", "sr", "goal", (F.col("base") + F.col("i")).alias("block"))
    have = per_chunk.groupBy("sr").agg(F.sum("n").alias("have"))
    short = goals.join(have, "sr", "left").select(
        "sr", "goal", F.coalesce("have", F.lit(0)).cast("long").alias("have"),
        F.ceil(F.col("goal") / plan.block).cast("long").alias("need")).where("need > have")
    short = short.select((F.lit(n_slots) + F.col("sr")).alias("slot"), "sr", "goal",
                         F.explode(F.sequence(F.col("have"), F.col("need") - 1)).alias("block"))
    left = F.col("goal") - F.col("block") * plan.block
    return ranked.unionByName(short).where(left > 0).select(
        "slot", "sr", "block", F.least(F.lit(plan.block), left).alias("words"))


def mix(df: DataFrame, plan: MixPlan = MixPlan(), id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with size, target and place; pieces of the mix).

    A piece is the part of one document that one slot reads: slot, epoch, first word, words.
    """
    sizes = cut_lineage(sized(df, id_col, source_col, text_col))
    per_source = cut_lineage(targets(sizes, plan))
    placed = cut_lineage(streams(sizes, per_source, plan))
    slots = schedule(df.sparkSession, per_source, plan)
    # a document's fragments: the blocks that its words fall in, in each reading of the stream
    parts = placed.where("size > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.lit(plan.max_epochs - 1)))).withColumn(
        "at", F.col("start") + F.col("epoch") * F.col("source_size")).where(F.col("at") < F.round("target"))
    first = F.floor(F.col("at") / plan.block).cast("long")
    last = F.floor((F.col("at") + F.col("size") - 1) / plan.block).cast("long")
    parts = parts.withColumn("block", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("at"), F.col("block") * plan.block)
    hi = F.least(F.col("at") + F.col("size"), F.col("block") * plan.block + F.col("words"))
    pieces = parts.join(slots, ["sr", "block"]).select(
        "doc_id", "key", "sr", "size", "start", "slot", "epoch", (lo - F.col("at")).alias("first_word"),
        (hi - lo).alias("words")).where("words > 0")
    return placed, pieces


def taken(df: DataFrame, plan: MixPlan = MixPlan(), id_col: str = "doc_id", source_col: str = "source",
          text_col: str = "text") -> DataFrame:
    """One row per document: size, its source's size and target, words that the mix takes."""
    placed, pieces = mix(df, plan, id_col, source_col, text_col)
    # the place in the stream tells all rows with words apart, repeated rows too
    got = pieces.groupBy("sr", "start", "size").agg(F.sum("words").alias("taken"))
    return placed.join(got, ["sr", "start", "size"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(df: DataFrame, plan: MixPlan = MixPlan(), id_col: str = "doc_id", source_col: str = "source",
                    text_col: str = "text") -> DataFrame:
    """The mix as documents: a row per reading of a document, all columns as they came; where a
    source's target ends inside a document, its text is cut after that word."""
    _, pieces = mix(df, plan, id_col, source_col, text_col)
    reads = pieces.groupBy("key", "start", "epoch", "size").agg(F.sum("words").alias("n"))
    # identical rows share a key; each of them takes the readings of one of their places
    reads = reads.groupBy(F.col("key").alias("__k")).agg(
        F.sort_array(F.collect_list(F.struct("start", "epoch", "n", "size"))).alias("__reads"))
    docs = df.withColumn("__key", content_key(id_col, source_col, text_col))
    docs = docs.withColumn("__i", F.row_number().over(Window.partitionBy("__key").orderBy(F.lit(1))))
    docs = docs.join(reads, F.col("__key") == F.col("__k"))
    docs = docs.withColumn("__start", F.expr("get(array_distinct(transform(__reads, r -> r.start)), __i - 1)"))
    docs = docs.withColumn("__read", F.explode(F.expr("filter(__reads, r -> r.start = __start)")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = F.when(F.col("__read.n") >= F.col("__read.size"), F.col(text_col)).otherwise(
        F.array_join(F.slice(words(text), F.lit(1), F.col("__read.n").cast("int")), " "))
    return docs.withColumn("__text", cut).select(
        *[F.col("__text").alias(c) if c == text_col else F.col(c) for c in df.columns])
