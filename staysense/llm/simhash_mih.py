"""SimHash near-dedup by multi-index hashing (operator 6).

A fingerprint bit is set when over half of the text's shingle hashes have it.  Fingerprints are
linked at ``max_bits`` differing bits or fewer and each document gets the smallest id reachable.

Distinct fingerprints only are searched.  A fingerprint is cut into segments, one table each.
With two segments and at most two differing bits, either the first segment differs in at most
one bit or the second not at all; so the first table is probed with the small Hamming ball
around the segment (a pair that differs in one bit is found from the side where the bit is 0)
and the second with the segment itself.  Each table match is verified by the complete distance.

A group of near copies may put thousands of distinct fingerprints into one bucket.  Buckets
above ``bucket_cap`` are searched by another exact way, without pairs: the members, and the
fingerprints whose probes meet them, are listed under every code that differs from them in
at most one bit of one segment (the other segment in full).  Two fingerprints differ in at most
two bits if and only if they share such a code, and at most 65 can share one; each is linked to
the least of its code.

Components come from alternating large-star and small-star steps on the links, distributed
and checkpointed; nothing of it is collected.

Defined results: null and empty texts, and texts without words, have fingerprint zero and are
linked to each other; rows repeating an id are rows of that id, each with its component; a null
id counts as greater than all others; ids are integers; an empty table gives no rows; ``group`` ignores
other columns, ``keep_one`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staysense.llm.common import row_key
from staysense.session import cut_lineage

SHINGLE, SEED, MAX_BITS = 3, 42, 2
HALF = 32                   # bits of a segment


def _fingerprint(text: str | None, size: int, seed: int) -> int:
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: ASCII blanks, A-Z only
    if not found:
        return 0
    if len(found) <= size:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(found), seed)], dtype=np.uint64)
    else:
        joined = b" ".join(found)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
        starts = np.concatenate(([0], ends[:-size]))
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts.tolist(), (ends[size - 1:] - 1).tolist())),
                             np.uint64, len(starts))
    n, ones = len(hashes), np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):                  # bounded memory for very long texts
        bits = np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                 seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) and the columns ``keep``; whole texts, in Arrow batches."""
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_fingerprint(t, size, seed) for t in texts], dtype="uint64").astype("int64")

    fp = F.pandas_udf(simhash, "long")
    return df.select(F.col(id_col).alias("doc_id"), fp(F.col(text_col)).alias("fp"), *keep)


def _low(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit((1 << HALF) - 1))


def _high(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, HALF)


def links(fps: DataFrame, max_bits: int = MAX_BITS, bucket_cap: int = 64) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) that connect whatever is within ``max_bits``."""
    if max_bits != 2:
        raise ValueError("the probe plan is made for two differing bits")
    table = fps.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("seg"), _low(F.col("fp")).alias("code")),
        F.struct(F.lit(1).alias("seg"), _high(F.col("fp")).alias("code")))).alias("t")).select("t.seg", "t.code", "fp")
    full = table.groupBy("seg", "code").agg(F.count("*").alias("n")).where(F.col("n") > bucket_cap).select("seg", "code")
    full = cut_lineage(full)
    light = table.join(full, ["seg", "code"], "left_anti")
    flips = "filter(transform(sequence(0, 31), i -> shiftleft(1L, i)), b -> (fp & b) = 0)"
    probes = fps.select("fp", F.expr(
        f"concat(array(struct(0 AS seg, fp & {(1 << HALF) - 1}L AS code), struct(1 AS seg, shiftrightunsigned(fp, {HALF}) AS code)), "
        f"transform({flips}, b -> struct(0 AS seg, (fp & {(1 << HALF) - 1}L) | b AS code)))").alias("p"))
    probes = probes.select("fp", F.explode_outer("p").alias("p")).select(F.col("fp").alias("q"), "p.seg", "p.code")
    near = F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= max_bits
    matched = probes.join(light, ["seg", "code"]).where((F.col("q") != F.col("fp")) & near).select(
        F.least("q", "fp").alias("a"), F.greatest("q", "fp").alias("b"))
    # the rest: whoever is in a full bucket or probes one
    crowd = probes.join(full, ["seg", "code"], "left_semi").select("q").distinct()
    codes = crowd.select("q", F.explode_outer(F.expr(
        "concat(array(q), transform(sequence(0, 63), i -> q ^ shiftleft(1L, i)))")).alias("code"))
    shared = codes.groupBy("code").agg(F.collect_list("q").alias("members")).where(F.size("members") > 1)
    crowded = shared.select(F.array_min("members").alias("a"), F.explode_outer("members").alias("b")).where("a <> b")
    return matched.unionByName(crowded).distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root): the least node that each node of ``edges`` (a, b) can reach."""
    edges = cut_lineage(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    seen = None
    for _ in range(max_rounds):
        # large star: neighbours above a node are linked to the least of its neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: a node's lesser neighbours and itself are linked to the least of them
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = cut_lineage(small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
    raise RuntimeError(f"components not settled after {max_rounds} rounds")


def _grouped(fps: DataFrame, max_bits: int, bucket_cap: int) -> DataFrame:
    """``fps`` with component_id and the fingerprint ``root_fp``, which no other component has."""
    distinct = cut_lineage(fps.groupBy("fp").agg(F.min("doc_id").alias("node")))
    pairs = links(distinct.select("fp"), max_bits, bucket_cap)
    nodes = distinct.select(F.col("fp").alias("f"), "node")
    # null ids order last: a fingerprint of such rows alone is a node of its own, by fingerprint
    named = (pairs.join(nodes, F.col("a") == F.col("f")).select("b", F.struct(F.col("node").isNull(), "node", "a").alias("a"))
             .join(nodes, F.col("b") == F.col("f")).select("a", F.struct(F.col("node").isNull(), "node", "b").alias("b")))
    order = "struct<absent: boolean, id: bigint, fp: bigint>"
    roots = components(named.select(F.col("a").cast(order).alias("a"), F.col("b").cast(order).alias("b")))
    roots = roots.select(F.col("node.fp").alias("f"), F.col("root.id").alias("root"), F.col("root.fp").alias("root_fp"))
    found = distinct.join(roots, F.col("fp") == F.col("f"), "left").select(
        F.col("fp").alias("f"), F.coalesce("root", "node").alias("component_id"), F.coalesce("root_fp", "fp").alias("root_fp"))
    return fps.join(found, F.col("fp") == F.col("f")).drop("f")


def group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, seed: int = SEED,
          max_bits: int = MAX_BITS, bucket_cap: int = 64) -> DataFrame:
    """doc_id, fp, component_id for every row of ``df``."""
    fps = cut_lineage(fingerprints(df, id_col, text_col, size, seed))
    return _grouped(fps, max_bits, bucket_cap).select("doc_id", "fp", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """Of each group the row with the least id, of rows with that id the one with the least content key; a null id
    is greater than all others.  All columns as they came; of rows that agree in id and text one stays."""
    keyed = df.withColumn("__key", row_key(F.col(id_col), F.col(text_col)))
    fps = cut_lineage(fingerprints(keyed, id_col, text_col, size, keep=("__key",)))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "__key")
    found = cut_lineage(_grouped(fps, max_bits, 64).select("root_fp", "__key", rank.alias("rank")))
    least = found.groupBy("root_fp").agg(F.min("rank").alias("least"))
    gone = found.join(least, "root_fp").where(F.col("rank") != F.col("least")).select(
        F.col("__key").alias("__gone")).distinct()
    kept = keyed.join(gone, F.col("__key") == F.col("__gone"), "left_anti")
    again = found.groupBy("__key").agg(F.count("*").alias("n")).where("n > 1").select("__key")
    if not again.isEmpty():
        kept = kept.join(again, "__key", "left_anti").unionByName(
            kept.join(again, "__key", "left_semi").dropDuplicates(["__key"]))
    return kept.select(*df.columns)
