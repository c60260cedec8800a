"""Merkle manifest of a dataset (operator 13).

Every row is a leaf, every group of rows (a language, say) a tree over its leaves in id order, and
the groups' roots, in group order, are the leaves of one more tree, whose root names the dataset.

A level is one grouping by parent: conditional aggregates spread its children over ``fanout`` slot
columns, the digest of the columns in order is the parent's, and what a child needs for its proof
are the columns but its own: those before and those after it.  A few levels make a pass.  Its rows
are dealt out once, by blocks of ``fanout ** levels`` neighbours, and the groupings inside a block
need no further exchange; a block carries its leaves' proofs as far as the block's top.  The next
pass starts from the blocks' tops, and at the end the proofs from there are handed down block by
block, one row a block on either side.  No task ever holds more than a block.

Defined results: a null value is ``-`` in its leaf, an empty one ``0:``; a null group is a group of
its own and comes first.  Rows of equal id are ordered by their leaves, equal rows stay rows of
their own (which of them has which place is open; as a set the results agree).  A lone leaf is its
tree's root.  An empty table has no rows.  Very long texts are read for their digest only, no later
step carries them.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staysense.functions.joins import bounded_broadcast
from staysense.operators.split import global_row_number
from staysense.session import cut_lineage


@dataclass(frozen=True)
class MerklePlan:
    """``fanout`` children a node; ``levels`` levels a pass, so blocks of ``fanout ** levels`` nodes."""

    fanout: int = 2
    levels: int = 5

    @property
    def block(self) -> int:
        return self.fanout ** self.levels


_STEP = "struct<before:string,after:string>"


def field(c: Column) -> Column:
    """What a value adds to a leaf: its length in UTF-8 bytes and itself."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(cols: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in cols]), 256)


def _level(nodes: DataFrame, plan: MerklePlan) -> DataFrame:
    """(grp, block, n, at, digest, members) one level up; finished trees (n = 1) stay as they are."""
    slots = [f"s{i}" for i in range(plan.fanout)]
    node = F.struct("digest", "members")
    wide = nodes.groupBy("grp", "block", "n", F.expr(f"at div {plan.fanout}").alias("at")).agg(
        *[F.max(F.when(F.col("at") % plan.fanout == i, node)).alias(s) for i, s in enumerate(slots)])
    done = F.col("n") == 1

    def beside(own: int) -> Column:
        """The slot columns but ``own``, as the next step of a proof."""
        return F.struct(F.concat_ws("", *[F.col(f"{s}.digest") for s in slots[:own]]).alias("before"),
                        F.concat_ws("", *[F.col(f"{s}.digest") for s in slots[own + 1:]]).alias("after"))

    def moved(own: int) -> Column:
        step = F.when(~done, F.array(beside(own))).otherwise(F.array().cast(f"array<{_STEP}>"))
        return F.coalesce(F.transform(f"{slots[own]}.members", lambda m: F.struct(
            m["row"].alias("row"), F.concat(m["path"], step).alias("path"))), F.expr(f"slice({slots[0]}.members, 1, 0)"))

    digest = F.when(done, F.col("s0.digest")).otherwise(
        F.sha2(F.concat_ws("", *[F.col(f"{s}.digest") for s in slots]), 256))
    members = F.concat(*[moved(i) for i in range(plan.fanout)])
    up = wide.select("grp", "block", "n", "at", digest.alias("digest"), members.alias("members"))
    return up.withColumn("n", F.expr(f"(n + {plan.fanout - 1}) div {plan.fanout}"))     # not above: it would be the n of the lambdas


def _pass(nodes: DataFrame, plan: MerklePlan) -> DataFrame:
    """(grp, block, n, digest, members) of each block of nodes (grp, n, at, digest, row)."""
    start = F.struct(F.col("row").alias("row"), F.array().cast(f"array<{_STEP}>").alias("path"))
    dealt = nodes.select("grp", F.expr(f"at div {plan.block}").alias("block"), "n", "at", "digest",
                         F.array(start).alias("members")).repartition("grp", "block")
    for _ in range(plan.levels):
        dealt = _level(dealt, plan)
    return cut_lineage(dealt.drop("at"))


def trees(leaves: DataFrame, plan: MerklePlan = MerklePlan()) -> list[DataFrame]:
    """The passes over leaves (grp, n, at, digest, row): the last one has a row per tree.

    ``n``: leaves of the tree, ``at``: place from 0, ``row``: what the leaf carries along.
    """
    most = leaves.agg(F.max("n")).first()[0] or 1
    passes = []
    while not passes or most > 1:
        if passes:
            leaves = passes[-1].select("grp", "n", F.col("block").alias("at"), "digest", F.lit(None).cast("int").alias("row"))
        passes.append(_pass(leaves, plan))
        most = -(-most // plan.block)
    return passes


def paths(passes: Sequence[DataFrame], tops: DataFrame, plan: MerklePlan = MerklePlan()) -> DataFrame:
    """(grp, row, path, *more) of every leaf; ``tops`` (grp, path, *more) continues the proofs of each tree."""
    more = [c for c in tops.columns if c not in ("grp", "path")]
    above = tops.select("grp", F.lit(0).cast("bigint").alias("block"), "path", *more)
    for blocks in reversed(passes[1:]):         # a node of a later pass is a block of the one before
        low = blocks.join(above, ["grp", "block"]).select(
            "grp", "block", F.posexplode("members").alias("place", "m"), "path", *more)
        above = low.select("grp", (F.col("block") * plan.block + F.col("place")).alias("block"),
                           F.concat("m.path", "path").alias("path"), *more)
    low = passes[0].join(above, ["grp", "block"]).select("grp", F.explode("members").alias("m"), "path", *more)
    return low.select("grp", F.col("m.row").alias("row"), F.concat("m.path", "path").alias("path"), *more)


def manifest(df: DataFrame, columns: Sequence[str], id_col: str = "doc_id", group_col: str = "lang",
             carry: dict[str, Column] | None = None, plan: MerklePlan = MerklePlan()) -> DataFrame:
    """A row per row: id, leaf, ``path`` (the proof, from the leaf up), subroot, root and what ``carry`` names.

    ``columns``: what a leaf's digest covers.  ``path`` holds (before, after) of each level: the digests
    left and right of the own one in its run, joined.  ``carry`` must be small columns of ``df``.
    """
    carry = carry or {}
    rows = df.select(field(F.col(group_col)).alias("grp"), F.col(group_col).alias("part"), F.col(id_col).alias("id"),
                     leaf_digest([F.col(c) for c in columns]).alias("leaf"),
                     F.struct(F.lit(0).alias("_"), *[c.alias(k) for k, c in carry.items()]).alias("carry"))
    numbered = global_row_number(rows, [F.col("part").asc(), F.col("id").asc(), F.col("leaf").asc(),
                                        F.monotonically_increasing_id().asc()])
    groups = cut_lineage(numbered.groupBy("grp", "part").agg(F.min("_rn").alias("first"), F.count(F.lit(1)).alias("n")))
    passes = trees(numbered.join(bounded_broadcast(groups.drop("part")), "grp").select(
        "grp", "n", (F.col("_rn") - F.col("first")).alias("at"), F.col("leaf").alias("digest"),
        F.struct("id", "leaf", "carry").alias("row")), plan)
    subroots = passes[-1].select("grp", F.col("digest").alias("subroot")).join(groups, "grp")
    subroots = global_row_number(subroots, [F.col("part").asc()])
    whole = trees(subroots.select(
        F.lit("all").alias("grp"), F.lit(groups.count()).cast("bigint").alias("n"), (F.col("_rn") - 1).alias("at"),
        F.col("subroot").alias("digest"), F.struct("grp", "subroot").alias("row")), plan)
    tops = whole[-1].select("grp", F.array().cast(f"array<{_STEP}>").alias("path"), F.col("digest").alias("root"))
    tops = paths(whole, tops, plan).select("row.grp", "path", "row.subroot", "root")
    return paths(passes, tops, plan).select(
        F.col("row.id").alias(id_col), F.col("row.leaf").alias("leaf"), "path", "subroot", "root",
        *[F.col(f"row.carry.{k}").alias(k) for k in carry])


def proof_text(path: Column) -> Column:
    """The digests of a proof, joined."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(path, leaf, lambda d, x: F.sha2(F.concat(x["before"], d, x["after"]), 256))
