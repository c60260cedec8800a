"""Document fingerprints by winnowing (operator 10), DataFrame functions only.

A text becomes its lower-cased words; every k consecutive words have a hash (built by doubling:
the hash of 2 words from those of 1, of 4 from those of 2, ...).  Of each window of w such
hashes the least is kept, the rightmost one on ties, with its position.  Any run of
``w + k - 1`` words that two texts share leaves the same fingerprint in both.

Defined results: a null text is an empty text and has an empty fingerprint, as has a text
without words; a text of fewer than k words has one gram, all its words; of fewer than w grams
one window.  Two empty fingerprints are alike (1.0).  Repeated rows keep their rows; an empty table gives
no rows; other columns are ignored.  A text's grams are arrays of its row, so memory follows the longest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staysense.llm.common import words

GRAM, WIN = 5, 8


def gram_hashes(df: DataFrame, text_col: str, out: str, k: int = GRAM) -> DataFrame:
    """Column ``out``: hashes of the k-word runs of ``text_col`` (array of long)."""
    df = df.withColumn(out, F.transform(words(F.lower(F.col(text_col))), lambda w: F.xxhash64(w)))
    done, parts, rest = 0, [], k                # binary digits of k: runs of 1, 2, 4, ... words
    df = df.withColumn(f"{out}_n", F.size(out))
    df = df.withColumn(f"{out}_all", F.when(F.col(f"{out}_n").between(1, k - 1), F.array(F.xxhash64(out))))
    run, names = 1, {1: out}
    while run * 2 <= k:
        a = names[run]
        b = f"{out}_{run * 2}"
        df = df.withColumn(b, F.expr(
            f"zip_with(slice({a}, 1, greatest(size({a}) - {run}, 0)), slice({a}, {run + 1}, size({a})), (x, y) -> xxhash64(x, y))"))
        names[run * 2] = b
        run *= 2
    for size in sorted(names, reverse=True):
        if size <= rest:
            parts.append((names[size], done))
            done, rest = done + size, rest - size
    n = f"greatest({out}_n - {k - 1}, 0)"
    expr = f"slice({parts[0][0]}, 1, {n})"
    for name, skip in parts[1:]:
        expr = f"zip_with({expr}, slice({name}, {skip + 1}, {n}), (x, y) -> xxhash64(x, y))"
    full = F.expr(expr)
    df = df.withColumn(f"{out}_grams", F.coalesce(F.col(f"{out}_all"), full))
    return df.drop(out, f"{out}_n", f"{out}_all", *[v for v in names.values() if v != out]).withColumnRenamed(
        f"{out}_grams", out)


def winnow(df: DataFrame, grams: str, out: str, w: int = WIN) -> DataFrame:
    """Column ``out``: the kept (hash, pos), by position, from the array column ``grams``.

    A gram is ranked by the upper 33 bits of its hash and then by its place, the rightmost first,
    both in one long; the minima of w neighbours come by doubling, each from two of half the width.
    """
    low = (1 << 31) - 1
    df = df.withColumn(f"{out}_m", F.expr(f"transform({grams}, (h, i) -> (h & {~low}L) | ({low}L - i))"))
    run = 1
    while run < w:                              # least() passes over the nulls beyond the end
        step = min(run, w - run)
        df = df.withColumn(f"{out}_m", F.expr(
            f"zip_with({out}_m, slice({out}_m, {step + 1}, size({out}_m)), (x, y) -> least(x, y))"))
        run += step
    df = df.withColumn(f"{out}_m", F.expr(f"array_distinct(slice({out}_m, 1, greatest(size({out}_m) - {w - 1}, 1)))"))
    df = df.withColumn(out, F.expr(
        f"transform({out}_m, m -> struct(get({grams}, CAST({low} - (m & {low}L) AS INT)) AS hash, "
        f"CAST({low} - (m & {low}L) AS INT) AS pos))"))
    return df.drop(f"{out}_m")


def fingerprint(df: DataFrame, text_col: str, out: str, k: int = GRAM, w: int = WIN) -> DataFrame:
    """Adds ``out``: array of (hash, pos) that winnowing keeps of the text."""
    df = df.withColumn(f"{out}_t", F.coalesce(F.col(text_col), F.lit("")))
    df = gram_hashes(df, f"{out}_t", f"{out}_g", k)
    return winnow(df, f"{out}_g", out, w).drop(f"{out}_t", f"{out}_g")


def likeness(a: Column, b: Column) -> Column:
    """Shared share of the distinct hashes of two fingerprints (arrays of long), 0 to 1."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, 1.0).otherwise(both / F.greatest(every, F.lit(1))).cast("double")


def as_text(fp: Column) -> Column:
    """``pos:hash`` in hex, comma-joined: equal texts have equal strings."""
    return F.concat_ws(",", F.transform(fp, lambda x: F.concat_ws(":", x["pos"].cast("string"), F.hex(x["hash"]))))


def with_next(docs: DataFrame, cols: list[str], id_col: str = "doc_id", bucket_rows: int = 1_000) -> DataFrame:
    """Adds ``next_<c>`` for each of ``cols``: the values of the next row by id, of the first after the last.

    Ids are cut into ranges at approximate quantiles (a list of bounded length in the plan), so that
    one window holds a range; each range also gets a copy of the first row of the next range that
    has any.  Rows of one id follow each other by ``cols``.
    """
    n = docs.count()
    pieces = max(1, min(-(-n // bucket_rows), 10_000))
    cuts = docs.select(F.percentile_approx(id_col, [i / pieces for i in range(1, pieces)], 10 * pieces)).first()[0] if (
        pieces > 1) else []
    cuts = sorted({c for c in cuts or [] if c is not None})
    name = docs.sparkSession.createDataFrame([(cuts,)], f"cuts array<{dict(docs.dtypes)[id_col]}>")
    rows = docs.crossJoin(F.broadcast(name)).withColumn("__range", range_number(F.col(id_col), F.col("cuts"), len(cuts))).drop("cuts")
    order = [F.col(id_col).asc_nulls_first(), *cols]
    everything = F.struct(F.col(id_col), *cols)
    heads = rows.groupBy("__range").agg(F.min_by(everything, F.struct(F.col(id_col).isNotNull(), F.col(id_col), *cols)).alias("head"))
    turn = Window.orderBy("__range")
    firsts = F.first("head").over(turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.withColumn("head", F.coalesce(F.lead("head").over(turn), firsts))
    guards = heads.select("head.*", "__range").withColumn("__guard", F.lit(True))
    both = rows.withColumn("__guard", F.lit(False)).unionByName(guards, allowMissingColumns=True)
    near = Window.partitionBy("__range").orderBy("__guard", *order)
    for c in cols:
        both = both.withColumn(f"next_{c}", F.lead(c).over(near))
    return both.where("NOT __guard").drop("__guard", "__range")


def range_number(x: Column, cuts: Column, n: int) -> Column:
    """How many of the n sorted ``cuts`` are at most x: binary search by halving steps."""
    steps = F.array(*[F.lit(1 << i) for i in range(n.bit_length() - 1, -1, -1)] or [F.lit(1)])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        F.coalesce(F.get(cuts, at + s - 1) <= x, F.lit(False)), at + s).otherwise(at))


def compare_edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text, its edited text (the last half replaced by the head of the next one) and fingerprints."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = with_next(docs, ["text"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    t = t.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    t = fingerprint(t, "text", "fp").drop("text")
    t = fingerprint(t, "next_text", "next_fp").drop("next_text")
    return fingerprint(t, "edited", "edited_fp")


def digest(t: DataFrame) -> DataFrame:
    def hashes(c):
        return F.array_distinct(F.col(c)["hash"])

    t = t.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
    t = t.withColumns({f"{c}_h": hashes(c) for c in ("fp", "next_fp", "edited_fp")})
    return t.select("doc_id", "n_chars", "edited_sha256", F.sha2(as_text(F.col("fp")), 256).alias("fingerprint"),
                    F.sha2(as_text(F.col("edited_fp")), 256).alias("edited_fingerprint"),
                    likeness(F.col("fp_h"), F.col("edited_fp_h")).alias("near_edited"),
                    likeness(F.col("fp_h"), F.col("next_fp_h")).alias("near_next"),
                    F.size("fp").cast("long").alias("n_kept"))
