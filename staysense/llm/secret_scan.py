"""Secret scan (operator 4), DataFrame functions only.

Base rules are patterns.  The method adds candidates that no pattern names: a window slides
over every long run of a character class, its Shannon entropy follows from the counts of the
characters in it, and a step changes only the two counts of the character that enters and the
one that leaves.  The stretch from the first to the last window above the class's threshold
is a finding.  Runs with too few different characters for the threshold are not scanned.  Base
findings and allow-listed spans are blanked first, so that runs end there and what stands beside
them is scanned (of a finding that overlaps one of an earlier kind, what is left is blanked if it
still is a match).  In a run that begins like a file path every segment is a candidate; if none is
long enough, what follows the path is.

Positions are code points, the end exclusive.  They come from the lengths of the matches and
of the gaps between them, so a text is never cut into characters outside candidate runs.  Every step
takes time in proportion to the text and its findings, and no pattern repeats a group, so that
very long texts, paths, runs and lists of findings neither slow it down nor exhaust a stack.

Defined results: a null text is an empty text, with no spans; an empty table has no rows; one row per
input row, so repeated rows give repeated results; other columns are ignored.  A stretch
that one class finds is blanked for the classes listed after it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base rules (kind, pattern, group whose length counts, least length), in order.
BASE_RULES = (
    ("assign", r"""(?:(?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)


@dataclass(frozen=True)
class CharClass:
    """Runs of ``pattern`` that also match every pattern of ``needs`` are scanned; ``fold`` folds case."""

    kind: str
    pattern: str
    alphabet: str
    window: int
    threshold: float
    needs: tuple[str, ...]
    fold: bool = False


_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharClass("entropy_hex", r"(?<![0-9A-Za-z])[0-9A-Fa-f]{20,}(?![0-9A-Za-z])", _DIGITS + "abcdef", 20, 3.0,
              ("[0-9]", "[A-Fa-f]"), True),
    CharClass("entropy_b64", r"[A-Za-z0-9+/_-]{24,}", _DIGITS + _UPPER + _LOWER + "+/_-", 24, 3.9,
              ("[0-9]", "[A-Z]", "[a-z]")),
    # keys in one case; under 1.1 % of random base36 and base32 windows are below the thresholds
    CharClass("entropy_lower", r"(?<![0-9A-Za-z])[0-9a-z]{24,}(?![0-9A-Za-z])", _DIGITS + _LOWER, 24, 3.6,
              ("[0-9]", "[a-z]")),
    CharClass("entropy_upper", r"(?<![0-9A-Za-z])[0-9A-Z]{24,}(?![0-9A-Za-z])", _DIGITS + _UPPER, 24, 3.5,
              ("[0-9]", "[A-Z]")),
)
#: Spans that look random and are no secrets.
ALLOWED = (
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",   # UUID
    r"(?i)example|dummy|placeholder|changeme|xxxx",                                    # samples in manuals
    r"(?i)abcdefghij|0123456789|qwertyuiop",                                           # alphabets and key rows
)
#: A file path begins with so many segments of this form.
PATH_SEGMENT, PATH_DEPTH = r"^[A-Za-z][A-Za-z0-9_-]{1,15}$", 3
_BLANK = "\x01"       # stands for a character of a span that is not scanned; in no class


_CHUNK = 256


def _sums(items: str, start: str, put: str, then: str) -> str:
    """SQL: a left fold over ``items`` from the number ``start`` that gives a string for each item.

    ``put``: the string of an item ``x`` at number ``s.at`` (no commas); ``then``: the next number.  Spark copies the
    state of a fold at every step, so ``items`` must be few: what is long comes in chunks of ``_CHUNK``.
    """
    return (f"split(trim(TRAILING ',' FROM aggregate({items}, struct('' AS out, CAST({start} AS INT) AS at), (s, x) -> struct("
            f"concat(s.out, {put}, ',') AS out, {then} AS at), s -> s.out)), ',')")


def _located(df: DataFrame, name: str, gaps: str, hits: str, measured: str) -> DataFrame:
    """Column ``name``: array of (start, end, n) from the texts before each hit, the hits and the measured parts."""
    none = "CAST(array() AS ARRAY<STRUCT<start: INT, end: INT, n: INT>>)"
    inner = _sums("c", "o", "CAST(s.at + x.gap AS STRING), ':', CAST(s.at + x.gap + x.len AS STRING), ':', CAST(x.n AS STRING)",
                  "s.at + x.gap + x.len")
    steps = {
        "len": f"zip_with(slice({gaps}, 1, size({hits})), zip_with({hits}, {measured}, (h, m) -> struct(length(h) AS len, "
               "length(m) AS n)), (g, h) -> struct(length(g) AS gap, h.len AS len, h.n AS n))",
        # the columns that a lambda names are named outside it too: Spark then keeps them, else it would copy them into the lambda
        "chunks": f"CASE WHEN size({name}_len) > 0 THEN transform(sequence(0, size({name}_len) - 1, {_CHUNK}), "
                  f"i -> slice({name}_len, i + 1, {_CHUNK})) END",
        "before": _sums(f"{name}_chunks", "0", "CAST(s.at AS STRING)", "s.at + aggregate(x, 0, (a, y) -> a + y.gap + y.len)"),
        "at": f"coalesce(transform(flatten(zip_with({name}_chunks, {name}_before, (c, o) -> {inner})), x -> split(x, ':')), array())"}
    for step, sql in steps.items():
        df = df.withColumn(f"{name}_{step}", F.expr(sql))
    place = "x -> struct(CAST(x[0] AS INT) AS start, CAST(x[1] AS INT) AS end, CAST(x[2] AS INT) AS n)"
    df = df.withColumn(name, F.expr(f"CASE WHEN size({hits}) > 0 THEN transform({name}_at, {place}) ELSE {none} END"))
    return df.drop(*[f"{name}_{step}" for step in steps])


def _found(df: DataFrame, name: str, pattern: str, group: int, text: str = "text") -> DataFrame:
    """Columns ``name``, ``<name>_hits`` and ``<name>_gaps``: the matches of ``pattern``."""
    df = df.withColumn(f"{name}_hits", F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    some = F.size(f"{name}_hits") > 0
    df = df.withColumn(f"{name}_gaps", F.when(some, F.split(text, pattern, -1)))
    if not group:
        return _located(df, name, f"{name}_gaps", f"{name}_hits", f"{name}_hits")
    df = df.withColumn(f"{name}_parts", F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))))
    return _located(df, name, f"{name}_gaps", f"{name}_hits", f"{name}_parts").drop(f"{name}_parts")


def _tagged(name: str, kind: str, order: int, least: int) -> str:
    return (f"transform(filter({name}, x -> x.n >= {least}), "
            f"x -> struct(x.start AS start, {order} AS ord, x.end AS end, '{kind}' AS kind))")


def high_entropy(run: Column, c: CharClass) -> Column:
    """(first, last) code points of ``run`` within windows at or above the threshold; first -1 if none."""
    weight = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(c.window + 2)])
    start = F.struct(F.lit("").alias("win"), F.lit(0.0).alias("sum"), F.lit(0).alias("i"), F.lit(-1).alias("first"),
                     F.lit(-1).alias("last"))

    def times(ch, win):
        return F.length(win) - F.length(F.replace(win, ch, F.lit("")))

    def step(s, e):
        full = F.length(s["win"]) == c.window
        leaves = F.substring(s["win"], 1, 1)
        n_out = times(leaves, s["win"])
        stay = F.when(full, F.substring(s["win"], 2, c.window)).otherwise(s["win"])
        n_in = times(e, stay)
        total = s["sum"] + F.get(weight, n_in + 1) - F.get(weight, n_in) + F.when(
            full, F.get(weight, n_out - 1) - F.get(weight, n_out)).otherwise(0.0)
        high = (s["i"] + 1 >= c.window) & (F.lit(math.log2(c.window)) - total / c.window >= c.threshold - 1e-9)
        first = F.when(high & (s["first"] < 0), s["i"] + 1 - c.window).otherwise(s["first"])
        last = F.when(high, s["i"] + 1).otherwise(s["last"])
        return F.struct(F.concat(stay, e).alias("win"), total.alias("sum"), (s["i"] + 1).alias("i"), first.alias("first"),
                        last.alias("last"))

    return F.aggregate(F.split(F.lower(run) if c.fold else run, ""), start, step, lambda s: F.struct(s["first"], s["last"]))


def _blanked(text: Column, pattern: str) -> Column:
    """``text`` with every match of ``pattern`` blanked; the length stays."""
    rest = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                      lambda gap, hit: F.concat(gap, F.repeat(F.lit(_BLANK), F.coalesce(F.length(hit), F.lit(0)))))
    return F.when(text.rlike(pattern), F.array_join(rest, "")).otherwise(text)


def _without_base(text: Column) -> Column:
    """``text`` with the findings of the base rules blanked, kind by kind."""
    for _, pattern, group, least in BASE_RULES:
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
        shown = F.zip_with(hits, parts, lambda h, p: F.when(
            F.length(p) >= least, F.repeat(F.lit(_BLANK), F.length(h))).otherwise(h))
        text = F.array_join(F.zip_with(F.split(text, pattern, -1), shown, lambda gap, h: F.concat(
            gap, F.coalesce(h, F.lit("")))), "")
    return text


def _cleared(t: DataFrame, allowed: tuple[str, ...], least: int) -> DataFrame:
    """Column ``scanned``: the text with base findings, allowed spans and the joiners beside them blanked; empty
    where no run of candidates' characters is ``least`` long."""
    def long_run(c):
        return F.exists(F.split(c, "[^A-Za-z0-9+/_-]+"), lambda r: F.length(r) >= least)

    t = t.withColumn("scanned", F.when(long_run(F.col("text")), F.when(
        F.size("base") > 0, _without_base(F.col("text"))).otherwise(F.col("text"))).otherwise(""))
    steps = ["|".join(f"(?:{p})" for p in allowed)] if allowed else []
    for pattern in [*steps, f"(?<={_BLANK})[/_-]+", f"[/_-]+(?={_BLANK})"]:
        t = t.withColumn("scanned", _blanked(F.col("scanned"), pattern))
    return t


def _paths_cut(text: Column, c: CharClass) -> Column:
    """``text`` with the paths in runs of ``c`` cut: at every '/' if a segment is long enough, else behind the path."""
    def cut(gap, run):
        segs = F.split(run, "/")
        lead = F.when(run.startswith("/"), 1).otherwise(0)
        bad = F.array_position(F.transform(F.slice(segs, lead + 1, F.size(segs) - 1 - lead), lambda x: x.rlike(PATH_SEGMENT)),
                               F.lit(False)).cast("int")
        depth = F.when(bad > 0, bad - 1).otherwise(F.size(segs) - 1 - lead)
        path = F.length(F.array_join(F.slice(segs, 1, lead + depth), "/")) + 1
        treated = F.when(F.exists(segs, lambda x: F.length(x) >= c.window), F.translate(run, "/", _BLANK)).otherwise(
            F.concat(F.repeat(F.lit(_BLANK), path), F.substring(run, path + 1, F.length(run))))
        return F.concat(gap, F.when(run.isNull(), "").when(run.contains("/") & (depth >= PATH_DEPTH), treated).otherwise(run))

    whole = F.zip_with(F.split(text, c.pattern, -1), F.regexp_extract_all(text, F.lit(c.pattern), F.lit(0)), cut)
    return F.when(text.rlike(f"/[A-Za-z0-9_-]{{2,16}}/"), F.array_join(whole, "")).otherwise(text)


def _wanted(c: CharClass, run: Column) -> Column:
    """Whether a run is scanned: it has what its class needs and enough different characters."""
    ok = F.lit(True)
    for p in c.needs:
        ok = ok & run.rlike(p)
    return ok & (F.size(F.array_distinct(F.split(F.lower(run) if c.fold else run, ""))) >= math.ceil(2 ** c.threshold - 1e-9))


def _stretches(t: DataFrame, c: CharClass, order: int) -> DataFrame:
    """Column ``<kind>_high``: the spans of the class; they are blanked in ``scanned`` for the classes after it."""
    k, none = c.kind, F.struct(F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    t = _found(t, k, c.pattern, 0, "scanned")
    t = t.withColumn(f"{k}_in", F.transform(f"{k}_hits", lambda run: F.when(_wanted(c, run), high_entropy(run, c)).otherwise(none)))
    spans = F.zip_with(k, f"{k}_in", lambda x, h: F.when(h["first"] >= 0, F.struct(
        (x["start"] + h["first"]).alias("start"), F.lit(order).alias("ord"), (x["start"] + h["last"]).alias("end"),
        F.lit(k).alias("kind"))))
    t = t.withColumn(f"{k}_high", F.filter(spans, lambda x: x.isNotNull()))
    shown = F.zip_with(f"{k}_hits", f"{k}_in", lambda run, h: F.when(h["first"] >= 0, F.concat(
        F.substring(run, F.lit(1), h["first"]), F.repeat(F.lit(_BLANK), h["last"] - h["first"]),
        F.substring(run, h["last"] + 1, F.length(run)))).otherwise(run))
    rest = F.array_join(F.zip_with(f"{k}_gaps", shown, lambda gap, run: F.concat(gap, F.coalesce(run, F.lit("")))), "")
    return t.withColumn("scanned", F.when(F.size(f"{k}_high") > 0, rest).otherwise(F.col("scanned"))).drop(
        k, f"{k}_hits", f"{k}_gaps", f"{k}_in")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """One row per input row: ``base`` and ``added`` spans (start, ord, end, kind), by start and kind."""
    t = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for kind, pattern, group, _ in BASE_RULES:
        t = _found(t, kind, pattern, group).drop(f"{kind}_hits", f"{kind}_gaps")
    base = [_tagged(kind, kind, i, least) for i, (kind, _, _, least) in enumerate(BASE_RULES)]
    t = t.withColumn("base", F.expr(f"sort_array(concat({', '.join(base)}))"))
    t = _cleared(t, allowed, min(c.window for c in classes))
    for c in classes:
        if "/" in c.alphabet:
            t = t.withColumn("scanned", _paths_cut(F.col("scanned"), c))
    for i, c in enumerate(classes):
        t = _stretches(t, c, len(BASE_RULES) + i)
    return t.select("doc_id", "text", "base", F.sort_array(F.concat(*[f"{c.kind}_high" for c in classes])).alias("added"))


def spans_text(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def digest(scanned: DataFrame) -> DataFrame:
    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return scanned.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind, *_ in BASE_RULES],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.sort_array(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"))


def redact(scanned: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The texts with every found span replaced by ``mark``; overlapping spans are replaced together."""
    pieces = ("aggregate(sort_array(concat(base, added)), struct(0 AS at, '' AS out), (s, x) -> CASE "
              "WHEN x.end <= s.at THEN s WHEN x.start < s.at THEN struct(x.end AS at, s.out AS out) ELSE "
              f"struct(x.end AS at, concat(s.out, substring(text, s.at + 1, x.start - s.at), '{mark}') AS out) END, "
              "s -> concat(s.out, substring(text, s.at + 1, length(text))))")
    return scanned.select("doc_id", F.expr(pieces).alias("text"))
