"""URL filter by a tree of path templates (operator 2), DataFrame functions only.

Rules name a host and the start of a path; the longest that fits decides.  All other urls are
judged by the template they fall under:

1. Variable segments of the path (numbers, ids, hashes, dates) become wildcards at once.
2. Level by level, under every node of a host's tree, siblings whose labelled shares are
   statistically alike (two-proportion test against the branch they join) are merged into one branch,
   however many they are and whatever their number of labels; those without labels are a branch.
3. A template's share of bad labels is smoothed towards that of all labelled urls; templates
   at or above the limit are rejected.

Labels come with the input; urls without one count for the tree but not for the share.  The
tree is built from counts per (host, generalised path), never from single urls.

Defined results: a null url, or one without ``://``, has an empty host and an empty path; a
repeated id keeps its rows, and is bad if any of its labels says so; with no labels at all every
template is allowed; an empty table has no rows; other columns are ignored.  Siblings of equal counts are
never parted; of equal shares the one with fewer labels is tested first.  Of rules of equal length that
fit, the one listed last decides.  Very long urls are split by array functions, in proportion to their length.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staysense.llm.common import ascii_lower
from staysense.session import cut_lineage


@dataclass(frozen=True)
class TreeRules:
    named: int = 25                 # a branch of more siblings is named after the first, a star and their number
    z_alike: float = 1.96           # siblings whose shares differ by less than that are one branch
    prior_weight: float = 5.0       # labelled urls that the overall share counts as
    reject_at: float = 0.8          # smoothed share of bad labels


#: What makes a segment variable, and the wildcard it becomes.
VARIABLE = (
    (r"[0-9]+", "{n}"),
    (r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}", "{uuid}"),
    (r"(?=[0-9A-Fa-f]*[0-9])[0-9A-Fa-f]{8,}", "{hex}"),
    (r"[0-9]{4}-[0-9]{2}(?:-[0-9]{2})?", "{date}"),
    (r"(?=.*[0-9])(?=.*[A-Za-z]).{6,}", "{id}"),
)


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return (ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null if none; ``rules``: (verdict, host/path)."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):       # the longest ends up outermost
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def segments(path: Column) -> Column:
    """The path's segments with variable ones as wildcards; a file name keeps its suffix."""
    def general(seg):
        stem = F.regexp_extract(seg, r"(?s)^(.*?)(\.[A-Za-z]{1,5})?\z", 1)
        suffix = F.regexp_extract(seg, r"(?s)^(.*?)(\.[A-Za-z]{1,5})?\z", 2)
        out = stem
        for pattern, name in reversed(VARIABLE):
            out = F.when(stem.rlike(f"(?s)^(?:{pattern})\\z"), F.lit(name)).otherwise(out)
        return F.concat(out, suffix)

    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), general)


def build_tree(urls: DataFrame, rules: TreeRules = TreeRules()) -> DataFrame:
    """(host, segs, template): the template of every generalised path; ``urls``: host, segs, bad."""
    nodes = cut_lineage(urls.groupBy("host", "segs").agg(
        F.count("*").alias("n"), F.count("bad").alias("labelled"),
        F.sum(F.coalesce(F.col("bad").cast("long"), F.lit(0))).alias("bad")))
    done, active = [], nodes.withColumn("template", F.lit("")).withColumn("rest", F.col("segs"))
    while True:
        active = cut_lineage(_common_start(active))
        done.append(active.where("size(rest) = 0").drop("rest"))
        active = active.where("size(rest) > 0")
        if active.isEmpty():
            return reduce(DataFrame.unionByName, done)
        active = cut_lineage(_merge_level(active, rules))


def _common_start(nodes: DataFrame) -> DataFrame:
    """Goes on to where the paths under a template part: an only child has no sibling to be merged with."""
    ends = nodes.where("size(rest) > 0").groupBy("host", "template").agg(F.min("rest").alias("lo"), F.max("rest").alias("hi"))
    ends = ends.withColumn("same", F.expr("zip_with(lo, hi, (x, y) -> coalesce(x = y, false))")).select(
        "host", "template", F.expr("if(array_contains(same, false), array_position(same, false) - 1, size(same))").cast(
            "int").alias("shared"))
    out = nodes.join(ends, ["host", "template"], "left").withColumn(
        "shared", F.when(F.size("rest") > 0, F.col("shared")).otherwise(0))
    return out.select("host", "segs", "n", "labelled", "bad", F.when(F.col("shared") > 0, F.concat(
        "template", F.lit("/"), F.array_join(F.slice("rest", F.lit(1), F.col("shared")), "/"))).otherwise(
        F.col("template")).alias("template"), F.slice("rest", F.col("shared") + 1, F.size("rest")).alias("rest"))


def _branches(kids: DataFrame, rules: TreeRules) -> DataFrame:
    """(host, template, labelled, bad, branch, members): the branch of the siblings with these counts.

    Siblings with equal counts are one class, so that a family of N labels has about N^(2/3) classes at
    most.  By rising share, a class joins the branch before it when one of its siblings passes the
    two-proportion test against that whole branch; siblings without labels are a branch of their own.
    The fold keeps the open branch's counts and the classes' branch numbers as text (its state is copied at every step).
    """
    classes = kids.groupBy("host", "template", "labelled", "bad").agg(F.count("*").alias("m")).withColumn(
        "share", F.col("bad") / F.greatest("labelled", F.lit(1)))
    family = classes.groupBy("host", "template").agg(F.sort_array(F.collect_list(
        F.struct((F.col("labelled") == 0).alias("none"), "share", "labelled", "bad", "m"))).alias("classes"))
    pooled = "((s.bad + x.bad) / (s.labelled + x.labelled))"
    error = f"sqrt({pooled} * (1 - {pooled}) * (1 / s.labelled + 1 / x.labelled))"
    alike = f"(s.labelled > 0 AND x.labelled > 0 AND abs(x.share - s.bad / s.labelled) <= {rules.z_alike}D * {error})"
    numbers = (
        "split(aggregate(classes, struct(0L AS labelled, 0L AS bad, -1 AS branch, '' AS out), (s, x) -> CASE "
        f"WHEN {alike} THEN struct(s.labelled + x.m * x.labelled AS labelled, s.bad + x.m * x.bad AS bad, s.branch AS branch, "
        "concat(s.out, ',', CAST(s.branch AS STRING)) AS out) "
        "ELSE struct(x.m * x.labelled AS labelled, x.m * x.bad AS bad, s.branch + 1 AS branch, "
        "concat(s.out, ',', CAST(s.branch + 1 AS STRING)) AS out) END, s -> substring(s.out, 2)), ',')")
    found = family.select("host", "template", F.explode(F.expr(
        f"zip_with(classes, {numbers}, (x, b) -> struct(x.labelled AS labelled, x.bad AS bad, x.m AS m, CAST(b AS INT) AS branch))"
    )).alias("c")).select("host", "template", "c.*")
    whole = Window.partitionBy("host", "template", "branch")        # classes of a branch
    return found.withColumn("members", F.sum("m").over(whole)).drop("m")


def _merge_level(nodes: DataFrame, rules: TreeRules) -> DataFrame:
    """Extends every template by what its next segment becomes; all ``nodes`` have one."""
    nodes = nodes.withColumn("seg", F.get("rest", F.lit(0)))
    kids = nodes.groupBy("host", "template", "seg").agg(
        F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    kids = kids.join(_branches(kids, rules), ["host", "template", "labelled", "bad"])
    # a branch is named after its members, one of many after the first and their number
    few = F.col("members") <= rules.named
    names = kids.groupBy("host", "template", "branch").agg(
        F.max("members").alias("members"), F.min("seg").alias("least"),
        F.sort_array(F.collect_list(F.when(few, F.col("seg")))).alias("all"))
    names = names.select("host", "template", "branch", F.when(few, F.array_join("all", "|")).otherwise(
        F.concat("least", F.lit("|*|"), F.col("members").cast("string"))).alias("name"))
    named = kids.select("host", "template", "seg", "branch").join(names, ["host", "template", "branch"]).drop("branch")
    return nodes.join(named, ["host", "template", "seg"]).withColumn("template", F.concat(
        "template", F.lit("/"), "name")).select(
        "host", "segs", "n", "labelled", "bad", "template", F.expr("slice(rest, 2, size(rest))").alias("rest"))


def judge_templates(nodes: DataFrame, rules: TreeRules = TreeRules()) -> DataFrame:
    """(host, template, urls, labelled, bad_share, rejected) per template."""
    overall = nodes.agg(F.sum("bad").alias("all_bad"), F.sum("labelled").alias("all_labelled"))
    prior = F.col("all_bad") / F.greatest("all_labelled", F.lit(1))
    per = nodes.groupBy("host", "template").agg(
        F.sum("n").alias("urls"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    share = (F.col("bad") + rules.prior_weight * prior) / (F.col("labelled") + rules.prior_weight)
    return per.crossJoin(F.broadcast(overall)).select(
        "host", "template", "urls", "labelled", share.alias("bad_share"),
        ((F.col("labelled") > 0) & (share >= rules.reject_at)).alias("rejected"))


def judge(df: DataFrame, rules: list[tuple[str, str]], labels: DataFrame | None = None,
          tree: TreeRules = TreeRules(), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Host, path, rule, template and verdict of every url.

    Labels are the verdicts of ``rules``; ``labels`` (id, bad) adds others where no rule fits.
    """
    host, path = host_path(F.col(url_col))
    urls = df.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = urls.withColumn("rule", rule).withColumn("by_rule", verdict).withColumn(
        "segs", segments(F.col("path")))
    urls = urls.withColumn("bad", F.col("by_rule") == "block")
    if labels is not None:
        known = labels.groupBy(F.col("id").alias("known_id")).agg(F.max("bad").alias("known_bad"))
        urls = urls.join(known, F.col("id") == F.col("known_id"), "left").withColumn(
            "bad", F.coalesce("bad", "known_bad")).drop("known_id", "known_bad")
    nodes = cut_lineage(build_tree(urls, tree))
    verdicts = nodes.select("host", "segs", "template").join(
        judge_templates(nodes, tree), ["host", "template"])
    return urls.join(verdicts, ["host", "segs"]).select(
        "id", "host", "path", "rule", "template",
        F.coalesce("by_rule", F.when(F.col("rejected"), F.lit("block")).otherwise("allow")).alias("verdict"),
        "labelled", "bad_share")
