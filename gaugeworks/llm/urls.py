"""URL filter by a path-template tree.

Per host, the paths form a tree of segments. From the root down, a segment stays a
branch of its own only if enough pages lie under it and its share of blocked pages
differs significantly from that of its parent's pages; all other siblings, rare ids and
branches that behave alike, merge into one wildcard branch, whose next segments are again
split the same way. What is left are templates. Labels come from hand-written rules; a
template is rejected when its smoothed share of blocked labels reaches a bound.

Only built-in functions, joins and aggregations. Pages are first counted per distinct
host and path with map-side aggregation; tables of kept branches are written before they
are joined, so that adaptive execution can broadcast a small one by its measured size or
split the rows of a hot host.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.text import filled, folded
from gaugeworks.session import cut_lineage


@dataclass(frozen=True)
class UrlRule:
    """Fits a host with all its subdomains and the paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class TreeRules:
    """Depth of the tree, least pages of a branch, z of the test, prior weight, bound."""

    depth: int = 4
    support: int = 20
    z: float = 3.0
    weight: float = 4.0
    reject: float = 0.8


HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


def rule_of(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """Text of the longest rule that fits, else null; equally long ones in the given order."""
    found = None
    for rule in sorted(rules, key=lambda r: -len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, rule.text) if found is None else found.when(fits, rule.text)
    return F.lit(None).cast("string") if found is None else found


def templates(paths: DataFrame, tree: TreeRules) -> DataFrame:
    """``host, path, n, blocked, allowed`` per distinct path, with its ``template`` added."""
    rows = paths.withColumn("_parts", F.slice(F.split("path", "/"), 2, 2**31 - 1)).withColumn("template", F.lit(""))
    for level in range(tree.depth):
        rows = rows.withColumn("_part", F.get("_parts", F.lit(level)))
        below = rows.filter("_part is not null")
        children = below.groupBy("host", "template", "_part").agg(F.sum("n").alias("n"), F.sum("blocked").alias("b"))
        parents = rows.groupBy("host", "template").agg(F.sum("n").cast("double").alias("pn"), F.sum("blocked").cast("double").alias("pb"))
        gap = F.col("b") * F.col("pn") - F.col("n") * F.col("pb")
        spread = F.lit(tree.z * tree.z) * F.col("n") * F.col("pb") * (F.col("pn") - F.col("pb"))
        kept = cut_lineage(
            children.filter(F.col("n") >= tree.support)
            .join(parents, ["host", "template"])
            .filter(gap * gap > spread)
            .select("host", "template", "_part", F.lit(True).alias("_own"))
        )
        own = F.when(F.col("_own"), F.col("_part")).otherwise(F.lit("*"))
        rows = (
            rows.join(kept, ["host", "template", "_part"], "left")
            .withColumn("template", F.when(F.col("_part").isNotNull(), F.concat("template", F.lit("/"), own)).otherwise(F.col("template")))
            .drop("_own", "_part")
        )
    deeper = F.size("_parts") > tree.depth
    return rows.withColumn("template", F.when(deeper, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))).drop("_parts")


def judged_templates(paths: DataFrame, tree: TreeRules) -> DataFrame:
    """Every template's pages, labels, smoothed purity and whether it is rejected."""
    groups = paths.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "blocked", "allowed")])
    b, a = paths.agg(F.sum("blocked"), F.sum("allowed")).first()
    prior = ((b or 0) + 1.0) / ((b or 0) + (a or 0) + 2.0)
    purity = (F.col("blocked") + F.lit(tree.weight * prior)) / (F.col("blocked") + F.col("allowed") + F.lit(tree.weight))
    return groups.withColumn("purity", purity).withColumn("rejected", F.col("purity") >= tree.reject)


def judge_urls(pages: DataFrame, rules: Sequence[UrlRule] = RULES, tree: TreeRules = TreeRules()) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and the page's ``template`` and ``purity``.

    The verdict is the rule's where one fits, else ``block`` on rejected templates and
    ``allow`` elsewhere. A null url, or one without ``://``, has empty host and path and is
    judged like any other. Null or repeated page_ids are rows of their own. Empty table: no
    rows. Further columns of any name are ignored.
    """
    url = filled(F.col("url"))
    rows = pages.select(
        "page_id", folded(F.regexp_extract(url, HOST, 1)).alias("host"), F.regexp_extract(url, PATH, 1).alias("path")
    )
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in (r.text, r.verdict)]) if rules else F.create_map(F.lit(""), F.lit(""))
    ruled = F.when(F.col("rule").isNotNull(), F.element_at(verdicts, F.col("rule")))
    paths = rows.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count_if(ruled == "block").alias("blocked"), F.count_if(ruled == "allow").alias("allowed")
    )
    shaped = cut_lineage(templates(cut_lineage(paths), tree))
    judged = cut_lineage(judged_templates(shaped, tree).select("host", "template", "purity", "rejected"))
    known = shaped.select("host", "path", "template").join(judged, ["host", "template"])
    return rows.join(cut_lineage(known), ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce(ruled, F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"),
        "template",
        "purity",
    )
