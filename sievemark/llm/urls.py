"""URL filter: a path-template tree per host, judged by smoothed labelled purity.

Listed rules label the URLs they fit. Every host's paths form a tree of segments. Segments
that look like numbers, hashes or dates become their class at once. Then, level by
level, children of one node are compared with their siblings: children too rare and
too many to be sections of the site, and children whose labels do not differ from their
siblings' beyond chance, become one wildcard branch; the others stay literal. A template is rejected if the share of blocked URLs among its labelled ones,
smoothed towards the overall share, reaches ``reject_at``.

All of it is DataFrame work: one count per node and child per level, then a lookup of
the children that stay literal.

Defined cases: a null url, or one without ``://``, has empty host and path and is judged
by its template alone; repeated rows count each; without labels nothing is rejected; an
empty table gives an empty result; extra columns pass through, names beginning with
``__`` are reserved.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.llm.columns import without
from sievemark.session import durable

#: An action and what it holds for: ``host/path`` beginnings; the host stands for its subdomains too.
UrlRule = tuple[str, str]

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WILDCARD = "*"
_CLASSES = (
    (r"^[0-9]+$", "<n>"),
    (r"^[0-9]{4}-[0-9]{2}(?:-[0-9]{2})?$", "<date>"),
    (r"^(?=[^0-9]*[0-9])[0-9a-f]{8,}(?:-[0-9a-f]+)*$", "<hex>"),
)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _CAPITALS, _SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The longest rule that fits, as ``struct(action, rule)``; null without one."""
    out = None
    for action, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        value = F.struct(F.lit(action).alias("action"), F.lit(rule).alias("rule"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<action:string,rule:string>")


def _classed(segment: Column) -> Column:
    """The class of a segment that is variable by its looks; an ending such as ``.html`` stays."""
    stem = F.regexp_extract(segment, r"^(.*?)(\.[A-Za-z]{2,5})?$", 1)
    ending = F.coalesce(F.regexp_extract(segment, r"^(.*?)(\.[A-Za-z]{2,5})?$", 2), F.lit(""))
    out = segment
    for pattern, name in reversed(_CLASSES):
        out = F.when(stem.rlike(pattern), F.concat(F.lit(name), ending)).otherwise(out)
    return out


def _children(rows: DataFrame) -> DataFrame:
    return rows.groupBy("__host", "__node", "__seg").agg(
        F.sum("__n").alias("n"), F.sum("__known").alias("known"), F.sum("__blocked").alias("blocked")
    )


def templates(
    pages: DataFrame,
    host: str = "host",
    path: str = "path",
    blocked: str = "blocked",
    max_depth: int = 4,
    max_children: int = 30,
    min_pages: int = 5,
    alpha: float = 0.05,
) -> DataFrame:
    """Add ``template``. ``blocked`` is true or false where a URL is labelled, else null.

    Segments beyond ``max_depth`` become one wildcard. A node with more than
    ``max_children`` children keeps as literal only those with at least ``min_pages``
    pages. A labelled child merges if its blocked share stays within the bound
    sqrt(ln(2/alpha)/2) * (1/sqrt(n) + 1/sqrt(m)) of that of its labelled siblings.
    """
    pages = without(pages, "template")
    names = pages.columns
    parts = F.filter(F.split(F.coalesce(F.col(path), F.lit("")), "/"), lambda s: s != "")
    known = F.col(blocked).isNotNull().cast("long")
    rows = pages.select(
        *names,
        F.coalesce(F.col(host), F.lit("")).alias("__host"),
        parts.alias("__parts"),
        F.lit("").alias("__node"),
        F.lit(1).cast("long").alias("__n"),
        known.alias("__known"),
        F.coalesce(F.col(blocked).cast("long"), F.lit(0)).cast("long").alias("__blocked"),
    )
    # Learning needs one row per host and path, not one per page.
    paths = durable(
        rows.groupBy("__host", "__parts", "__node").agg(F.sum("__n").alias("__n"), F.sum("__known").alias("__known"), F.sum("__blocked").alias("__blocked"))
    )
    spread = math.sqrt(math.log(2 / alpha) / 2)
    literal_tables = []
    level_rows = paths
    for depth in range(max_depth):
        level_rows = level_rows.withColumn("__seg", _classed(F.get("__parts", F.lit(depth))))
        children = _children(level_rows.where(F.col("__seg").isNotNull()))
        nodes = children.groupBy("__host", "__node").agg(
            F.count("*").alias("all_children"),
            F.sum("known").alias("all_known"),
            F.sum("blocked").alias("all_blocked"),
        )
        others = F.col("all_known") - F.col("known")
        gap = F.abs(F.col("blocked") / F.col("known") - (F.col("all_blocked") - F.col("blocked")) / others)
        bound = F.lit(spread) * (1 / F.sqrt("known") + 1 / F.sqrt(others))
        alike = F.when((F.col("known") > 0) & (others > 0), gap < bound)
        rare = (F.col("all_children") > max_children) & (F.col("n") < min_pages)
        literal = durable(
            children.join(nodes, ["__host", "__node"])
            .where(~F.coalesce(alike, F.lit(False)) & ~rare)
            .select("__host", "__node", "__seg", F.lit(True).alias("__literal"))
        )
        literal_tables.append(literal)
        level_rows = _descend(level_rows, literal)
    for depth, literal in enumerate(literal_tables):
        rows = _descend(rows.withColumn("__seg", _classed(F.get("__parts", F.lit(depth)))), literal)
    deeper = F.when(F.size("__parts") > max_depth, F.lit("/**")).otherwise("")
    return rows.select(*names, F.concat("__host", F.when(F.col("__node") == "", "/").otherwise(F.col("__node")), deeper).alias("template"))


def _descend(rows: DataFrame, literal: DataFrame) -> DataFrame:
    """Move every row to the child its segment belongs to."""
    joined = rows.join(literal, ["__host", "__node", "__seg"], "left")
    label = F.when(F.col("__literal"), F.col("__seg")).otherwise(WILDCARD)
    node = F.when(F.col("__seg").isNull(), F.col("__node")).otherwise(F.concat("__node", F.lit("/"), label))
    return joined.withColumn("__node", node).drop("__seg", "__literal")


def judge(
    pages: DataFrame,
    rules: Sequence[UrlRule],
    url: str = "url",
    smoothing: float = 10.0,
    reject_at: float = 0.8,
) -> DataFrame:
    """Add ``host path rule template purity verdict``. A fitting rule decides; else the template does."""
    pages = without(pages, "host", "path", "rule", "template", "purity", "verdict")
    names = pages.columns
    parsed = pages.withColumn("__h", host_of(F.col(url))).withColumn("__p", path_of(F.col(url)))
    ruled = parsed.withColumn("__rule", fitting_rule(F.col("__h"), F.col("__p"), rules))
    labelled = ruled.withColumn("__label", F.col("__rule.action") == "block")
    placed = templates(labelled, "__h", "__p", "__label")
    stats = placed.groupBy("template").agg(
        F.count("__label").alias("__known"), F.sum(F.col("__label").cast("long")).alias("__bad")
    )
    totals = labelled.agg(F.count("__label").alias("n"), F.sum(F.col("__label").cast("long")).alias("bad")).first()
    prior = (totals["bad"] or 0) / totals["n"] if totals["n"] else 0.0
    purity = (F.coalesce(F.col("__bad"), F.lit(0)) + smoothing * prior) / (F.col("__known") + smoothing)
    # A template nobody labelled has no purity of its own and is not rejected.
    rejected = F.when(F.col("__known") > 0, purity >= reject_at).otherwise(F.lit(False))
    judged = placed.join(stats.withColumn("purity", purity).withColumn("__no", rejected).drop("__bad", "__known"), "template")
    method = F.when(F.col("__no"), "block").otherwise("allow")
    return judged.select(
        *names,
        F.col("__h").alias("host"),
        F.col("__p").alias("path"),
        F.col("__rule.rule").alias("rule"),
        "template",
        "purity",
        F.coalesce(F.col("__rule.action"), method).alias("verdict"),
    )
