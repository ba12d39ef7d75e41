"""URL filters with redirect equivalence.

A page is judged by the longest allow or block rule that fits its host and path. A page that no
rule fits takes the verdict of its aliases: URLs tied to it by redirects (a refresh in the page, or
a given redirect table) or canonical links. Aliases are the connected components of those edges. In
a component an explicit allow goes before any block; without either, the default holds.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits no rule, is no
alias of anything and gets the default verdict. Repeated rows get the same verdict each. Of two
rules as long, allow wins, then the first in sort order. Links to relative targets other than
``/...`` are no edges. A null or empty html has no links. Other columns pass through; those named
like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_bounded
from .common import free_name, without
from .components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The URL as a node: lower-cased host and the rest up to ``#``, whatever the scheme."""
    return F.when(_rest(url).isNotNull(),
                  F.concat(host_of(url), F.regexp_extract(_rest(url), r"^[^/?#]*([^#]*)", 1)))


def rules_frame(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(action, ``host/path``) pairs as a table of rule, rule_host, rule_path, action."""
    rows = [(r, r.partition("/")[0], "/" + r.partition("/")[2], a) for a, r in rules]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, action string")


def match_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest fitting rule of every distinct (host, path) that any rule fits."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    tails = (places.select("host", "path").distinct().where("host <> ''")
             .withColumn("rule_host", F.explode(F.array_distinct(suffixes))))
    fits = tails.join(broadcast_if_bounded(rules), "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    best = F.struct((-F.length("rule")).alias("size"), F.col("action"), F.col("rule"))  # "allow" sorts first
    return (fits.groupBy("host", "path").agg(F.min(best).alias("best"))
            .select("host", "path", "best.rule", "best.action"))


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): each page's node and the node its canonical link or refresh names."""
    tag = F.explode(F.concat(F.regexp_extract_all(F.col(html), F.lit(CANONICAL), F.lit(0)),
                             F.regexp_extract_all(F.col(html), F.lit(REFRESH), F.lit(0))))
    quoted = F.regexp_extract("tag", r"(?is)(?:href\s*=|url\s*=)\s*[\"']?([^\"'\s>]+)", 1)
    linked = (pages.where(F.col(html).rlike(r"(?i)canonical|refresh") & F.col(url).contains("://"))
              .select(F.col(url).alias("_url"), tag.alias("tag")).withColumn("to", quoted))
    scheme = F.substring_index("_url", "://", 1)
    target = F.when(F.col("to").contains("://"), F.col("to")).when(
        F.col("to").startswith("//"), F.concat(scheme, F.lit(":"), F.col("to"))).when(
        F.col("to").startswith("/"), F.concat(scheme, F.lit("://"), host_of(F.col("_url")), F.col("to")))
    return linked.select(node_of(F.col("_url")).alias("a"), node_of(target).alias("b")).where("b is not null")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", html: str | None = "html",
          redirects: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict (and by_alias: the verdict came from aliases).

    ``redirects`` has from_url and to_url.
    """
    new = ["host", "path", "rule", "verdict", "by_alias"]
    pages = without(pages, new)
    link = F.col(url)
    edges = None
    if html:
        edges = link_edges(pages, url, html)
    if redirects is not None:
        given = redirects.select(node_of(F.col("from_url")).alias("a"), node_of(F.col("to_url")).alias("b"))
        edges = given if edges is None else edges.unionByName(given)
    action, alias, node = (free_name(pages, n) for n in ("rule_action", "alias_action", "link_node"))
    placed = pages.withColumns({"host": host_of(link), "path": path_of(link), node: node_of(link)})
    judged = placed.join(match_rules(placed, rules).withColumnRenamed("action", action), ["host", "path"], "left")
    if edges is None:
        judged = judged.withColumn(alias, F.lit(None).cast("string"))
    else:
        found = connected_components(edges)
        as_url = F.concat(F.lit("x://"), F.col("node"))
        members = found.withColumns({"host": host_of(as_url), "path": path_of(as_url)})
        said = members.join(match_rules(members, rules), ["host", "path"], "left")
        # min over the actions: "allow" sorts before "block", and null (no rule) is skipped.
        votes = said.groupBy("component").agg(F.min("action").alias(alias))
        judged = judged.join(found.join(votes, "component").select(F.col("node").alias(node), alias), node, "left")
    keep = [F.col(f"`{c}`") for c in pages.columns]
    return judged.select(*keep, "host", "path", "rule", F.coalesce(action, alias, F.lit(default)).alias("verdict"),
                         (F.col(action).isNull() & F.col(alias).isNotNull()).alias("by_alias"))
