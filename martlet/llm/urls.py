"""URL filters: rules by host and path, and trust that spreads over links between hosts.

A rule names a host and the beginning of a path; it fits the host and its subdomains, and the
longest one that fits decides. Where none fits, the host's place in the link graph decides: a
host is a trusted seed by the share of its pages that a rule allows, and a blocked seed by the
share that a rule blocks. Trust is the personalised PageRank from the trusted seeds along the
links, distrust the one from the blocked seeds against the links (who links to spam is suspect).
A host is blocked where distrust holds at least ``threshold`` of the two.

Everything per host is a Spark table; a round moves rank over the edges by one join and one sum.
What hosts without links hold goes back to the seeds, which only changes all ranks by one factor,
so it is left to the end, where ranks are made shares. Nothing but the count that ends the rounds
reaches the driver; some rounds are written together, and the written ones before are deleted.

Defined results: the host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z in lower case; the path goes on from there up to ``?``, ``#`` or the end. A null url and one
without ``://`` have an empty host and path, fit no rule and are allowed, as is a host that no
rank reaches. Links within a host count for nothing. Null html has no links. Of fitting rules
that are equally long, the one with the longer host wins. Repeated rows each get a row; an empty
table gives no rows; other columns take no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import lower_ascii
from martlet.session import materialise, scratch

ROUNDS_AT_ONCE = 4
_HOST = r"(?s)^.*?://([^/?#]*)"
_PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
_LINK = r"(?i)\b(?:href|src|action)\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s<>]+)"


@dataclass(frozen=True)
class Rule:
    """``host/path`` with the verdict ``allow`` or ``block``."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        below = (host == self.host) | host.endswith(f".{self.host}")
        return below & path.startswith(self.path)


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r.pattern), -len(r.host), r.verdict != "block"))
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in reversed(ordered):
        own = F.struct(F.lit(rule.pattern).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(rule.fits(host, path), own).otherwise(found)
    return found


def host_links(pages: DataFrame, host: Column, html: Column) -> DataFrame:
    """``src, dst, links`` between different hosts, from the links in the pages' html."""
    targets = F.regexp_extract_all(html, F.lit(_LINK), F.lit(1))
    links = pages.select(host.alias("src"), F.explode(targets).alias("dst"))
    links = links.select("src", lower_ascii(F.col("dst")).alias("dst"))
    between = links.where((F.col("src") != F.col("dst")) & (F.col("src") != ""))
    return between.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"))


def host_ranks(
    links: DataFrame,
    seeds: DataFrame,
    *,
    damping: float = 0.85,
    tolerance: float = 1e-4,
) -> DataFrame:
    """``host, trust, distrust``; ``seeds`` has ``host`` and the weights ``trusted, blocked``.

    Seeds send out their weight; each round, what reached a host goes on over its links, less the
    share that stops. A host's rank is all that ever reached it, as a share of what reached all.
    The rounds end when no host gains more than ``tolerance`` of what it has, so a host of small
    rank counts like any other and one that rank has just reached goes on: however far a chain of
    links is, it is followed to its end.
    """
    ways = [("trust", "src", "dst", "trusted"), ("distrust", "dst", "src", "blocked")]
    edges, start = [], []
    for kind, source, target, weight in ways:
        out = links.groupBy(source).agg(F.sum("links").alias("out"))
        edges.append(
            links.join(out, source).select(
                F.lit(kind).alias("kind"),
                F.col(source).alias("host"),
                F.col(target).alias("to"),
                (F.lit(damping) * F.col("links") / F.col("out")).alias("share"),
            )
        )
        own = F.col(weight).cast("double")
        start.append(seeds.where(own > 0).select(F.lit(kind).alias("kind"), "host", own.alias("rank")))
    with scratch(links.sparkSession) as held:
        held.append(edges := materialise(edges[0].union(edges[1])))
        first = start[0].union(start[1]).withColumn("flow", F.col("rank"))
        held.append(materialise(first))
        while held[-1].where(F.col("flow") > tolerance * F.col("rank")).limit(1).count():
            held.append(materialise(_rounds(edges, held[-1])))
        ranks = held[-1]
        total = ranks.groupBy("kind").agg(F.sum("rank").alias("total"))
        shared = ranks.join(total, "kind").withColumn("rank", F.col("rank") / F.col("total"))
        of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0.0))
        return materialise(
            shared.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))
        )


def _rounds(edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """``ranks`` (``kind, host, rank, flow``) after some rounds; ``flow`` is what came in the last."""
    parts = [ranks.withColumn("flow", F.lit(0.0))]
    flow = ranks.where(F.col("flow") > 0).select("kind", "host", "flow")
    for left in range(ROUNDS_AT_ONCE - 1, -1, -1):
        flow = (
            edges.join(flow, ["kind", "host"])
            .groupBy("kind", F.col("to").alias("host"))
            .agg(F.sum(F.col("flow") * F.col("share")).alias("flow"))
        )
        last = F.lit(0.0) if left else F.col("flow")
        parts.append(flow.select("kind", "host", F.col("flow").alias("rank"), last.alias("flow")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("flow").alias("flow"))


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    *,
    threshold: float = 0.5,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every page."""
    parts = pages.select(
        F.col(id_col).alias("id"),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
    )
    ruled = parts.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    verdict = F.col("found.verdict")
    shares = (
        ruled.where(F.col("host") != "")
        .groupBy("host")
        .agg(
            F.avg(F.when(verdict == "allow", 1).otherwise(0)).alias("allowed"),
            F.avg(F.when(verdict == "block", 1).otherwise(0)).alias("denied"),
        )
    )
    seeds = materialise(
        shares.select("host", F.col("allowed").alias("trusted"), F.col("denied").alias("blocked"))
    )
    links = materialise(host_links(pages, host_of(F.col(url_col)), F.col(html_col)))
    ranks = host_ranks(links, seeds)
    suspect = F.col("distrust") >= threshold * (F.col("trust") + F.col("distrust"))
    by_host = F.when(suspect & (F.col("distrust") > 0), "block").otherwise("allow")
    return ruled.join(ranks, "host", "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(verdict, by_host).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
