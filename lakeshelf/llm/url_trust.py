"""URL filter by link-graph propagation.

Hosts are nodes; links between hosts, counted over all pages, are edges.
Trust starts at hosts with pages under allow rules and follows links
(personalised PageRank); distrust starts at hosts with pages under block rules
and runs against the links, to the hosts that point there. A seed's weight is
the share of its host's pages under such rules. Distrust is split over all
links into a host, so each share shrinks with their number. Exposure is the
same distrust averaged over the links of the host that points there, however
many others do. A host is blocked if its distrust or its exposure exceeds its
trust by ``margin``; a page under a rule follows the longest rule instead.

All of it is DataFrame operations: edges are summed before they are joined,
each iteration is a join, a grouped sum and a written table. The verdicts of
hosts are broadcast only if their measured size is small.

Defined cases: a null url, or one without "://", has an empty host and path,
fits no rule and is allowed; null html has no links; links within a host count
for nothing; repeated pages are judged alike; an empty table gives no rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checked_broadcast, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))

_URL = r"(?s)://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def _lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_of(url: Column) -> Column:
    return _lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES, field: str = "text") -> Column:
    """``text`` or ``verdict`` of the longest rule that fits (of equally long
    ones the first), else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):  # the longest is tested first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(getattr(r, field))).otherwise(out)
    return out


def located(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, rule_verdict)."""
    p = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    h, a = F.col("host"), F.col("path")
    return p.select("page_id", "host", "path", rule_of(h, a, rules).alias("rule"), rule_of(h, a, rules, "verdict").alias("rule_verdict"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links from pages of one host to another."""
    links = pages.select(host_of(F.col("url")).alias("src"),
                         F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("dst"))
    links = links.select("src", _lower(F.col("dst")).alias("dst")).where("src != dst and src != ''")
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, rounds: int = 20, tolerance: float = 1e-4) -> DataFrame:
    """(host, trust, distrust, exposure) for all hosts of ``seeds`` (host, allow,
    block) and ``edges`` (src, dst, n, written). Stops after ``rounds`` or when no value
    moves by ``tolerance``."""
    out_sum = edges.groupBy("src").agg(F.sum("n").alias("total"))
    in_sum = edges.groupBy("dst").agg(F.sum("n").alias("total"))
    forward = edges.join(out_sum, "src").select(F.col("src").alias("host"), F.col("dst").alias("to"),
                                                (F.col("n") / F.col("total")).alias("wt"),
                                                F.lit(0.0).alias("wd"), F.lit(0.0).alias("wx"))
    back = edges.join(in_sum, "dst").join(out_sum.withColumnRenamed("total", "links"), "src").select(
        F.col("dst").alias("host"), F.col("src").alias("to"), F.lit(0.0).alias("wt"),
        (F.col("n") / F.col("total")).alias("wd"), (F.col("n") / F.col("links")).alias("wx"))
    flows = materialize(forward.unionByName(back), "flows")
    nodes = seeds.unionByName(edges.select(F.explode(F.array("src", "dst")).alias("host"), F.lit(0.0).alias("allow"), F.lit(0.0).alias("block")))
    nodes = materialize(nodes.groupBy("host").agg(F.max("allow").alias("allow"), F.max("block").alias("block")), "nodes")
    base = {"trust": "allow", "distrust": "block", "exposure": "block"}
    start = {c: (1 - damping) * F.col(seed) for c, seed in base.items()}
    state = nodes.select("host", "allow", "block", *[v.alias(c) for c, v in start.items()])
    if flows.isEmpty():
        return state.select("host", *base)
    for _ in range(rounds):
        got = flows.join(state, "host").groupBy(F.col("to").alias("host")).agg(
            *[F.sum(F.col(c) * F.col(w)).alias(f"_{c}") for c, w in zip(base, ("wt", "wd", "wx"))])
        new = {c: start[c] + damping * F.coalesce(f"_{c}", F.lit(0.0)) for c in base}
        state = materialize(state.join(got, "host", "left").select(
            "host", "allow", "block", *[v.alias(c) for c, v in new.items()],
            F.greatest(*[F.abs(F.col(c) - v) for c, v in new.items()]).alias("moved")), "ranks")
        if (state.agg(F.max("moved")).first()[0] or 0.0) < tolerance:
            break
        state = state.drop("moved")
    return state.select("host", *base)


def host_verdicts(pages: DataFrame, rules=RULES, damping: float = 0.85, margin: float | None = None) -> DataFrame:
    """(host, trust, distrust, exposure, blocked). ``margin`` defaults to what a host
    without links has when half of its pages are under block rules."""
    margin = (1 - damping) / 2 if margin is None else margin
    seeds = located(pages, rules).where("host != ''").groupBy("host").agg(
        F.avg(F.coalesce((F.col("rule_verdict") == "allow").cast("double"), F.lit(0.0))).alias("allow"),
        F.avg(F.coalesce((F.col("rule_verdict") == "block").cast("double"), F.lit(0.0))).alias("block"))
    ranks = propagate(seeds, materialize(host_edges(pages), "edges"), damping)
    return ranks.withColumn("blocked", F.greatest("distrust", "exposure") - F.col("trust") > margin)


def judge(pages: DataFrame, rules=RULES, damping: float = 0.85, margin: float | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page."""
    blocked = host_verdicts(pages, rules, damping, margin).where("blocked").select("host", "blocked")
    out = located(pages, rules).join(checked_broadcast(blocked), "host", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce(
        "rule_verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"))
