"""URL filter: host and path rules, and link-graph propagation for what no rule covers
(DataFrame functions only).

Trust starts at hosts whose pages the rules allow and follows links; distrust starts at
hosts whose pages they block and follows links backwards. Both are personalised PageRanks
over the host graph, as join-and-sum passes until the ranks stand still.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import written

# Fixed value: the attribute that holds a link, and its target.
LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?([^\"'\s>]+)"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(rest, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, or nulls."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):  # longer rules wrap shorter ones
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.text)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, links): links between different hosts, summed. Relative links stay on
    their host and are no edges."""
    target = F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    absolute = F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), F.col("to"))).otherwise(F.col("to"))
    return (
        pages.select(host_of(F.col("url")).alias("src"), target.alias("to"))
        .where(F.col("to").rlike("^([A-Za-z][A-Za-z0-9+.-]*:)?//"))
        .select("src", host_of(absolute).alias("dst"))
        .where("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("links"))
    )


def propagate(edges: DataFrame, seeds: DataFrame, tolerance: float, damping: float, name: str) -> DataFrame:
    """Personalised PageRank: edges (src, dst, links), seeds (host, seed) to (host, rank).

    rank = seed + damping * sum over in-links of the linking host's rank by link share: a
    host without links has its seed as rank. Hosts absent from the result have rank 0.

    Ranks only grow, and the sum grows by `damping` times the last growth at most, so what a
    host still lacks is bounded by the last growth: passes end when it is below `tolerance`,
    at the latest after as many as the sum of the seeds takes to shrink to that."""
    out = edges.groupBy("src").agg(F.sum("links").alias("total"))
    shares = written(
        edges.join(out, "src").select("src", "dst", (F.col("links") / F.col("total")).alias("share")), name
    )
    rank = seeds.select("host", F.col("seed").alias("rank"))
    if shares.isEmpty():
        return rank
    left = tolerance * (1 - damping) / damping
    mass = seeds.agg(F.sum("seed")).first()[0] or 0.0
    for _ in range(math.ceil(math.log(left / mass) / math.log(damping)) if mass > left else 0):
        sent = (
            rank.join(shares, rank.host == shares.src)
            .groupBy(F.col("dst").alias("host"))
            .agg((F.sum(F.col("rank") * F.col("share")) * damping).alias("part"))
        )
        rank = written(
            sent.unionByName(seeds.select("host", F.col("seed").alias("part")))
            .groupBy("host")
            .agg(F.sum("part").alias("rank")),
            name,
        )
        before, mass = mass, rank.agg(F.sum("rank")).first()[0]
        if mass - before <= left:
            break
    return rank


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    tolerance: float = 1e-6,
    damping: float = 0.85,
    threshold: float = 0.5,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, distrust.

    A host's seed of trust (distrust) is the share of its pages that rules allow (block).
    Without a rule a page is blocked when its host's distrust exceeds its trust by more
    than `threshold`, the weight of a host with that share of blocked pages; hosts that
    neither reaches are allowed. Null URLs and URLs without `://` have an empty host, which
    is never a seed; null html has no links. Ties at the threshold are allowed. Trust and
    distrust are `tolerance` below their limits at most.
    """
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = parts.withColumn("rule", rule).withColumn("ruled", verdict)
    hosts = written(
        judged.where("host <> ''")
        .groupBy("host")
        .agg(
            F.avg(F.coalesce((F.col("ruled") == "allow").cast("double"), F.lit(0.0))).alias("allowed"),
            F.avg(F.coalesce((F.col("ruled") == "block").cast("double"), F.lit(0.0))).alias("blocked"),
        ),
        "host-seeds",
    )
    edges = written(host_links(pages), "host-edges")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    trust = propagate(
        edges, hosts.where("allowed > 0").select("host", F.col("allowed").alias("seed")), tolerance, damping, "trust"
    )
    distrust = propagate(
        back, hosts.where("blocked > 0").select("host", F.col("blocked").alias("seed")), tolerance, damping, "distrust"
    )
    ranks = (
        hosts.select("host")
        .join(trust.withColumnRenamed("rank", "trust"), "host", "left")
        .join(distrust.withColumnRenamed("rank", "distrust"), "host", "left")
        .fillna(0.0)
    )
    by_method = F.when(F.col("distrust") - F.col("trust") > threshold, "block").otherwise("allow")
    return judged.join(ranks, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", by_method).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
