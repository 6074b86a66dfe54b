"""URL filter by rules and link-graph propagation, in DataFrame operations only.

Rules decide the urls they fit. They also seed the hosts: trust starts at hosts by
their allowed pages and flows along host links (personalised PageRank); distrust
starts at hosts by their blocked pages and flows against them, to whoever links
there. A url no rule fits is blocked if its host's distrust is above its trust by
the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chainstrata.llm.columns import LOWER, UPPER
from chainstrata.session import materialized

# (verdict, host, path prefix).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
STAY = 0.85
ROUNDS = 200  # of the SQL twin, whose scores lack less than 1e-13 of all mass
# Scores have settled once none moves by more than this share of itself; then at most STAY / (1 - STAY)
# times as much is missing. Equal scores may differ by that and by rounding, far less than ALIKE.
SETTLED = 1e-9
ALIKE = 1e-7
RATIO = 1.0
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?i)\shref\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#\"'\s>]+)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits the host or one it lies under, and whose path begins the url's."""
    rule = verdict = F.lit(None).cast("string")
    for decision, name, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(name + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """(source, target, weight) between different hosts, from a frame with ``host`` and the pages' html.

    Relative links stay on their host and are no edges. The share of a target in a
    host's links is combined before the shuffle.
    """
    targets = F.transform(F.regexp_extract_all(html, F.lit(LINK), F.lit(1)), lambda h: F.translate(h, UPPER, LOWER))
    links = pages.filter(F.col("host") != "").select(F.col("host").alias("source"), F.explode(targets).alias("target"))
    counted = links.filter(F.col("source") != F.col("target")).groupBy("source", "target").agg(F.count("*").alias("n"))
    total = counted.groupBy("source").agg(F.sum("n").alias("total"))
    return counted.join(total, "source").select("source", "target", (F.col("n") / F.col("total")).alias("weight"))


def reversed_links(links: DataFrame) -> DataFrame:
    """Edges against the links: each host passes its distrust to the hosts that link to it, equally."""
    total = links.groupBy("target").agg(F.count("*").alias("total"))
    return links.join(total, "target").select(F.col("target").alias("source"), F.col("source").alias("target"), (F.lit(1.0) / F.col("total")).alias("weight"))


def propagate(seeds: DataFrame, edges: DataFrame, stay: float = STAY, settled: float = SETTLED) -> DataFrame:
    """(host, score) of personalised PageRank: score = (1 - stay) seed + stay * sum of weight * score over edges in.

    Walkers at a host without edges return to the seeds' share only, as the rest is
    dropped. Runs until every score, however small, moves by less than the share
    ``settled`` of itself: as many rounds as the longest shortest path from a seed, then
    about ln(settled) / ln(stay) more, as a change shrinks by ``stay`` each round.
    Contributions to a host of many links are combined before the shuffle,
    and the source side of the join is one row per host. Hosts no seed reaches are absent.
    """
    base = materialized(seeds.select("host", (F.col("seed") * (1 - stay)).alias("base")), "seeds")
    now = base.select("host", F.col("base").alias("score"))
    if edges.isEmpty():
        return now
    while True:
        flows = edges.join(now, edges["source"] == now["host"]).select(F.col("target").alias("host"), (F.col("weight") * F.col("score") * stay).alias("score"))
        parts = flows.unionByName(base.select("host", F.col("base").alias("score"))).withColumn("old", F.lit(0.0)).unionByName(
            now.select("host", F.lit(0.0).alias("score"), F.col("score").alias("old")))
        following = materialized(parts.groupBy("host").agg(F.sum("score").alias("score"), F.sum("old").alias("old")), "scores")
        moved = following.agg(F.max(F.try_divide(F.abs(F.col("score") - F.col("old")), F.greatest("score", "old")))).first()[0]
        now = following.select("host", "score")
        if not moved or moved < settled:
            return now


def _seeds(hosts: DataFrame, pages: str) -> DataFrame:
    """Each host's share of all ``pages`` of one verdict."""
    some = hosts.filter(F.col(pages) > 0).select("host", F.col(pages).cast("double").alias("n"))
    total = some.agg(F.sum("n")).first()[0]
    return some.select("host", (F.col("n") / F.lit(total or 1.0)).alias("seed"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, page_id: str = "page_id", url: str = "url",
          html: str = "html", ratio: float = RATIO) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every row.

    ``verdict`` is the fitting rule's; without one it is "block" if the host's
    distrust exceeds ``ratio`` times its trust, else "allow". Scores that differ by
    less than the share ALIKE are equal, whatever their size, and equal ones allow. Null urls and urls
    without ``://`` have an empty host and path; no rule fits them, no link counts
    for them, and they are allowed. Null html has no links; long html is searched whole.
    Repeated rows are judged each, and count as often in seeds and links; an empty
    table gives no rows.
    """
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    parsed = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.col(html).alias("html"))
    ruled = parsed.withColumns({"rule": rule, "_ruled": verdict})
    hosts = materialized(ruled.filter(F.col("host") != "").groupBy("host").agg(
        F.count_if(F.col("_ruled") == "allow").alias("allowed"), F.count_if(F.col("_ruled") == "block").alias("blocked")), "hosts")
    links = materialized(host_links(parsed), "host-links")
    trust = propagate(_seeds(hosts, "allowed"), links)
    distrust = propagate(_seeds(hosts, "blocked"), materialized(reversed_links(links), "reversed-links"))

    def score(name: str) -> Column:
        return F.coalesce("score", F.lit(0.0)).alias(name)
    scores = materialized(
        hosts.select("host").join(trust, "host", "left").select("host", score("trust"))
        .join(distrust, "host", "left").select("host", "trust", score("distrust")), "host-scores")
    # A host may own a third of all pages; this join's left side is split where it is large.
    judged = ruled.drop("html").join(scores, "host", "left")
    by_host = F.when(F.coalesce("distrust", F.lit(0.0)) > F.lit(ratio * (1 + ALIKE)) * F.coalesce("trust", F.lit(0.0)), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("_ruled", by_host).alias("verdict"),
                         F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
