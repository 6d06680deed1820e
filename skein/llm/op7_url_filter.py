"""URL filter: prefix rules first, then trust propagated over the host link graph.

A url that a rule fits gets the longest rule's verdict.  The other urls get a
verdict for their host: personalised PageRank from hosts with allowed pages
(trust, along links) against personalised PageRank from hosts with blocked
pages (distrust, against the links: who points at blocked hosts is suspect).
A host is blocked when its distrust exceeds ``ratio`` times its trust.
Ranks are iterated until no host's rank changes by more than ``TOLERANCE`` of
itself over ``cut_every`` rounds, so every host that a seed can reach has one.

Host edges: absolute and protocol-relative links of the page's html, and an
edge both ways between a host and its parent domain (down to
``min_labels`` labels), which ties the subdomains of one owner together.

Defined results
* null url or url without ``://``: empty host and path, no rule fits, verdict
  ``allow`` (nothing speaks against it); such pages add no edges;
* null html adds no links; hosts that no seed reaches are allowed;
* repeated pages are judged row by row; repeated links add to an edge's weight;
* without any blocked (or allowed) page there is no distrust (trust) at all;
* an empty table gives no rows; other input columns are ignored.

All state is in tables keyed by host, at every size; the driver sees counts and sums.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import cut, lower_ascii, table

#: (host and path prefix, verdict); the fixed rules of the registered query.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Hosts up to which their verdicts are broadcast (under 100 bytes each).
BROADCAST_HOSTS = 100_000
#: Greatest relative change of any host's rank between two cuts at which iteration ends.
TOLERANCE = 1e-6
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest fitting rule, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at = text.index("/")
        of_host, prefix = text[:at], text[at:]
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(prefix)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def judged_by_rules(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule, decided."""
    p = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    return p.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("decided"))


def host_edges(pages: DataFrame, min_labels: int = 2) -> DataFrame:
    """src, dst, weight: links between different hosts, and host - parent domain edges."""
    p = pages.select(host_of(F.col("url")).alias("src"), "html").where("src != ''")
    links = p.select("src", F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
    links = links.select("src", lower_ascii(F.col("dst")).alias("dst"), F.lit(1.0).alias("weight"))
    labels = F.split("src", r"\.")
    # Every step of the way up: a.b.c.d -> b.c.d -> c.d
    hosts = p.select("src").distinct().select(labels.alias("l"))
    steps = hosts.where(F.size("l") > min_labels).select(
        "l", F.explode(F.sequence(F.lit(1), F.size("l") - F.lit(min_labels))).alias("k"))

    def tail(k: Column) -> Column:
        return F.array_join(F.slice("l", k, F.size("l")), ".")

    up = steps.select(tail(F.col("k")).alias("src"), tail(F.col("k") + 1).alias("dst"),
                      F.lit(1.0).alias("weight")).distinct()
    down = up.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    return links.unionByName(up).unionByName(down).where("src != dst").groupBy("src", "dst").agg(
        F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int | None = 10,
              cut_every: int = 8) -> DataFrame:
    """Personalised PageRank of (kind, host, seed) over (kind, src, dst, share).

    Several kinds run side by side; shares of a source sum to 1, seeds of all
    kinds together sum to 1.  Mass at hosts without out-links ends there.

    ``rounds`` rounds from the whole seeds; with ``None``, from the seeds' own share
    until the ranks are settled.  From there ranks only grow (each is a sum over
    ever longer paths), so nothing oscillates and a new host counts as a change.
    """
    start = 1.0 if rounds is not None else 1 - damping
    rank = seeds.select("kind", "host", (F.col("seed") * start).alias("rank"))
    before = rank
    for k in itertools.count():
        if k == rounds:
            break
        moved = edges.join(rank.withColumnRenamed("host", "src"), ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"))
        back = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank"))
        rank = moved.unionByName(back).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if (k + 1) % cut_every == 0:
            rank = cut(rank, "url-rank")
            if rounds is None:
                if not _moved(before, rank):
                    break
                before = rank
    return rank


def _moved(before: DataFrame, after: DataFrame) -> bool:
    """Whether any rank grew by more than ``TOLERANCE`` of itself; the driver sees one number."""
    both = after.select("kind", "host", "rank", F.lit(0.0).alias("old")).unionByName(
        before.select("kind", "host", F.lit(0.0).alias("rank"), F.col("rank").alias("old")))
    both = both.groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("old").alias("old"))
    most = both.where("rank > 0").agg(F.max((F.col("rank") - F.col("old")) / F.col("rank"))).first()[0]
    return (most or 0.0) > TOLERANCE


def host_verdicts(pages: DataFrame, judged: DataFrame, ratio: float = 2.0, min_labels: int = 2,
                  damping: float = 0.85, rounds: int | None = 10) -> DataFrame:
    """host, trust, distrust, host_verdict for every host that some rank reaches.

    ``rounds`` rounds of power iteration; ``None``, as ``filter_urls`` has it, until settled.
    """
    seeds = judged.where("decided is not null and host != ''").select(
        F.when(F.col("decided") == "allow", "trust").otherwise("distrust").alias("kind"), "host")
    seeds = seeds.groupBy("kind", "host").agg(F.count(F.lit(1)).alias("n"))
    # One scale for both kinds: a page decided either way weighs the same.
    whole = float(seeds.agg(F.sum("n")).first()[0] or 1)
    seeds = cut(seeds.select("kind", "host", (F.col("n") / whole).alias("seed")), "url-seeds")
    e = cut(host_edges(pages, min_labels), "url-edges")
    both = e.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        e.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"),
                 F.col("src").alias("dst"), "weight"))
    out = both.groupBy("kind", "src").agg(F.sum("weight").alias("_all"))
    shares = cut(both.join(out, ["kind", "src"]).select(
        "kind", "src", "dst", (F.col("weight") / F.col("_all")).alias("share")), "url-shares")
    rank = propagate(shares, seeds, damping, rounds)
    wide = rank.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("rank"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("rank"))), F.lit(0.0)).alias("distrust"))
    return wide.withColumn("host_verdict", F.when(
        F.col("distrust") > F.col("trust") * ratio, "block").otherwise("allow"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, ratio: float = 2.0,
                min_labels: int = 2, damping: float = 0.85, rounds: int | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every page (page_id, url, html)."""
    pages = pages.select("page_id", "url", "html")
    judged = judged_by_rules(pages, rules)
    hosts = cut(host_verdicts(pages, judged, ratio, min_labels, damping, rounds), "url-hosts")
    small = F.broadcast(hosts) if hosts.count() <= BROADCAST_HOSTS else hosts
    return judged.join(small, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("decided", "host_verdict", F.lit("allow")).alias("verdict"), "trust", "distrust")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page's url by the fixed rules, else by its host."""
    return filter_urls(table(spark, sf_dir, "pages"))
