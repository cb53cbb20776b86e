"""URL filters: rules first, then link-graph propagation per host (operator 6).

Rules name a host (with all its subdomains) and a path prefix; the longest that
fits decides. For all other pages the host decides: trust spreads from hosts
with allowed pages along host links (personalised PageRank), distrust from hosts
with blocked pages against the links' direction, and a host is blocked if
distrust has at least BLOCK_SHARE of the two.

Host links come from the pages' href attributes. Links within a host carry no
weight, so a host can't vouch for itself; relative links are such links.

Ranks are iterated until a step moves at most TOLERANCE of the mass (each step moves
at most DAMPING of what the one before moved, so about 90 steps for the values below); what is left
unmoved then is below 6 TOLERANCE.

Defined results: a null url, or one without ://, has an empty host and path,
which no rule fits and no link reaches; a host that neither trust nor distrust
reaches is allowed; rank that ends in a host without links returns to the seeds;
repeated pages count as pages; null html has no links; further columns are ignored.
"""

from __future__ import annotations

import itertools
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import table, written

#: (verdict, host, path prefix).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DAMPING = 0.85
TOLERANCE = 1e-6
BLOCK_SHARE = 0.5
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _ruled(host: Column, path: Column, rules, pick) -> Column:
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):  # the longest is asked first
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        out = F.when(fits, F.lit(pick(rule))).otherwise(out)
    return out


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts."""
    link = F.col("link")
    target = (F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), host_of(link))
              .when(link.startswith("//"), host_of(F.concat(F.lit("x:"), link))))
    # Links without a host stay within their own; they are left out before they become rows.
    found = F.filter(F.regexp_extract_all("html", F.lit(HREF), F.lit(1)), lambda x: F.contains(x, F.lit("//")))
    return (pages.select(host_of(F.col("url")).alias("src"), F.explode(found).alias("link"))
            .select("src", target.alias("dst")).where("src <> '' and dst <> '' and src <> dst")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("n")))


def propagate(links: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(kind, host, rank). links: src, dst, n. seeds: kind (allow or block), host, seed (sums
    to one per kind). Trust follows links, distrust goes against them."""
    both = links.select(F.lit("allow").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n").unionByName(
        links.select(F.lit("block").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n"))
    both = written(both, "host-links")
    out = written(both.groupBy("kind", "host").agg(F.sum("n").alias("all")), "host-out")
    edges = written(both.join(out, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("all")).alias("share")), "host-shares")
    seeds = written(seeds, "host-seeds")
    rank = seeds.select("kind", "host", F.col("seed").alias("rank"))
    for step in itertools.count():
        sent = rank.join(edges, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.col("rank") * F.col("share")).alias("got"))
        kept = {r.kind: r.got for r in sent.groupBy("kind").agg(F.sum("got").alias("got")).collect()}
        # What isn't sent on by links goes back to the seeds.
        back = F.lit(0.0)
        for kind in ("allow", "block"):
            back = F.when(F.col("kind") == kind, F.lit(1.0 - DAMPING * float(kept.get(kind, 0.0)))).otherwise(back)
        fresh = sent.select("kind", "host", (F.col("got") * DAMPING).alias("rank")).unionByName(
            seeds.select("kind", "host", (F.col("seed") * back).alias("rank")))
        fresh = written(fresh.groupBy("kind", "host").agg(F.sum("rank").alias("rank")), f"rank-{step}")
        moved = fresh.join(rank.withColumnRenamed("rank", "old"), ["kind", "host"], "left").agg(
            F.sum(F.abs(F.col("rank") - F.coalesce("old", F.lit(0.0)))).alias("d")).first().d
        rank = fresh
        if (moved or 0.0) <= tolerance:
            break
    return rank


def judge(pages: DataFrame, rules=RULES, tolerance: float = TOLERANCE) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust."""
    url = F.col("url")
    asked = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    host, path = F.col("host"), F.col("path")
    asked = asked.withColumn("rule", _ruled(host, path, rules, lambda r: r[1] + r[2])).withColumn("ruled", _ruled(host, path, rules, lambda r: r[0]))
    counts = asked.where("ruled is not null and host <> ''").groupBy(F.col("ruled").alias("kind"), "host").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "seed-counts")
    total = {r.kind: r.n for r in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    whole = F.when(F.col("kind") == "allow", F.lit(float(total.get("allow", 1)))).otherwise(F.lit(float(total.get("block", 1))))
    rank = propagate(host_links(pages), counts.select("kind", "host", (F.col("n") / whole).alias("seed")), tolerance)
    hosts = written(rank.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "allow", F.col("rank"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "block", F.col("rank"))), F.lit(0.0)).alias("distrust")), "host-ranks")
    out = asked.join(hosts, "host", "left").withColumn("trust", F.coalesce("trust", F.lit(0.0))).withColumn("distrust", F.coalesce("distrust", F.lit(0.0)))
    bad = (F.col("distrust") > 0) & (F.col("distrust") >= BLOCK_SHARE * (F.col("trust") + F.col("distrust")))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(bad, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")


def op6_link_propagation(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
