"""URL filters by link-graph propagation.

Pages that a rule allows or blocks make their hosts seeds. Trust spreads from
allowed seeds along host edges as personalised PageRank; distrust spreads from
blocked seeds along reversed edges, to those who link to them. A host is
blocked where its share of all distrust exceeds its share of all trust; its
pages that no rule fits get that verdict.

Only built-in column functions are used. Links are counted by pair of hosts
within each task before they are shuffled, so a host with a third of all pages
or links costs a row per pair; ranks are joined to edges by host, where
adaptive joins split a hub, and are summed by partial aggregates. Each round
is written, so that no lineage grows. Rounds end when ranks stand still; what
moves shrinks by the damping each round, which bounds their number.

Defined cases: a null url, or one without `://`, has an empty host and path,
fits no rule and is allowed unless the empty host is distrusted; null html has
no links; links without a host are their own host's and change nothing; hosts
that no seed reaches, or whose trust and distrust are equal, are allowed; of
rules of one length the later one in the order of their names wins; very long
urls and pages are scanned whole; repeated rows each count and get a row;
other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm._store import Work, table
from canopy.llm.decontaminate import LOWER, UPPER

# Fixed values.
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]
DAMPING = 0.85
STILL = 1e-9
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^\s/?#"'<>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.substring(url, at + 3, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    has = F.coalesce(at > 0, F.lit(False))
    return F.when(has, F.translate(host, UPPER, LOWER)).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else nulls."""
    out = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for verdict, own, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(own + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def propagate(work: Work, seeds: DataFrame, edges: DataFrame, name: str, damping: float = DAMPING, rounds: int | None = None) -> DataFrame:
    """(host, rank): personalised PageRank from seeds(host, seed) over edges(a, b, n); rank leaks at hosts without links."""
    total = seeds.agg(F.sum("seed")).first()[0] or 1.0
    start = work.save(seeds.select("host", (F.col("seed") / total).alias("seed")), f"{name}-seed")
    shares = work.save(edges.join(edges.groupBy("a").agg(F.sum("n").alias("_all")), "a").select("a", "b", (F.col("n") / F.col("_all")).alias("share")), f"{name}-edges")
    now = start.select("host", ((1 - damping) * F.col("seed")).alias("rank"))
    if shares.isEmpty():
        return now
    now = work.save(now, f"{name}-0")
    base = start.select("host", ((1 - damping) * F.col("seed")).alias("rank"))
    # A round moves at most damping ** k of all rank, so that many rounds always suffice.
    rounds = math.ceil(math.log(STILL) / math.log(damping)) + 1 if rounds is None else rounds
    for k in range(1, rounds + 1):
        sent = now.join(shares, F.col("host") == F.col("a")).select(F.col("b").alias("host"), (damping * F.col("rank") * F.col("share")).alias("rank"))
        then = work.save(base.unionByName(sent).groupBy("host").agg(F.sum("rank").alias("rank")), f"{name}-{k}")
        moved = then.join(now.withColumnRenamed("rank", "was"), "host", "full").agg(F.sum(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("was", F.lit(0.0))))).first()[0]
        work.drop(f"{name}-{k - 1}")
        now = then
        if (moved or 0) < STILL:
            break
    return now


def judge_urls(spark: SparkSession, pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, damping: float = DAMPING) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust for each row of pages(page_id, url, html)."""
    work = Work(spark, "urls")
    host, path = host_and_path(F.col("url"))
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    marked = parts.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    judged = work.save(marked.select("page_id", "host", "path", "fit.rule", "fit.verdict"), "judged")
    pairs = parts.select(F.col("host").alias("a"), F.explode(F.transform(links, lambda h: F.translate(h, UPPER, LOWER))).alias("b"))
    edges = work.save(pairs.filter("a <> '' AND b <> a").groupBy("a", "b").agg(F.count("*").alias("n")), "edges")
    seeds = work.save(judged.filter("verdict IS NOT NULL").groupBy("host", "verdict").agg(F.count("*").cast("double").alias("seed")), "seeds")
    trust = propagate(work, seeds.filter("verdict = 'allow'"), edges, "trust", damping)
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "n")
    distrust = propagate(work, seeds.filter("verdict = 'block'"), back, "distrust", damping)
    both = trust.withColumnRenamed("rank", "trust").join(distrust.withColumnRenamed("rank", "distrust"), "host", "full")
    hosts = work.save(both.select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")), "hosts")
    joined = judged.join(hosts, "host", "left")
    by_host = F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("verdict", by_host).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def op4_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark, table(spark, sf_dir, "pages"))


QUERIES = {"op4_url_trust": op4_url_trust}
ORACLE: dict[str, str] = {}
