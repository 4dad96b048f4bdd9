"""URL filters: host and path rules, and link-graph trust for what no rule decides. DataFrame functions only.

Trust is a personalised PageRank from hosts whose pages rules allow, along host links; distrust is one from hosts whose
pages rules block, along reversed links: who links to blocked hosts is suspect. A host's seed is the share of its pages
that rules allow (block), so ranks compare with (1 - damping) = a host that is wholly allowed (blocked) by rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, saved, small

#: Rule → verdict. A rule is a host, and the path its pages start with.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: Ranks are compared at so many decimal places; equal to the threshold is blocked.
PLACES = 9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?i)\bhref\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#\"'\s>]+)"


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for null or without `://`."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty for null or without `://`."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. A rule fits its host and all subdomains where the path
    starts with the rule's; of two equally long ones the first in alphabetical order."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """(src, dst, weight): pages of src that link to host dst, src <> dst. Relative links stay within the host."""
    return (
        pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(F.transform(F.regexp_extract_all(F.col(html), F.lit(LINK), 1), lambda x: F.translate(x, UPPER, LOWER)))).alias("dst"))
        .where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight")))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = 0.85, iterations: int = 20, cut_every: int = 5) -> DataFrame:
    """(kind, host, rank) from seeds (kind, host, seed) over links (kind, src, dst, weight): rank = (1-d) seed + d * inflow,
    each host dealing its rank out in proportion to the weights. Mass of hosts without links is not dealt out."""
    out = links.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    edges = saved(links.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("total")).alias("share")), "edges")
    base = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank")).where("rank > 0")
    if edges.isEmpty() or base.isEmpty():
        return base
    base = saved(base, "seeds")
    rank = base
    for i in range(iterations):
        flow = edges.join(rank.withColumnRenamed("host", "src"), ["kind", "src"]).groupBy("kind", F.col("dst").alias("host")).agg((F.sum(F.col("share") * F.col("rank")) * damping).alias("rank"))
        rank = flow.unionByName(base).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if (i + 1) % cut_every == 0:
            rank = saved(rank, "rank")
    return rank


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, damping: float = 0.85, iterations: int = 20, least: float = 0.5, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every page with host, path, rule, verdict, trust and distrust; other columns than page_id are left out.

    A page without a rule is blocked if its host's distrust is above its trust and at least `least` of that of a host which
    rules block wholly; else allowed, as are hosts the graph says nothing of and pages without a host. Null urls and html have
    no host and no links; repeated rows count as pages of their own. Ranks are rounded to nine
    places before they are compared, so that the order of sums doesn't decide. Host ranks are broadcast up to `broadcast_bytes`;
    beyond, they are joined with a shuffle whose large hosts Spark splits.
    """
    judged = pages.select("page_id", "html", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")).withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    shares = judged.where("host <> ''").groupBy("host").agg(
        F.avg(F.when(F.col("found.verdict") == "allow", 1.0).otherwise(0.0)).alias("trust"), F.avg(F.when(F.col("found.verdict") == "block", 1.0).otherwise(0.0)).alias("distrust"))
    seeds = shares.select("host", F.explode(F.create_map(F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust"))).alias("kind", "seed"))
    links = saved(host_links(judged), "links")
    both = links.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    ranks = propagate(seeds, both, damping, iterations)
    value = lambda kind: F.round(F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)), PLACES).alias(kind)
    hosts = small(saved(ranks.groupBy("host").agg(value("trust"), value("distrust")), "hosts"), broadcast_bytes)
    method = F.when((F.col("distrust") > F.col("trust")) & (F.col("distrust") >= F.lit(round(least * (1 - damping), PLACES))), "block").otherwise("allow")
    return judged.drop("html").join(hosts, "host", "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", method).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")
