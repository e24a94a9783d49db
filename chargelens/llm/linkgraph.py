"""Host verdicts by link-graph propagation; DataFrame functions only."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargelens.llm.common import LOWER, UPPER, stage

DAMPING = 0.85
ROUNDS = 8  # of the SQL, which has no loop
TOLERANCE = 1e-10  # of the sum of score changes from one written table to the next
CUT_EVERY = 4  # rounds between written tables
MARGIN = 1.0  # a host is blocked when its distrust exceeds so many times its trust


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str


# Rules of the query.
RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for null or without `://`."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """struct<rule, verdict> of the longest rule that fits, null if none; ties to the rule listed first."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, n): absolute links between different hosts."""
    links = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)href\s*=\s*["']?(?:[a-z]+:)?//([^/"'?#>\s]+)"""), 1)
    found = pages.filter(F.col(html).isNotNull() & F.col(html).rlike(r"""(?i)href\s*=\s*["']?(?:[a-z]+:)?//""")).select(host_of(F.col(url)).alias("src"), F.explode(links).alias("dst"))
    found = found.withColumn("dst", F.translate("dst", UPPER, LOWER)).filter("src <> '' and src <> dst")
    return found.groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank: edges (src, dst, n), seeds (host, seed) summing to one -> (host, score).

    Each round: score = (1 - damping) * seed + damping * sum of shares over links, until scores stand still; each round
    shrinks the changes by `damping`, so this ends on every graph. What a host without links out holds is lost.
    """
    out = edges.groupBy("src").agg(F.sum("n").alias("total"))
    share = stage(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("w")))
    start = stage(seeds.select("host", (F.col("seed") * (1 - damping)).alias("base")))
    score = start.select("host", F.col("base").alias("score"))
    if share.isEmpty():
        return score
    while True:
        before = score
        for _ in range(CUT_EVERY):
            moved = share.join(score, share.src == score.host).select(F.col("dst").alias("host"), (F.col("score") * F.col("w") * damping).alias("score"))
            score = moved.union(start.select("host", F.col("base").alias("score"))).groupBy("host").agg(F.sum("score").alias("score"))
        score = stage(score)
        both = score.union(before.select("host", -F.col("score"))).groupBy("host").agg(F.sum("score").alias("d"))
        if (both.agg(F.sum(F.abs("d"))).first()[0] or 0.0) <= tolerance:
            return score


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, page_id: str = "page_id", url: str = "url", html: str = "html", damping: float = DAMPING, tolerance: float = TOLERANCE, margin: float = MARGIN) -> DataFrame:
    """(page_id, host, path, rule, trust, distrust, verdict) per input row.

    Trusted seeds are the hosts with pages that a rule allows, blocked seeds those with pages that a rule for a whole host
    blocks, weighted by these pages. Trust flows along links, distrust against them (who links to a blocked host). A url without a rule is
    blocked where distrust > margin * trust of its host, else allowed; hosts that nothing reaches are allowed. Null urls
    and urls without `://` have an empty host and path, no rule, and are allowed. Null html has no links; repeated rows
    each keep a row. Other columns are not read; an empty table gives an empty result.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("r", longest_rule(F.col("host"), F.col("path"), rules))
    whole = [r.host + r.path for r in rules if r.path == "/"]
    seed = (F.col("r.verdict") == "allow") | F.col("r.rule").isin(whole)
    seen = stage(rows.filter(seed).groupBy("host", F.col("r.verdict").alias("verdict")).agg(F.count("*").alias("n")))
    edges = stage(host_edges(pages, url, html))
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")

    def seeds(verdict: str) -> DataFrame:
        own = seen.filter(F.col("verdict") == verdict)
        total = own.agg(F.sum("n").alias("all_n"))
        return own.join(total).select("host", (F.col("n") / F.col("all_n")).alias("seed"))

    trust = propagate(edges, seeds("allow"), damping, tolerance).withColumnRenamed("score", "trust")
    distrust = propagate(back, seeds("block"), damping, tolerance).withColumnRenamed("score", "distrust")
    hosts = stage(trust.join(distrust, "host", "full"))
    judged = rows.join(hosts, "host", "left").select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("own"), *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("trust", "distrust")])
    by_graph = F.when(F.col("distrust") > margin * F.col("trust"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", "trust", "distrust", F.coalesce("own", by_graph).alias("verdict"))
