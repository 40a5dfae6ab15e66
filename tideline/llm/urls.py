"""URL filter: rules first, then trust and distrust spread over the graph of hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.tables import table, whole_text, written

# The rules of the contract, as host, path and verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
DAMPING = 0.85
TOLERANCE = 1e-11  # rounds end when all that they still pass on, of a mass of 1 given to the seeds, is less
ROUNDS = 1000  # safety bound: each round passes on at most 85 % of the one before, so 156 are enough
DISTRUSTED = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\b(?:href|src|action)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def host_of(url: str | Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(whole_text(url), r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: str | Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.regexp_extract(whole_text(url), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, written host and path, and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for suffix, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == suffix) | host.endswith(f".{suffix}")) & path.startswith(start)
        name, verdict = F.when(fits, suffix + start).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """a, b, weight: links between different hosts, and one edge each way between a host and the site above it.

    A site above is the host without its first label, if that has a page of its own.
    """
    links = pages.where("host <> ''").select(
        F.col("host").alias("a"), F.explode(F.regexp_extract_all(whole_text("html"), F.lit(LINK), 1)).alias("b"))
    links = links.select("a", F.translate("b", UPPER, LOWER).alias("b")).where("a <> b").groupBy("a", "b").agg(F.count("*").alias("weight"))
    hosts = pages.where("host <> ''").groupBy("host").agg(F.count("*").alias("n")).select("host")
    above = hosts.select(F.col("host").alias("a"), F.regexp_extract("host", r"\A[^.]*\.(.+)", 1).alias("b")).where("b <> ''").join(
        hosts.select(F.col("host").alias("b")), "b")
    both = above.select("a", "b").unionByName(above.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return links.unionByName(both.withColumn("weight", F.lit(1).cast("long"))).groupBy("a", "b").agg(F.sum("weight").alias("weight"))


def sum_of_rounds(ways: DataFrame, start: DataFrame, tolerance: float) -> DataFrame:
    """kind, host, rank: what all rounds bring to each host. Each round is written, so lineage stays short."""
    total = passed = start.select("kind", "host", F.col("seed").alias("rank"))
    for k in range(1, ROUNDS + 1):
        passed = written(ways.join(passed.withColumnRenamed("host", "a"), ["kind", "a"]).groupBy("kind", F.col("b").alias("host")).agg(
            (DAMPING * F.sum(F.col("rank") * F.col("share"))).alias("rank")), "host-ranks")
        total = total.unionByName(passed)
        if (passed.agg(F.sum("rank")).first()[0] or 0.0) <= tolerance:
            return total.groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if k % 16 == 0:
            total = written(total.groupBy("kind", "host").agg(F.sum("rank").alias("rank")), "host-totals")
    raise RuntimeError(f"ranks of hosts not settled after {ROUNDS} rounds")


def spread(edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """host, trust, distrust: personalised PageRank from (host, allowed, blocked) over (a, b, weight).

    Trust follows links, distrust goes back along them. What a host without onward edges holds
    returns to the seeds, which is the same as to let it go and to scale the sum of all rounds to 1.
    Rounds go on until what they pass on is below the tolerance; a host so far from all seeds that its share is smaller counts as not reached.
    """
    ways = edges.select(F.lit("trust").alias("kind"), "a", "b", "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("b").alias("a"), F.col("a").alias("b"), "weight"))
    out = ways.groupBy("kind", "a").agg(F.sum("weight").alias("all"))
    ways = written(ways.join(out, ["kind", "a"]).select("kind", "a", "b", (F.col("weight") / F.col("all")).alias("share")), "host-ways")
    start = seeds.select("host", F.explode(F.create_map(
        F.lit("trust"), F.col("allowed"), F.lit("distrust"), F.col("blocked"))).alias("kind", "n")).where("n > 0")
    totals = start.groupBy("kind").agg(F.sum("n").alias("all"))
    start = written(start.join(totals, "kind").select("kind", "host", (F.col("n") / F.col("all")).alias("seed")), "host-seeds")
    total = sum_of_rounds(ways, start, tolerance)
    whole = total.groupBy("kind").agg(F.sum("rank").alias("whole"))
    # Written, so that its size is known and pages are not dealt out by host where it is small.
    rank = written(total.join(F.broadcast(whole), "kind").select("kind", "host", (F.col("rank") / F.col("whole")).alias("rank")), "host-ranks")
    return rank.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("rank"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("rank"))), F.lit(0.0)).alias("distrust"))


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """One row per row of (page_id, url, html): page_id, host, path, rule, verdict, trust, distrust.

    The longest rule that fits the host or a domain above it and the start of the path decides. A
    page without a rule is judged by its host: blocked when its distrust is more than half of its
    trust and distrust together, allowed otherwise, also when nothing reaches it or the url is null
    or has no host. Seeds are the hosts of pages that rules allow or block, by their number.
    """
    parts = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"), "html")
    name, says = rule_of(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": name, "says": says})
    seeds = parts.where("host <> ''").groupBy("host").agg(
        F.count(F.when(F.col("says") == "allow", 1)).alias("allowed"), F.count(F.when(F.col("says") == "block", 1)).alias("blocked"))
    ranks = spread(host_edges(parts), seeds.where("allowed > 0 or blocked > 0"))
    share = F.col("distrust") / (F.col("trust") + F.col("distrust"))
    return parts.select("page_id", "host", "path", "rule", "says").join(ranks, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("says", F.when((F.col("trust") + F.col("distrust") > 0) & (share > DISTRUSTED), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
