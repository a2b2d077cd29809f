"""URL rules behind a blocked Bloom filter.

A rule is a canonical host and path prefix with a verdict; it fits its host and all subdomains. A page asks for
every (host suffix, path prefix) it could match, with path prefixes of the lengths that rules have. The filter,
split into blocks of 256 bits so that one look tells, drops almost all questions; an exact hash join on the key
removes the false positives. The longest fitting rule wins (of equal keys the first verdict in order); without
one, a URL is not listed and gets ``unlisted``.

Null URLs and such without "://" have an empty host and path and fit no rule. Equal URLs are judged once; repeated
rows each get the verdict. Rules with null host or path are ignored, rows of equal rules count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The filter has at most so many blocks of 32 bytes, 2 MB; beyond about 100,000 rules it lets more through.
MOST_BLOCKS = 1 << 16
BITS_PER_KEY = 16
PROBES = 6


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    return F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def probes(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """A key's block and its bits there (0 to 255)."""
    h, g = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    bits = [F.pmod(F.shiftrightunsigned(g, 8 * i), F.lit(256)).cast("int") for i in range(PROBES)]
    return F.pmod(h, F.lit(blocks)).cast("int"), bits


def bloom(rules: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w3): the blocks that hold any bit."""
    block, bits = probes(F.col("key"), blocks)
    one = rules.select(block.alias("block"), F.explode(F.array(*bits)).alias("bit"))
    word = lambda i: F.bit_or(F.when(F.floor(F.col("bit") / 64) == i, F.expr("shiftleft(1L, bit % 64)")).otherwise(F.lit(0).cast("long")))
    return one.groupBy("block").agg(*[word(i).alias(f"w{i}") for i in range(4)])


def may_hold(key: Column, blocks: int) -> Column:
    """With a key's block joined to the row: are all its bits set?"""
    _, bits = probes(key, blocks)
    test = F.lit(True)
    for b in bits:
        word = F.element_at(F.array("w0", "w1", "w2", "w3"), (F.floor(b / 64) + 1).cast("int"))
        test = test & (F.call_function("getbit", word, b % 64) == 1)
    return test


def judge(pages: DataFrame, rules: DataFrame, unlisted: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages`` (page_id, url); ``rules`` has host, path,
    verdict."""
    listed = rules.where("host IS NOT NULL AND path IS NOT NULL").groupBy(F.concat("host", "path").alias("key"), "host", "path").agg(F.min("verdict").alias("verdict"))
    shape = listed.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.length("path")).alias("lengths")).first()
    blocks = min(MOST_BLOCKS, max(1, -(-shape["n"] * BITS_PER_KEY // 256)))
    host, path = parts(F.col("url"))
    asked = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = asked.where("host != ''").groupBy("host", "path").agg(F.count(F.lit(1)).alias("times"))
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = sorted(shape["lengths"])
    if not lengths:
        return asked.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(unlisted).alias("verdict"))
    prefix = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
    keys = urls.select("host", "path", F.explode(suffix).alias("rule_host"), prefix.alias("prefixes"))
    keys = keys.select("host", "path", "rule_host", F.explode("prefixes").alias("rule_path")).where("rule_path IS NOT NULL")
    keys = keys.withColumn("key", F.concat("rule_host", "rule_path"))
    block, _ = probes(F.col("key"), blocks)
    passed = keys.withColumn("block", block).join(F.broadcast(bloom(listed, blocks)), "block").where(may_hold(F.col("key"), blocks))
    exact = passed.join(
        listed.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("key").alias("rule"), "verdict"),
        ["rule_host", "rule_path"],
    )
    best = exact.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
    best = best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))
    return asked.join(best, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(unlisted)).alias("verdict"))
