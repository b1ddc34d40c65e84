"""URL filter: host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

The filter is a table of 256-bit blocks, four 64-bit words each; a URL sets one bit in each word of one block. Pages that
miss a bit are decided without any shuffle. The few that pass go to an exact hash join with the list, which removes the
false positives. Everything is built-in column functions.

Defined results: a null URL, or one without `://`, has an empty host and path, matches no rule and is allowed. Repeated
pages are judged alike. Other columns of the input are ignored. An empty list or an empty table gives no blocked page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Verdict and rule: a host, and the leading part of the path.
Rule = tuple[str, str]

BITS_PER_URL = 16
BLOCK_BYTES = 48
BROADCAST_BYTES = 8 << 20


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without `www.`, path without closing slashes; scheme, query and fragment do not count. Null without a host."""
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", "")))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct (verdict, rule); null if none does."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def _masks(key: Column) -> list[Column]:
    h = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int")) for i in range(4)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter: one row for each block that holds a bit. `listed` has a column `url`."""
    parts = [m.alias(f"m{i}") for i, m in enumerate(_masks(F.col("url")))]
    bits = [F.bit_or(f"m{i}").alias(f"w{i}") for i in range(4)]
    return listed.select(_block(F.col("url"), blocks).alias("block"), *parts).groupBy("block").agg(*bits)


def maybe_listed(rows: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """The rows whose `column` may be a value of the one column of `listed`, told where they lie: no listed one is lost, few others are kept.

    The filter is broadcast and never above BROADCAST_BYTES; very long lists only make it less sharp.
    """
    listed = listed.toDF("url")
    blocks = min(max(1, -(-listed.count() * BITS_PER_URL // 256)), BROADCAST_BYTES // BLOCK_BYTES)
    probed = rows.withColumn("block", _block(F.col(column), blocks)).join(F.broadcast(bloom_blocks(listed, blocks)), "block")
    for i, mask in enumerate(_masks(F.col(column))):
        probed = probed.where(F.col(f"w{i}").bitwiseAND(mask) != 0)
    return probed.select(rows.columns)


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Verdict for every page: that of its longest rule, else `block` if its canonical URL is listed, else `allow`.

    `listed` has one column of canonical URLs; nulls and repeats in it do not count. `rules` are configuration, held in
    the plan as one expression. Returns `id_col`, host, path, rule, verdict, and possible (the Bloom filter's answer).
    """
    listed = listed.toDF("url").where("url is not null").distinct()
    blocks = max(1, -(-listed.count() * BITS_PER_URL // 256))
    bloom = bloom_blocks(listed, blocks)
    if blocks * BLOCK_BYTES <= BROADCAST_BYTES:  # beyond it the same join is shuffled
        bloom = F.broadcast(bloom)
    urls = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    urls = urls.select("*", matching_rule(F.col("host"), F.col("path"), rules).alias("match"), canonical(F.col("host"), F.col("path")).alias("key"))
    probed = urls.withColumn("block", _block(F.col("key"), blocks)).join(bloom, "block", "left")
    passed = F.lit(True)
    for i, mask in enumerate(_masks(F.col("key"))):
        passed = passed & (F.col(f"w{i}").bitwiseAND(mask) != 0)
    probed = probed.withColumn("possible", F.coalesce(passed & F.col("key").isNotNull(), F.lit(False)))
    exact = listed.select(F.col("url").alias("key"), F.lit(True).alias("hit"))
    hits = probed.where("possible").join(exact, "key", "left")
    misses = probed.where("not possible").withColumn("hit", F.lit(None).cast("boolean"))
    verdict = F.coalesce(F.col("match.verdict"), F.when(F.col("hit"), "block").otherwise("allow"))
    columns = [F.col("id").alias(id_col), "host", "path", F.col("match.rule").alias("rule"), verdict.alias("verdict"), "possible"]
    return hits.select(columns).unionByName(misses.select(columns))


def repeated_urls(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """A list to filter by: canonical URLs that two or more pages carry, as crawler traps and mirrors make them."""
    key = canonical(host_of(F.col(url_col)), path_of(F.col(url_col)))
    return pages.select(key.alias("url")).where("url is not null").groupBy("url").count().where("count > 1").select("url")
