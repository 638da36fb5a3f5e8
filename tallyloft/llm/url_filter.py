"""URL filter: a blocked Bloom filter over listed canonical URLs, then an exact hash join on what it lets through.

A listed entry is a host and the start of a path, written canonically as ``host`` + ``path``. It fits its host and all subdomains
where the URL's path starts with the entry's path. The possible entries for a URL are its host cut to the numbers of labels that
occur in the list, each with its path cut to the lengths that occur in the list; their number depends on the list's shapes, not on
its size. The filter has 256-bit blocks of eight 32-bit words; a key sets one bit in each word of its block, so one lookup by block
number answers a key. False positives end in the exact join. Of several entries that fit, the longest wins; at equal length the one
with the longer host; an entry listed both ways blocks.

Defined results: a NULL URL, or one without ``://``, has an empty host and path and fits no entry. URLs that fit none get the default
verdict. Empty lists and tables give empty or default results. NULL ids stay, repeated rows are judged each. List entries with a
NULL host or path are ignored.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloft.llm.common import ascii_lower

WORDS = [f"w{i}" for i in range(8)]
# Entries (of at most some hundred bytes) and filter blocks (of 40 bytes) up to this many are broadcast: below 64 MB.
BROADCAST_ENTRIES = 200_000


def host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """One bit in each of the eight words, from eight bytes of a second hash."""
    second = F.xxhash64(F.lit("bits"), key)
    return [F.call_function("shiftleft", F.lit(1), F.shiftrightunsigned(second, 8 * i).bitwiseAND(F.lit(31)).cast("int"))
            for i in range(8)]


def listed(entries: DataFrame) -> DataFrame:
    """Canonical list: entry_no, key, host, verdict; one row per key."""
    keyed = entries.filter("host IS NOT NULL AND path IS NOT NULL").select(
        ascii_lower(F.col("host")).alias("host"), F.col("path"), F.col("verdict"))
    one = keyed.groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("blocks"))
    return one.select(
        F.xxhash64("host", "path").alias("entry_no"), F.concat("host", "path").alias("key"), "host", F.length("path").alias("path_chars"),
        F.size(F.split("host", r"\.")).alias("labels"), F.when(F.col("blocks"), "block").otherwise("allow").alias("verdict"))


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter: block, w0 .. w7."""
    marked = keys.select(_block(F.col("key"), blocks).alias("block"), *(b.alias(w) for b, w in zip(_bits(F.col("key")), WORDS)))
    return marked.groupBy("block").agg(*(F.bit_or(w).alias(w) for w in WORDS))


def candidates(host_col: Column, path_col: Column, labels: list[int], lengths: list[int]) -> Column:
    """Canonical keys of the entries that could fit, each of a number of labels and a path length that the list has."""
    parts = F.split(host_col, r"\.")
    hosts = F.transform(F.filter(F.array(*map(F.lit, labels)), lambda n: n <= F.size(parts)),
                        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    paths = F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path_col)),
                        lambda n: F.substring(path_col, F.lit(1), n))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))


def judge(pages: DataFrame, entries: DataFrame, ids: list[str], url_col: str = "url", default: str = "allow") -> DataFrame:
    """A row per page: ``ids``, host, path, rule (the entry that decided, or NULL) and verdict."""
    rules = listed(entries)
    shape = rules.agg(F.count("*"), F.collect_set("labels"), F.collect_set("path_chars")).first()
    size, labels, lengths = shape[0], sorted(shape[1]), sorted(shape[2])
    small = F.broadcast if size <= BROADCAST_ENTRIES else (lambda df: df.hint("shuffle_hash"))
    own = {c: f"__id_{i}" for i, c in enumerate(ids)}
    urls = pages.select(*(F.col(c).alias(n) for c, n in own.items()), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"),
                        F.monotonically_increasing_id().alias("row"))
    row = ["row", *own.values(), "host", "path"]
    if not size:
        judged = urls.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
        return judged.select(*(F.col(n).alias(c) for c, n in own.items()), "host", "path", "rule", "verdict")
    blocks = -(-size * 16 // 256)  # 16 bits a key
    # The NULL candidate keeps pages that fit nothing.
    tried = urls.withColumn("key", F.explode(F.concat(
        F.array(F.lit(None).cast("string")), candidates(F.col("host"), F.col("path"), labels, lengths))))
    passes = functools.reduce(operator.and_, (F.col(w).bitwiseAND(b) != 0 for w, b in zip(WORDS, _bits(F.col("key")))))
    possible = (tried.withColumn("block", _block(F.coalesce("key", F.lit("")), blocks))
                .join(small(bloom(rules, blocks)), "block", "left").filter(F.col("key").isNull() | passes).select(*row, "key"))
    exact = possible.join(small(rules.select("key", "entry_no", F.length("key").alias("n"), F.length("host").alias("n_host"))), "key", "left")
    # Partial aggregation leaves one row per page before the shuffle, as a page's candidates lie together.
    best = exact.groupBy(*row).agg(F.max_by("entry_no", F.col("n").cast("bigint") * (1 << 31) + F.col("n_host")).alias("entry_no"))
    judged = best.join(small(rules.select("entry_no", F.col("key").alias("rule"), "verdict")), "entry_no", "left")
    return judged.select(*(F.col(n).alias(c) for c, n in own.items()), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def allowed(pages: DataFrame, entries: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The pages whose URL is not blocked, with all their columns."""
    urls = pages.select(F.col(url_col).alias("__url")).distinct()
    blocked = judge(urls, entries, ["__url"], "__url", default).filter("verdict = 'block'").select("__url")
    return pages.join(blocked, F.col(url_col).eqNullSafe(F.col("__url")), "left_anti")
