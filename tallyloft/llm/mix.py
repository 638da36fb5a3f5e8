"""Mixing sources to target weights through a multivariate-hypergeometric splitting tree.

Every source is cut into blocks by a keyed hash of its documents. A source's target is drawn as whole rounds over all its blocks
plus a part: whole blocks in an order permuted per source, then, in rounds over the blocks that follow, the documents that still fit
into what is needed, until none of the source does, and the shortest one left if that comes nearer. So the number of block draws of each source, its quota, is exact. A tree over the output shards splits
all quotas: each node passes a hypergeometric draw of its blocks to its left half, the rest to its right, until each shard has its own number of
blocks of each source; these numbers add up to the quotas. Shards then take disjoint runs of the source's permuted draws and
shuffle them locally by hash.

Every decision is a function of the source, the hash and the seed, so runs agree, whatever the partitions. A source's rows are never
brought together: sums go by (source, block), at most 2**16 blocks a source, and only hashes and sizes of a round's last blocks, BLOCK_WORDS or
two of its 2**16 parts, meet in one task. A level of the tree handles a node's sources together: one number per source.

Weights are 1, 2, 3, repeating over the sources by code point, NULL last. Targets share the total of all sizes by weight, stop
at ``most`` times the source's size, and the excess is shared again by weight until no target is above.

Defined results: a NULL or blank text has size 0 and gives no words. NULL sources are one source. Rows that repeat id and
text are taken alike. An empty table gives an empty mix. Other columns are carried along by ``mixed``.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloft.operators.keys import dense_key
from tallyloft.session import stage

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 1 << 17
SHARD_WORDS = 1 << 23
BROADCAST_DRAWS = 200_000  # rows of some 60 bytes


@dataclasses.dataclass
class Plan:
    seed: int
    bits: int  # of the hash that number the block
    most: int
    sized: DataFrame  # id, key, size, hash: a row per document
    blocks: DataFrame  # key, block, words, source_size, target, rounds, whole, chosen (hashes of a part of the block)
    total: int

    def block(self, code: Column) -> Column:
        return F.shiftrightunsigned(code, 64 - self.bits) if self.bits else F.lit(0).cast("bigint")


def source_key(source: Column) -> Column:
    """Sorts like the source by code point, NULL last, and is never NULL."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def _code(seed: int, id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))


def targets(sources: DataFrame, most: int = 3) -> DataFrame:
    """``sources`` (key, source_size) with weight and target."""
    numbered = stage(dense_key(sources, ["key"], "no"), "mix-sources").withColumn("weight", (F.col("no") - 1) % 3 + 1)
    total, weights = numbered.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    capped, share, ceiling = None, total / weights if weights else 0.0, F.col("source_size") * most
    while True:
        above = F.col("weight") * F.lit(float(share)) > ceiling
        used, left, now = numbered.agg(
            F.coalesce(F.sum(F.when(above, ceiling)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.count_if(above)).first()
        if now == capped or not left:
            break
        capped, share = now, (total - used) / left
    return numbered.withColumn("target", F.least(ceiling.cast("double"), F.col("weight") * F.lit(float(share))))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", most: int = 3, seed: int = 42,
         block_words: int = BLOCK_WORDS) -> Plan:
    """What the mix takes of each block."""
    sized = stage(docs.select(
        F.col(id_col).alias("id"), source_key(F.col(source_col)).alias("key"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        _code(seed, id_col, text_col).alias("code")), "mix-sizes")
    sources = stage(targets(sized.groupBy("key").agg(F.sum("size").alias("source_size")), most), "mix-targets")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    out = Plan(seed, min(16, (total // block_words).bit_length()), most, sized, sized, total)

    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    parts = sources.select("key", "source_size", "target", rounds.alias("rounds")).withColumn(
        "rest", F.col("target") - F.col("rounds") * F.col("source_size"))
    by_block = sized.groupBy("key", out.block(F.col("code")).alias("block")).agg(F.sum("size").alias("words"))
    permuted = Window.partitionBy("key").orderBy(F.xxhash64(F.lit(seed), "key", "block"), "block")
    cut = by_block.join(parts, "key").withColumn("sum", F.sum("words").over(permuted)).withColumn("whole", F.col("sum") <= F.col("rest"))
    used = F.coalesce(F.max(F.when(F.col("whole"), F.col("sum"))).over(Window.partitionBy("key")), F.lit(0))
    cut = stage(cut.withColumn("need", F.col("rest") - used), "mix-blocks")

    chosen = _rest(out, cut, block_words).groupBy("key", "block").agg(F.sum("size").alias("got"), F.sort_array(F.collect_list("code")).alias("codes"))
    blocks = cut.join(chosen, ["key", "block"], "left").withColumn("full", F.coalesce(F.col("got") == F.col("words"), F.lit(False)))
    out.blocks = stage(blocks.select("key", "block", "words", "source_size", "target", "rounds", (F.col("whole") | F.col("full")).alias("whole"),
                                     F.when(~F.col("full"), F.col("codes")).alias("chosen")), "mix-plan")
    return out


def _rest(planned: Plan, cut: DataFrame, block_words: int) -> DataFrame:
    """``key``, ``block``, ``code``, ``size`` of what fits after the whole blocks. A round settles a block of each open source at least."""
    on = ["key", "block"]
    state = cut.filter(~F.col("whole") & (F.col("need") > 0)).select(*on, "need")
    # Longer documents neither fit nor come nearer.
    left = (planned.sized.filter("size > 0").withColumn("block", planned.block(F.col("code"))).groupBy(*on, "code").agg(F.sum("size").alias("size"))
            .join(state, on).filter("size < 2 * need").withColumnRenamed("need", "first_need"))
    left = stage(left, "mix-left")
    permuted = Window.partitionBy("key").orderBy(F.xxhash64(F.lit(planned.seed), *on), "block")
    taken = left.select(*on, "code", "size").limit(0)
    while True:
        fitting = left.drop("first_need").join(state, on).filter("size <= need")
        steps = (fitting.groupBy(*on, "need").agg(F.sum("size").alias("fit")).withColumn("sum", F.sum("fit").over(permuted))
                 .withColumn("all", F.col("sum") <= F.col("need"))
                 .withColumn("near", ~F.col("all") & (F.col("sum") - F.col("fit") <= F.col("need") + block_words))
                 .withColumn("used", F.coalesce(F.max(F.when(F.col("all"), F.col("sum"))).over(Window.partitionBy("key")), F.lit(0))))
        steps = stage(steps, "mix-fits")
        if not steps.take(1):
            break
        held = fitting.drop("need").join(steps.filter(F.col("all") | F.col("near")), on)
        picked = held.filter("near").withColumn("need", F.col("need") - F.col("used")).select(*on, "code", "size", "sum", "need").groupBy("key").applyInPandas(
            _fit, "key string, block long, code long, size long")
        got = stage(held.filter("all").select(*on, "code", "size").unionByName(picked), "mix-fitted")
        taken = taken.unionByName(got)
        spent = got.groupBy("key").agg(F.sum("size").alias("spent"))
        state = stage(steps.filter(~F.col("all") & ~F.col("near")).join(spent, "key", "left").select(
            *on, (F.col("need") - F.coalesce("spent", F.lit(0))).alias("need")).filter("need > 0"), "mix-open")
    spent = taken.groupBy("key").agg(F.sum("size").alias("spent"))
    shortest = (left.join(taken, [*on, "code"], "left_anti").groupBy("key")
                .agg(F.min(F.struct("size", "block", "code")).alias("d"), F.first("first_need").alias("need")).join(spent, "key", "left")
                .withColumn("need", F.col("need") - F.coalesce("spent", F.lit(0))).filter("d.size - need < need")
                .select("key", "d.block", "d.code", "d.size"))
    return stage(taken.unionByName(shortest), "mix-rest")


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents that fit into what the source still needs, in permuted order."""
    rows = rows.sort_values(["sum", "code"])
    need, takes = float(rows["need"].iloc[0]), []
    for size in rows["size"]:
        takes.append(size <= need)
        need -= size if takes[-1] else 0
    return rows[takes][["key", "block", "code", "size"]]


def allotted(code: Column, chosen: Column) -> Column:
    """Whether a draw of a block holds the document."""
    return chosen.isNull() | F.array_contains(chosen, code)


def split(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``shard``, ``key``, ``n`` from ``key``, ``n``: the splitting tree, a level at a time."""
    schema = "first long, last long, key string, n long"

    def halve(node: pd.DataFrame) -> pd.DataFrame:
        node = node.sort_values("key")
        first, last = int(node["first"].iloc[0]), int(node["last"].iloc[0])
        if last - first < 2:
            return node
        middle, n = (first + last) // 2, node["n"].to_numpy()
        total = int(n.sum())
        left = np.random.default_rng([seed, first, last]).multivariate_hypergeometric(
            n, total * (middle - first) // (last - first), method="marginals")
        both = pd.concat([node.assign(last=middle, n=left), node.assign(first=middle, n=n - left)])
        return both[both["n"] > 0]

    nodes = quotas.select(F.lit(0).cast("long").alias("first"), F.lit(shards).cast("long").alias("last"), "key", "n")
    for _ in range((shards - 1).bit_length()):
        nodes = nodes.groupBy("first", "last").applyInPandas(lambda node: halve(node)[["first", "last", "key", "n"]], schema)
    return nodes.select(F.col("first").alias("shard"), "key", "n")


def shards_for(planned: Plan, shard_words: int = SHARD_WORDS) -> int:
    """Shards of about ``shard_words`` words, but of four blocks of the largest possible source at least."""
    return max(1, -(-planned.total // max(shard_words, 4 * planned.total // (1 << planned.bits))))


def draws(planned: Plan, shards: int | None = None) -> DataFrame:
    """A row per drawn block: key, block, copy, shard, chosen (NULL: the whole block)."""
    shards = shards_for(planned) if shards is None else shards
    times = F.col("rounds") + (F.col("whole") | F.col("chosen").isNotNull()).cast("bigint")
    drawn = (planned.blocks.withColumn("times", times).filter("times > 0")
             .select("key", "block", "rounds", "chosen", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
             .select("key", "block", "copy", F.when(F.col("copy") > F.col("rounds"), F.col("chosen")).alias("chosen")))
    permuted = Window.partitionBy("key").orderBy(F.xxhash64(F.lit(planned.seed), "key", "block", "copy"), "block", "copy")
    drawn = stage(drawn.withColumn("slot", F.row_number().over(permuted).cast("bigint") - 1), "mix-draws")
    leaves = split(drawn.groupBy("key").agg(F.count("*").alias("n")), shards, planned.seed)
    end = F.sum("n").over(Window.partitionBy("key").orderBy("shard"))
    slots = leaves.withColumn("end", end).select(
        "key", "shard", F.explode(F.sequence(F.col("end") - F.col("n"), F.col("end") - 1)).alias("slot"))
    return stage(drawn.join(slots, ["key", "slot"]).drop("slot"), "mix-shards")


def taken(planned: Plan, drawn: DataFrame) -> DataFrame:
    """A row per document: id, size, source_size, target (of its source), taken (words the mix takes, repeats counted)."""
    by_block = drawn.groupBy("key", "block").agg(
        F.count_if(F.col("chosen").isNull()).alias("whole_draws"), F.first("chosen", ignorenulls=True).alias("chosen"))
    facts = planned.blocks.select("key", "block", "source_size", "target").join(by_block, ["key", "block"], "left")
    rows = planned.sized.withColumn("block", planned.block(F.col("code"))).join(facts, ["key", "block"])
    times = F.coalesce("whole_draws", F.lit(0)) + F.coalesce(F.array_contains("chosen", F.col("code")), F.lit(False)).cast("bigint")
    return rows.select("id", "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def mixed(docs: DataFrame, planned: Plan, drawn: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix: the columns of ``docs``, a row per draw, with ``mix_shard`` and ``mix_copy``, each shard together and shuffled.

    Columns of ``docs`` by these two names, as an earlier mix leaves them, give way to the new ones.
    """
    docs = docs.drop("mix_shard", "mix_copy")
    shards = drawn.agg(F.coalesce(F.max("shard"), F.lit(0))).first()[0] + 1
    marked = docs.withColumns({"__key": source_key(F.col(source_col)), "__code": _code(planned.seed, id_col, text_col)})
    right = drawn.select(F.col("key").alias("__key"), F.col("block").alias("__block"), F.col("chosen").alias("__chosen"),
                         F.col("copy").alias("mix_copy"), F.col("shard").alias("mix_shard"))
    if drawn.count() <= BROADCAST_DRAWS:
        right = F.broadcast(right)
    rows = marked.withColumn("__block", planned.block(F.col("__code"))).join(right, ["__key", "__block"])
    rows = rows.filter(allotted(F.col("__code"), F.col("__chosen")))
    rows = rows.withColumn("__order", F.xxhash64(F.lit(planned.seed), "__code", "mix_copy"))
    rows = rows.repartitionByRange(shards, "mix_shard").sortWithinPartitions("mix_shard", "__order")
    return rows.drop("__key", "__code", "__block", "__chosen", "__order")
