"""Conversation prefix trie: a node per distinct sequence of first turns, with totals over its subtree by a depth-band rollup.

A node is known by its depth and two 64-bit sums (exclusive or) of hashes of its turns, each salted with the turn's place. The smallest
conversation that starts with a node owns it; what a conversation owns is one run down to its last turn, so only the first node of that run
has a parent owned by another one.

Subtree totals: depths are cut in bands of ``BAND`` levels. Within a band each node explodes to its ancestors in the band only: the nodes that
one conversation owns in one band share their path, so a conversation and band give one row per level. The totals of band roots are then
completed first: band roots alone form a trie of a ``BAND``-th of the depth, rolled up the same way, and each completed total goes to the
ancestors in the band above. Rounds grow with the logarithm of the depth, and no row explodes to more than ``BAND`` rows.

Turns are numbered without bringing a conversation into one task: they are sorted over range partitions, and what a conversation holds in
earlier partitions is added from a table of the partitions' first and last conversations. So are the running sums. The member lists of nodes
are sorted the same way, joined to pieces of ``PIECE`` ids, and hashed as a stream.

Defined results: rows without a conversation id belong to none and are left out. NULL role and text are empty. NULL turns come first; equal
turns of a conversation are ordered by the SHA-256 of length of role, ``:``, role and text; repeated rows are turns of their own. A conversation of
no turns is a member of the root only. An empty table gives no node. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloft.llm.common import HOT_SHARE, attach
from tallyloft.session import stage

BAND = 8
PIECE_BITS = 9
_PART_BITS = 33  # of monotonically_increasing_id: the position within a partition
_EMPTY = hashlib.sha256(b"").hexdigest()


def _lane(k: int, depth: Column, digest: Column) -> Column:
    return F.xxhash64(F.lit(k), depth.cast("bigint"), digest)


def _node() -> Column:
    return F.struct("depth", "x1", "x2")


def ordered(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Turns in order: conv, digest, size, part (of the sorted table), place."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.length(text).cast("bigint").alias("size"), F.monotonically_increasing_id().alias("row"))
    # The row number keeps equal rows apart, so that a turn repeated many times spreads over partitions.
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")]
    placed = turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "digest", "size", F.monotonically_increasing_id().alias("place"))
    return stage(placed, "turns").withColumn("part", F.shiftright("place", _PART_BITS))


def _earlier(rows: DataFrame, found: list[Column], sums: list[Column]) -> DataFrame:
    """For conversations at the edge of a partition: sums over their rows in earlier partitions. At most two rows per partition.

    ``found`` are aggregates of a conversation's rows in one partition, ``sums`` window functions over these.
    """
    edges = rows.groupBy("part").agg(F.min("conv").alias("a"), F.max("conv").alias("b"))
    edges = F.broadcast(edges.select(F.explode(F.array("a", "b")).alias("conv")).distinct())
    held = rows.join(edges, "conv", "left_semi").groupBy("part", "conv").agg(*found)
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(held.select("part", "conv", *(s.over(before).alias(f"before{i}") for i, s in enumerate(sums))))


def members(turns: DataFrame, group: int | None, most: int) -> DataFrame:
    """A row per conversation and depth from 0 on: conv, depth, x1, x2 (the node), size (of its last text), last (whether the conversation ends here).

    With ``group``, conversation c takes over the first crc32(c) % ``most`` turns of conversation c - c % ``group`` in place of its own.
    """
    here = Window.partitionBy("part", "conv").orderBy("place")
    earlier = _earlier(turns, [F.count("*").alias("n")], [F.sum("n")])

    def position(rows: DataFrame) -> DataFrame:
        return rows.join(earlier, ["part", "conv"], "left").withColumn("pos", F.col("r") + F.coalesce("before0", F.lit(0))).drop("r", "before0")

    facts = turns.groupBy("conv").agg(F.count("*").alias("n"))
    if group:
        first = position(turns.withColumn("r", F.row_number().over(here)).filter(F.col("r") < most)).filter(F.col("pos") < most)
        heads = first.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "size"))).alias("head"))
        facts = facts.withColumn("h", F.crc32(F.col("conv").cast("string")) % most).withColumn("base", F.col("conv") - F.col("conv") % group)
        facts = facts.join(heads.withColumnRenamed("conv", "base"), "base", "left").withColumn(
            "head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h").cast("int")))
        steps = F.transform("head", lambda e, i: F.struct((i + 1).cast("bigint").alias("depth"), e["size"].alias("size"), *(
            F.aggregate(F.transform(F.slice("head", F.lit(1), i + 1), lambda t, j: _lane(k, j + 1, t["digest"])), F.lit(0).cast("bigint"), lambda a, x: a.bitwiseXOR(x)).alias(f"x{k}") for k in (1, 2))))
        facts = facts.select("conv", "n", "h", F.size("head").cast("bigint").alias("p"), steps.alias("steps"))
    else:
        none = F.array().cast("array<struct<depth:bigint,size:bigint,x1:bigint,x2:bigint>>")
        facts = facts.select("conv", "n", F.lit(0).cast("bigint").alias("h"), F.lit(0).cast("bigint").alias("p"), none.alias("steps"))
    root = F.array(F.struct(*(F.lit(0).cast("bigint").alias(c) for c in ("depth", "size", "x1", "x2"))))
    facts = stage(facts.withColumn("steps", F.concat(root, "steps")), "conversations")

    total = facts.agg(F.sum("n")).first()[0] or 0
    tip = F.element_at("steps", -1)
    own = attach(turns, facts.select("conv", "n", "h", "p", tip["x1"].alias("p1"), tip["x2"].alias("p2")), "conv",
                 facts.filter(F.col("n") * HOT_SHARE >= total))
    own = position(own.withColumn("r", F.row_number().over(here))).filter("pos > h").withColumn("depth", F.col("p") + F.col("pos") - F.col("h"))
    running = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = stage(own.select("part", "conv", "depth", "size", "p1", "p2", (F.col("pos") == F.col("n")).alias("last"), *(
        F.bit_xor(_lane(k, F.col("depth"), F.col("digest"))).over(running).alias(f"x{k}") for k in (1, 2))), "running")
    earlier_sums = _earlier(own, [F.max_by(f"x{k}", "depth").alias(f"x{k}") for k in (1, 2)], [F.bit_xor(f"x{k}") for k in (1, 2)])
    whole = lambda k: F.col(f"x{k}").bitwiseXOR(F.col(f"p{k}")).bitwiseXOR(F.coalesce(f"before{k - 1}", F.lit(0))).alias(f"x{k}")
    own = own.join(earlier_sums, ["part", "conv"], "left").select("conv", "depth", whole(1), whole(2), "size", "last")
    taken = facts.select("conv", F.explode("steps").alias("s"), ((F.col("n") <= F.col("h")) & (F.col("s.depth") == F.col("p"))).alias("last"))
    return stage(own.unionByName(taken.select("conv", "s.depth", "s.x1", "s.x2", "s.size", "last")), "members")


def subtree_totals(paths: DataFrame, owned: DataFrame, sums: list[str], deepest: int, band: int = BAND) -> DataFrame:
    """``sums`` over the subtree of each node, itself included, as a row per ``node``.

    ``paths``: conv, depth, node for every node that a conversation starts with. ``owned``: conv, depth, node, ``sums`` for the nodes
    that it owns.
    """
    level = F.expr(f"depth div {band}").alias("band")
    bands = paths.groupBy("conv", level).agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("path"))
    bands = stage(bands, "trie-bands")
    runs = owned.groupBy("conv", level).agg(F.array_sort(F.collect_list(F.struct("depth", *sums))).alias("run"))

    def below(at: Column, s: str) -> Column:
        return F.aggregate(F.filter("run", lambda o: o["depth"] >= at), F.lit(0).cast("bigint"), lambda t, o: t + o[s]).alias(s)

    inside = bands.join(runs, ["conv", "band"]).select(F.explode(F.transform("path", lambda a: F.struct(
        a["node"].alias("node"), *(below(a["depth"], s) for s in sums)))).alias("a")).select("a.*")
    inside = inside.groupBy("node").agg(*(F.sum(s).alias(s) for s in sums))
    if deepest < band:
        return inside
    inside = stage(inside, "trie-inside")
    at_root, up = F.col("depth") % band == 0, F.expr(f"depth div {band}").alias("depth")
    roots = stage(owned.filter(at_root).select("conv", up, "node").join(inside, "node"), "trie-roots")
    done = subtree_totals(paths.filter(at_root).select("conv", up, "node"), roots, sums, deepest // band, band)
    done = stage(roots.select("conv", "depth", "node").join(done, "node"), "trie-roots-done")
    handed = done.filter("depth > 0").select("conv", (F.col("depth") - 1).alias("band"), *sums).join(bands, ["conv", "band"]).select(
        F.explode("path.node").alias("node"), *sums)
    return inside.unionByName(handed).groupBy("node").agg(*(F.sum(s).alias(s) for s in sums))


def _hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the pieces of each node, which follow each other."""
    at, digest = None, None
    for frame in frames:
        done = []
        for key, ids in zip(zip(frame["depth"], frame["x1"], frame["x2"]), frame["ids"]):
            if key == at:
                digest.update(b"," + ids.encode())
                continue
            if at is not None:
                done.append((*at, digest.hexdigest()))
            at, digest = key, hashlib.sha256(ids.encode())
        yield pd.DataFrame(done, columns=["depth", "x1", "x2", "ends_sha256"])
    if at is not None:
        yield pd.DataFrame([(*at, digest.hexdigest())], columns=["depth", "x1", "x2", "ends_sha256"])


def ends(rows: DataFrame) -> DataFrame:
    """depth, x1, x2, ends_sha256 of the nodes at which a conversation ends."""
    order = ["depth", "x1", "x2", "conv"]
    listed = rows.filter("last").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    listed = stage(listed.withColumn("place", F.monotonically_increasing_id()), "trie-ends")
    pieces = listed.groupBy("depth", "x1", "x2", F.shiftright("place", PIECE_BITS).alias("piece")).agg(
        F.min("conv").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    return pieces.repartition("depth", "x1", "x2").sortWithinPartitions("depth", "x1", "x2", "first").drop("piece").mapInPandas(
        _hashed, "depth bigint, x1 bigint, x2 bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, group: int | None = None, most: int = 6, id_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text", band: int = BAND) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = members(ordered(conversations, id_col, turn_col, role_col, text_col), group, most)
    owner = F.min(F.struct("conv", "last"))
    nodes = rows.groupBy("depth", "x1", "x2").agg(owner.alias("o"), F.count("*").alias("n_convs"), F.max("size").alias("size"))
    nodes = stage(nodes.select(_node().alias("node"), "depth", "o.conv", (~F.col("o.last")).alias("goes_on"), "n_convs", "size"), "trie-nodes")
    tops = nodes.groupBy("conv").agg(F.min("depth").alias("depth")).filter("depth > 0")
    over = rows.select("conv", (F.col("depth") + 1).alias("depth"), _node().alias("node"))
    tops = stage(tops.join(over, ["conv", "depth"]), "trie-tops")  # node: the parent of the first owned one
    children = stage(tops.groupBy("node").agg(F.count("*").alias("k")), "trie-children")
    total = tops.count()
    parents = attach(tops, nodes.select("node", F.col("conv").alias("above")), "node", children.filter(F.col("k") * HOT_SHARE >= total)).drop("node")
    n_children = F.coalesce("k", F.lit(0)) + F.col("goes_on").cast("bigint")
    nodes = nodes.join(children, "node", "left").join(parents, ["conv", "depth"], "left").select(
        "node", "conv", "depth", F.when(F.col("depth") > 0, F.coalesce("above", "conv")).alias("above"), "n_convs", n_children.alias("n_children"),
        (n_children == 0).cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    nodes = stage(nodes, "trie-weighed")
    sums = ["n_leaves", "saved_tokens"]
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = subtree_totals(rows.select("conv", "depth", _node().alias("node")), nodes.select("conv", "depth", "node", *sums), sums, deepest, band)
    ended = ends(rows).select(_node().alias("node"), "ends_sha256")
    return nodes.drop(*sums).join(totals, "node").join(ended, "node", "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("above").alias("parent_conv_id"), "n_convs", "n_children", *sums,
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))
