"""SimHash near-duplicates: fingerprints of word shingles, linked at a few differing bits through tables of pivot distances.

Fingerprints that differ in at most ``max_bits`` bits agree on some ``parts - max_bits`` of ``parts`` bit ranges, so one equality
join per choice of ranges forms every pair that can link. For each fingerprint the Hamming distances to fixed reference
fingerprints are computed once; by the triangle inequality a pair whose distances to any one reference differ by more than ``max_bits``
cannot link, and the largest coordinate difference throws out nearly all pairs before their own bits are compared. Both tests
stand in the join's condition, so only links leave it.

Copies are one node from the start. A bucket of the join beyond ``HEAVY`` fingerprints is not paired: there each fingerprint x lists the
values k within one flip and within two flips of it. All fingerprints within two flips of a k are linked to the smallest
fingerprint within one flip of that k, which is at most three bits away. Every pair at three bits or fewer meets at such a k, so the
components are the same, with rows in proportion to the bucket instead of its square.

Defined results: a NULL, empty or blank text has fingerprint zero and is linked like any other. Fewer words than ``words`` make
one shingle. NULL ids get a component's id like other rows, which is NULL only if all its ids are. Repeated rows share a component.
Other columns are not read.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloft.llm.common import HOT_SHARE, WHITE_ODD, attach, only
from tallyloft.llm.components import components
from tallyloft.session import stage

SEED = 42
PIVOTS = 16
HEAVY = 4096  # beyond it the flips, some 2,100 a fingerprint, are fewer rows than the pairs
_ODD = re.compile(WHITE_ODD.encode())
_BLOCK = 1 << 18


def fingerprint_of(text: bytes | None, words: int = 3) -> int:
    """The 64 bits as a signed number."""
    flat = _ODD.sub(b" ", (text or b"").lower()).strip(b" ")  # bytes.lower() changes A-Z only
    if not flat:
        return 0
    spaces = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    if len(spaces) < words:
        starts, ends = np.array([0]), np.array([len(flat)])
    else:
        starts, ends = np.append(0, spaces + 1)[: len(spaces) + 2 - words], np.append(spaces, len(flat))[words - 1:]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(starts), _BLOCK):
        spans = zip(starts[i:i + _BLOCK].tolist(), ends[i:i + _BLOCK].tolist())
        own = [xxhash.xxh64_intdigest(flat[a:b], SEED) for a, b in spans]
        octets = np.array(own, np.uint64).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, words: int = 3) -> Column:
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, words) for t in texts], dtype="int64")

    return of(text.cast("binary"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def pivot_table(fp: Column) -> list[Column]:
    """Distances to the references, eight of them packed in the bytes of one number."""
    near = [F.bit_count(fp.bitwiseXOR(F.lit(_signed(xxhash.xxh64_intdigest(f"reference {i}".encode(), SEED))))).cast("bigint")
            for i in range(PIVOTS)]
    packed = []
    for i in range(0, PIVOTS, 8):
        word = near[i]
        for j in range(1, 8):
            word = word.bitwiseOR(F.shiftleft(near[i + j], 8 * j))
        packed.append(word.alias(f"pivots{i // 8}"))
    return packed


def _far(max_bits: int) -> Column:
    """Whether some reference tells the two sides apart."""
    part = lambda c, j: F.shiftright(F.col(c), 8 * j).bitwiseAND(F.lit(127))
    return F.greatest(*(F.abs(part(f"pivots{w}", j) - part(f"other{w}", j)) for w in range(PIVOTS // 8) for j in range(8))) > max_bits


def range_masks(nodes: int, max_bits: int) -> list[int]:
    """Masks of the bit ranges to agree on: as few choices as leave buckets of a few fingerprints on average."""
    for parts in range(max_bits + 1, 64):
        cuts = [64 * i // parts for i in range(parts + 1)]
        ranges = [((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:])]
        masks = [sum(c) for c in itertools.combinations(ranges, parts - max_bits)]
        if min(m.bit_count() for m in masks) + 2 >= nodes.bit_length() or len(masks) >= 35:
            return masks
    return masks


def links(prints: DataFrame, max_bits: int = 3, heavy: int = HEAVY) -> DataFrame:
    """Links a, b that join all fingerprints (column ``fp``, distinct) at ``max_bits`` or fewer differing bits.

    Outside heavy buckets these are all such pairs; inside, enough of them to give the same components.
    """
    masks = range_masks(max(1, prints.count()), max_bits)
    listed = prints.select("fp", *pivot_table(F.col("fp"))).withColumn("choice", F.explode(F.array(*(
        F.struct(F.lit(i).alias("no"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for i, m in enumerate(masks)))))
    listed = stage(listed.select("fp", "pivots0", "pivots1", "choice.no", "choice.bits"), "fingerprint-choices")
    crowds = stage(listed.groupBy("no", "bits").agg(F.count("*").alias("n")).filter(F.col("n") > heavy).select("no", "bits"),
                   "fingerprint-crowds")
    crowded = bool(crowds.take(1))
    left = listed.join(crowds, ["no", "bits"], "left_anti") if crowded else listed
    right = listed.select(F.col("no").alias("no_b"), F.col("bits").alias("bits_b"), F.col("fp").alias("b"),
                          F.col("pivots0").alias("other0"), F.col("pivots1").alias("other1"))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= max_bits
    paired = left.join(right, [F.col("no") == F.col("no_b"), F.col("bits") == F.col("bits_b"), F.col("fp") < F.col("b"),
                               ~_far(max_bits), close]).select(F.col("fp").alias("a"), "b")
    return paired.unionByName(_stars(listed.join(crowds, ["no", "bits"]), max_bits)) if crowded else paired


def _stars(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Links within each bucket (no, bits) through the values a few flips away."""
    def flipped(flips: int) -> DataFrame:
        masks = [_signed(sum(c)) for n in range(flips + 1) for c in itertools.combinations([1 << b for b in range(64)], n)]
        return crowded.select("no", "bits", "fp", F.explode(F.lit(np.array(masks, np.int64))).alias("mask")).select(
            "no", "bits", "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("k"))

    near = max_bits // 2
    hubs = flipped(near).groupBy("no", "bits", "k").agg(F.min("fp").alias("a"))
    around = flipped(max_bits - near).withColumnRenamed("fp", "b")
    return around.join(hubs, ["no", "bits", "k"]).filter("a <> b").select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 3,
                    heavy: int = HEAVY) -> DataFrame:
    """A row per document: id, text_key (a hash that tells texts of one id apart), fp, root (the component), component_id (its smallest id)."""
    prints = stage(docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"),
                               fingerprint(F.col(text_col), words).alias("fp")), "fingerprints")
    nodes = stage(prints.groupBy("fp").agg(F.min("id").alias("first_id"), F.count("*").alias("n")), "fingerprint-nodes")
    roots = components(links(nodes.select("fp"), max_bits, heavy), "fingerprint-links")
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    facts = stage(rooted.select("fp", "root", "n").join(named, "root").select("fp", "root", "component_id", "n"), "fingerprint-components")
    total = nodes.agg(F.sum("n")).first()[0] or 0
    return attach(prints, facts.select("fp", "root", "component_id"), "fp", facts.filter(F.col("n") * HOT_SHARE >= total))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 3) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns."""
    found = near_duplicates(docs, id_col, text_col, words, max_bits)
    first = (found.filter(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("root", "component_id")
             .agg(F.min("text_key").alias("text_key")).select(F.col("component_id").alias("id"), "text_key"))
    return only(docs, first, {"id": F.col(id_col), "text_key": F.xxhash64(text_col)})
