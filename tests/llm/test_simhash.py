import random
import re

import numpy as np
import pytest
import xxhash

from tallyloft.llm import simhash
from tallyloft.llm.components import components


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    own = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = [None, "", " \n", "One", "one two", "A b C", "a  b\tc d", "Ärger É x y z", "\u00a0x y\u2003z w v", "a b c " * 3000, "ABC\x0bdef\x0cghi jkl"]


def test_fingerprints_by_definition():
    for text in TEXTS:
        assert simhash.fingerprint_of(text.encode() if text is not None else None) % (1 << 64) == plain(text)
    long = " ".join(map(str, range(300_000)))
    assert simhash.fingerprint_of(long.encode()) % (1 << 64) == plain(long)


def test_native_hash_is_the_same(spark):
    row = spark.sql("SELECT xxhash64('a b c') AS h").first()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


def components_of(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    values = np.array(prints, np.int64).view(np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= 3):
            root[find(i + 1 + int(j))] = find(i)
    return [find(i) for i in range(len(values))]


def same_partition(found, expected):
    return len(set(zip(found, expected))) == len(set(found)) == len(set(expected))


@pytest.mark.parametrize("heavy", [4096, 6, 0])
def test_links_reach_what_all_pairs_reach(spark, heavy):
    draw = random.Random(3)
    centres = [draw.getrandbits(64) for _ in range(12)]
    prints = set()
    for c in centres:
        at = c
        for _ in range(25):
            prints.add(at)
            for b in draw.sample(range(64), draw.choice([1, 2, 3, 4, 5])):
                at ^= 1 << b
            at = draw.choice([at, c])
    prints = [simhash._signed(p) for p in prints]
    links = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), heavy=heavy)
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 3 for a, b in links.collect())
    roots = {r.node: r.root for r in components(links).collect()}
    assert same_partition([roots.get(p, p) for p in prints], components_of(prints))


def test_choices_of_ranges_cover_every_close_pair():
    for nodes in (10, 1 << 20, 1 << 30, 1 << 36):
        masks = simhash.range_masks(nodes, 3)
        draw = random.Random(nodes)
        for _ in range(300):
            flips = sum(1 << b for b in draw.sample(range(64), 3))
            assert any(not m & flips for m in masks)


def test_long_chain_is_one_component(spark):
    chain = spark.range(2000).selectExpr("id + 1 AS a", "id AS b")
    assert {r.root for r in components(chain).collect()} == {0}
    assert components(chain.limit(0)).count() == 0


def test_documents_ties_nulls_and_clashing_columns(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(7, base, "p"), (3, base + " x", "q"), (5, base, "r"), (None, None, "s"), (1, "", "t"), (1, "", "t"), (8, "one two", "u"), (9, "Two one", "v"), (None, "null id", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    found = simhash.near_duplicates(docs).collect()
    close = (plain(base) ^ plain(base + " x")).bit_count() <= 3
    expected = [3 if close else 5, 3, 3 if close else 5, 1, 1, 1, 8, 9, None]
    assert sorted((r.id, r.component_id) for r in found if r.id is not None) == sorted(
        (i, e) for (i, _, _), e in zip(rows, expected) if i is not None)
    left = simhash.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([*({3} if close else {3, 5}), 1, 8, 9, None], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.deduplicate(docs.limit(0)).count() == 0


def test_one_group_with_a_third_of_the_rows(spark):
    rows = [(i, "same words here again" if i % 3 == 0 else f"text number {i} of many {i * 7}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_duplicates(docs).collect()
    prints = [simhash._signed(plain(t)) for _, t in rows]
    roots = components_of(prints)
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min(least.get(r, i), i)
    assert {r.id: r.component_id for r in found} == {i: least[r] for (i, _), r in zip(rows, roots)}
