import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyloft.llm import langid

DATA = "/root/testdata/sf0.01"


def kneser_ney(text, order, alphabet):
    """Interpolated Kneser-Ney by definition: probability of a unit after a context, from one string with START before it."""
    units = "".join(c if langid.letter_table()[ord(c)] != 32 else " " for c in text.lower())
    units = "￿" * (order - 1) + " ".join(units.split(" ")) if "  " not in units else None
    counts = {order: Counter(units[i - order + 1:i + 1] for i in range(order - 1, len(units)))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discount, heads = {}, {}
    for k, c in counts.items():
        ones, twos = (sum(v == n for v in c.values()) for n in (1, 2))
        discount[k] = min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.05), 0.95)
        heads[k] = defaultdict(list)
        for g, v in c.items():
            heads[k][g[:-1]].append(v)

    def p(gram, k):
        if not k:
            return 1 / alphabet
        lower = p(gram[1:], k - 1)
        after = heads[k].get(gram[:-1])
        if not after:
            return lower
        return max(counts[k].get(gram, 0) - discount[k], 0) / sum(after) + discount[k] * len(after) / sum(after) * lower

    return p


def packed(text):
    return langid.grams(langid.units([text])[0])


def model_of(texts):
    langs = sorted(texts)
    return langid.Model(langs, [tuple(np.unique(packed(texts[x]), return_counts=True)) for x in langs])


def test_probabilities_by_definition():
    texts = {"a": "the cat and the dog and the end of the tale", "b": "der hund und die katze und das ende"}
    model = model_of(texts)
    alphabet = round(2 ** -model.floor)
    plain = [kneser_ney(texts[x], 4, alphabet) for x in model.langs]
    probe = "the katze zq and the endx qq"
    stream = langid.units([probe])[0]
    found = model.log_probabilities(packed(probe))
    string = "".join(map(chr, stream))
    for i in range(len(found)):
        for j, p in enumerate(plain):
            assert found[i, j] == pytest.approx(math.log2(p(string[i:i + 4], 4)), abs=1e-3)


def test_probabilities_sum_to_one():
    model = model_of({"a": "abracadabra banana", "b": "cab dab"})
    every = [ord(c) for c in {chr(u) for t in ("abracadabra banana", "cab dab") for u in langid.units([t])[0]} - {"￿"}]
    for context in ("abr", "zzz", "na ", "￿￿￿"):
        head = sum(ord(c) << 16 * (3 - i) for i, c in enumerate(context))
        keys = np.array([head | u for u in every], np.uint64)
        total = np.exp2(model.log_probabilities(keys)).sum(axis=0)
        assert (total <= 1 + 1e-5).all() and (total >= 1 - 1.5 / len(every)).all()  # the rest is for unseen characters


def test_hash_array_finds_all_and_only_its_keys():
    draw = np.random.default_rng(1)
    keys = np.unique(draw.integers(0, 1 << 63, 5000).astype(np.uint64))
    array = langid.HashArray(keys)
    assert (langid._mixed(keys)[array.order] == array.hashes).all()
    at = array.find(keys)
    assert (at >= 0).all() and (keys[array.order][at] == keys).all()
    assert (array.find(keys + np.uint64(1)) >= 0).sum() == np.isin(keys + np.uint64(1), keys).sum()
    assert (langid.HashArray(keys[:0]).find(keys) < 0).all()


def test_counts_are_those_of_all_texts_whatever_the_batches(spark):
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choice(["Ab", "ćd", "é,1x", "😀𝒳y", ""]) for _ in range(draw.randint(0, 60))), "xy"[i % 2]) for i in range(200)]
    rows += [(900, None, "x"), (901, "abc", None), (902, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    found = {(r.lang, r.gram % (1 << 64)): r.n for r in langid.count(docs, "text", "lang").collect()}
    expected = Counter((lang, int(g)) for _, t, lang in rows if t and lang for g in packed(t))
    assert found == expected


def test_long_texts_are_scored_whole(monkeypatch):
    model = model_of({"a": "the cat and the dog " * 3, "b": "der hund und die katze " * 3})
    text = "the dog and " * 500 + "die katze und " * 700
    whole = model.costs([text, "the", text])
    monkeypatch.setattr(langid, "CHUNK", 97)
    parts = model.costs([text, "the", text])
    assert np.allclose(whole[0], parts[0]) and (whole[1] == parts[1]).all()
    assert model.guess([text]).lang[0] == "b"


def test_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = langid.learn(docs.filter("crc32(string(doc_id)) % 4 <> 2"))
    held = docs.filter("crc32(string(doc_id)) % 4 = 2 AND length(text) > 100")
    found = held.select("lang", langid.guess(model, held, held["text"]).alias("g")).collect()
    assert sum(r.lang == r.g.lang for r in found) >= 0.99 * len(found)
    assert not any(r.g.rejected for r in found) and all(0 <= r.g.score <= 1 for r in found)
    foreign = model.guess(["Это совершенно другой язык, и его здесь нет " * 5, "qzxj wvkq zzxq jjqx vvkz qqqx xzzj " * 9, None, "", "12 + 3 !!", "😀"])
    assert foreign["rejected"].all() and list(foreign["lang"][2:]) == ["und"] * 4 and list(foreign["score"][2:]) == [0.0] * 4
    extra = spark.createDataFrame([(1, "Ertion the and of that with", "kept"), (2, None, "gone"), (None, "", "gone")], "doc_id long, text string, rejected string")
    assert langid.identified(extra, model).collect() == [(1, "Ertion the and of that with", "kept")]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None), (None, None, "x")], "doc_id long, text string, lang string")
    for some in (docs, docs.limit(0)):
        model = langid.learn(some)
        assert model.langs == []
        assert [(r.g.lang, r.g.rejected) for r in docs.select(langid.guess(model, docs, docs["text"]).alias("g")).collect()] == [("und", True)] * 2


def test_one_language_and_small_model(spark):
    docs = spark.createDataFrame([(i, "the cat and the dog", "en") for i in range(30)], "doc_id long, text string, lang string")
    model = langid.learn(docs, max_cells=5)
    assert model.langs in ([], ["en"])
    assert langid.learn(docs).guess(["the cat and the dog"]).lang[0] == "en"


def test_models_beyond_the_bound_keep_every_n_gram(spark, monkeypatch):
    """A written model gives what the broadcast one gives, a rare language included."""
    monkeypatch.setattr(langid, "RANGE_CELLS", 64)
    rows = [(i, "the cat and the dog and the end of the tale " * (i % 3 + 1) + "x" * (i % 7), "en") for i in range(60)]
    rows += [(100 + i, "der hund und die katze und das ende " * (i % 2 + 1) + "ü" * i, "de") for i in range(9)] + [(200, "Ћирилица је писмо, а ово текст на њему 𝒳", "sr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole, written = langid.learn(docs), langid.learn(docs, max_cells=100)
    assert isinstance(written, langid.WrittenModel) and not isinstance(whole, langid.WrittenModel)
    assert written.langs == whole.langs == ["de", "en", "sr"] and written.floor == whole.floor
    probe = [t for _, t, _ in rows] + ["the katze zq and the endx qq", "ово је hund", "q", None, ""]
    for t in probe[:-2]:
        assert np.allclose(written.log_probabilities(packed(t)), whole.log_probabilities(packed(t)), atol=1e-4)
    assert np.allclose(written.limits, whole.limits, atol=1e-4)
    one, two = whole.guess(probe), written.guess(probe)
    assert (one["lang"] == two["lang"]).all() and (one["rejected"] == two["rejected"]).all() and one["lang"][69] == "sr" and not one["rejected"][69]
    found = docs.select("doc_id", langid.guess(written, docs, docs["text"]).alias("g")).collect()
    assert {r.doc_id: r.g.lang for r in found} == {i: x for i, _, x in rows}
    assert not any(r.g.rejected for r in found)


def test_written_models_refuse_a_folder_that_is_no_path(spark):
    """Also one without a scheme, where the default file system is another one."""
    rows = spark.createDataFrame([(1, [0.5])], "key long, value array<double>").selectExpr("2 AS no", "key", "value")
    with pytest.raises(RuntimeError, match="as a path"):
        langid._written([rows], 1, "http://host/folder")
    spark.conf.set("fs.defaultFS", "http://host")
    try:
        with pytest.raises(RuntimeError, match="as a path"):
            langid._written([rows], 1, "/folder")
    finally:
        spark.conf.unset("fs.defaultFS")
