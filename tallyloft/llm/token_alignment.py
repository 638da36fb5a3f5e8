"""Cross-tokenizer alignment: groups of tokens between the byte offsets at which tokens of both tokenizers end, by merge-path pieces.

Tokenizer A encodes a space and the text, B encodes the text and puts the space itself. In a task, the ends of many documents' tokens
lie in two ascending lists. Diagonal binary searches cut the merge of both into pieces of equal work that need nothing of each other: a
piece marks the ends that occur on both sides and numbers its groups; the tokens past its last common end and those before the first one
of the next piece are stitched by adding up the pieces' counts of common ends, so a group may span any number of pieces. The links of a
document (A-B occurrence pairs within a group) leave the task as distinct id pairs with their number.

How many documents hold a pair, and the highest such count of each A id, are aggregates over all documents. They return to the documents by
a join on the pair: pairs that hold at least one row in ``HOT_PAIRS`` (so at most that many at any size) by broadcast, all others by a shuffle.

A word (a space and what follows up to the next single space between two other characters) is encoded once per task and kept, as no token
of either tokenizer crosses such a space: the byte-level one splits there, and no piece of the other holds a space behind another
character (checked when the model is read; otherwise texts are encoded whole). So long texts are worked off in stretches of ``STRETCH``
characters, and what is kept of words is bounded.

Defined results: a text that is NULL, empty, not valid UTF-8, or whose joined token bytes of A or B differ from space and text has no
tokens: zeros and an empty ``groups``. Every row is a document, repeated rows and NULL ids too. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloft.llm.common import shared
from tallyloft.session import stage

PIECE = 1 << 14  # ends in a piece
STRETCH = 1 << 18  # characters worked on at a time
HOT_PAIRS = 1 << 16
_KEPT_WORDS, _KEPT_IDS = 1 << 18, 1 << 21
_WIDE_GROUP = 1 << 12
_WORD_GAP = re.compile(r"(?<=\S) (?=\S)")
_BITS = 24
# Fixed value: how a byte-level tokenizer of this kind splits a text before it merges.
_BYTE_LEVEL_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def merge_cuts(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two ascending lists is cut: one binary search per diagonal, all at once. Equal ends stay in one piece."""
    diagonal = np.arange(work, len(a) + len(b), work)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        ahead = np.zeros(len(diagonal), bool)
        ahead[open_] = a[mid[open_]] <= b[diagonal[open_] - 1 - mid[open_]]
        low, high = np.where(open_ & ahead, mid + 1, low), np.where(open_ & ~ahead, mid, high)
    i, j = low, diagonal - low
    split = (i > 0) & (j < len(b))
    split[split] = a[i[split] - 1] == b[j[split]]
    j = j + split
    return np.concatenate([[0], i, [len(a)]]), np.concatenate([[0], j, [len(b)]])


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A piece: which of its ends occur on the other side."""
    at = np.searchsorted(b, a)
    in_a = at < len(b)
    in_a[in_a] = b[at[in_a]] == a[in_a]
    in_b = np.zeros(len(b), bool)
    in_b[at[in_a]] = True
    return in_a, in_b


def grouped(a: np.ndarray, b: np.ndarray, work: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For ends of A and B: the group of each token, and whether it closes its group."""
    i, j = merge_cuts(a, b, work)
    last_a, last_b = np.empty(len(a), bool), np.empty(len(b), bool)
    group_a, group_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    before = 0  # common ends of earlier pieces: a piece's open tail and the next one's head get the same number
    for i0, i1, j0, j1 in zip(i, i[1:], j, j[1:]):
        in_a, in_b = common_ends(a[i0:i1], b[j0:j1])
        last_a[i0:i1], last_b[j0:j1] = in_a, in_b
        group_a[i0:i1] = before + np.cumsum(in_a) - in_a
        group_b[j0:j1] = before + np.cumsum(in_b) - in_b
        before += int(in_a.sum())
    return group_a, group_b, last_a, last_b


def _slices(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of all slices, one after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


def _byte_level() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: visible Latin-1 stands for itself, the rest follows from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [x for x in range(256) if x not in visible]
    return {chr(c): x for c, x in [*zip(visible, visible), *((256 + i, x) for i, x in enumerate(hidden))]}


class Vocabulary:
    """Bytes and printed forms of one tokenizer's ids."""

    def __init__(self, of_id: list[bytes], inner: str, closing: str):
        self.of_id = of_id
        self.widths = np.array([len(x) for x in of_id], np.int64)
        self.inner = np.array([f"{i}{inner}" for i in range(len(of_id))], object)
        self.closing = np.array([f"{i}{closing}" for i in range(len(of_id))], object)

    def printed(self, ids: np.ndarray, last: np.ndarray) -> np.ndarray:
        return np.where(last, self.closing[ids], self.inner[ids])


class Aligner:
    def __init__(self, a_json: str, b_model: bytes, work: int = PIECE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.work = Tokenizer.from_str(a_json), work
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        octet, size = _byte_level(), self.a.get_vocab_size()
        a_names = [self.a.id_to_token(i) or "" for i in range(size)]
        b_names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(b_names)]
        self.words_apart = not any("▁" in p.lstrip("▁") for p in b_names)
        self.vocabulary = (Vocabulary([bytes(octet[c] for c in t) if all(c in octet for c in t) else t.encode() for t in a_names], ",", "|"),
                           Vocabulary(b_bytes, ",", ";"))
        self.encode_a = self._byte_pairs(json.loads(a_json)["model"], octet) or (
            lambda words: [e.ids for e in self.a.encode_batch_fast([f" {w}" for w in words], add_special_tokens=False)])
        self.forget()

    @staticmethod
    def _byte_pairs(model: dict, octet: dict[str, int]) -> Callable[[list[str]], list[list[int]]] | None:
        """A's encoder by ranks, several times faster, where the ids follow the order of the merges: then merging the least id is merging the first."""
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        single = [t for t in model["vocab"] if len(t) == 1]
        if [model["vocab"].get(t) for t in merged] != list(range(len(single), len(single) + len(merged))):
            return None
        import tiktoken

        ranks = {bytes(octet[c] for c in t): model["vocab"][t] for t in [*single, *merged]}
        encoding = tiktoken.Encoding("a", pat_str=_BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})
        return lambda words: [encoding.encode_ordinary(f" {w}") for w in words]

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.sound = np.empty(0, bool)
        self.flat = [np.empty(0, np.int64)] * 2
        self.starts = [np.empty(0, np.int64)] * 2
        self.lengths = [np.empty(0, np.int64)] * 2

    def words(self, text: str) -> list[str]:
        return _WORD_GAP.split(text) if self.words_apart else [text]

    def learn(self, words: list[str]) -> np.ndarray:
        """The numbers of ``words``, which are encoded where they are new."""
        if len(self.number) > _KEPT_WORDS or max(map(len, self.flat)) > _KEPT_IDS:
            self.forget()
        new = list(dict.fromkeys(w for w in words if w not in self.number))
        if new:
            found = self.encode_a(new), self.b.encode(new, num_threads=1)
            self.sound = np.append(self.sound, self._sound(new, found[0], 0) & self._sound(new, found[1], 1))
            for side, listed in enumerate(found):
                lengths = np.fromiter(map(len, listed), np.int64, len(new))
                self.starts[side] = np.append(self.starts[side], len(self.flat[side]) + np.cumsum(lengths) - lengths)
                self.lengths[side] = np.append(self.lengths[side], lengths)
                self.flat[side] = np.append(self.flat[side], np.fromiter(chain.from_iterable(listed), np.int64))
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def _sound(self, words: list[str], listed: list[list[int]], side: int) -> np.ndarray:
        """Which words are what their tokens' bytes make."""
        of_id = self.vocabulary[side].of_id
        raw = [f" {w}".encode() for w in words]
        widths = self.vocabulary[side].widths[np.fromiter(chain.from_iterable(listed), np.int64)]
        ends = np.cumsum(np.fromiter(map(len, listed), np.int64, len(words)))
        ends_right = np.array_equal(np.append(0, np.cumsum(widths))[ends], np.cumsum(np.fromiter(map(len, raw), np.int64, len(words))))
        if ends_right and b"".join(map(of_id.__getitem__, chain.from_iterable(listed))) == b"".join(raw):
            return np.ones(len(words), bool)
        made = [b"".join(map(of_id.__getitem__, ids)) for ids in listed]
        return np.fromiter(map(bytes.__eq__, made, raw), bool, len(words))

    def align(self, docs: list[list[str]]) -> list[dict[str, Any]]:
        """For each document, given as words: sound, n_a, n_b, n_groups, n_links, groups, pairs (coded), times."""
        sizes = np.array([len(d) for d in docs])
        words = self.learn([w for d in docs for w in d])
        doc_of_word = np.repeat(np.arange(len(docs)), sizes)
        sound = np.bincount(doc_of_word[~self.sound[words]], minlength=len(docs)) == 0
        words, doc_of_word = words[sound[doc_of_word]], doc_of_word[sound[doc_of_word]]
        ids, docs_of, ends = [], [], []
        for side, vocabulary in enumerate(self.vocabulary):
            lengths = self.lengths[side][words]
            ids.append(self.flat[side][_slices(self.starts[side][words], lengths)])
            docs_of.append(np.repeat(doc_of_word, lengths))
            ends.append(np.cumsum(vocabulary.widths[ids[-1]]))
        group_a, group_b, last_a, last_b = grouped(*ends, self.work)
        n_groups = int(last_a.sum())
        in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        start_a, start_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        doc_of_group = docs_of[0][last_a]
        per_doc = lambda x: np.bincount(x, minlength=len(docs))
        n_links = np.zeros(len(docs), np.int64)
        np.add.at(n_links, doc_of_group, in_a * in_b)

        text = np.empty(len(group_a) + len(group_b), object)
        text[np.arange(len(group_a)) + start_b[group_a]] = self.vocabulary[0].printed(ids[0], last_a)
        text[np.arange(len(group_b)) + (start_a + in_a)[group_b]] = self.vocabulary[1].printed(ids[1], last_b)

        narrow = in_a * in_b <= _WIDE_GROUP
        tokens = narrow[group_a]
        group = group_a[tokens]
        partners = ids[1][_slices(start_b[group], in_b[group])]
        code = np.repeat(docs_of[0][tokens] << 2 * _BITS | ids[0][tokens] << _BITS, in_b[group]) | partners
        code, times = np.unique(code, return_counts=True)
        wide = []
        for g in np.flatnonzero(~narrow):
            own = [np.unique(x[s:s + n], return_counts=True) for x, s, n in ((ids[0], start_a[g], in_a[g]), (ids[1], start_b[g], in_b[g]))]
            wide.append((((doc_of_group[g] << 2 * _BITS) | own[0][0][:, None] << _BITS | own[1][0]).ravel(), (own[0][1][:, None] * own[1][1]).ravel()))
        if wide:
            code, times = summed(*(np.concatenate(x) for x in zip((code, times), *wide)))
        n_a, n_b, groups = per_doc(docs_of[0]), per_doc(docs_of[1]), per_doc(doc_of_group)
        cuts = np.append(0, np.cumsum(n_a + n_b))
        of_doc = np.searchsorted(code, np.arange(len(docs) + 1) << 2 * _BITS)
        return [{"sound": bool(sound[d]), "n_a": int(n_a[d]), "n_b": int(n_b[d]), "n_groups": int(groups[d]), "n_links": int(n_links[d]),
                 "groups": "".join(text[cuts[d]:cuts[d + 1]].tolist())[:-1],
                 "pairs": code[of_doc[d]:of_doc[d + 1]] & (1 << 2 * _BITS) - 1, "times": times[of_doc[d]:of_doc[d + 1]]} for d in range(len(docs))]


def summed(code: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code, at = np.unique(code, return_inverse=True)
    total = np.zeros(len(code), np.int64)
    np.add.at(total, at, times)
    return code, total


NONE = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "sha": "", "pairs": np.empty(0, np.int64), "times": np.empty(0, np.int64)}


def _whole(aligner: Aligner, words: list[str]) -> dict[str, Any]:
    """A long text, stretch by stretch: each ends with a word, so with a common end."""
    out, digest, held = dict(NONE), hashlib.sha256(), 0
    stretch: list[str] = []
    codes, times = [], []

    def work() -> bool:
        found = aligner.align([stretch])[0]
        digest.update(((";" if out["n_a"] else "") + found["groups"]).encode())
        for k in ("n_a", "n_b", "n_groups", "n_links"):
            out[k] += found[k]
        codes.append(found["pairs"])
        times.append(found["times"])
        if sum(map(len, codes)) > STRETCH:
            code, n = summed(np.concatenate(codes), np.concatenate(times))
            codes[:], times[:] = [code], [n]
        return found["sound"]

    for word in words:
        stretch.append(word)
        held += len(word) + 1
        if held >= STRETCH:
            if not work():
                return NONE
            stretch, held = [], 0
    if stretch and not work():
        return NONE
    code, n = summed(np.concatenate(codes), np.concatenate(times))
    return out | {"sha": digest.hexdigest(), "pairs": code, "times": n}


_FIELDS = ("n_a", "n_b", "n_groups", "n_links")


def _aligned(models: Callable[[], tuple[str, bytes]]) -> Callable:
    schema = pa.schema([("row", pa.int64()), *((k, pa.int64()) for k in _FIELDS), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])

    def record(rows: list[int], found: list[dict[str, Any]]) -> pa.RecordBatch:
        offsets = pa.array(np.append(0, np.cumsum([len(x["pairs"]) for x in found])), pa.int32())
        flat = lambda k: pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x[k] for x in found]), pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), *(pa.array([x[k] for x in found], pa.int64()) for k in _FIELDS),
                                           pa.array([x["sha"] for x in found], pa.string()), flat("pairs"), flat("times")], schema=schema)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, waiting, held = Aligner(*models()), [], 0

        def flush() -> pa.RecordBatch:
            found = aligner.align([words for _, words in waiting])
            done = [f | {"sha": hashlib.sha256(f["groups"].encode()).hexdigest()} if f["sound"] and f["n_a"] else NONE for f in found]
            return record([row for row, _ in waiting], done)

        for batch in batches:
            for row, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    text = (raw.as_py() or b"").decode()
                except UnicodeDecodeError:
                    text = ""
                if not text:
                    yield record([row], [NONE])
                elif len(text) > STRETCH:
                    yield record([row], [_whole(aligner, aligner.words(text))])
                else:
                    waiting.append((row, aligner.words(text)))
                    held += len(text)
                    if held >= STRETCH or len(waiting) >= 1 << 14:
                        yield flush()
                        waiting, held = [], 0
        if waiting:
            yield flush()

    return of


def alignments(docs: DataFrame, a_json: str, b_model: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` rows by a number: row, n_a, n_b, n_groups, n_links, groups_sha256, pairs (A id << 24 | B id), times."""
    models = shared(docs.sparkSession.sparkContext, (a_json, b_model))
    return docs.select("row", F.col(text_col).cast("binary").alias("text")).mapInArrow(
        _aligned(models), ", ".join(["row bigint", *(f"{k} bigint" for k in _FIELDS), "groups_sha256 string", "pairs array<bigint>", "times array<bigint>"]))


def aligned(docs: DataFrame, a_json: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    # The id rides along as the row's name; rows are told apart by a number that the write fixes.
    named = docs.select(F.col(id_col).alias("row"), F.col(text_col).alias("text"))
    found = stage(alignments(named, a_json, b_model).withColumn("no", F.monotonically_increasing_id()), "aligned")
    held = found.select("no", F.inline(F.arrays_zip("pairs", "times"))).withColumnsRenamed({"pairs": "pair", "times": "k"})
    counts = stage(held.groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    of_a = F.shiftright("pair", _BITS)
    highest = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("top"))
    facts = stage(counts.withColumn("a", of_a).join(highest, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "pair-facts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    common = F.broadcast(facts.filter(F.col("n") * HOT_PAIRS >= total))
    sums = [F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("n_best"), F.sum(F.col("k") * F.col("n")).alias("count_sum")]
    near = held.join(common, "pair").groupBy("no").agg(*sums)
    rest = held.join(common.select("pair"), "pair", "left_anti").join(facts, "pair").groupBy("no").agg(*sums)
    scored = near.unionByName(rest).groupBy("no").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return found.select("no", F.col("row").alias("id"), *_FIELDS, "groups_sha256").join(scored, "no", "left").select(
        "id", *_FIELDS, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")), "groups_sha256")
