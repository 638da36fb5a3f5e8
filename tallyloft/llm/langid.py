"""Language identification by interpolated Kneser-Ney character models, one per language.

Texts are lower-cased; everything but letters and marks becomes one space. Spark counts the n-grams of all learning documents: tasks sum
up their own texts, a shuffle sums up tasks. From the counts of the longest n-grams every lower order follows (Kneser-Ney counts the
different characters before a shorter n-gram), so only these are counted. The n-grams of all languages stand in sorted arrays of 64-bit hashes,
one array per order, beside the log-probabilities of each language; an n-gram that no language has falls back to the next shorter one with
the weights of its context. No n-gram is left out: a model of at most ``max_cells`` probabilities is built on the driver and broadcast, a larger one by
Spark, which writes the arrays in files by hash range to the shared folder; tasks map the files they need into memory.

The language with the lowest cross-entropy per character wins. A document is rejected if that cross-entropy is nearer to what texts of
other languages cost than to what the language's own texts cost, as measured on all learning documents; short texts get more room.

Defined results: NULL texts and texts without a letter are ``und``, score 0, rejected; so is every text if nothing could be
learned. NULL languages and texts are not learned from. Ties go to the first language by code point. Repeated rows count each.
Other columns are neither read nor changed.
"""

from __future__ import annotations

import os
import re
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloft.llm.common import shared
from tallyloft.session import scratch_path, stage

ORDER = 4  # characters of the longest n-gram: four UTF-16 units fill 64 bits
START = 0xFFFF
CHUNK = 1 << 20
SCORED_CELLS = 1 << 22  # probabilities that a task looks up at a time
RANGE_CELLS = 1 << 19  # probabilities in a file of a written model, about
ASTRAL = re.compile("[\U00010000-\U0010ffff]")
UNKNOWN = "und"
GUESS = "lang string, score double, cross_entropy double, rejected boolean"


def letter_table() -> np.ndarray:
    """Units to themselves if they are letters, marks, halves of a surrogate pair or START, else to a space."""
    table = np.full(1 << 16, 32, np.uint16)
    for c in range(1 << 16):
        if unicodedata.category(chr(c))[0] in "LM" or 0xD800 <= c < 0xE000:
            table[c] = c
    table[START] = START
    return table


_TABLE: list[np.ndarray] = []


def units(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The units of all texts, each begun by START three times, and their number by text."""
    if not _TABLE:
        _TABLE.append(letter_table())
    head = np.full(ORDER - 1, START, np.uint16).tobytes()
    parts = []
    for t in texts:
        t = ASTRAL.sub(lambda m: m[0] if m[0].isalpha() else " ", t) if not t.isascii() else t
        parts.append(head + t.lower().encode("utf-16-le", "surrogatepass"))
    all_units = _TABLE[0][np.frombuffer(b"".join(parts), np.uint16)]
    lengths = np.array([len(p) // 2 for p in parts], np.int64)
    space = all_units == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    return all_units[keep], np.add.reduceat(keep, np.cumsum(lengths) - lengths, dtype=np.int64) if len(parts) else lengths


def grams(stream: np.ndarray) -> np.ndarray:
    """For each unit from the fourth on, it and the three before it in one number."""
    u = stream.astype(np.uint64)
    return (u[:-3] << np.uint64(48)) | (u[1:-2] << np.uint64(32)) | (u[2:-1] << np.uint64(16)) | u[3:]


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK characters; a longer text stands alone."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > CHUNK:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def windows(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """n-grams of the texts and the text of each, some CHUNK at a time."""
    stream, lengths = units(texts)
    of = np.repeat(np.arange(len(texts)), lengths)
    for a in range(0, len(stream), CHUNK):
        part = stream[max(0, a - ORDER + 1):a + CHUNK]
        if len(part) >= ORDER:
            real = part[ORDER - 1:] != START
            yield grams(part)[real], of[max(a, ORDER - 1):a + CHUNK][real]


def count(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang``, ``gram``, ``n`` over all texts of all documents with a language."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for lang, own in batch.groupby("lang"):
                texts = list(own["text"])
                for a, b in chunks(texts):
                    for found, _ in windows(texts[a:b]):
                        keys, n = np.unique(found, return_counts=True)
                        if lang in held:
                            keys, of = np.unique(np.concatenate([held[lang][0], keys]), return_inverse=True)
                            n = np.bincount(of, np.concatenate([held[lang][1], n])).astype(np.int64)
                        held[lang] = keys, n
                        if len(keys) > CHUNK:
                            yield pd.DataFrame({"lang": lang, "gram": keys.view(np.int64), "n": n})
                            del held[lang]
        for lang, (keys, n) in held.items():
            yield pd.DataFrame({"lang": lang, "gram": keys.view(np.int64), "n": n})

    known = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    return (known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
            .mapInPandas(sums, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def _mixed(keys: np.ndarray) -> np.ndarray:
    h = keys * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return h * np.uint64(0xD6E8FEB86659FD93)


class HashArray:
    """Sorted hashes with a directory of their first bits."""

    def __init__(self, keys: np.ndarray):
        self.bits = np.uint64(64 - max(1, int(len(keys)).bit_length()))
        hashes = _mixed(keys)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.first = np.searchsorted(self.hashes >> self.bits, np.arange((1 << 64 - int(self.bits)) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        h = _mixed(keys)
        bucket = (h >> self.bits).astype(np.int64)
        at, end = self.first[bucket], self.first[bucket + 1]
        out = np.full(len(h), -1, np.int32)
        todo = np.flatnonzero(at < end)
        h, at, end = h[todo], at[todo], end[todo]
        while len(todo):
            same = self.hashes[at] == h
            out[todo[same]] = at[same]
            on = ~same & (at + 1 < end)
            todo, h, at, end = todo[on], h[on], at[on] + 1, end[on]
        return out


class Model:
    """Log-probabilities of all n-grams by language, and of falling back from all contexts."""

    def __init__(self, langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        """counts: by language, sorted n-grams and their numbers."""
        self.langs = langs
        self.limits: np.ndarray | None = None  # by language: cross-entropy beyond which a text is rejected
        self.room = 0.0  # by the root of the text's length
        if not langs:
            return
        masks = [np.uint64((1 << 16 * k) - 1) for k in range(ORDER + 1)]
        tables = []  # by language and order: n-grams, counts, contexts, their sums, their different next characters, discount
        for keys, n in counts:
            by_order = [None] * (ORDER + 1)
            for k in range(ORDER, 0, -1):
                if k < ORDER:
                    keys, n = np.unique(by_order[k + 1][0] & masks[k], return_counts=True)
                contexts, at, kinds = np.unique(keys >> np.uint64(16), return_index=True, return_counts=True)
                ones, twos = int((n == 1).sum()), int((n == 2).sum())
                discount = min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.05), 0.95)
                by_order[k] = keys, n.astype(np.float64), contexts, np.add.reduceat(n, at).astype(np.float64), kinds, discount
            tables.append(by_order)
        every = [np.unique(np.concatenate([t[k][0] for t in tables])) for k in range(1, ORDER + 1)]
        alphabet = len(every[0]) + 1
        self.floor = -np.log2(alphabet)

        def at(keys: np.ndarray, wanted: np.ndarray, values: np.ndarray) -> np.ndarray:
            i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            return np.where(keys[i] == wanted, values[i], 0.0)

        self.arrays, self.logs, self.context_arrays, self.falls = [None], [None], [None], [None]
        lower = None
        for k in range(1, ORDER + 1):
            keys = every[k - 1]
            contexts = np.unique(keys >> np.uint64(16))
            p, fall = np.zeros((len(keys), len(langs))), np.zeros((len(contexts), len(langs)))
            for j, t in enumerate(tables):
                own, n, heads, sums, kinds, discount = t[k]
                before = 1 / alphabet if k == 1 else lower[np.searchsorted(every[k - 2], keys & masks[k - 1]), j]
                total, types = at(heads, keys >> np.uint64(16), sums), at(heads, keys >> np.uint64(16), kinds)
                safe = np.maximum(total, 1)
                p[:, j] = np.where(total > 0, np.maximum(at(own, keys, n) - discount, 0) / safe + discount * types / safe * before, before)
                total, types = at(heads, contexts, sums), at(heads, contexts, kinds)
                fall[:, j] = np.where(total > 0, discount * types / np.maximum(total, 1), 1.0)
            lower = p
            for arrays, logs, own, values in ((self.arrays, self.logs, keys, p), (self.context_arrays, self.falls, contexts, fall)):
                arrays.append(HashArray(own))
                logs.append(np.log2(values).astype(np.float32)[arrays[-1].order])
        self.masks = masks

    def log_probabilities(self, keys: np.ndarray, k: int = ORDER) -> np.ndarray:
        """Bits (negative) of each n-gram's last character, by language."""
        if not k:
            return np.full((len(keys), len(self.langs)), self.floor, np.float32)
        at = self.arrays[k].find(keys)
        out = self.logs[k][at]
        if len(missing := np.flatnonzero(at < 0)):
            keys = keys[missing]
            context = self.context_arrays[k].find(keys >> np.uint64(16))
            fall = np.where((context >= 0)[:, None], self.falls[k][context], 0)
            out[missing] = fall + self.log_probabilities(keys & self.masks[k - 1], k - 1)
        return out

    def costs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in bits per character by text and language, and the characters."""
        sums, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for a, b in chunks(texts):
            for keys, of in windows(texts[a:b]):
                step = max(1, SCORED_CELLS // len(self.langs))
                for i in range(0, len(of), step):
                    own = of[i:i + step]
                    edges = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                    sums[a + own[edges]] -= np.add.reduceat(self.log_probabilities(keys[i:i + step]), edges, axis=0, dtype=np.float64)
                    n[a + own[edges]] += np.diff(np.append(edges, len(own)))
        return sums / np.maximum(n, 1)[:, None], n

    def guess(self, texts: list[str | None]) -> pd.DataFrame:
        known = [i for i, t in enumerate(texts) if t is not None and self.langs and any(map(str.isalpha, t))]
        out = pd.DataFrame({"lang": UNKNOWN, "score": 0.0, "cross_entropy": None, "rejected": True}, index=range(len(texts)))
        out["cross_entropy"] = out["cross_entropy"].astype("float64")
        if known:
            cost, n = self.costs([texts[i] for i in known])
            best = cost.argmin(axis=1)
            least = cost.min(axis=1)
            odds = np.exp2(-(cost - least[:, None]) * np.minimum(n, 100)[:, None])
            out.loc[known, "lang"] = [self.langs[j] for j in best]
            out.loc[known, "score"] = 1 / odds.sum(axis=1)
            out.loc[known, "cross_entropy"] = least
            limit = np.inf if self.limits is None else self.limits[best] + self.room / np.sqrt(np.maximum(n, 1))
            out.loc[known, "rejected"] = least > limit
        return out


class RangeFiles:
    """Sorted hashes and the rows beside them in files by hash range; looked up like a HashArray and its rows."""

    def __init__(self, bits: int, width: int, files: list[tuple[int, int, str]]):
        """files: range, rows and path of each."""
        self.bits, self.width = bits, width
        files = sorted(files)
        self.paths = [path for _, _, path in files]
        self.starts = np.cumsum([0, *(n for _, n, _ in files)])
        self.file_of = {r: i for i, (r, _, _) in enumerate(files)}

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        hashes, of = np.unique(_mixed(keys), return_inverse=True)
        out = np.full(len(hashes), -1, np.int64)
        parts = _ranges(hashes, self.bits)
        edges = np.flatnonzero(np.diff(parts, prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:]):
            i = self.file_of.get(int(parts[a]))
            if i is not None:
                held = np.load(f"{self.paths[i]}-hashes.npy", mmap_mode="r")
                at = np.minimum(np.searchsorted(held, hashes[a:b]), len(held) - 1)
                out[a:b] = np.where(held[at] == hashes[a:b], self.starts[i] + at, -1)
        return out[of]

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        """The rows at these places; zeros for -1."""
        places, of = np.unique(at, return_inverse=True)
        out = np.zeros((len(places), self.width), np.float32)
        files = np.searchsorted(self.starts, places, "right") - 1
        for i in np.unique(files[places >= 0]):
            own = files == i
            out[own] = np.load(f"{self.paths[i]}-rows.npy", mmap_mode="r")[places[own] - self.starts[i]]
        return out[of]


def _ranges(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


class WrittenModel(Model):
    """The same model in files of the shared folder, built by Spark."""

    def __init__(self, langs: list[str], counts: DataFrame):
        """counts: ``lang``, ``gram``, ``n`` of all n-grams."""
        super().__init__([], [])
        self.langs = langs
        self.masks = [np.uint64((1 << 16 * k) - 1) for k in range(ORDER + 1)]
        number = (F.array_position(F.lit(langs), F.col("lang")) - 1).cast("int")
        cells = {ORDER: counts.select(number.alias("no"), "gram", F.col("n").cast("double").alias("n"))}
        for k in range(ORDER - 1, 0, -1):
            shorter = cells[k + 1].select("no", F.col("gram").bitwiseAND(F.lit((1 << 16 * k) - 1)).alias("gram"))
            cells[k] = stage(shorter.groupBy("no", "gram").agg(F.count("*").cast("double").alias("n")), "language-cells")
        alphabet = cells[1].select("gram").distinct().count() + 1
        self.floor = -np.log2(alphabet)

        index = F.lit(list(range(len(langs))))

        def wide(rows: DataFrame, key: str, *names: str) -> DataFrame:
            """A row per key, with an array by language of each column; 0 where the language has none."""
            def filled(n: str) -> Column:
                return F.transform(index, lambda i: F.coalesce(F.try_element_at(F.col(n), i), F.lit(0.0))).alias(n)

            held = rows.groupBy(key).agg(*(F.map_from_entries(F.collect_list(F.struct("no", n))).alias(n) for n in names))
            return held.select(key, *map(filled, names))

        written, lower = [], None  # table, key, values
        for k in range(1, ORDER + 1):
            sums = {r[0]: (r[1], r[2]) for r in cells[k].groupBy("no").agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).collect()}
            discounts = F.lit([float(min(max(a / (a + 2 * b) if a else 0.5, 0.05), 0.95)) for a, b in (sums[j] for j in range(len(langs)))])
            head = F.shiftrightunsigned("gram", 16).alias("head")
            heads = cells[k].groupBy("no", head).agg(F.sum("n").alias("total"), F.count("*").cast("double").alias("kinds"))
            heads = stage(wide(heads, "head", "total", "kinds"), "language-contexts")
            rows = wide(cells[k], "gram", "n").withColumn("head", F.shiftrightunsigned("gram", 16))
            rows = rows.join(F.broadcast(heads) if k == 1 else heads, "head")  # the shortest n-grams have one context
            if k == 1:
                rows = rows.withColumn("before", F.lit([1 / alphabet] * len(langs)))
            else:
                rows = rows.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << 16 * (k - 1)) - 1))).join(lower, "suffix")
            fallen = lambda i: F.get(discounts, i) * F.get("kinds", i) / F.get("total", i)
            p = F.transform(index, lambda i: F.when(
                F.get("total", i) > 0,
                F.greatest(F.get("n", i) - F.get(discounts, i), F.lit(0.0)) / F.get("total", i) + fallen(i) * F.get("before", i)).otherwise(F.get("before", i)))
            rows = stage(rows.select("gram", p.alias("p")), "language-probabilities")
            lower = rows.select(F.col("gram").alias("suffix"), F.col("p").alias("before"))
            falls = F.transform(index, lambda i: F.when(F.get("total", i) > 0, fallen(i)).otherwise(1.0))
            written.append(rows.select(F.lit(2 * k).alias("no"), F.col("gram").alias("key"), F.col("p").alias("value")))
            written.append(stage(heads.select(F.lit(2 * k + 1).alias("no"), F.col("head").alias("key"), falls.alias("value")), "language-falls"))
        tables = _written(written, len(langs), scratch_path(counts.sparkSession, "language-model"))
        self.arrays = self.logs = [None, *(tables[2 * k] for k in range(1, ORDER + 1))]
        self.context_arrays = self.falls = [None, *(tables[2 * k + 1] for k in range(1, ORDER + 1))]


def _written(tables: list[DataFrame], width: int, folder: str) -> dict[int, RangeFiles]:
    """Files of about RANGE_CELLS logarithms of the rows (no, key, value) of each table, by number."""
    # A path without a scheme is one of the cluster's default file system, which need not be the executors' own.
    spark = tables[0].sparkSession
    named = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    whole = named.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(named).toUri()
    if whole.getScheme() != "file":
        raise RuntimeError(f"a language model of this size needs a spark.checkpoint.dir that all executors have as a path, not {whole}")
    folder = whole.getPath()
    bits = {2 + i: max(0, t.count() * width // RANGE_CELLS).bit_length() for i, t in enumerate(tables)}

    @F.pandas_udf("bigint")
    def ranges(keys: pd.Series, of: pd.Series) -> pd.Series:
        hashes = _mixed(keys.to_numpy(np.int64).view(np.uint64))
        return pd.Series((hashes >> np.uint64(1)).astype(np.int64) >> (63 - of.to_numpy(np.int64)))

    def write(own: pd.DataFrame) -> pd.DataFrame:
        os.makedirs(folder, exist_ok=True)
        path = f"{folder}/{uuid.uuid4().hex}"  # an attempt's own; only those of finished tasks are named in the model
        hashes = _mixed(own["key"].to_numpy(np.int64).view(np.uint64))
        order = np.argsort(hashes)
        np.save(f"{path}-hashes.npy", hashes[order])
        np.save(f"{path}-rows.npy", np.log2(np.stack(own["value"].to_numpy())[order]).astype(np.float32))
        return pd.DataFrame({"no": own["no"].iloc[:1], "range": own["range"].iloc[:1], "n": len(own), "path": path})

    found: dict[int, list] = {no: [] for no in bits}
    for no, table in zip(bits, tables):
        dealt = table.withColumn("range", ranges("key", F.lit(bits[no])))
        for r in dealt.groupBy("no", "range").applyInPandas(write, "no int, range long, n long, path string").collect():
            found[no].append((r["range"], r["n"], r["path"]))
    return {no: RangeFiles(bits[no], width, files) for no, files in found.items()}


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_cells: int = 8_000_000) -> Model:
    """Count all documents that have a language, build the models of all their n-grams, calibrate on the same documents.

    ``max_cells`` bounds what the driver builds and broadcasts; larger models are built and written by Spark.
    """
    counts = stage(count(docs, text_col, lang_col), "language-grams")
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    if counts.count() * len(langs) > max_cells:
        model = WrittenModel(langs, counts)
    else:
        rows = counts.toPandas()
        rows = rows.assign(gram=rows["gram"].to_numpy().view(np.uint64)).sort_values("gram")
        own = [rows[rows["lang"] == x] for x in langs]
        model = Model(langs, [(r["gram"].to_numpy(), r["n"].to_numpy()) for r in own])
    if langs:
        _calibrate(model, docs, text_col, lang_col)
    return model


def _calibrate(model: Model, docs: DataFrame, text_col: str, lang_col: str) -> None:
    held = shared(docs.sparkSession.sparkContext, model)

    def cost(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        langs = held().langs
        for batch in batches:
            bits, n = held().costs(list(batch["text"]))
            for own, rows in batch.assign(at=range(len(batch)))[n >= 20].groupby("lang"):
                yield pd.DataFrame({"own": own, "by": langs, "bits": bits[rows["at"].to_numpy()].sum(axis=0), "n": len(rows)})

    known = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    seen = (known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
            .mapInPandas(cost, "own string, by string, bits double, n long").groupBy("own", "by")
            .agg((F.sum("bits") / F.sum("n")).alias("bits")).toPandas())
    seen["own_bits"] = seen["own"] == seen["by"]
    limits = []
    for lang in model.langs:
        by = seen[seen["by"] == lang]
        own = by[by["own_bits"]]["bits"].mean()
        other = by[~by["own_bits"]]["bits"].min()
        if np.isnan(own):
            limits.append(np.inf)
        else:
            limits.append(own + 0.75 * ((-model.floor if np.isnan(other) else other) - own))
    model.limits = np.array(limits)
    model.room = 4 * 2.5  # four times the spread of one character's bits, about 2.5 in any alphabet


def guess(model: Model, docs: DataFrame, text: Column) -> Column:
    """A struct column (GUESS): language, its share of the likelihood, cross-entropy, whether it is rejected."""
    held = shared(docs.sparkSession.sparkContext, model)

    @F.pandas_udf(GUESS)
    def of(texts: pd.Series) -> pd.DataFrame:
        return held().guess([None if t is None else t for t in texts])

    return of(text)


def identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    return docs.withColumn("__guess", guess(model, docs, F.col(text_col))).filter(~F.col("__guess.rejected")).drop("__guess")
