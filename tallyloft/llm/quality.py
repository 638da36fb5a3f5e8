"""Quality grades by ordinal cumulative-link regression on hashed text.

One weight vector over hashed tokens gives a document one number; ordered thresholds cut the line into grades:
P(grade <= k) = logistic(threshold_k - weights . features). The grades share the weights, so few labels suffice, and the order of
the thresholds holds by construction (the first and logarithms of the gaps are what is fitted). The expected grade and the probability of a
grade or better serve to select.

Tokens are runs of letters and digits and runs of other signs, in lower case; the first four letters of longer words, the share of capitals
and the length's order of magnitude count as tokens. A feature is whether its token occurs. Most words say nothing about a grade, so the
fit carries a penalty on absolute weights, which leaves few of them.

The features of at most ``sample`` graded documents, those with the smallest hashes, are gathered on the driver and fitted there by full
gradients; all documents are scored, whole texts, where they are.

Defined results: a NULL or blank text has no features but its length and is graded all the same. Documents without a grade are not
learned from. With no grades at all the expected grade is NULL, with one it is this grade. Repeated rows are graded each; other columns stay.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloft.llm.common import sampled, shared

BITS = 20
SAMPLE = 8192
ROUNDS = 200
# Picked among 0.5, 0.65, 0.75, 0.85 and 0.9 on labels outside the fit, so the shares measured there flatter it.
KEEP_PROBABILITY = 0.65
LEAST_DOCUMENTS = 5  # a feature of fewer graded documents is left out
TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
_BLOCK = 1 << 20  # characters tokenised at a time


class Hashes(dict):
    """Hash of a token, remembered."""

    def __missing__(self, token: str) -> int:
        if len(self) > 1 << 18:
            self.clear()
        self[token] = code = zlib.crc32(token.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)
        return code


_KNOWN = Hashes()


def features(text: str | None, known: Hashes) -> list[int]:
    """The text's features, each once."""
    text = text or ""
    found: set[int] = set()
    upper = tokens = start = 0
    while start < len(text):
        end = start + _BLOCK
        while end < len(text) and not text[end].isspace():
            end += 1
        own = TOKEN.findall(text[start:end])
        tokens += len(own)
        upper += sum(map(str.isupper, own))
        words = {w.lower() for w in own}
        found.update([known[w] for w in words], [known["^" + w[:4]] for w in words if len(w) > 4])
        start = end
    found.add(known[f" length {len(text).bit_length()}"])
    if upper * 4 > tokens:
        found.add(known[" capitals"])
    return sorted(found)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Grader:
    """Weights and thresholds; ``grades`` are the graded values in order."""

    def __init__(self, grades: list[int], weights: np.ndarray, thresholds: np.ndarray):
        self.grades, self.weights, self.thresholds = grades, weights.astype(np.float32), thresholds

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        line = np.array([self.weights[features(t, _KNOWN)].sum(dtype=np.float64) for t in texts])
        below = _logistic(self.thresholds[None, :] - line[:, None])
        return np.diff(np.concatenate([np.zeros((len(line), 1)), below, np.ones((len(line), 1))], axis=1), axis=1)


def _slopes(line: np.ndarray, level: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the loss, by document: towards its upper threshold and from its lower one."""
    upper, lower = _logistic(np.append(cuts, 40.0)[level] - line), _logistic(np.append(-40.0, cuts)[level] - line)
    p = np.maximum(upper - lower, 1e-9)
    return upper * (1 - upper) / p, lower * (1 - lower) / p


def fit(sizes: np.ndarray, columns: np.ndarray, grade: np.ndarray, rounds: int = ROUNDS) -> Grader:
    """Maximum likelihood with the penalty, by proximal steps of per-weight size.

    ``columns`` holds the features of all documents one after the other, ``sizes`` how many each has.
    """
    grades, weights = sorted(set(grade.tolist())), np.zeros(1 << BITS)
    if len(grades) < 2:
        return Grader(grades, weights, np.zeros(0))
    level, n = np.searchsorted(grades, grade), len(grade)
    penalty = 0.1 / np.sqrt(n)
    rows = np.repeat(np.arange(n, dtype=np.int32), sizes)
    share = np.cumsum(np.bincount(level, minlength=len(grades)))[:-1] / n
    cuts = np.log(share / (1 - share))
    shape = np.append(cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3)))
    # Features whose slope is far below the penalty before any weight is set stay without one.
    up, low = _slopes(np.zeros(n), level, cuts)
    kept = (np.bincount(columns, minlength=1 << BITS) >= LEAST_DOCUMENTS) & (
        np.abs(np.bincount(columns, (up - low)[rows], 1 << BITS)) / n >= penalty / 2)
    rows, columns = rows[kept[columns]], columns[kept[columns]]
    # Twice: to find the features, then with a twentieth of the penalty to find the weights of these.
    for part in (1.0, 0.05):
        used, columns = np.unique(columns, return_inverse=True)
        w, squares = np.zeros(len(used)), np.zeros(len(used))
        first, second = np.zeros(len(shape)), np.zeros(len(shape))
        for t in range(1, rounds + 1):
            cuts = np.cumsum(np.append(shape[:1], np.exp(shape[1:])))
            up, low = _slopes(np.bincount(rows, w[columns], n), level, cuts)
            slope = np.bincount(columns, (up - low)[rows], len(used)) / n
            squares += slope ** 2
            step = 0.5 / np.sqrt(squares + 1e-8)
            w = w - step * slope
            w = np.sign(w) * np.maximum(np.abs(w) - step * penalty * part, 0)
            by_cut = np.array([low[level == k + 1].sum() - up[level == k].sum() for k in range(len(cuts))]) / n
            by_shape = np.cumsum(by_cut[::-1])[::-1] * np.append(1.0, np.exp(shape[1:]))
            first += 0.1 * (by_shape - first)
            second += 0.01 * (by_shape ** 2 - second)
            shape = shape - 0.05 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
        rows, columns = rows[w[columns] != 0], used[columns[w[columns] != 0]]
    weights[used] = w
    return Grader(grades, weights, np.cumsum(np.append(shape[:1], np.exp(shape[1:]))))


def learn(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade",
          sample: int = SAMPLE) -> Grader:
    """Fit on at most ``sample`` documents of ``docs`` that have a row in ``grades`` (id, grade)."""
    @F.pandas_udf("array<int>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t, _KNOWN) for t in texts])

    known = grades.filter(F.col(grade_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("grade"))
    some = sampled(known, F.xxhash64("id", "grade"), sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(some), "id")  # ``some`` has ``sample`` rows at most
    some = sampled(rows, F.xxhash64("id", "grade", "text"), sample).select("id", "grade", of("text").alias("found"))
    got = some.orderBy("id", "grade", F.xxhash64("found")).drop("id").toArrow().combine_chunks()
    found = got["found"].combine_chunks()
    return fit(np.diff(found.offsets.to_numpy()), found.flatten().to_numpy(), got["grade"].to_numpy())


def graded(grader: Grader, docs: DataFrame, text: Column) -> Column:
    """A struct column: expected_grade, and p_<grade> the probability of each grade."""
    held = shared(docs.sparkSession.sparkContext, grader)
    grades = grader.grades
    names = ["expected_grade", *(f"p_{g}" for g in grades)]

    @F.pandas_udf(", ".join(f"`{n}` double" for n in names))
    def of(texts: pd.Series) -> pd.DataFrame:
        p = held().probabilities(list(texts))[:, :len(grades)]
        expected = p @ np.array(grades, float) if grades else np.full(len(texts), np.nan)
        return pd.DataFrame(np.column_stack([expected, p]), columns=names)

    return of(text)


def tail(grade: Column, grader: Grader, least: int) -> Column:
    """The probability of ``least`` or a better grade; 1 where no grade is known."""
    if not grader.grades:
        return F.lit(1.0)
    return sum((grade[f"p_{g}"] for g in grader.grades if g >= least), F.lit(0.0))


def selected(docs: DataFrame, grader: Grader, least: int = 1, probability: float = KEEP_PROBABILITY, text_col: str = "text") -> DataFrame:
    """Documents that have ``least`` or a better grade with the given probability, with all their columns."""
    scored = docs.withColumn("__grade", graded(grader, docs, F.col(text_col)))
    return scored.filter(tail(F.col("__grade"), grader, least) >= probability).drop("__grade")
