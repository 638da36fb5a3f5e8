"""Embedding near-duplicates: an inverted multi-index proposes pairs of vectors, their exact cosine decides.

Unit vectors are cut in two halves, and each half has a codebook of its own, so that k + k centroids span a grid of k * k cells. Every
vector is listed in the cell of its two nearest centroids. As a query it visits cells in the order of the two halves' summed
distances: for each half and centroid the squared distance to the wall between the nearest cell and that one is a lower bound of
how far a point behind the wall must be, and the sum over both halves bounds the distance of any vector in a cell. The traversal ends
where that sum passes the stop. With ``target_recall`` 1 the stop is the squared distance of two vectors at the least cosine, which
no linked pair can exceed. Below 1 it is calibrated: neighbours at exactly the least cosine are drawn in random directions around the
sampled vectors, and the stop reaches that share of them (pairs at a higher cosine are nearer, so more of them are reached).
Each pair is met once, from the vector in the lower cell.

Only codebooks and stop are fitted on a sample, of ``SAMPLE`` vectors a centroid (at most ``SAMPLE * MOST_CENTROIDS``), drawn by hash.
All vectors are listed and all query. Equal vectors are one node from the start, which carries their number. A cell is verified in blocks
of some ``BLOCK`` vectors, a group per pair of blocks, so a crowded cell spreads over tasks; a group returns a count per vector and a
star per connected part of its links, never its pairs.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components, and rows with a NULL label, link with nothing.
Vectors of different length do not link. Rows are vectors: repeated rows link with each other, and a component's id is its smallest
non-NULL id. ``kept`` marks the rows whose id is the component's (NULL ids only where all are). Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloft.llm.common import HOT_SHARE, attach, sampled, shared
from tallyloft.llm.components import components
from tallyloft.session import stage

CELL = 128  # vectors of one label in a cell, on average
BLOCK = 512
SAMPLE = 32  # vectors a centroid
MOST_CENTROIDS = 2048  # a half
DRAWS = 8  # neighbours drawn around each sampled vector
_ROUNDS = 12
_CHUNK = 1024


def unit_rows(raws: pd.Series, width: int) -> np.ndarray:
    """Rows of doubles, filled up with zeros."""
    rows = np.zeros((len(raws), width))
    for i, raw in enumerate(raws):
        own = np.frombuffer(raw, np.float64)
        rows[i, :len(own)] = own
    return rows


def unit_bytes(vector: np.ndarray) -> bytes:
    own = np.asarray(vector, np.float64)
    own = own / np.abs(own).max()  # so that squares stay finite
    return (own / np.sqrt(own @ own)).tobytes()


def packed(vector: Column) -> Column:
    @F.pandas_udf("binary")
    def of(vectors: pd.Series) -> pd.Series:
        return pd.Series([unit_bytes(v) for v in vectors], dtype=object)

    return of(vector)


def _squared(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((rows ** 2).sum(1)[:, None] - 2 * rows @ centroids.T + (centroids ** 2).sum(1), 0)


def _nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.concatenate([_squared(rows[i:i + _CHUNK], centroids).argmin(1) for i in range(0, len(rows), _CHUNK)])


def _codebook(rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    rows = np.unique(rows, axis=0)
    centroids = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(_ROUNDS):
        at = _nearest(rows, centroids)
        n = np.bincount(at, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, rows)
        centroids[n > 0] = sums[n > 0] / n[n > 0, None]
    return centroids


@dataclass
class MultiIndex:
    books: tuple[np.ndarray, np.ndarray]
    width: int
    stop: float
    least_cosine: float

    def halves(self, rows: np.ndarray) -> list[np.ndarray]:
        cut = self.width - self.width // 2
        return [rows[:, :cut], rows[:, cut:]]

    def walls(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half: the nearest centroid of each row, and the squared distances to the walls of the other centroids' cells."""
        found = []
        for half, book in zip(self.halves(rows), self.books):
            far = _squared(half, book)
            near = far.argmin(1)
            apart = np.sqrt(_squared(book, book))[near]
            gap = (far - far[np.arange(len(far)), near][:, None]) / np.maximum(2 * apart, 1e-300)
            gap[np.arange(len(far)), near] = 0
            found.append((near, np.square(np.maximum(gap, 0))))
        return found

    def visits(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, cell, own) in arrays: the own cell of each row and the higher cells that it visits.

        One step a rank of the first half's sorted walls; there the second half is walked as far as the stop allows. These are
        the cells that a heap over both sorted lists pops before their sum passes the stop.
        """
        (near1, wall1), (near2, wall2) = self.walls(rows)
        wide = len(self.books[1])
        own = near1 * wide + near2
        yield np.arange(len(rows)), own, np.ones(len(rows), bool)
        order1, order2 = wall1.argsort(1, kind="stable"), wall2.argsort(1, kind="stable")
        sorted1, sorted2 = np.take_along_axis(wall1, order1, 1), np.take_along_axis(wall2, order2, 1)
        left = np.arange(len(rows))
        for rank in range(wall1.shape[1]):
            left = left[sorted1[left, rank] <= self.stop]
            if not len(left):
                return
            reach = sorted2[left] <= (self.stop - sorted1[left, rank])[:, None]
            at, second = np.nonzero(reach)
            row = left[at]
            cell = order1[row, rank] * wide + order2[row, second]
            higher = cell > own[row]
            yield row[higher], cell[higher], np.zeros(int(higher.sum()), bool)


def fit(rows: np.ndarray, k: int, least_cosine: float, target_recall: float) -> MultiIndex:
    """Codebooks of ``k`` centroids and the stop of the traversal, from unit ``rows``."""
    rng = np.random.default_rng(7)
    width = rows.shape[1]
    furthest = max(0.0, 2 - 2 * least_cosine) * (1 + 1e-9) + 1e-12
    index = MultiIndex((np.zeros((1, 0)), np.zeros((1, 0))), width, furthest, least_cosine)
    index.books = tuple(_codebook(half, k, rng) for half in index.halves(rows))
    if target_recall < 1 and width > 1:
        needed = []
        for _ in range(DRAWS):
            aside = rng.standard_normal(rows.shape)
            aside -= (aside * rows).sum(1)[:, None] * rows
            aside /= np.maximum(np.sqrt((aside ** 2).sum(1)), 1e-300)[:, None]
            other = least_cosine * rows + math.sqrt(max(0.0, 1 - least_cosine ** 2)) * aside
            cells = [_nearest(half, book) for half, book in zip(index.halves(other), index.books)]
            for i in range(0, len(rows), _CHUNK):
                walls = [w for _, w in index.walls(rows[i:i + _CHUNK])]
                needed.append(sum(w[np.arange(len(w)), c[i:i + _CHUNK]] for w, c in zip(walls, cells)))
        index.stop = min(furthest, float(np.quantile(np.concatenate(needed), target_recall, method="higher")))
    return index


def linked(left: np.ndarray, right: np.ndarray, within: bool, least_cosine: float) -> np.ndarray:
    """Which of the rows link: left with right, and, if ``within``, left with left as well. A square over left + right."""
    rows = np.concatenate([left, right])
    n, found = len(left), np.zeros((len(rows), len(rows)), bool)
    for i in range(0, n, _CHUNK):
        found[i:min(i + _CHUNK, n)] = left[i:i + _CHUNK] @ rows.T >= least_cosine
    if not within:
        found[:n, :n] = False
    np.fill_diagonal(found, False)
    found[n:, :n] = found[:n, n:].T
    return found


def stars(found: np.ndarray) -> np.ndarray:
    """The first row of the connected part that each row is in."""
    root = np.full(len(found), -1)
    for start in range(len(found)):
        if root[start] >= 0:
            continue
        root[start], front = start, np.array([start])
        while len(front):
            front = np.flatnonzero(found[front].any(0) & (root < 0))
            root[front] = start
    return root


def _lister(index: Callable[[], MultiIndex]) -> Callable:
    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        multi = index()
        for frame in frames:
            for i in range(0, len(frame), _CHUNK):
                part = frame.iloc[i:i + _CHUNK]
                rows = unit_rows(part["unit"], multi.width)
                for row, cell, own in multi.visits(rows):
                    yield part.iloc[row].assign(cell=cell, own=own)

    return listed


def _verifier(width: int, least_cosine: float) -> Callable:
    def verified(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node", kind="stable")
        left, right = frame[frame["is_left"]], frame[~frame["is_left"]]
        found = linked(unit_rows(left["unit"], width), unit_rows(right["unit"], width), key[2] == key[3], least_cosine)
        has = found.any(1)
        found = found[np.ix_(has, has)]
        node, n = (np.concatenate([left[c], right[c]])[has] for c in ("node", "n"))
        return pd.DataFrame({"node": node, "links": found @ n.astype(np.int64), "star": node[stars(found)]})

    return verified


def near_duplicates(vectors: DataFrame, least_cosine: float = 0.98, target_recall: float = 0.9999, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label", block: int = BLOCK) -> DataFrame:
    """A row per vector: id, n_links, component_id, kept."""
    component = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf)
    vector = F.col(vector_col).cast("array<double>")
    sound = F.coalesce(F.col(label_col).isNotNull() & F.forall(vector, component) & F.exists(vector, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("id"), F.when(sound, F.struct(
        F.col(label_col).cast("string").alias("label"), vector.alias("vector"))).alias("v"))
    rows = stage(rows, "vectors")
    nodes = rows.filter("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
    # A number per node, fixed by the write; the length of a vector is part of what must be equal.
    nodes = stage(nodes.select(F.monotonically_increasing_id().alias("node"), "v", "first_id", "n", packed(F.col("v.vector")).alias("unit"),
                               F.concat(F.size("v.vector"), F.lit(":"), "v.label").alias("kind")), "vector-nodes")
    sums, spread = _links(nodes.select("node", "kind", "unit", "n"), least_cosine, target_recall, block)
    roots = components(spread, "vector-links")
    rooted = nodes.select("node", "v", "first_id", "n").join(roots, "node", "left").join(sums, "node", "left").select(
        "node", "v", "first_id", "n", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    rooted = stage(rooted, "vector-components")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    total = rooted.agg(F.sum("n")).first()[0] or 0
    # A root's row is hot like a vector's: a component may hold a third of all nodes.
    crowds = rooted.groupBy("root").agg(F.count("*").alias("k")).filter(F.col("k") * HOT_SHARE >= total)
    facts = attach(rooted, named, "root", crowds).select("v", "n", "component_id", (F.col("links") + F.col("n") - 1).alias("n_links"))
    facts = stage(facts, "vector-facts")
    found = attach(rows.filter("v IS NOT NULL"), facts.select("v", "component_id", "n_links"), "v", facts.filter(F.col("n") * HOT_SHARE >= total))
    alone = rows.filter("v IS NULL").select("id", F.col("id").alias("component_id"), F.lit(0).cast("bigint").alias("n_links"))
    return found.select("id", "component_id", "n_links").unionByName(alone).select(
        "id", "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _links(nodes: DataFrame, least_cosine: float, target_recall: float, block: int) -> tuple[DataFrame, DataFrame]:
    """Per node the number of vectors in other nodes that it links with; and links a, b that join the same nodes."""
    spark = nodes.sparkSession
    # The size of a vector's label, on average over the vectors.
    sizes = nodes.groupBy("kind").agg(F.count("*").cast("double").alias("k")).agg(F.sum("k"), F.sum(F.col("k") * F.col("k"))).first()
    crowd = sizes[1] / sizes[0] if sizes[0] else 0
    k = int(min(max(1, round(math.sqrt(crowd / CELL))), MOST_CENTROIDS))
    width = (nodes.agg(F.max(F.octet_length("unit"))).first()[0] or 8) // 8
    drawn = sampled(nodes.select("unit"), F.xxhash64("unit"), SAMPLE * max(k, 16)).toPandas()["unit"] if sizes[0] else []
    index = fit(unit_rows(drawn, width) if len(drawn) else np.eye(1, width), k, least_cosine, target_recall)
    listed = nodes.mapInPandas(_lister(shared(spark.sparkContext, index)), "node bigint, kind string, unit binary, n bigint, cell bigint, own boolean")
    listed = stage(listed.select(F.struct("kind", "cell").alias("at"), "own", "node", "n", "unit"), "vector-cells")
    cells = listed.groupBy("at").agg(F.count_if("own").alias("members"), F.count_if(~F.col("own")).alias("guests"))
    blocks = lambda c: F.ceil(F.col(c) / block).cast("int")
    cells = stage(cells.filter("members > 0 AND members + guests > 1").select(
        "at", "members", "guests", blocks("members").alias("m"), blocks("guests").alias("g")), "vector-crowds")
    hot = cells.filter((F.col("members") + F.col("guests")) * HOT_SHARE >= listed.count())
    placed = attach(listed, cells.select("at", "m", "g"), "at", hot)
    # Groups are (l, r): block l of the members against block r of members (r < m) or block r - m of the guests. A cell of one
    # block has its first guests in its group (0, 0).
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("own"), F.col("m")).otherwise(F.col("g"))).cast("int")
    first = F.when(F.col("m") == 1, 0).otherwise(F.col("m"))
    last = F.greatest(first + F.col("g"), F.lit(1)) - 1
    pair = lambda a, b, is_left: F.struct(a.alias("l"), b.alias("r"), F.lit(is_left).alias("is_left"))
    to = F.when(F.col("own"), F.concat(
        F.transform(F.sequence("mine", last), lambda r: pair(F.col("mine"), r, True)),
        F.transform(F.slice(F.sequence(F.lit(0), "mine"), 1, F.col("mine")), lambda b: pair(b, F.col("mine"), False))))
    to = to.otherwise(F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda b: pair(b, first + F.col("mine"), False)))
    dealt = placed.withColumn("mine", mine).select("at.kind", "at.cell", "node", "n", "unit", F.explode(to).alias("to"))
    dealt = dealt.select("kind", "cell", "to.l", "to.r", "to.is_left", "node", "n", "unit")
    found = dealt.groupBy("kind", "cell", "l", "r").applyInPandas(_verifier(width, least_cosine), "node bigint, links bigint, star bigint")
    found = stage(found, "vector-found")
    return found.groupBy("node").agg(F.sum("links").alias("links")), found.select(F.col("node").alias("a"), F.col("star").alias("b"))
