"""Hard negatives by an inverted multi-index over whole-number vectors.

Vectors are cut into two halves; a codebook for each half is fitted on a bounded sample
(``SAMPLE`` rows) and every row is indexed in the cell of its two nearest codewords. For an
anchor, a half's codewords have score bounds: inner product with the codeword plus the
anchor's length times the codeword's radius, the largest distance of a row to it over the
whole table. A cell's bound is the sum of its halves', so a heap over the two sorted lists
yields the cells from the highest bound down (multi-sequence), without listing them all.

Two searches use it: an anchor's best rows of its own label (positives), then for each
positive the best rows of other labels whose score lies in a window relative to the
positive's. Either stops at the first cell whose bound lies below what is certain: the k-th
best score so far, of all windows the least, or the lower end of the window. Scores are
whole numbers, so the result is exact, ties included.

Cells live on the cluster, so a search runs in waves: an anchor takes cells from its heap
that hold ``FIRST_ROWS`` rows, then ``GROWTH`` times as many and so on, and leaves as soon as
it is certain. Cells are dealt by hash into shards of about ``SHARD_ROWS`` rows, a full cell
into several; a shard asked by many anchors deals these into parts. An anchor is sent once
to a shard, with its cells there.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take
no part. Components are floored after scaling, into 64 bits; scores beyond 64 bits count as
the nearest number in them. Rows equal in id, label and floored vector are one row; other rows that
share an id are rows of their own, each with its negatives, but never one another's
positives or negatives. Vectors of different lengths are not compared. A window around a negative score is
empty. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstar.llm.common import splits, stored, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score
SAMPLE = 16_384
CELL_ROWS = 256
SHARD_ROWS = 8192
PART_VISITS = 2048
MOST_WORDS = 256  # of a half: the sizes of cells go to every task
FIRST_ROWS, GROWTH = 2048, 8
KMEANS_ROUNDS = 12
SEED = 23
_MOST = 1 << 63

_ROWS = "id long, label long, v array<long>, row long"
_CELLED = _ROWS + ", length int, a int, b int"
_ASKED = "row long, id long, label long, v array<long>, done int, low array<long>, high array<long>, sure long"


def numbers(rows: DataFrame, id_col: str, label: Column, vector_col: str, scale: int = SCALE) -> DataFrame:
    """id, label, floored vector and a key ``row`` of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    picked = rows.where(F.col(id_col).isNotNull() & label.isNotNull() & F.coalesce(whole, F.lit(False)))
    floored = F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    named = picked.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), floored.alias("v"))
    return named.withColumn("row", F.xxhash64(F.lit(SEED), "id", "label", "v"))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact; beyond 64 bits the nearest number in them."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    largest = float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * a.shape[1]
    if largest < 2**52:  # doubles hold every partial sum
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if largest < 2**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -_MOST, _MOST - 1).astype(np.int64)


def codewords(points: np.ndarray, k: int) -> np.ndarray:
    """Centres of at most k groups of points: seeded choice, then rounds of k-means."""
    if not points.shape[1]:
        return np.zeros((1, 0))
    points = np.unique(points, axis=0)
    rng = np.random.default_rng(SEED)
    centres = points[np.sort(rng.choice(len(points), min(k, len(points)), replace=False))]
    for _ in range(KMEANS_ROUNDS):
        at = nearest_word(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, points)
        n = np.bincount(at, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest_word(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


@dataclass
class Books:
    """Codebooks of the two halves of vectors of one length, with the radius of each codeword."""

    words: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]

    @classmethod
    def of(cls, sample: np.ndarray, k: int) -> Books:
        half = sample.shape[1] // 2
        words = tuple(codewords(part, k) for part in (sample[:, :half], sample[:, half:]))
        return cls(words, tuple(np.zeros(len(w)) for w in words))

    def cells(self, v: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half: the nearest codeword of every vector, and its distance."""
        half, out = v.shape[1] // 2, []
        for part, words in zip((v[:, :half], v[:, half:]), self.words, strict=True):
            at = nearest_word(part, words)
            out.append((at, np.sqrt(((part - words[at]) ** 2).sum(axis=1))))
        return out

    def bounds(self, v: np.ndarray) -> list[np.ndarray]:
        """For each half: what the score with any row of a codeword cannot exceed."""
        half, out = len(v) // 2, []
        for part, words, radii in zip((v[:half], v[half:]), self.words, self.radii, strict=True):
            inner, length = words @ part, float(np.sqrt(part @ part))
            # a little more, for the rounding of doubles
            out.append((inner + length * radii) + 1e-9 * (np.abs(inner) + length * radii) + 1e-3)
        return out


def cells_in_order(bounds: list[np.ndarray]) -> Iterator[tuple[float, int, int]]:
    """(bound, a, b) of all cells from the highest bound down: a heap over two sorted lists."""
    first, second = (np.argsort(-b, kind="stable") for b in bounds)
    high, low = bounds[0][first], bounds[1][second]
    heap = [(-(high[0] + low[0]), 0, 0)] if len(first) and len(second) else []
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(first[i]), int(second[j])
        # a cell enters through its neighbour in the first list, or along the first row
        if i + 1 < len(first):
            heapq.heappush(heap, (-(high[i + 1] + low[j]), i + 1, j))
        if i == 0 and j + 1 < len(second):
            heapq.heappush(heap, (-(high[0] + low[j + 1]), 0, j + 1))


@dataclass
class Cells:
    """Codebooks by vector length, and the sizes of the cells that hold rows."""

    books: dict[int, Books]
    sizes: dict[int, dict[tuple[int, int], int]]
    n_shards: int = 1

    def book(self, length: int) -> Books:
        """A length the sample does not hold has one codeword, the zero vector."""
        if length not in self.books:
            halves = tuple(np.zeros((1, m)) for m in (length // 2, length - length // 2))
            self.books[length] = Books(halves, (np.zeros(1), np.zeros(1)))
        return self.books[length]

    def pieces(self, length: int, a: int, b: int) -> int:
        """A cell is one piece; a full cell has several."""
        return splits(self.sizes[length].get((a, b), 0), SHARD_ROWS)

    def shard(self, length: int, a: int, b: int, piece: int) -> int:
        return hash((length, a, b, piece)) % self.n_shards


class MultiIndex:
    """The rows in cells, and their codebooks."""

    def __init__(self, rows: DataFrame, sample: int = SAMPLE, cell_rows: int = CELL_ROWS):
        self.spark = rows.sparkSession
        rows = stored(rows, "negatives-rows")
        n = rows.count()
        place = F.pmod(F.xxhash64(F.lit(SEED), "row"), F.lit(1 << 30))
        share = min(1.0, sample / max(1, n))
        by_length: dict[int, list] = {}
        for r in rows.where(place < int(share * (1 << 30))).select("v").toLocalIterator():
            by_length.setdefault(len(r.v), []).append(r.v)
        self.cells = Cells({}, {}, splits(n, SHARD_ROWS))
        for length, vectors in by_length.items():
            own = np.array(sorted(vectors), dtype=float).reshape(len(vectors), length)
            k = max(1, round((len(own) / share / cell_rows) ** 0.5))
            self.cells.books[length] = Books.of(own, min(k, MOST_WORDS, max(1, len(own) // 8)))
        self.rows = stored(self._celled(rows), "negatives-cells")
        for part, column in enumerate(("a", "b")):
            # one row per codeword
            for r in self.rows.groupBy("length", column).agg(F.max(f"far_{column}").alias("far")).toLocalIterator():
                self.cells.book(r.length).radii[part][r[column]] = r.far
        for r in self.rows.groupBy("length", "a", "b").count().toLocalIterator():
            self.cells.sizes.setdefault(r.length, {})[r.a, r.b] = r["count"]

    def _celled(self, rows: DataFrame) -> DataFrame:
        cells = self.cells

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = batch.column(2).to_pylist()
                lengths = np.array([len(v) for v in vectors], dtype=np.int32)
                a, b = np.zeros((2, len(vectors)), dtype=np.int32)
                far = np.zeros((2, len(vectors)))
                for length in np.unique(lengths):
                    own = np.flatnonzero(lengths == length)
                    v = np.array([vectors[i] for i in own], dtype=float).reshape(len(own), length)
                    (a[own], far[0, own]), (b[own], far[1, own]) = cells.book(int(length)).cells(v)
                extra = [pa.array(lengths), pa.array(a), pa.array(b), pa.array(far[0]), pa.array(far[1])]
                names = [*batch.schema.names, "length", "a", "b", "far_a", "far_b"]
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=names)

        return rows.mapInArrow(run, _CELLED + ", far_a double, far_b double")

    def sharded(self) -> DataFrame:
        """The rows with the shard and piece of each."""
        cells = self.cells

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = batch.select(["row", "length", "a", "b"]).to_pydict()
                out = []
                for row, length, a, b in zip(*rows.values(), strict=True):
                    out.append(cells.shard(length, a, b, row % cells.pieces(length, a, b)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], names=[*batch.schema.names, "shard"])

        return self.rows.select(*[c.split()[0] for c in _CELLED.split(", ")]).mapInArrow(run, _CELLED + ", shard int")

    def visits(self, asked: DataFrame, n_rows: int) -> DataFrame:
        """The next cells of each anchor, by shard, until they hold ``n_rows`` rows or it is certain.

        An anchor yields one row without a shard as well, with the number of cells it has
        taken and whether the next one lies below ``sure``.
        """
        cells = self.cells

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: list[tuple] = []
                for r in batch.to_pylist():
                    length, taken, held, own, closed = len(r["v"]), 0, 0, {}, True
                    for bound, a, b in cells_in_order(cells.book(length).bounds(np.array(r["v"], dtype=float))):
                        if bound < r["sure"]:
                            break
                        if held >= n_rows:
                            closed = False
                            break
                        taken += 1
                        if taken > r["done"] and (a, b) in cells.sizes.get(length, {}):
                            held += cells.sizes[length][a, b]
                            for piece in range(cells.pieces(length, a, b)):
                                own.setdefault(cells.shard(length, a, b, piece), []).append((a << 32) | b)
                    base = (r["row"], r["id"], r["label"], r["v"], taken, r["low"], r["high"], r["sure"])
                    out += [(*base, s, sorted(set(c)), None) for s, c in own.items()] + [(*base, None, None, closed)]
                columns = list(zip(*out, strict=True)) or [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        longs = pa.list_(pa.int64())
        types = [pa.int64(), pa.int64(), pa.int64(), longs, pa.int32(), longs, longs, pa.int64(), pa.int32(), longs, pa.bool_()]
        names = [c.split()[0] for c in _ASKED.split(", ")] + ["shard", "cells", "closed"]
        schema = pa.schema(list(zip(names, types, strict=True)))
        columns = [c.split()[0] for c in _ASKED.split(", ")]
        return asked.select(*columns).mapInArrow(run, _ASKED + ", shard int, cells array<long>, closed boolean")


def best_of_shard(rows: pd.DataFrame, asked: pd.DataFrame, k: int, same: bool) -> list[tuple]:
    """(row, window, found, score): the best ``k`` rows of a shard for each anchor and window.

    Windows are ``low`` to ``high``, both included; rows have the anchor's label (``same``) or another.
    """
    rows = rows.drop_duplicates(["row", "id"])
    rows = rows.assign(cell=rows["a"].astype("int64") * (1 << 32) + rows["b"]).sort_values("cell")
    lengths = rows["length"].to_numpy()
    out: list[tuple] = []
    for n, ask in asked.groupby(asked["v"].map(len)):
        own = rows[lengths == n]
        if own.empty:
            continue
        ids, labels, cells = (own[c].to_numpy() for c in ("id", "label", "cell"))
        matrix = np.array(own["v"].tolist(), dtype=np.int64).reshape(len(own), n)
        vectors = np.array(ask["v"].tolist(), dtype=np.int64).reshape(len(ask), n)
        for q, r in enumerate(ask.itertuples(index=False)):
            if q % 256 == 0:  # scores of so many anchors at once
                scores_of = products(vectors[q : q + 256], matrix)
            first, last = np.searchsorted(cells, r.cells), np.searchsorted(cells, r.cells, side="right")
            at = np.concatenate([np.arange(a, b) for a, b in zip(first, last, strict=True)])
            at = at[(ids[at] != r.id) & ((labels[at] == r.label) == same)]
            scores, found = scores_of[q % 256, at], ids[at]
            for w, (low, high) in enumerate(zip(r.low, r.high, strict=True)):
                inside = np.flatnonzero((scores >= low) & (scores <= high))
                best = inside[np.lexsort((found[inside], -scores[inside]))[:k]]
                out += [(r.row, w, int(found[i]), int(scores[i])) for i in best]
    return out


def searched(index: MultiIndex, asked: DataFrame, k: int, same: bool) -> DataFrame:
    """row, window, rank, found, score: the certain best ``k`` rows for each anchor and window.

    ``asked``: row, id, label, v, and the windows' ends ``low`` and ``high``.
    """
    spark, rows = index.spark, index.sharded()
    least = F.array_min("low")
    asked = stored(asked.withColumns({"done": F.lit(0), "sure": least}), "negatives-asked")
    windows = asked.select("row", F.posexplode("low").alias("window", "low_end"))
    best = spark.createDataFrame([], "row long, window int, found long, score long")
    order = Window.partitionBy("row", "window").orderBy(F.col("score").desc(), "found")
    n_rows = FIRST_ROWS

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = best_of_shard(rows, asked, k, same) if len(rows) and len(asked) else []
        return pd.DataFrame(found, columns=["row", "window", "found", "score"])

    while True:
        visits = stored(index.visits(asked, n_rows), "negatives-visits")
        ask = visits.where("shard IS NOT NULL")
        parts = ask.groupBy("shard").agg(F.ceil(F.count("*") / PART_VISITS).cast("int").alias("n_part"))
        parts = stored(parts, "negatives-parts")
        tasks = parts.agg(F.sum("n_part")).first()[0]
        if not tasks:
            break
        ask = ask.join(parts, "shard").withColumn("part", F.pmod("row", "n_part").cast("int"))
        dealt = rows.join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_part") - 1)))
        keys = ["shard", "part"]
        pair = [x.drop("n_part").repartition(splits(tasks, 2), *keys).groupBy(*keys) for x in (dealt, ask)]
        found = pair[0].cogroup(pair[1]).applyInPandas(run, "row long, window int, found long, score long")
        ranked = best.unionAll(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = stored(ranked.drop("rank"), "negatives-best")
        # what is certain of a window: its k-th best score, or its lower end
        kth = best.groupBy("row", "window").agg(F.when(F.count("*") == k, F.min("score")).alias("kth"))
        sure = windows.join(kth, ["row", "window"], "left").groupBy("row").agg(
            F.min(F.greatest("low_end", F.coalesce("kth", "low_end"))).alias("sure")
        )
        still = visits.where("NOT closed").drop("sure", "shard", "cells", "closed")
        asked = stored(still.join(sure, "row"), "negatives-asked")
        if not asked.limit(1).count():
            break
        n_rows *= GROWTH
    return best.withColumn("rank", F.row_number().over(order))


def mine(
    rows: DataFrame,
    is_anchor: Column,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores, for rows of ``numbers``.

    A negative's score lies between ``low`` and ``high`` percent of the positive's, both included.
    """
    index = MultiIndex(rows)
    anchors = index.rows.where(is_anchor).select("row", "id", "label", "v").dropDuplicates(["row"])
    anchors = stored(anchors, "negatives-anchors")
    wide = anchors.withColumns({"low": F.array(F.lit(-_MOST)), "high": F.array(F.lit(_MOST - 1))})
    positives = searched(index, wide, n_positives, same=True)
    positives = stored(positives.select("row", "rank", F.col("found").alias("positive_id"), F.col("score").alias("ps")), "negatives-positives")
    # 100 * score >= low * ps, and 100 * score <= high * ps, in whole numbers without overflow
    ends = positives.where("ps >= 0").select(
        "row",
        F.struct(
            "rank", "positive_id", "ps",
            F.ceil(F.col("ps").cast("decimal(25,0)") * low / 100).cast("long").alias("low"),
            F.floor(F.col("ps").cast("decimal(25,0)") * high / 100).cast("long").alias("high"),
        ).alias("w"),
    )
    windows = ends.groupBy("row").agg(F.array_sort(F.collect_list("w")).alias("w"))
    asked = anchors.join(windows, "row").select("row", "id", "label", "v", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    negatives = searched(index, asked, n_negatives, same=False)
    named = anchors.select("row", F.col("id").alias("anchor_id")).join(windows, "row").select("row", "anchor_id", F.posexplode("w").alias("window", "w"))
    return negatives.join(named, ["row", "window"]).select(
        "anchor_id",
        F.col("w.positive_id").alias("positive_id"),
        "rank",
        F.col("found").alias("negative_id"),
        F.col("w.ps").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(numbers(vectors, "vec_id", label, "embedding"), F.col("id") % 50 == 0)
