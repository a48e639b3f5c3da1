"""Approximate nearest neighbours by stable projections indexed by kd-trees.

Vectors are projected onto ``AXES`` Gaussian directions. The squared ratio of a pair's
projected distance to its true distance follows a chi-square law with that many degrees of
freedom. Neighbours are taken in order of projected distance and verified on the original
vectors, until the projected distance is so large that, with probability ``SURE``, no
vector beyond it can be nearer than the k-th best so far.

The projected space is cut into cells by a kd-tree built on a bounded sample (``SAMPLE``
points); every row is indexed in its cell. Cells are dealt by id into blocks of about
``BLOCK_ROWS`` rows, whose number grows with the input, each with a kd-tree of its own, so
equal vectors do not gather in one task. A query first searches one block of its own cell,
which bounds its k-th distance; then it visits the cells, all their blocks, that the
stopping test cannot rule out. Busy cells deal their queries into parts as well.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component
take no part; vectors of different lengths are not compared. Rows repeating an id are one
candidate at its nearest vector; a repeated query id asks with its least vector. Fewer than
k candidates are all returned. Null ids take no part. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstar.llm.common import splits, stored, table

K = 10
AXES = 6  # even: the chi-square law then has a closed form
SURE = 0.995
SAMPLE = 16_384
CELL_ROWS = 4096
BLOCK_ROWS = 4096
PART_QUERIES = 512
LEAF = 32
SEED = 11


def chi_square_quantile(p: float, axes: int = AXES) -> float:
    """The value below which a chi-square variable of an even number of degrees falls with probability p."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        x = (low + high) / 2
        term, total = 1.0, 1.0
        for i in range(1, axes // 2):
            term *= x / 2 / i
            total += term
        if 1 - np.exp(-x / 2) * total < p:
            low = x
        else:
            high = x
    return high


REACH = chi_square_quantile(SURE)


def directions(length: int) -> np.ndarray:
    return np.random.default_rng([SEED, length]).standard_normal((length, AXES))


def usable(vector: Column) -> Column:
    """Vectors that take part."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(whole & F.exists(vector, lambda x: x != 0), F.lit(False))


def projected(rows: DataFrame) -> DataFrame:
    """id, v and the projection p of rows (id, v array<double>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                out.append((np.array(v) @ directions_of(len(v))).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.float64()))], names=["id", "v", "p"]
            )

    known: dict[int, np.ndarray] = {}

    def directions_of(length: int) -> np.ndarray:
        if length not in known:
            known[length] = directions(length)
        return known[length]

    return rows.mapInArrow(run, "id long, v array<double>, p array<double>")


class Tree:
    """A kd-tree over points as the boxes of its leaves and the points in each."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.leaves: list[np.ndarray] = []
        low, high = [], []
        self.cuts: list[tuple[int, float, int, int]] = []  # axis, value, and two children: cut or ~leaf
        inf = np.full(points.shape[1], np.inf)

        def build(own: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> int:
            spread = np.ptp(points[own], axis=0) if len(own) else np.zeros(len(lo))
            axis = int(spread.argmax())
            if len(own) <= leaf or spread[axis] == 0:
                self.leaves.append(own)
                low.append(lo)
                high.append(hi)
                return ~(len(self.leaves) - 1)
            values = points[own, axis]
            cut = float(np.median(values))
            if cut == values.max():  # many equal values: cut below them
                cut = float(values[values < cut].max())
            here = len(self.cuts)
            self.cuts.append((axis, cut, 0, 0))
            hi_left, lo_right = hi.copy(), lo.copy()
            hi_left[axis] = lo_right[axis] = cut
            left = build(own[values <= cut], lo, hi_left)
            right = build(own[values > cut], lo_right, hi)
            self.cuts[here] = (axis, cut, left, right)
            return here

        self.root = build(np.arange(len(points)), -inf, inf)
        self.low, self.high = np.array(low), np.array(high)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf that holds each point."""
        at = np.full(len(points), self.root)
        while (at >= 0).any():
            for node in np.unique(at[at >= 0]):
                own = np.flatnonzero(at == node)
                axis, cut, left, right = self.cuts[node]
                at[own] = np.where(points[own, axis] <= cut, left, right)
        return ~at

    def box_distance(self, point: np.ndarray) -> np.ndarray:
        """Squared projected distance from a point to each leaf's box."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return (gap * gap).sum(axis=1)


def search_block(ids: np.ndarray, vectors: np.ndarray, points: np.ndarray, queries, k: int) -> list[tuple]:
    """(query, id, distance) of the nearest rows of a block, for queries (id, v, p, bound)."""
    tree = Tree(points, LEAF)
    out = []
    for own, v, p, bound in queries:
        best_d, best_i = np.zeros(0), np.zeros(0, dtype=np.int64)
        reach = tree.box_distance(p)
        for leaf in np.argsort(reach, kind="stable"):
            if reach[leaf] > REACH * bound * bound:
                break  # the stopping test holds for all further neighbours
            rows = tree.leaves[leaf]
            gap = points[rows] - p
            rows = rows[((gap * gap).sum(axis=1) <= REACH * bound * bound) & (ids[rows] != own)]
            if not len(rows):
                continue
            gap = vectors[rows] - v
            d = np.concatenate((best_d, np.sqrt((gap * gap).sum(axis=1))))
            i = np.concatenate((best_i, ids[rows]))
            order = np.lexsort((i, d))
            _, first = np.unique(i[order], return_index=True)
            order = order[np.sort(first)[:k]]
            best_d, best_i = d[order], i[order]
            if len(best_d) == k:
                bound = min(bound, float(best_d[-1]))
        out += [(own, int(i), float(d)) for i, d in zip(best_i, best_d, strict=True)]
    return out


class Search:
    """An index over (vec_id, embedding) rows."""

    def __init__(self, rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding"):
        self.spark = rows.sparkSession
        vector = F.col(vector_col).cast("array<double>")
        valid = rows.where(F.col(id_col).isNotNull() & usable(vector))
        self.rows = stored(projected(valid.select(F.col(id_col).cast("long").alias("id"), vector.alias("v"))), "nearest-rows")
        n = self.rows.count()
        place = F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1 << 30))
        share = min(1.0, SAMPLE / max(1, n))
        picked = self.rows.where(place < int(share * (1 << 30))).select("p").toLocalIterator()
        sample = np.array([r.p for r in picked]).reshape(-1, AXES)
        self.cells = Tree(sample, splits(int(CELL_ROWS * share), 1))
        celled = self.with_cell(self.rows)
        counts = {r.cell: r["count"] for r in celled.groupBy("cell").count().collect()}
        blocks = self._by_cell({c: splits(m, BLOCK_ROWS) for c, m in counts.items()})
        self.blocked = celled.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        self.n_blocks, self.blocks = sum(splits(m, BLOCK_ROWS) for m in counts.values()), blocks

    def with_cell(self, rows: DataFrame) -> DataFrame:
        """Add the number of the cell that a row's projection falls into."""
        tree = self.cells

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.schema.get_field_index("p")
                points = np.array(batch.column(at).to_pylist()).reshape(-1, AXES)
                cell = pa.array(tree.leaf_of(points), pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, cell], names=[*batch.schema.names, "cell"])

        return rows.mapInArrow(run, "id long, v array<double>, p array<double>, cell int")

    def _by_cell(self, values: dict[int, int]) -> Column:
        """A number for each cell; cells are bounded by the sample."""
        if not values:
            return F.lit(1)
        known = F.array(*[F.lit(int(values.get(c, 1))) for c in range(len(self.cells.leaves))])
        return F.get(known, F.col("cell"))

    def _found(self, asked: DataFrame, k: int) -> DataFrame:
        """(query, id, d) from the blocks that queries (id, v, p, bound, cell, block) visit."""
        asked = stored(asked, "nearest-visits")
        busy = {r.cell: r.n for r in asked.groupBy("cell", "block").count().groupBy("cell").agg(F.max("count").alias("n")).collect()}
        parts = self._by_cell({c: splits(n, PART_QUERIES) for c, n in busy.items()})
        asked = asked.withColumn("part", F.pmod(F.xxhash64("id", F.lit(3)), parts).cast("int"))
        rows = self.blocked.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        n_tasks = splits(self.n_blocks, 2)
        keys = ["cell", "block", "part"]

        def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(rows) and len(asked):
                lengths, wanted = rows["v"].map(len), asked["v"].map(len)
                for length in wanted.unique():
                    own, ask = rows[lengths == length], asked[wanted == length]
                    if len(own):
                        queries = zip(ask["id"], ask["v"].map(np.asarray), ask["p"].map(np.asarray), ask["bound"], strict=True)
                        out += search_block(own["id"].to_numpy(), np.stack(own["v"]), np.stack(own["p"]), queries, k)
            return pd.DataFrame(out, columns=["query", "id", "d"])

        dealt = rows.repartition(n_tasks, *keys).groupBy(*keys), asked.repartition(n_tasks, *keys).groupBy(*keys)
        return dealt[0].cogroup(dealt[1]).applyInPandas(run, "query long, id long, d double")

    def nearest(self, is_query: Column, k: int = K) -> DataFrame:
        """(query_id, rank, vec_id, score) for the rows whose ``id`` satisfies a condition."""
        queries = self.rows.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
        queries = stored(self.with_cell(projected(queries)), "nearest-queries")
        home = queries.select(
            "id", "v", "p", F.lit(float("inf")).alias("bound"), "cell", F.pmod(F.xxhash64("id"), self.blocks).cast("int").alias("block")
        )
        first = self._found(home, k)
        bounds = first.groupBy("query").agg(F.when(F.count("*") == k, F.max("d")).alias("bound"))
        bounded = queries.join(bounds, queries["id"] == bounds["query"], "left").select(
            "id", "v", "p", F.coalesce("bound", F.lit(float("inf"))).alias("bound")
        )
        tree, reach = self.cells, REACH

        def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = batch.to_pydict()
                cells = [
                    np.flatnonzero(tree.box_distance(np.array(p)) <= reach * b * b).tolist()
                    for p, b in zip(columns["p"], columns["bound"], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"]
                )

        visited = bounded.mapInArrow(
            visits, "id long, v array<double>, p array<double>, bound double, cells array<int>"
        ).select("id", "v", "p", "bound", F.explode("cells").alias("cell"))
        visited = visited.withColumn("block", F.explode(F.sequence(F.lit(0), self.blocks.cast("int") - 1)))
        found = self._found(visited, k).groupBy("query", "id").agg(F.min("d").alias("d"))
        rank = F.row_number().over(Window.partitionBy("query").orderBy("d", "id"))
        return (
            found.withColumn("rank", rank)
            .where(F.col("rank") <= k)
            .select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), F.col("d").alias("score"))
        )


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Search(table(spark, sf_dir, "embeddings")).nearest(F.col("id") % 100 == 0)
