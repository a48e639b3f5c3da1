"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Pieces of full length are sequences of their own. The rest are dealt by hash into groups
of a few thousand, a number that grows with the input. Each group starts from best-fit
decreasing; where that meets the lower bound ceil(tokens / capacity) the group is done.
Otherwise several islands evolve it as independent rows: a crossover injects whole
well-filled bins of one parent into the other, bins that share their documents are taken
apart, and the displaced documents are put back best fit, largest first. After every epoch
each island passes its elite to the next one by a join on (group, island).

Defined cases: null texts are empty, and an empty text is one piece holding only the end
id. Repeated ids and equal texts are packed as separate documents. Null ids are packed too.
An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import splits, stored, table
from tripstar.llm.tokens import encoder, in_batches

CAPACITY = 2048
END_ID = 0
RANKS, END_OF_TEXT_ID = "byte_bpe_50k.tiktoken", 50256
GROUP_ITEMS = 2048
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 6
POPULATION = 4

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def generations(n_items: int) -> int:
    """Generations for a group: a smaller one gets more, for about equal work."""
    return GENERATIONS * max(1, GROUP_ITEMS // max(1, n_items))


def tokenised_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, crc32 of its ids.

    Only a document of more than ``capacity`` tokens is cut, from its end into full
    pieces; what is left over at its beginning is the first piece.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
        ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(RANKS, END_OF_TEXT_ID).encode
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            rows = []
            ids, at = batch.column(0).to_pylist(), 0
            for texts in in_batches(text.as_py() for text in batch.column(1)):
                for raw in encode(texts):
                    raw += end
                    n = len(raw) // 4
                    head = n % capacity or capacity
                    edges = [0, *range(head, n + 1, capacity)]
                    for piece, (i, j) in enumerate(zip(edges, edges[1:], strict=False)):
                        rows.append((ids[at], piece, i, j - i, zlib.crc32(raw[4 * i : 4 * j])))
                    at += 1
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    picked = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return picked.mapInArrow(cut, PIECES)


class Bins:
    """Open bins by free room; finds the one with the least room that still fits."""

    def __init__(self, capacity: int):
        self.capacity, self.mask = capacity, 0
        self.by_room: list[list[list[int]]] = [[] for _ in range(capacity + 1)]

    def add(self, items: list[int], room: int) -> None:
        self.by_room[room].append(items)
        self.mask |= 1 << room

    def put(self, item: int, size: int) -> None:
        fitting = self.mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            same = self.by_room[room]
            items = same.pop()
            if not same:
                self.mask ^= 1 << room
            items.append(item)
        else:
            room, items = self.capacity, [item]
        self.add(items, room - size)

    def bins(self) -> list[list[int]]:
        return [items for same in self.by_room for items in same]


def best_fit(
    sizes: list[int], items: list[int], kept: list[list[int]], capacity: int, by: dict[int, float] | None = None
) -> list[list[int]]:
    """Kept bins filled up with further items, largest first (or by another measure)."""
    bins = Bins(capacity)
    for own in kept:
        bins.add(list(own), capacity - sum(sizes[i] for i in own))
    for i in sorted(items, key=lambda i: (-(by or sizes)[i], i)):
        bins.put(i, sizes[i])
    return bins.bins()


def fitness(bins: list[list[int]], sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the mean square of their filling."""
    return -len(bins), sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def crossover(
    mother: list[list[int]], father: list[list[int]], sizes: list[int], capacity: int, rng
) -> list[list[int]]:
    """The mother with some of the father's best-filled bins put in whole."""
    filled = sorted(father, key=lambda b: -sum(sizes[i] for i in b))
    well = filled[: max(1, len(filled) // 2)]
    injected = [b for b, take in zip(well, rng.random(len(well)) < 0.5, strict=True) if take]
    inside = {i for b in injected for i in b}
    intact = [b for b in mother if inside.isdisjoint(b)]
    # the worst-filled of the mother's bins are opened as well, and a few others by chance
    intact.sort(key=lambda b: -sum(sizes[i] for i in b))
    cut = len(intact) - max(1, len(intact) // 20)
    chance = rng.random(len(intact)) < min(0.25, 4 / max(1, len(intact)))
    opened = [b for k, b in enumerate(intact) if k >= cut or chance[k]]
    kept = [b for k, b in enumerate(intact) if k < cut and not chance[k]]
    displaced = [i for b in mother if not inside.isdisjoint(b) for i in b if i not in inside]
    loose = displaced + [i for b in opened for i in b]
    # largest first, but nearly equal ones in an order that changes
    shaken = dict(zip(loose, np.array([sizes[i] for i in loose]) * (1 + 0.2 * rng.random(len(loose))), strict=True))
    return best_fit(sizes, loose, injected + kept, capacity, shaken)


def evolve(
    sizes: list[int], elites: list[list[list[int]]], capacity: int, seed: list[int], generations: int, population: int
) -> list[list[int]]:
    """The fittest packing after some generations, or as soon as the lower bound is met."""
    rng = np.random.default_rng(seed)
    bound = -(-sum(sizes) // capacity)
    people = list(elites)
    everyone = list(range(len(sizes)))
    while len(people) < population:  # first fits in shuffled order keep the founders apart
        bins = Bins(capacity)
        shaken = np.array(sizes) * (1 + 0.1 * rng.random(len(sizes)))
        for i in sorted(everyone, key=lambda i: -shaken[i]):
            bins.put(i, sizes[i])
        people.append(bins.bins())
    people.sort(key=lambda b: fitness(b, sizes, capacity), reverse=True)
    for _ in range(generations):
        if len(people[0]) <= bound:
            break
        first, second = rng.choice(min(3, len(people)), 2, replace=False)
        children = [crossover(people[a], people[b], sizes, capacity, rng) for a, b in ((first, second), (second, first))]
        # one of each fitness: copies of the fittest would soon be all there is
        ranked = {fitness(b, sizes, capacity): b for b in [*children, *people]}
        people = [ranked[f] for f in sorted(ranked, reverse=True)[:population]]
        if len(people) == 1:
            people.append(best_fit(sizes, everyone, [], capacity, dict(enumerate(rng.random(len(sizes))))))
    return people[0]


def _numbers(bins: list[list[int]], n: int) -> list[int]:
    out = [0] * n
    for number, items in enumerate(bins):
        for i in items:
            out[i] = number
    return out


def _bins(numbers) -> list[list[int]]:
    out: dict[int, list[int]] = {}
    for i, number in enumerate(numbers):
        out.setdefault(int(number), []).append(i)
    return list(out.values())


GROUPS = (
    "group long, ids array<long>, pieces array<int>, starts array<long>, sizes array<int>, "
    "crcs array<long>, bins array<int>, n_bins int, bound int"
)


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    group_items: int = GROUP_ITEMS,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """Add sequence_id and offset to stored pieces (see ``tokenised_pieces``)."""
    small = pieces.where(F.col("length") < capacity)
    n_groups = splits(small.count(), group_items)
    group = F.pmod(F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32"), F.lit(n_groups))

    def found(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        sizes = pdf["length"].tolist()
        bins = best_fit(sizes, list(range(len(sizes))), [], capacity)
        ids = [None if pd.isna(x) else int(x) for x in pdf["doc_id"]]
        return pd.DataFrame({
            "group": [pdf["group"].iloc[0]], "ids": [ids], "pieces": [pdf["piece"].tolist()],
            "starts": [pdf["start"].tolist()], "sizes": [sizes], "crcs": [pdf["ids_crc32"].tolist()],
            "bins": [_numbers(bins, len(sizes))], "n_bins": [len(bins)],
            "bound": [-(-sum(sizes) // capacity)],
        })

    # few groups a task: a group is short work, but the smaller tables have only some of them
    dealt = small.withColumn("group", group).repartition(splits(n_groups, 4), "group")
    founders = stored(dealt.groupBy("group").applyInPandas(found, GROUPS), "packing-groups")

    def epoch(number: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                best = []
                for row in pdf.itertuples(index=False):
                    sizes = [int(s) for s in row.sizes]
                    elites = [_bins(row.bins)] + ([_bins(row.guest)] if row.guest is not None else [])
                    seed = [number, int(row.island), int(row.group)]
                    bins = evolve(sizes, elites, capacity, seed, generations(len(sizes)), POPULATION)
                    best.append((row.group, row.island, _numbers(bins, len(sizes)), *fitness(bins, sizes, capacity)))
                yield pd.DataFrame(best, columns=["group", "island", "bins", "fewer", "fill"])

        return run

    open_groups = founders.where("n_bins > bound").select("group", "sizes", "bins")
    tasks = splits(n_groups * islands, 8)
    state = open_groups.select("*", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
    state = state.withColumn("guest", F.lit(None).cast("array<int>"))
    evolved = None
    for number in range(epochs):
        evolved = stored(
            state.repartition(tasks, "group", "island").mapInPandas(
                epoch(number), "group long, island int, bins array<int>, fewer int, fill double"
            ),
            "packing-islands",
        )
        guests = evolved.select(
            "group", F.expr(f"(island + 1) % {islands}").cast("int").alias("island"), F.col("bins").alias("guest")
        )
        state = (
            evolved.drop("fewer", "fill")
            .join(guests, ["group", "island"])
            .join(open_groups.select("group", "sizes"), "group")
        )
    winners = evolved.groupBy("group").agg(
        F.max_by("bins", F.struct("fewer", "fill", -F.col("island"))).alias("won")
    )
    packed = (
        founders.join(winners, "group", "left")
        .withColumn("bins", F.coalesce("won", "bins"))
        .select("group", F.explode(F.arrays_zip("ids", "pieces", "starts", "sizes", "crcs", "bins")).alias("x"))
        .select(
            F.col("x.ids").alias("doc_id"), F.col("x.pieces").alias("piece"), F.col("x.starts").alias("start"),
            F.col("x.sizes").cast("long").alias("length"), F.col("x.crcs").alias("ids_crc32"),
            (F.col("group") * (1 << 24) + F.col("x.bins")).alias("sequence_id"),
        )
    )
    # a bin holds at most ``capacity`` rows
    placed = packed.selectExpr(
        "*",
        "coalesce(sum(length) OVER (PARTITION BY sequence_id ORDER BY doc_id, piece, ids_crc32, start "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS offset",
    )
    full = pieces.where(F.col("length") == capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return placed.unionByName(full)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack(stored(tokenised_pieces(docs), "pieces"))
