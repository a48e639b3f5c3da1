"""Ranked lexical search turned round: the items' inverted index visits the documents.

The queries (items) are few and the documents many, so it is the items that are indexed: an
inverted index over their terms goes to every task, each document's counts of those terms
stream through it, and every task keeps one bounded heap of the best documents per item.
The heaps are then merged, first by salt and then by item.

Documents are read once. That pass counts terms and stores, for each document, its length
and the counts of the terms that some item asks for, besides one row per task with its
number of documents, of terms and of documents per term. Weights need the totals of all
documents, so scoring is a second pass, over the stored counts alone.

The index is bounded: items are dealt into blocks of about ``max_terms`` distinct terms, each
asked of all documents in a pass of its own; their number grows with the items only.

A term is a longest run of ASCII letters and digits and of characters beyond ASCII, with A-Z
in lower case. Weights and scores are whole numbers, see ``weight`` and ``length_part``.

Defined cases: null and empty texts, and those without a term, are no documents for the
counts and are never found. Repeated rows are documents each. Documents without an id
rank after those of equal score. Items without an id take no part; rows repeating an item's
id are one item, with its least text; an item without terms finds nothing. Empty tables give
no rows. Other columns are ignored. An item's terms must fit into memory, a text's as well.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstar.llm.common import splits, stored, table

K = 10
MAX_TERMS = 1_000_000
CELLS = 4_000_000
SALTS = 64

# every byte that ends a term becomes a blank, A-Z become a-z, all others stay
_PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
_COUNTS = "doc_id long, n long, terms binary, counts binary, n_docs long"
_FOUND = "item_id long, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text (UTF-8), in order."""
    return text.translate(_PLAIN).split()


def weight(n_docs: int, df: int) -> int:
    """Weight of a term that so many of all documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_part(n: int, n_docs: int, n_terms: int) -> int:
    """A document's length against the mean one, in hundredths; a quarter counts at any length."""
    return 100 - 75 + (75 * n * n_docs) // n_terms


@dataclass
class ItemIndex:
    """Terms of a block of items, and for each term the items that hold it, with repeats."""

    ids: np.ndarray
    number: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray
    repeats: np.ndarray

    @classmethod
    def of(cls, texts: list[tuple[int, bytes]]) -> ItemIndex:
        number: dict[bytes, int] = {}
        postings: list[list[tuple[int, int]]] = []
        for item, (_, text) in enumerate(texts):
            for term, repeats in Counter(terms_of(text)).items():
                at = number.setdefault(term, len(number))
                if at == len(postings):
                    postings.append([])
                postings[at].append((item, repeats))
        flat = np.array([p for own in postings for p in own], dtype=np.int64).reshape(-1, 2)
        starts = np.cumsum([0, *map(len, postings)])
        return cls(np.array([i for i, _ in texts], dtype=np.int64), number, starts, flat[:, 0], flat[:, 1])


def blocks_of(items: DataFrame, id_col: str, text_col: str, max_terms: int) -> Iterator[ItemIndex]:
    """The items as indexes of bounded size."""
    one = items.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id"))
    one = one.agg(F.min(F.col(text_col).cast("binary")).alias("text"))
    # a term takes two bytes at least, its end included
    one = one.withColumn("size", F.ceil((F.coalesce(F.octet_length("text"), F.lit(0)) + 1) / F.lit(2)))
    one = stored(one, "lexical-items")
    n_blocks = splits(int(one.agg(F.sum("size")).first()[0] or 0), max_terms)
    block = F.pmod(F.xxhash64("id"), F.lit(n_blocks))
    for b in range(n_blocks):
        texts = [(r.id, bytes(r.text or b"")) for r in one.where(block == b).toLocalIterator()]
        if texts:
            yield ItemIndex.of(sorted(texts))


def term_counts(docs: DataFrame, index: ItemIndex, id_col: str, text_col: str) -> DataFrame:
    """Per document that holds a term of the index: its length and counts; per task: its totals.

    The totals of a task have ``n_docs``, and in ``counts`` the documents per term.
    """
    number = index.number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(number), dtype=np.int64)
        n_docs = n_terms = 0
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("counts", pa.binary()), ("n_docs", pa.int64())]
        )
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                words = terms_of(text.as_py() or b"")
                if not words:
                    continue
                n_docs += 1
                n_terms += len(words)
                found = list(filter(lambda x: x is not None, map(number.get, words)))
                if found:
                    own, tf = np.unique(np.array(found, dtype="<i4"), return_counts=True)
                    df[own] += 1
                    out.append((doc_id.as_py(), len(words), own.tobytes(), tf.astype("<i8").tobytes(), None))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        held = np.flatnonzero(df)
        total = (None, n_terms, held.astype("<i4").tobytes(), df[held].tobytes(), n_docs)
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(total, schema, strict=True)], schema=schema)

    picked = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
    return picked.mapInArrow(run, _COUNTS)


def totals(counts: DataFrame, n_index_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms, and documents per term, summed over the tasks in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, n_terms = np.zeros(n_index_terms, dtype=np.int64), 0, 0
        for batch in batches:
            rows = batch.to_pydict()
            n_docs, n_terms = n_docs + sum(rows["n_docs"]), n_terms + sum(rows["n"])
            for terms, held in zip(rows["terms"], rows["counts"], strict=True):
                df[np.frombuffer(terms, "<i4")] += np.frombuffer(held, "<i8")
        if n_docs:
            held = np.flatnonzero(df)
            numbers = np.concatenate(([-2, -1], held))
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers), pa.array(np.concatenate(([n_docs, n_terms], df[held])))], names=["term", "n"]
            )

    parts = counts.where("n_docs IS NOT NULL").mapInArrow(run, "term long, n long")
    # one row per term of a bounded index
    summed = {r.term: r.n for r in parts.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator()}
    df = np.array([summed.get(t, 0) for t in range(n_index_terms)], dtype=np.int64)
    return summed.get(-2, 0), summed.get(-1, 0), df


class Heaps:
    """The best ``k`` documents of each item: higher scores first, then smaller ids, then none."""

    def __init__(self, n_items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n_items)]
        self.least = np.ones(n_items, dtype=np.int64)  # scores below cannot enter

    def take(self, ids: list[int | None], scores: np.ndarray) -> None:
        """Offer documents (rows) with their scores for each item (columns)."""
        for row, item in zip(*np.nonzero(scores >= self.least), strict=True):
            own, heap = ids[row], self.heaps[item]
            entry = (int(scores[row, item]), own is not None, -(own or 0))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.least[item] = max(1, heap[0][0])

    def rows(self) -> list[tuple[int, int | None, int]]:
        return [(i, -minus if known else None, score) for i, heap in enumerate(self.heaps) for score, known, minus in heap]


def scored(index: ItemIndex, w: np.ndarray, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Scores of documents (length part, terms, counts) for every item."""
    lengths = np.array([len(t) for _, t, _ in rows])
    doc = np.repeat(np.arange(len(rows)), lengths)
    terms = np.concatenate([t for _, t, _ in rows])
    tf = np.concatenate([c for _, _, c in rows])
    m = np.array([m for m, _, _ in rows], dtype=np.int64)[doc]
    gain = w[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
    first, n = index.starts[terms], index.starts[terms + 1] - index.starts[terms]
    at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    out = np.zeros((len(rows), len(index.ids)), dtype=np.int64)
    np.add.at(out.reshape(-1), np.repeat(doc, n) * len(index.ids) + index.items[at], np.repeat(gain, n) * index.repeats[at])
    return out


def best_of_tasks(counts: DataFrame, index: ItemIndex, k: int) -> DataFrame:
    """Each task's best documents for every item of the index."""
    n_docs, n_terms, df = totals(counts, len(index.number))
    w = np.array([weight(n_docs, int(n)) for n in df], dtype=np.int64)
    most = max(1, CELLS // max(1, len(index.ids)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps, run_rows, ids, size = Heaps(len(index.ids), k), [], [], min(64, most)

        def flush() -> None:
            if run_rows:
                heaps.take(ids, scored(index, w, run_rows))
                run_rows.clear()
                ids.clear()

        for batch in batches:
            rows = batch.to_pydict()
            for doc_id, n, terms, held in zip(rows["doc_id"], rows["n"], rows["terms"], rows["counts"], strict=True):
                ids.append(doc_id)
                run_rows.append((length_part(n, n_docs, n_terms), np.frombuffer(terms, "<i4"), np.frombuffer(held, "<i8")))
                if len(run_rows) >= size:
                    flush()
                    size = min(2 * size, 4096, most)  # small at first, so that heaps fill before much is offered
        flush()
        found = heaps.rows()
        columns = list(zip(*found, strict=True)) or [[]] * 3
        items = pa.array(index.ids[np.array(columns[0], dtype=np.int64)])
        yield pa.RecordBatch.from_arrays(
            [items, pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["item_id", "doc_id", "score"]
        )

    return counts.where("n_docs IS NULL").mapInArrow(run, _FOUND)


def search(
    items: DataFrame,
    docs: DataFrame,
    k: int = K,
    item_id: str = "item_id",
    item_text: str = "text",
    doc_id: str = "doc_id",
    doc_text: str = "text",
    max_terms: int = MAX_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the best ``k`` documents above score 0 for each item."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = docs.sparkSession.createDataFrame([], _FOUND)
    for index in blocks_of(items, item_id, item_text, max_terms):
        counts = stored(term_counts(docs, index, doc_id, doc_text), "lexical-counts")
        heaps = best_of_tasks(counts, index, k).withColumn("salt", F.spark_partition_id() % SALTS)
        salted = F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))
        found = found.unionAll(heaps.withColumn("rank", salted).where(F.col("rank") <= k).select("item_id", "doc_id", "score"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))
