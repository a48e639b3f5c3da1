"""Toxicity by multiple-instance learning from document labels.

A document is a bag of sentences. Each sentence has a logistic score over its words and
their first four and five letters; a document's score is the noisy-or of its sentences,
1 - prod(1 - p). Only documents are labelled, so the gradient of the document loss is
shared out over the sentences by their part in the noisy-or; a soft threshold leaves
weights on the telling features alone. Sentences that score high are then located.

The model is fitted on a bounded sample of labelled documents: about ``max_positive`` and
``max_negative`` of them and ``max_bytes`` of text, chosen by a hash of their id. Features are
counted and chosen in Spark, and tasks turn sentences into feature numbers; the driver holds
these numbers alone. Scoring covers every whole text.

Defined cases: null, empty and blank texts have no sentence and score 0. Null labels are
left out; several labels of one id count as the highest. Without labels of both kinds every
document gets the share of toxic labels (0 without any). Repeated rows are scored each by
itself. Null ids are scored and never learned from. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import held_out, stored, table

MAX_POSITIVE, MAX_NEGATIVE = 3000, 5000
MAX_FEATURES = 4000
ROUNDS = 150
THRESHOLD = 0.3
OFFENDING = 0.5
LEAST = 0.05  # lesser weights are left out
MAX_BYTES = 64 << 20  # of the sample's texts
CACHED_WORDS = 150_000

_SENTENCE = re.compile(r"[^.!?\n]*\w[^.!?\n]*")
_WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """A lower-cased word, and its first four and five letters if it is longer."""
    return [word, *(f"{word[:k]}*" for k in (4, 5) if len(word) > k)]


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -40.0
    words: dict[str, float] = field(default_factory=dict)

    def word(self, word: str) -> float:
        weight = self.words.get(word)
        if weight is None:
            weight = sum(self.weights.get(f, 0.0) for f in features(word)) or 0.0
            if len(self.words) < CACHED_WORDS:
                self.words[word] = weight
        return weight

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score and its offending sentences as (start, end, score)."""
        text = text or ""
        telling = any(map(self.word, _WORD.findall(text.lower())))
        found, rest = [], 0.0
        # a sentence without a telling word counts as clean, so length alone says nothing
        for m in _SENTENCE.finditer(text) if telling else ():
            z = sum(map(self.word, _WORD.findall(m[0].lower())))
            if z == 0.0:
                continue
            p = float(_sigmoid(self.bias + z))
            rest += float(np.log1p(-min(p, 1 - 1e-12)))
            if p >= OFFENDING:
                found.append((m.start(), m.end(), p))
        if not self.weights:
            rest = float(np.log1p(-_sigmoid(self.bias))) if text.strip() else 0.0
        return min(1.0, max(0.0, -float(np.expm1(rest)))), found


def fit(
    docs: list[tuple[int, list[np.ndarray]]], names: list[str], rounds: int = ROUNDS, least: float = LEAST
) -> Model:
    """Noisy-or regression, by proximal gradient steps with per-weight rates.

    ``docs``: label and sentences of each document, a sentence as numbers of features in ``names``.
    """
    y = np.array([label > 0 for label, _ in docs], dtype=float)
    if not len(y) or y.min() == y.max():
        share = y.mean() if len(y) else 0.0
        return Model({}, float(np.clip(np.log(share + 1e-18) - np.log1p(-share + 1e-18), -40, 40)))
    bags = [bag for _, bag in docs]
    sizes = np.array([len(words) for bag in bags for words in bag], dtype=np.int32)
    cols = np.concatenate([np.zeros(0, dtype=np.int32), *(words for bag in bags for words in bag)]).astype(np.int32)
    rows = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    own_doc = np.repeat(np.arange(len(y), dtype=np.int32), [len(bag) for bag in bags])
    del bags, docs
    w, bias = np.zeros(len(names)), -4.0
    squares, square = np.full(len(names), 1e-8), 1e-8
    telling = np.ones(len(sizes), dtype=bool)
    for step in range(rounds):
        if step % 25 == 24:
            # words that are not telling so far need no more rounds; sentences without a telling
            # word count as clean from here on, as they do in scoring
            active = np.abs(w[cols]) > (least if step + 25 >= rounds else 0)
            cols, rows = cols[active], rows[active]
            telling = np.bincount(rows, minlength=len(sizes)) > 0
        p = np.where(telling, _sigmoid(np.bincount(rows, w[cols], len(sizes)) + bias), 0.0)
        clear = np.exp(np.bincount(own_doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y)))  # prod(1 - p)
        part = np.where(y == 1, clear / np.maximum(1 - clear, 1e-9), -1.0)
        slope = part[own_doc] * p
        g = np.bincount(cols, slope[rows], len(names)) / len(y)
        g_bias = slope.sum() / len(y)
        squares += g * g
        square += g_bias * g_bias
        rate = 0.5 / np.sqrt(squares)
        w += rate * g
        w = np.sign(w) * np.maximum(np.abs(w) - rate * 3e-4, 0.0)
        bias = min(bias + 0.5 / np.sqrt(square) * g_bias, -4.0)
    return Model({n: float(v) for n, v in zip(names, w, strict=True) if abs(v) > least}, float(bias))


def feature_counts(rows: DataFrame) -> DataFrame:
    """feature, n1, n0: how many toxic and other documents of (text, toxic) rows hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = (Counter(), Counter())
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = set(_WORD.findall((text.as_py() or "").lower()))
                seen[label > 0].update({f for w in words for f in features(w)})
            for label, counts in enumerate(seen):
                columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
                zeros = pa.array(np.zeros(len(counts), dtype=np.int64))
                n = [columns[1], zeros] if label else [zeros, columns[1]]
                yield pa.RecordBatch.from_arrays([columns[0], *n], names=["feature", "n1", "n0"])

    parts = rows.mapInArrow(run, "feature string, n1 long, n0 long")
    return parts.groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def telling_features(rows: DataFrame, max_features: int = MAX_FEATURES) -> list[str]:
    """Features whose share differs most between the labels, in standard errors."""
    n1, n0 = rows.agg(F.count_if(F.col("toxic") > 0), F.count_if(F.col("toxic") <= 0)).first()
    if not n1 or not n0:
        return []
    a, b, n = F.col("n1"), F.col("n0"), n1 + n0
    share = (a + b) / n
    spread = F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-9)
    counts = feature_counts(rows).where(a + b >= 5)
    top = counts.withColumn("gap", F.abs(a / n1 - b / n0) / spread).orderBy(F.desc("gap"), "feature").limit(max_features)
    return [r.feature for r in top.select("feature").collect()]


def numbered_sentences(rows: DataFrame, names: list[str]) -> DataFrame:
    """toxic, and the sentences that hold a feature as its numbers: all in ``numbers``, cut by ``sizes``."""
    number = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}

        def own(word: str) -> tuple[int, ...]:
            found = known.get(word)
            if found is None:
                found = tuple(number[f] for f in features(word) if f in number)
                if len(known) < CACHED_WORDS:
                    known[word] = found
            return found

        for batch in batches:
            numbers, sizes = [], []
            for text in batch.column(0):
                bags = [[i for w in _WORD.findall(s.lower()) for i in own(w)] for s in _SENTENCE.findall(text.as_py() or "")]
                bags = [bag for bag in bags if bag]
                numbers.append(np.array([i for bag in bags for i in bag], dtype="<i4").tobytes())
                sizes.append(np.array([len(bag) for bag in bags], dtype="<i4").tobytes())
            columns = [batch.column(1), pa.array(numbers, pa.binary()), pa.array(sizes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "numbers", "sizes"])

    return rows.mapInArrow(run, "toxic int, numbers binary, sizes binary")


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    max_positive: int = MAX_POSITIVE,
    max_negative: int = MAX_NEGATIVE,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """About so many labelled texts outside the held-out quarter, as (text, toxic).

    Where they hold more than about ``max_bytes``, fewer are taken, by the same hash.
    """
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    share = F.when(F.col("toxic") == 1, max_positive / max(1, counts.get(1, 0))).otherwise(
        max_negative / max(1, counts.get(0, 0))
    )
    picked = known.withColumns({"place": place, "share": share}).where("place < share")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # the picked ids are bounded by the sample's size
    rows = stored(texts.join(F.broadcast(picked), "doc_id"), "toxicity-sample")
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return rows.where(F.col("place") < F.col("share") * min(1.0, max_bytes / max(1, size))).select("text", "toxic")


def fit_model(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of a bounded sample; its texts and words stay in Spark, the driver gets numbers."""
    rows = training_rows(docs, labels)
    names = telling_features(rows)
    # documents without a telling sentence are clear whatever the weights: only their number counts
    found: list[tuple[int, bytes, bytes]] = [
        (r.toxic, bytes(r.numbers), bytes(r.sizes)) for r in numbered_sentences(rows, names).toLocalIterator()
    ]
    found.sort()
    read = lambda raw: np.frombuffer(raw, "<i4")
    return fit([(y, np.split(read(raw), np.cumsum(read(sizes))[:-1]) if sizes else []) for y, raw, sizes in found], names)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, and the offending sentences as structs of start, end and score."""
    plain = Model(model.weights, model.bias)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(plain.weights, plain.bias)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            scored = [own.score(t.as_py()) for t in batch.column(1)]
            spans = [[{"start": a, "end": b, "score": p} for a, b, p in s] for _, s in scored]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s for s, _ in scored], pa.float64()), pa.array(spans, kind)],
                names=["doc_id", "score", "sentences"],
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(
        run, "doc_id long, score double, sentences array<struct<start: int, end: int, score: double>>"
    )


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with all their columns."""
    at, plain = docs.columns.index(text_col), Model(model.weights, model.bias)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(plain.weights, plain.bias)
        for batch in batches:
            yield batch.filter(pa.array([own.score(t.as_py())[0] < threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, fit_model(docs, table(spark, sf_dir, "labels")))
    spans = F.transform("sentences", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.array_join(spans, ",").alias("sentences"),
    )
