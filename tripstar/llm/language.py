"""Language identification by a byte convolutional network, in numpy.

Text is cut into windows of a fixed length of UTF-8 bytes, the last one padded. Bytes are
embedded, filters of several widths slide over the embeddings, the maximum of each filter
over a window goes through a softmax layer. A text's probabilities are the mean over all of
its windows, weighted by their bytes. Windows go through the network in batches of a fixed
size, so memory does not grow with a text.

The network is fitted by Adam on windows of a bounded sample: about ``max_texts`` labelled
texts outside the held-out quarter, chosen by a hash of their id, at most
``windows_a_text`` windows from each. Languages are those seen in the sample, which
takes all texts of a language that has few. Prediction covers every whole text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every
text if no labelled text was seen. With one language seen, that one is predicted. Null
languages are not learned from. Repeated rows are predicted each by itself. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import held_out, table

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
MAX_TEXTS = 3000
WINDOWS_A_TEXT = 2
EPOCHS = 4
MIN_STEPS = 300
BATCH = 64
PADDING = 0
UNDETERMINED = "und"


def windows(raw: bytes, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The windows that cover a text, as rows of bytes, and how many bytes each holds."""
    n = max(1, -(-len(raw) // size))
    out = np.full(n * size, PADDING, dtype=np.uint8)
    out[: len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    held = np.full(n, size)
    held[-1] = len(raw) - (n - 1) * size
    return out.reshape(n, size), held


@dataclass
class ByteNet:
    """Embedding (256, e), one filter bank (width * e, f) with bias for each width, and a softmax layer."""

    languages: list[str]
    embedding: np.ndarray
    banks: list[np.ndarray]
    shifts: list[np.ndarray]
    out: np.ndarray
    out_shift: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 5) -> ByteNet:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return cls(
            languages,
            normal(256, EMBEDDING, scale=1.0),
            [normal(w * EMBEDDING, FILTERS, scale=(w * EMBEDDING) ** -0.5) for w in WIDTHS],
            [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS],
            normal(FILTERS * len(WIDTHS), len(languages), scale=0.1),
            np.zeros(len(languages), dtype=np.float32),
        )

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.banks, *self.shifts, self.out, self.out_shift]

    def _slices(self, x: np.ndarray, width: int) -> np.ndarray:
        """Embedded bytes (n, size, e) as overlapping rows (n, size - width + 1, width * e)."""
        n, size, e = x.shape
        s0, s1, s2 = x.strides
        return np.lib.stride_tricks.as_strided(x, (n, size - width + 1, width * e), (s0, s1, s2))

    def forward(self, rows: np.ndarray):
        """Softmax of windows of bytes, and what the gradient needs."""
        x = np.ascontiguousarray(self.embedding[rows])
        pooled, places = [], []
        for width, bank, shift in zip(WIDTHS, self.banks, self.shifts, strict=True):
            z = np.ascontiguousarray(self._slices(x, width)).reshape(-1, width * EMBEDDING) @ bank
            z = z.reshape(len(rows), -1, FILTERS)
            at = z.argmax(axis=1)
            places.append(at)
            pooled.append(np.take_along_axis(z, at[:, None, :], axis=1)[:, 0, :] + shift)
        h = np.concatenate(pooled, axis=1)
        active = np.maximum(h, 0)
        logits = active @ self.out + self.out_shift
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True), x, places, h, active

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Softmax of windows of bytes."""
        x = np.ascontiguousarray(self.embedding[rows])
        pooled = [
            (np.ascontiguousarray(self._slices(x, w)).reshape(-1, w * EMBEDDING) @ bank)
            .reshape(len(rows), -1, FILTERS).max(axis=1) + shift
            for w, bank, shift in zip(WIDTHS, self.banks, self.shifts, strict=True)
        ]
        logits = np.maximum(np.concatenate(pooled, axis=1), 0) @ self.out + self.out_shift
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def gradients(self, rows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy, in the order of ``parameters``."""
        p, x, places, h, active = self.forward(rows)
        d = p.copy()
        d[np.arange(len(rows)), labels] -= 1
        d /= len(rows)
        g_out, g_out_shift = active.T @ d, d.sum(axis=0)
        dh = (d @ self.out.T) * (h > 0)
        g_embedding = np.zeros_like(self.embedding)
        g_banks, g_shifts = [], []
        each = np.arange(len(rows))[:, None]
        for k, (width, bank, at) in enumerate(zip(WIDTHS, self.banks, places, strict=True)):
            own = dh[:, k * FILTERS : (k + 1) * FILTERS]  # only the place of the maximum learns
            seen = np.concatenate([x[each, at + j] for j in range(width)], axis=2)  # (n, f, width * e)
            g_banks.append(np.einsum("nfw,nf->wf", seen, own, optimize=True))
            g_shifts.append(own.sum(axis=0))
            back = own[:, :, None] * bank.T[None, :, :]
            for j in range(width):
                np.add.at(g_embedding, rows[each, at + j], back[:, :, j * EMBEDDING : (j + 1) * EMBEDDING])
        return [g_embedding, *g_banks, *g_shifts, g_out, g_out_shift]

    def predict(self, text: str) -> tuple[str, float]:
        """The likeliest language of a whole text and its mean probability."""
        rows, held = windows(text.encode("utf-8", "surrogatepass"))
        total = np.zeros(len(self.languages))
        for i in range(0, len(rows), BATCH):
            total += held[i : i + BATCH] @ self.probabilities(rows[i : i + BATCH])
        best = int(total.argmax())
        return self.languages[best], float(total[best] / max(1, held.sum()))

    def predict_all(self, texts: list[str]) -> list[tuple[str, float]]:
        """``predict`` for many texts, their windows batched together."""
        cut = [windows(t.encode("utf-8", "surrogatepass")) for t in texts]
        totals = np.zeros((len(texts), len(self.languages)))
        rows = np.concatenate([r for r, _ in cut]) if cut else np.zeros((0, WINDOW), np.uint8)
        held = np.concatenate([h for _, h in cut]) if cut else np.zeros(0)
        owner = np.repeat(np.arange(len(texts)), [len(h) for _, h in cut])
        for i in range(0, len(rows), BATCH):
            part = slice(i, i + BATCH)
            np.add.at(totals, owner[part], self.probabilities(rows[part]) * held[part, None])
        sizes = np.bincount(owner, held, len(texts))
        best = totals.argmax(axis=1)
        return [(self.languages[b], float(t[b] / max(1, s))) for b, t, s in zip(best, totals, sizes, strict=True)]


def fit(rows: np.ndarray, labels: list[str], epochs: int = EPOCHS, seed: int = 5) -> ByteNet | None:
    """Train on labelled windows, for ``MIN_STEPS`` steps at least; None without any."""
    languages = sorted(set(labels))
    if not languages:
        return None
    net, rng = ByteNet.fresh(languages, seed), np.random.default_rng(seed)
    number = {lang: i for i, lang in enumerate(languages)}
    truth = np.array([number[lang] for lang in labels])
    slow = [np.zeros_like(p) for p in net.parameters]
    fast = [np.zeros_like(p) for p in net.parameters]
    step = 0
    for _ in range(max(epochs, -(-MIN_STEPS // -(-len(rows) // BATCH)))):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            part, step = order[i : i + BATCH], step + 1
            for p, g, m, v in zip(net.parameters, net.gradients(rows[part], truth[part]), slow, fast, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def training_rows(docs: DataFrame, max_texts: int = MAX_TEXTS) -> DataFrame:
    """About ``max_texts`` (text, lang), evenly from the languages."""
    known = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    known = known.where(~held_out(F.col("doc_id")))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return known.select("text", "lang")
    each = max_texts / len(counts)
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, each / n)).otherwise(share)
    place = F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    return known.where(place < share).select("text", "lang")


def training_windows(rows: DataFrame) -> DataFrame:
    """At most ``WINDOWS_A_TEXT`` windows of each text, chosen by its bytes, as (lang, window)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, cut = [], []
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                own, _ = windows(raw)
                rng = np.random.default_rng(zlib.crc32(raw))
                for i in rng.permutation(len(own))[:WINDOWS_A_TEXT]:
                    langs.append(lang)
                    cut.append(own[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(cut, pa.binary())], names=["lang", "window"])

    return rows.select("text", "lang").mapInArrow(run, "lang string, window binary")


def fit_network(docs: DataFrame) -> ByteNet | None:
    """A network of a bounded sample: only its windows come to the driver, a few hundred bytes each."""
    found = sorted((r.lang, bytes(r.window)) for r in training_windows(training_rows(docs)).toLocalIterator())
    rows = np.frombuffer(b"".join(w for _, w in found), dtype=np.uint8).reshape(len(found), WINDOW)
    return fit(rows, [lang for lang, _ in found])


def predict_languages(docs: DataFrame, net: ByteNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score for every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lettered = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            found = [(UNDETERMINED, 0.0)] * len(texts)
            if net is not None:
                at = [i for i, known in enumerate(lettered) if known]
                while at:  # texts of a few megabytes together, or a longer one alone
                    n, size = 0, 0
                    while n < len(at) and (not n or size + len(texts[at[n]]) <= 2_000_000):
                        size += len(texts[at[n]])
                        n += 1
                    for i, x in zip(at[:n], net.predict_all([texts[i] for i in at[:n]]), strict=True):
                        found[i] = x
                    del at[:n]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    picked = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    return picked.mapInArrow(run, "doc_id long, lang_pred string, score double")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict_languages(docs, fit_network(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
