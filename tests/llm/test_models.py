"""Toxicity and language: held-out accuracy, gradients, and the defined cases."""

from __future__ import annotations

import numpy as np
from conftest_llm import is_held_out, text
from pyspark.sql import functions as F

from tripstar.llm import language, toxicity
from tripstar.llm.queries import QUERIES


def test_toxicity_finds_sentences_of_labelled_documents(spark):
    docs, labels = [], []
    for i in range(400):
        lines = text(i).split("\n")
        if i % 4 == 0:
            lines[i % 5] = lines[i % 5].replace(" ", " horrid ", 1)
        docs.append((i, "\n".join(lines)))
        labels.append((i, int(i % 4 == 0)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit_model(d, known)
    rows = {r.doc_id: r for r in toxicity.score_documents(d, model).collect()}
    wrong = [i for i, y in labels if (rows[i].score >= 0.3) != bool(y) and is_held_out(i)]
    assert len(wrong) <= 2
    spans = [docs[i][1][s.start : s.end] for i in range(0, 400, 4) for s in rows[i].sentences]
    assert len(spans) >= 95 and sum("horrid" in s for s in spans) >= 0.95 * len(spans)
    kept = toxicity.drop_toxic(d, model)
    assert kept.columns == d.columns and 290 <= kept.count() <= 310


def test_noisy_or_of_sentences():
    model = toxicity.Model({"bad": 3.0, "dire": 5.0}, -4.0)
    score, found = model.score("Fine. So bad! Dire, dire\nfine")
    p = [1 / (1 + np.exp(-z)) for z in (-1.0, 6.0)]
    assert abs(score - (1 - (1 - p[0]) * (1 - p[1]))) < 1e-9
    assert [s[:2] for s in found] == [(13, 24)]


def test_toxicity_awkward(spark, clashing, no_docs):
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1), (2, 0), (99, 0)], "doc_id long, toxic int")
    model = toxicity.fit_model(clashing, labels)
    rows = toxicity.score_documents(clashing, model).collect()
    assert len(rows) == clashing.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 for r in rows if r.doc_id in (4, 5, 6))
    assert toxicity.score_documents(no_docs, model).count() == 0
    nobody = toxicity.fit_model(no_docs, labels)
    assert all(r.score < 1e-6 for r in toxicity.score_documents(clashing, nobody).collect())
    assert toxicity.drop_toxic(clashing, nobody).count() == clashing.count()


def test_language_gradients():
    rng = np.random.default_rng(0)
    net = language.ByteNet.fresh(["a", "b", "c"])
    for name in ("embedding", "out", "out_shift"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.banks = [b.astype(np.float64) for b in net.banks]
    net.shifts = [b.astype(np.float64) for b in net.shifts]
    rows, labels = rng.integers(0, 256, (5, 40), dtype=np.uint8), np.array([0, 1, 2, 1, 0])

    def loss() -> float:
        return float(-np.log(net.probabilities(rows)[np.arange(5), labels]).mean())

    for p, g in zip(net.parameters, net.gradients(rows, labels), strict=True):
        flat, slope = p.reshape(-1), g.reshape(-1)
        for i in rng.choice(len(flat), 12):
            keep = flat[i]
            flat[i] = keep + 1e-6
            up = loss()
            flat[i] = keep - 1e-6
            down = loss()
            flat[i] = keep
            assert abs((up - down) / 2e-6 - slope[i]) < 1e-4


def test_language_windows_cover_whole_texts():
    raw = bytes(range(1, 256)) * 3
    rows, held = language.windows(raw)
    assert rows.tobytes()[: len(raw)] == raw and held.sum() == len(raw)
    net = language.ByteNet.fresh(["a", "b"])
    texts = ["abc", "é" * 1000, "word " * 5000]
    assert [(x, round(p, 6)) for x, p in net.predict_all(texts)] == [(x, round(p, 6)) for x, p in map(net.predict, texts)]


def test_language_query_held_out(spark, sf_dir):
    found = QUERIES["op5_language_id"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    joined = docs.select("doc_id", "lang").join(found, "doc_id").where("lang IS NOT NULL")
    right, n = joined.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right > 0.9
    assert all(r.held_out == is_held_out(r.doc_id) for r in found.collect())


def test_language_awkward(spark, clashing, no_docs):
    net = language.fit_network(clashing)
    rows = {}
    for r in language.predict_languages(clashing, net).collect():
        rows.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert rows[4] == rows[5] == rows[6] == [("und", 0.0)] and len(rows[3]) == 2
    assert {x for v in rows.values() for x, _ in v} <= {"en", "de", "fr", "und"}
    assert language.fit_network(no_docs) is None
    assert {r.lang_pred for r in language.predict_languages(clashing, None).collect()} == {"und"}
    assert language.predict_languages(no_docs, net).count() == 0


def test_toxicity_query(spark, sf_dir):
    rows = QUERIES["op3_toxicity"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.predicted == int(r.score >= 0.3) and r.held_out == is_held_out(r.doc_id) for r in rows)
