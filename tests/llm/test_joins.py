"""The n-gram join, nearest neighbours and the pipeline against plain versions."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import SCHEMA, text
from pyspark.sql import functions as F

import corpus_pipeline
from tripstar.llm import graph, nearest, ngram_join, shingles
from tripstar.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text: str | None, width: int) -> frozenset:
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    width = min(width, len(w))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if w else frozenset()


def plain_components(rows: list[tuple], width: int, percent: int) -> list[tuple]:
    sets, label = [shingle_set(t, width) for _, t in rows], list(range(len(rows)))

    def root(x: int) -> int:
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    least: dict = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(((d, len(s), least.get(root(i), d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def copies(seed: int, n: int, edits: int) -> list[str]:
    rng, out = random.Random(seed), []
    base = text(seed, 6).split(" ")
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(len(own))] = rng.choice(["zq", "xv", "the"]) + str(rng.randint(0, 3))
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (1, 70), (2, 100)])
def test_components_against_all_pairs(spark, width, percent):
    rng = random.Random(width)
    texts = [t for s in range(5) for t in copies(s, 40, 12)] + [None, "", "a", "A", "a b", "a  b", "the end"] + [text(99)] * 6
    chain = text(7, 3).split(" ")
    for i in range(30):  # each link of a chain is near its neighbours only
        chain[i % len(chain)] = f"new{i}"
        texts.append(" ".join(chain))
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(3, texts[8]), (None, texts[9])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_components(docs, width, percent).collect()), key=str)
    assert found == plain_components(rows, width, percent)


def test_shingles_are_those_of_the_words(monkeypatch):
    texts = [text(3), "A a  a\ta", "é É ß", "x" * 5000 + " y " + "z" * 700, "", " "]
    whole = [shingles.shingle_set(t, 2) for t in texts]
    assert [len(s) for s in whole] == [len(shingle_set(t, 2)) for t in texts]
    shingles._powers.cache_clear()
    monkeypatch.setattr(shingles, "STRETCH", 64)  # words over a stretch are hashed by themselves
    assert [len(shingles.shingle_set(t, 2)) for t in texts] == [len(s) for s in whole]
    assert set(shingles.shingle_set("Long tail of words " * 9, 2)) == set(shingles.shingle_set("long TAIL of words " * 9, 2))
    shingles._powers.cache_clear()


def test_join_awkward(spark, clashing, no_docs):
    found = collections.Counter((r.doc_id, r.component_id) for r in ngram_join.ngram_components(clashing).collect())
    assert found[0, 0] == found[1, 0] == 1 and found[3, 3] == 2 and found[4, 4] == 1
    kept = ngram_join.one_of_each_group(clashing)
    assert kept.columns == clashing.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 not in ids and ids.count(3) == 1 and {4, 5, 6, 7, 8, None} <= set(ids)
    assert ngram_join.ngram_components(no_docs).count() == ngram_join.one_of_each_group(no_docs).count() == 0


def test_one_of_each_group_tells_rows_of_one_id_apart(spark):
    one, two, three = text(1), text(2), text(3)
    near = three.replace(three.split()[3], "zzz", 1)
    rows = [(1, one), (2, one), (2, two), (3, three), (3, near), (3, two + "\nquite another line of words here.")]
    kept = ngram_join.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = collections.Counter(r.doc_id for r in kept)
    # text two is left under id 2, and one of the two near texts of id 3
    assert (2, two) in [tuple(r) for r in kept] and (2, one) not in [tuple(r) for r in kept]
    assert sum(r.text in (three, near) for r in kept) == 1 and found[1] == 1


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (160, 300), (300, 159)]
    rng.shuffle(edges)
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in [*range(100, 161), 300]}}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def plain_nearest(ids, vectors, query, k=10):
    d = np.sqrt(((vectors - vectors[query]) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, d)) if i != query][:k]
    return [(int(ids[i]), float(d[i])) for i in order]


def test_nearest_query_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    found = collections.defaultdict(list)
    for r in QUERIES["op7_nearest_neighbours"](spark, sf_dir).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    hits = 0
    for q in np.flatnonzero(ids % 100 == 0):
        own, want = sorted(found[ids[q]]), plain_nearest(ids, vectors, q)
        assert [r for r, _, _ in own] == list(range(1, 11))
        true = {int(i): float(np.sqrt(((vectors[n] - vectors[q]) ** 2).sum())) for n, i in enumerate(ids)}
        assert all(score == true[i] for _, i, score in own) and len({i for _, i, _ in own}) == 10
        hits += len({i for _, i, _ in own} & {i for i, _ in want})
    assert hits >= 0.9 * 10 * len(found) and len(found) == sum(ids % 100 == 0)


def test_nearest_awkward(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 40)
    monkeypatch.setattr(nearest, "CELL_ROWS", 50)
    rng, nan, inf = np.random.default_rng(0), float("nan"), float("inf")
    good = [(i, rng.standard_normal(8).tolist()) for i in range(150)]
    same = [(1000 + i, [1.0] * 8) for i in range(300)]  # a common vector
    bad = [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [nan] * 8), (2004, [inf] + [0.0] * 7), (2005, [None] * 8), (None, [2.0] * 8)]
    other = [(2100, [1.0, 2.0]), (2200, [1.0, 2.5])]
    rows = good + same + bad + other + [good[5]]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, cell string")
    index = nearest.Search(table)
    found = collections.defaultdict(list)
    for r in index.nearest(F.col("id") % 100 == 0).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(found) == {0, 100, 1000, 1100, 1200, 2100, 2200}
    assert [i for _, i, _ in sorted(found[1100])] == list(range(1000, 1010))
    assert [i for _, i, _ in sorted(found[1000])] == list(range(1001, 1011))
    assert [i for _, i, _ in found[2100]] == [2200] and all(len(found[q]) == 10 for q in (0, 100))
    ids, vectors = np.array([i for i, _ in good + same]), np.array([v for _, v in good + same])
    hits = sum(len({i for _, i, _ in found[q]} & {i for i, _ in plain_nearest(ids, vectors, n)}) for q, n in ((0, 0), (100, 100)))
    assert hits >= 18
    none = nearest.Search(table.limit(0))
    assert none.nearest(F.col("id") % 100 == 0).count() == 0


def test_chi_square_quantile():
    assert abs(nearest.chi_square_quantile(0.95) - 12.5916) < 1e-3
    assert abs(nearest.chi_square_quantile(0.99, 2) - 9.2103) < 1e-3


def planted_copies(n: int = 5) -> list[tuple]:
    """Pairs of one-line documents that differ in a run of 8 of 120 words: too much for the line
    stage (one word in twenty), while their 5-word shingles have a similarity of 104 / 128."""
    rows = []
    for i in range(n):
        words = [w for k in range(12) for w in text(9000 + 20 * i + k, 1, 14).split()][:120]
        other = words[:50] + [f"q{i}w{k}x" for k in range(8)] + words[58:]
        rows += [(9000 + 2 * i + k, " ".join(w), "en", "planted", len(" ".join(w))) for k, w in enumerate((words, other))]
    return rows


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(planted_copies(), SCHEMA))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "mixing", "packing"]
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        sizes.append(docs.count())
        left = {r.doc_id for r in docs.where("doc_id >= 9000").select("doc_id").distinct().collect()}
        if len(sizes) == 3:
            assert left == {9000, 9002, 9004, 9006, 9008}
        elif len(sizes) < 3:
            assert len(left) == 10
    assert sizes[0] > sizes[1] > sizes[2] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.where("piece = 0").count() == sizes[3]
    assert corpus_pipeline.run(spark, sf_dir).where("piece = 0").count() > 0


def test_pipeline_stages_against_plain_versions(spark, sf_dir):
    from test_cleaning import plain_dedup

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.length("text") < 1500).limit(60)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    deduped = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, sf_dir).collect()}
    assert deduped == {i: t for i, t in plain_dedup(rows, 2, 30).items() if t.strip()}
    groups = {d: c for d, _, c in plain_components(rows, 5, 80)}
    kept = {r.doc_id for r in corpus_pipeline.ngram_join(spark, docs, sf_dir).collect()}
    assert kept == {d for d, c in groups.items() if d == c}


def test_pipeline_awkward(spark, sf_dir, clashing, no_docs):
    for start in (clashing, no_docs):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "stage")
        assert (docs.count() == 0) == (start is no_docs)
    assert SCHEMA


def test_sets_are_made_of_few_texts_at_a_time():
    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(1500)])], names=["text"])
    parts = list(ngram_join._few(iter([batch, batch.slice(0, 0), batch.slice(0, 3)])))
    assert max(p.num_rows for p in parts) <= ngram_join.ROWS_AT_ONCE
    assert [t for p in parts for t in p.column(0).to_pylist()] == [str(i) for i in [*range(1500), 0, 1, 2]]
