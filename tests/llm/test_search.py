"""Hard negatives, token files and lexical search against plain versions."""

from __future__ import annotations

import io
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from conftest_llm import awkward
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripstar.llm import hard_negatives, lexical, token_files
from tripstar.llm.queries import QUERIES
from tripstar.session import scratch_dir

VECTORS = "vec_id long, label long, embedding array<double>"


def plain_negatives(rows: list[tuple], every: int, low: int = 50, high: int = 95) -> list[tuple]:
    """Over all pairs: (anchor, positive, rank, negative, both scores), in plain whole numbers."""
    use = {
        (i, y, tuple(int(np.floor(256 * x)) for x in v))
        for i, y, v in rows
        if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    out = []
    for i, y, v in use:
        if i % every:
            continue
        others = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, z) for j, z, w in use if j != i and len(w) == len(v)]
        for minus, j, _ in sorted(o for o in others if o[2] == y)[:5]:
            fits = sorted(o for o in others if o[2] != y and low * -minus <= 100 * -o[0] <= high * -minus)
            out += [(i, j, k + 1, n, -minus, -s) for k, (s, n, _) in enumerate(fits[:3])]
    return sorted(out)


def mined(spark, rows: list[tuple], every: int, **kwargs) -> list[tuple]:
    table = spark.createDataFrame(rows, VECTORS).withColumns({"row": F.lit("x"), "cell": F.lit(1), "rank": F.lit(2)})
    given = hard_negatives.numbers(table, "vec_id", F.col("label"), "embedding")
    found = hard_negatives.mine(given, F.col("id") % every == 0, **kwargs)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("dims,spread", [(8, 1.0), (3, 0.05), (1, 1.0)])
def test_negatives_against_all_pairs(spark, monkeypatch, dims, spread):
    # small cells, shards and waves, so that anchors take several waves, pieces and parts
    for name, value in (("CELL_ROWS", 16), ("SHARD_ROWS", 40), ("FIRST_ROWS", 20), ("GROWTH", 3), ("PART_VISITS", 5)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(6, dims))
    rows = [(i, int(rng.integers(4)), (centres[rng.integers(6)] + spread * rng.normal(size=dims)).tolist()) for i in range(300)]
    rows += [(1000 + i, 1, rows[7][2]) for i in range(60)]  # many ties, in one cell
    assert mined(spark, rows, 10) == plain_negatives(rows, 10)


def test_negatives_awkward(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.6, 0.4]), (3, 2, [0.5, 0.5]), (4, 2, [0.5, 0.5]),
        (5, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (6, 1, None), (7, 1, [1.0, None]), (8, 1, [inf, 1.0]), (9, 1, [nan, 1.0]),
        (10, 1, []), (11, 2, []), (20, 1, []), (12, 1, [1.0, 2.0, 3.0]), (30, 7, [0.0, 0.0]), (31, 7, [-1.0, 0.0]),
        (40, 1, [-1.0, -1.0]), (1, 2, [0.7, 0.3]), (0, 2, [0.3, 0.3]), (50, 3, [1e300, -1e300]), (51, 3, [1e300, 1.0]), (60, 4, [1.0, 1.0]),
    ]
    plain = [r for r in rows if r[0] not in (50, 51)]
    huge = (50, 51)
    ours = mined(spark, rows, 10)
    assert all(abs(s) < 1 << 63 for r in ours for s in r[4:])
    assert [r for r in ours if r[0] not in huge and not {r[1], r[3]} & set(huge)]
    assert mined(spark, plain, 10) == plain_negatives(plain, 10)
    assert mined(spark, [], 10) == [] and mined(spark, plain[:1], 10) == []


def test_cells_come_in_order_of_their_bounds():
    rng = np.random.default_rng(5)
    sample = np.floor(rng.normal(size=(400, 6)) * 256)
    books = hard_negatives.Books.of(sample, 5)
    (a, far_a), (b, far_b) = books.cells(sample)
    for radii, at, far in zip(books.radii, (a, b), (far_a, far_b), strict=True):
        np.maximum.at(radii, at, far)
    for v in sample[:20]:
        cells = list(hard_negatives.cells_in_order(books.bounds(v)))
        assert len({c[1:] for c in cells}) == len(cells) == len(books.words[0]) * len(books.words[1])
        assert all(x[0] >= y[0] for x, y in zip(cells, cells[1:], strict=False))
        bound = {c[1:]: c[0] for c in cells}
        assert all(score <= bound[i, j] for score, i, j in zip(sample @ v, a, b, strict=True))


def test_products_beyond_doubles():
    a = np.array([[1 << 40, 3], [(1 << 62) - 1, 1 << 62]], dtype=np.int64)
    assert hard_negatives.products(a, a).tolist() == [[(1 << 63) - 1 if (1 << 80) > 1 << 63 else 0, (1 << 63) - 1], [(1 << 63) - 1] * 2]
    b = np.array([[(1 << 30) + 1, 5]], dtype=np.int64)
    assert hard_negatives.products(b, b).tolist() == [[((1 << 30) + 1) ** 2 + 25]]


# token files


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))


def plain_ids(library, text: str | None) -> list[int]:
    return [*library.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]


def expected(library, rows: list[tuple]) -> list[tuple]:
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = plain_ids(library, text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_token_query(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = sorted(map(tuple, QUERIES["op12_token_files"](spark, sf_dir).collect()))
    assert found == expected(library, [tuple(r) for r in docs])


def test_words_encode_as_whole_texts(library):
    rng = random.Random(4)
    blanks = [chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x202F, 0x3000, 0x200B)]
    bits = ["don't", "'ll", "Zoë", "é", "́", "ΣΑΣ", "漢字", "😀", "42", "...", "<|endoftext|>", "<|START", "x" * 90, "I'M", "ẛ̣"]
    encoder = token_files.WordEncoder(token_files.VOCABULARY, 40)
    for _ in range(300):
        text = "".join(rng.choice(blanks if rng.random() < 0.45 else bits) for _ in range(rng.randint(0, 40)))
        got = np.frombuffer(b"".join(encoder.encode(text)), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, repr(text)
    long = " ".join(f"word{i % 97}" for i in range(2000))
    assert [len(p) for p in encoder.pieces(long, 500)] and "".join(encoder.pieces(long, 500)) == long


def packed_file(docs: list[tuple], frame_ids: int) -> bytes:
    sink = io.BytesIO()
    writer = token_files.Writer(sink, frame_ids)
    for doc_id, ids in docs:
        raw = np.array(ids, dtype="<u4").tobytes()
        writer.add(doc_id, iter([raw[i : i + 44] for i in range(0, len(raw), 44)]))
    writer.close()
    return sink.getvalue()


def test_file_format():
    rng = random.Random(9)
    docs = [(i if i % 9 else None, [rng.randrange(50_000) for _ in range(rng.choice([0, 1, 7, 60, 500]))]) for i in range(120)]
    raw = packed_file(docs, 100)
    # any reader of the format can decompress the whole
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert whole == b"".join(np.array(ids, dtype="<u4").tobytes() for _, ids in docs)
    reader = token_files.Reader(pa.BufferReader(raw))
    assert [(i, n, c) for i, _, n, c in reader.documents()] == [
        (i, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())) for i, ids in docs
    ]
    assert max(f.size for f in reader.frames) <= 400
    places = np.cumsum([0, *[len(ids) for _, ids in docs]])
    for k in (3, 50, 119):
        lone = token_files.Reader(pa.BufferReader(raw))
        got = list(lone.ids(int(places[k]), len(docs[k][1])))
        assert (np.concatenate(got).tolist() if got else []) == docs[k][1]
        assert lone.read_bytes < len(raw) / 3  # only the frames of the document and the seek table
    assert list(token_files.Reader(pa.BufferReader(packed_file([], 100))).documents()) == []


@pytest.mark.parametrize("where", ["frame", "list", "table", "end"])
def test_damage_is_found(where):
    raw = bytearray(packed_file([(i, list(range(i, i + 50))) for i in range(20)], 100))
    reader = token_files.Reader(pa.BufferReader(bytes(raw)))
    at = {"frame": reader.frames[2].at + 20, "list": reader.list_end - 30, "table": len(raw) - 12, "end": len(raw) - 1}[where]
    raw[at] ^= 0x55
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.Reader(pa.BufferReader(bytes(raw))).documents())


def test_token_files_awkward(spark, clashing, no_docs, library):
    folder = scratch_dir(spark, "tokens")
    manifest = token_files.write_files(clashing, folder, file_bytes=3000, frame_ids=64)
    assert manifest.count() > 3
    read = token_files.read_files(manifest).join(token_files.file_starts(manifest), "part")
    found = read.select("doc_id", F.col("before") + F.col("place"), "n_tokens", "ids_crc32").collect()
    rows = [(r[0], r[1]) for r in awkward()]
    assert sorted(map(tuple, found), key=str) == sorted(expected(library, rows), key=str)
    ids = {r.doc_id: r.ids for r in token_files.fetch(manifest, F.col("doc_id").isin(4, 9, 10, 11)).collect()}
    texts = dict(rows)
    assert ids == {i: plain_ids(library, texts[i]) for i in (4, 9, 10, 11)}
    none = token_files.write_files(no_docs, scratch_dir(spark, "tokens"))
    assert none.count() == 0 and token_files.read_files(none).count() == 0


def test_files_of_dead_attempts_are_not_read(spark, awkward_docs):
    folder = scratch_dir(spark, "tokens")
    token_files.write_files(awkward_docs, folder)  # as an attempt that was lost after it wrote
    manifest = token_files.write_files(awkward_docs, folder)
    assert token_files.read_files(manifest).count() == awkward_docs.count()


# ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text: str | None) -> list[str]:
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(items: dict, docs: list[tuple], k: int = 10) -> list[tuple]:
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items.items():
        found = []
        for doc_id, counts in held:
            m = 100 - 75 + 75 * sum(counts.values()) * n_docs // total
            score = sum(
                int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df[t] + 1)))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in plain_terms(text)
                if t in counts
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("k,max_terms", [(10, 10**6), (3, 30_000), (1000, 10**6)])
def test_search_against_all_pairs(spark, clashing, monkeypatch, k, max_terms):
    monkeypatch.setattr(lexical, "SALTS", 2)
    docs = [(r[0], r[1]) for r in awkward()]
    texts = [t for _, t in docs if t]
    items = {i: " ".join(t.split()[2:14]) for i, t in enumerate(texts)}
    items |= {90: None, 91: "", 92: "é ß 漢字 ENDE ende ende", 93: "nowhere at all", 94: "x" * 100_000}
    rows = [*items.items(), (None, "one two"), (92, "é ß 漢字 ENDE ende ende"), (93, None)]
    table = spark.createDataFrame(rows, "item_id long, text string").withColumns({"id": F.lit(3), "rank": F.lit(4), "score": F.lit(5)})
    found = lexical.search(table, clashing, k=k, max_terms=max_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_search(items, docs, k)


def test_search_of_nothing(spark, clashing, no_docs):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert lexical.search(items, no_docs).count() == 0
    assert lexical.search(items.limit(0), clashing).count() == 0


def test_heaps_keep_the_best_whatever_the_order():
    rng = random.Random(2)
    rows = [(rng.randrange(9) or None, rng.randrange(5)) for _ in range(400)]
    want = sorted(((-s, i is None, i or 0) for i, s in rows if s > 0))[:7]
    for size in (1, 13, 400):
        rng.shuffle(rows)
        heaps = lexical.Heaps(1, 7)
        for a in range(0, 400, size):
            part = rows[a : a + size]
            heaps.take([i for i, _ in part], np.array([[s] for _, s in part]))
        assert sorted((-s, i is None, i or 0) for _, i, s in heaps.rows()) == want
