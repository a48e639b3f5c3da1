"""Tokens, packing, rollups and mixing against plain versions."""

from __future__ import annotations

import collections
import random
import struct
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripstar.llm import mixing, packing, token_rollups
from tripstar.llm.common import stored
from tripstar.llm.queries import QUERIES
from tripstar.llm.tokens import Counter, Encoder
from tripstar.session import scratch_dir

ODD = [
    "", " ", "  ", "a  b   c", " lead", "trail ", "x\n \nfoo  bar", "a<|endoftext|> b", "é  b", "\x1c a", "a\x1c b",
    "don't  'll it's", "x\t y 　 z", "\x85 \x85a b", "a​ b", "1 22 333 ,, .. !! 漢 字 😀 😀",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(library, text: str) -> list[int]:
    return library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("cached", [0, 5, 10**6])
def test_cut_encoding_equals_the_library(spark, sf_dir, library, cached):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    encoder = Encoder(packing.RANKS, packing.END_OF_TEXT_ID, cached)
    for _ in range(2):
        for text, raw in zip(texts, encoder.encode(texts), strict=True):
            assert list(struct.unpack(f"<{len(raw) // 4}I", raw)) == ids_of(library, text)
    counter = Counter((packing.RANKS,), cached)
    assert [counter.count(t)[0] for t in texts if "<|" not in t] == [len(ids_of(library, t)) for t in texts if "<|" not in t]


def check_packing(rows, texts: dict, library, capacity: int = packing.CAPACITY) -> int:
    pieces, bins = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for doc_id, own in pieces.items():
        ids = [*ids_of(library, texts[doc_id] or ""), 0]
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert own[0].start == 0 and all(a.start + a.length == b.start for a, b in zip(own, own[1:], strict=False))
        assert sum(r.length for r in own) == len(ids) and all(r.length == capacity for r in own[1:])
        for r in own:
            part = ids[r.start : r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        assert own[0].offset == 0 and all(a.offset + a.length == b.offset for a, b in zip(own, own[1:], strict=False))
        assert own[-1].offset + own[-1].length <= capacity
    return len(bins)


def test_packing_query(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op6_best_fit_packing"](spark, sf_dir).collect()
    bins = check_packing(rows, texts, library)
    assert bins <= -(-sum(r.length for r in rows) // packing.CAPACITY) + 2


def test_genetic_search_beats_best_fit():
    # triples of exactly the capacity: best fit decreasing opens more bins than needed
    rng = random.Random(3)
    sizes = []
    for _ in range(20):
        a, b = rng.randint(26, 50), rng.randint(26, 40)
        sizes += [a, b, 100 - a - b]
    greedy = packing.best_fit(sizes, list(range(60)), [], 100)
    best = packing.evolve(sizes, [greedy], 100, [1], 60, 8)
    assert sorted(i for b in best for i in b) == list(range(60))
    assert all(sum(sizes[i] for i in b) <= 100 for b in best)
    assert len(best) <= len(greedy) and packing.fitness(best, sizes, 100) > packing.fitness(greedy, sizes, 100)
    child = packing.crossover(greedy, best, sizes, 100, __import__("numpy").random.default_rng(0))
    assert sorted(i for b in child for i in b) == list(range(60))


def test_islands_and_migration(spark):
    sizes = [51, 27, 22] * 8 + [49, 30, 21] * 8
    rows = [(i, 0, 0, s, i) for i, s in enumerate(sizes)]
    pieces = stored(spark.createDataFrame(rows, packing.PIECES), "pieces")
    packed = packing.pack(pieces, capacity=100, group_items=24, islands=3, epochs=2).collect()
    assert sorted(r.doc_id for r in packed) == list(range(48))
    fill = collections.Counter()
    for r in packed:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 100 and len(fill) <= 18


def test_packing_awkward(spark, clashing, no_docs, library):
    rows = packing.pack(stored(packing.tokenised_pieces(clashing), "pieces")).collect()
    by_id = collections.Counter(r.doc_id for r in rows if r.piece == 0)
    assert by_id == collections.Counter(r.doc_id for r in clashing.collect())
    assert {(r.length, r.doc_id) for r in rows if r.doc_id in (4, 5)} == {(1, 4), (1, 5)}
    once = [r for r in rows if by_id[r.doc_id] == 1]
    for r in once:
        assert r.length <= 2048
    assert packing.pack(stored(packing.tokenised_pieces(no_docs), "pieces")).count() == 0


def test_rollups_against_recount(spark):
    ledger = token_rollups.TokenLedger(spark, scratch_dir(spark, "ledger"))
    state, rng = {}, random.Random(8)
    encoders = {n: Encoder(f, None).encoding for n, f in token_rollups.TOKENIZERS.items()}
    for batch in range(4):
        changes = []
        for seq in range(30):
            doc, op = rng.randrange(20), rng.choice(["insert", "revise", "delete"])
            changes.append((doc, op, " ".join(rng.choices("a bb  the cat <|endoftext|> é".split(" "), k=9)),
                            rng.choice(["s", None]), rng.choice(["en", None]), seq))
        for doc, op, text, source, lang, _ in changes:
            state.pop(doc, None)
            if op != "delete":
                state[doc] = (text, source, lang)
        frame = spark.createDataFrame(changes, "doc_id long, op string, text string, source string, lang string, seq long")
        assert ledger.commit(f"b{batch}", frame)
        assert not ledger.commit(f"b{batch}", frame)
        want = collections.defaultdict(lambda: [0, 0])
        for text, source, lang in state.values():
            for name, e in encoders.items():
                own = want[source, lang, name]
                own[0] += 1
                own[1] += len(e.encode_ordinary(text))
        found = {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens] for r in ledger.totals().collect()}
        assert found == dict(want)


def test_rollups_leave_dead_attempts_out(spark):
    ledger = token_rollups.TokenLedger(spark, scratch_dir(spark, "ledger"))
    ddl = "doc_id long, op string, text string, source string, lang string"
    frame = spark.createDataFrame([(1, "insert", "one two", "s", "en"), (None, "insert", None, "s", "en")], ddl)
    spark.createDataFrame([("s", "en", "byte_bpe_50k", 9, 9)], token_rollups.ROLLUPS.rpartition(",")[0]).write.parquet(
        ledger._folder("rollups", "died"))
    ledger.commit("a", frame.limit(0))
    assert ledger.totals().count() == 0
    ledger.commit("b", frame)
    assert {(r.tokenizer, r.n_docs) for r in ledger.totals().collect()} == {(n, 2) for n in token_rollups.TOKENIZERS}


def test_rollups_query(spark, sf_dir):
    """After inserts, revisions, deletes and inserts again the totals are those of the table."""
    encoders = {n: Encoder(f, None).encoding for n, f in token_rollups.TOKENIZERS.items()}
    want = collections.defaultdict(lambda: [0, 0])
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        for name, e in encoders.items():
            own = want[r.source, r.lang, name]
            own[0] += 1
            own[1] += len(e.encode_ordinary(r.text or ""))
    rows = QUERIES["op9_token_rollups"](spark, sf_dir).collect()
    assert {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens] for r in rows} == dict(want)


def test_rollups_awkward(spark, clashing, no_docs):
    """Clashing columns, a very long text, repeated rows, nulls, and an attempt that commits late."""
    ledger = token_rollups.TokenLedger(spark, scratch_dir(spark, "ledger"))
    assert ledger.commit("0", clashing.withColumns({"op": F.lit("insert"), "n_docs": F.lit(5), "attempt": F.lit("x"), "bucket": F.lit(1)}))
    rows = {(r.doc_id, r.text, r.source, r.lang) for r in clashing.collect()}  # the repeated row counts once
    e = Encoder(token_rollups.TOKENIZERS["byte_bpe_50k"], None).encoding
    want = collections.defaultdict(lambda: [0, 0])
    for _, text, source, lang in rows:
        want[source, lang][0] += 1
        want[source, lang][1] += len(e.encode_ordinary(text or ""))
    before = ledger.totals()
    found = {(r.source, r.lang): [r.n_docs, r.n_tokens] for r in before.where("tokenizer = 'byte_bpe_50k'").collect()}
    assert found == dict(want)
    # a second attempt of the batch that commits after the first changes nothing
    spark.createDataFrame([("0", "0" * 32, 99)], token_rollups.COMMITS).write.mode("append").parquet(f"{ledger.path}/commits")
    again = token_rollups.TokenLedger(spark, ledger.path)
    assert sorted(map(str, again.totals().collect())) == sorted(map(str, before.collect()))
    assert again.commit("1", no_docs.withColumn("op", F.lit("insert"))) and again.totals().count() == before.count()


def test_flow_reroutes_overlapping_sources():
    # what both sources share goes to the one that has nothing else
    patterns = [(("a",), 10), (("a", "b"), 10)]
    flow = mixing.route(patterns, {"a": 10, "b": 10})
    assert dict(flow[0]) == {"a": 10} and flow[1]["b"] == 10 and flow[1]["a"] == 0
    # a second pass only where the first cannot serve
    flow = mixing.route(patterns, {"a": 25, "b": 10})
    assert sum(flow[0].values()) + sum(flow[1].values()) == 35 and flow[0]["a"] <= 20
    assert sum(mixing.route([((None,), 5)], {None: 99})[0].values()) == 10


def test_flow_is_maximal_and_cheapest():
    rng = random.Random(2)
    for _ in range(30):
        sources = ["a", "b", "c"]
        patterns = [(tuple(rng.sample(sources, rng.randint(1, 3))), rng.randint(0, 5)) for _ in range(4)]
        quotas = {s: rng.randint(0, 12) for s in sources}

        def most(passes: int, patterns=patterns, quotas=quotas) -> int:  # by subsets, as in Hall's theorem
            best = None
            for mask in range(8):
                left = [s for i, s in enumerate(sources) if mask >> i & 1]
                cut = sum(q for s, q in quotas.items() if s not in left) + sum(
                    passes * size for m, size in patterns if set(m) & set(left))
                best = cut if best is None else min(best, cut)
            return best

        for passes in (1, 2):
            flow = mixing.route(patterns, quotas, passes)
            assert sum(sum(f.values()) for f in flow) == most(passes)
        first = sum(min(sum(f.values()), size) for f, (_, size) in zip(flow, patterns, strict=True))
        assert first <= most(2)


def test_overlapping_mix_on_documents(spark):
    rows = [(i, ["a"] if i % 3 == 0 else ["a", "b"] if i % 3 == 1 else ["b", None], 1 + i % 7, f"{i * 7919 % 1000:08x}") for i in range(90)]
    sized = spark.createDataFrame(rows, "doc_id long, members array<string>, size long, place string")
    out = mixing.mix(sized, lambda sizes: {"a": 100, "b": 150, None: 40}).collect()
    assert len(out) == 90 and sum(r.taken for r in out) == 290
    assert all(0 <= r.taken <= 2 * r.size for r in out)


def test_mix_awkward(spark, clashing, no_docs):
    mixed = mixing.mixed_documents(clashing)
    assert mixed.columns == clashing.columns
    sized = mixing.sized_documents(clashing, F.array("source"))
    rows = mixing.mix_by_weight(sized).collect()
    assert len(rows) == clashing.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    taken, target = collections.Counter(), {}
    for r in rows:
        taken[r.members[0]] += r.taken
        target[r.members[0]] = r.target
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    sizes = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(mixing.n_words(F.col("text"))).alias("n")).collect()}
    longest = collections.Counter()
    for r in rows:
        longest[r.members[0]] = max(longest[r.members[0]], r.size)
    assert all(abs(sizes.get(s, 0) - n) <= longest[s] / 2 for s, n in taken.items())
    texts = collections.Counter(r.text for r in mixed.collect())
    assert set(texts) <= {r.text for r in clashing.collect()}
    assert mixing.mixed_documents(no_docs).count() == 0


def test_mix_takes_documents_whole(spark):
    texts = {i: "\n ".join(f"a{i}  b\tc{j}" for j in range(20)) for i in range(9)}
    rows = [(i, t, "s" if i % 3 else "r", len(t)) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    mixed = mixing.mixed_documents(docs).collect()
    assert all(r.text == texts[r.doc_id] and r.n_chars == len(r.text) for r in mixed)
    times = collections.Counter(r.doc_id for r in mixed)
    for r in mixing.mix_by_weight(mixing.sized_documents(docs, F.array("source"))).collect():
        assert times[r.doc_id] == (r.taken + r.size // 2) // r.size
