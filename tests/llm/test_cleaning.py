"""Personal data, line quality and line deduplication against plain versions."""

from __future__ import annotations

import collections
import hashlib
import re

import pytest
from oracle_compare import connect, differences
from pyspark.sql import functions as F

from tripstar.llm import line_dedup, line_quality, pii
from tripstar.llm.queries import CHECKS, QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def passes(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text: str | None) -> list[tuple]:
    found = [(m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text or "") if passes(kind, m[0])]
    return sorted(found)


PRIVATE = [
    None, "", "mail a.b+c@x-y.org and q@r.s.t.. or @bad a@b", "a@b.c%d@e.f x@y.z@w.v",
    "at 1.2.3.4.5.6.7.8 and 300.1.1.1 and 010.001.000.255", "v1.2.3.4 0001.2.3.4",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 5500000000000004 7", "4" * 16 + " " + "0" * 16,
    "call +1 (269) 555-3296 or +12 3 4567890123456 +1+2 +44.20.7946.0958", "é😀 +1 (269) 555-3296 ß a@b.cd",
    "1 2 3 4 5 6 7 8 9 0 " * 3000, "a." * 30000 + "@" + "b." * 20000, "9" * 50000, "+1" + "(" * 20000,
    "write to jane.doe at example dot com please", "phone: (269) 555-3296.", "ref (269) 555-32967",
]


def test_base_spans(spark):
    rows = spark.createDataFrame(list(enumerate(PRIVATE)), "doc_id long, text string")
    found = rows.select("doc_id", pii.listed(pii.base_spans(F.coalesce("text", F.lit("")))).alias("s")).collect()
    want = {i: ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in base_spans(t)) for i, t in enumerate(PRIVATE)}
    assert {r.doc_id: r.s for r in found} == want


def test_method_adds_spans_and_keeps_base(spark, clashing):
    many = [(i, f"phone: (269) 555-{1000 + i}. Mail me at box{i}@mail.example.com, call +1 269 555 {1000 + i}")
            for i in range(200)]
    docs = spark.createDataFrame([*many, *[(1000 + i, t) for i, t in enumerate(PRIVATE)]], "doc_id long, text string")
    patterns = pii.vote_patterns(docs)
    assert patterns.agg(F.sum("n")).first()[0] > 600
    model = pii.fit_spans(patterns)
    found = pii.find_spans(docs, model).select("doc_id", pii.listed(F.col("base")).alias("b"), pii.listed(F.col("spans")).alias("s"))
    rows = {r.doc_id: (r.b, r.s) for r in found.collect()}
    assert all(set(b.split(",")) <= set(s.split(",")) for b, s in rows.values() if b)
    assert sum(s != b for b, s in rows.values()) >= 200  # the numbers without a country code
    none = pii.find_spans(clashing, pii.fit_spans(pii.vote_patterns(clashing.limit(0))))
    assert none.count() == clashing.count()


def test_personal_data_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op1_personal_data"](spark, sf_dir).collect():
        spans = base_spans(texts[r.doc_id])
        listed = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        counts = collections.Counter(kind for _, _, kind, _ in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [counts[k] for k in PATTERNS]


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, sf_dir, name):
    assert differences(connect(sf_dir), CHECKS[name], QUERIES[name](spark, sf_dir)) == []


def repeated(text: str) -> int:
    w = WORD.findall(text)
    windows = list(zip(w, w[1:], w[2:], strict=False))
    n = collections.Counter(windows)
    return len({i + j for i, x in enumerate(windows) if n[x] > 1 for j in range(3)})


def test_line_quality_measures(spark, clashing, no_docs):
    rows = clashing.collect()
    found = collections.Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        for r in line_quality.clean_lines(clashing).collect()
    )
    want = collections.Counter()
    for r in rows:
        t = r.text or ""
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        want[(r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeated(t))] += 1
    assert found == want
    assert line_quality.clean_lines(no_docs).count() == 0


def test_line_quality_verdicts(spark):
    good = " ".join(f"word{i}" for i in range(60)) + "."
    rows = [
        (1, good), (2, good + "\nHome | News | Login"), (3, "\n".join(["A | B | C"] * 30)),
        (4, "\n".join(f"no end {i} here" for i in range(40))), (5, good + "\nAll rights reserved."),
    ]
    kept = {r.doc_id: (r.kept, r.clean_text) for r in line_quality.clean_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: v for k, (v, _) in kept.items()} == {1: True, 2: True, 3: False, 4: False, 5: True}
    assert kept[2][1] == good == kept[5][1]


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2, 4])
def test_banded_distance(spark, edits):
    import random

    rng = random.Random(edits)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abcdé😀") for _ in range(rng.randint(edits + 1, 40)))
        b = list(a)
        for _ in range(rng.randint(0, edits + 2)):
            at = rng.randrange(len(b)) if b else 0
            rng.choice([lambda: b.insert(at, "x"), lambda: b.pop(at) if b else None, lambda: b.__setitem__(slice(at, at + 1), ["y"])])()
        if not b:
            continue
        pairs.append((a, "".join(b)) if len(a) >= len(b) else ("".join(b), a))
    rows = spark.createDataFrame(pairs, "longer string, shorter string").where(f"char_length(longer) - char_length(shorter) <= {edits}")
    for r in rows.withColumn("d", F.expr(line_dedup.banded_distance("longer", "shorter", edits))).collect():
        true = distance(r.longer, r.shorter)
        assert (r.d == true) if true <= edits else (r.d > edits), (r, true)


def plain_dedup(rows: list[tuple], edits: int, min_chars: int) -> dict:
    """Kept lines of each document by comparing every line with every earlier one."""
    firsts, kept = [], collections.defaultdict(list)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            bare = line.strip(" \t\n\x0b\f\r")
            if not bare:
                kept[doc_id].append(line)
            elif bare not in firsts:
                near = len(bare) >= min_chars and any(
                    len(x) >= min_chars and abs(len(x) - len(bare)) <= edits and distance(x, bare) <= edits for x in firsts
                )
                firsts.append(bare)
                if not near:
                    kept[doc_id].append(line)
    return {i: "\n".join(kept[i]) for i, _ in rows}


def edited_lines() -> list[tuple]:
    import random

    rng, rows = random.Random(4), []
    lines = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(8, 60))).strip() for _ in range(25)]
    for i in range(60):
        own = []
        for line in rng.sample(lines, 4):
            line = list(line)
            for _ in range(rng.choice([0, 1, 2, 3])):
                at = rng.randrange(len(line))
                line[at : at + rng.choice([0, 1, 1])] = rng.choice(["", "z", "é"])
            own.append("".join(line))
        rows.append((i, "\n".join([*own, " "])))
    return rows


@pytest.mark.parametrize("edits,min_chars", [(2, 30), (1, 10), (3, 12)])
def test_line_dedup_against_all_pairs(spark, edits, min_chars):
    rows = edited_lines()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, edits, min_chars).collect()}
    assert found == plain_dedup(rows, edits, min_chars)


def test_line_dedup_joins_when_ids_are_many(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    test_line_dedup_against_all_pairs(spark, 2, 30)


def word_edited_lines() -> list[tuple]:
    import random

    rng, rows = random.Random(6), []
    vocabulary = ["".join(rng.choice("abcdeé😀") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    lines = [rng.choices(vocabulary, k=k) for k in (12, 19, 20, 21, 39, 40, 41, 60, 75, 140, 400)]
    for i in range(120):
        own = list(rng.choice(lines))
        most = len(own) // 20
        for _ in range(rng.choice([max(most - 1, 0), most, most, most + 1])):
            at = rng.randrange(len(own))
            own[at : at + rng.choice([0, 1, 1])] = rng.choice([[], [f"new{rng.randint(0, 9)}orthth"]])
        rows.append((i, " ".join(own)))
    return rows


def test_line_dedup_threshold_grows_with_the_words(spark):
    rows = word_edited_lines()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, words_an_edit=20).collect()}
    firsts, want, by_words = [], {}, 0
    for i, line in rows:
        own = line.split(" ")
        gone = line in firsts or any(distance(x, line) <= 2 for x in firsts if abs(len(x) - len(line)) <= 2)
        near = any(
            abs(len(x) - len(own)) <= min(len(x), len(own)) // 20 and distance(x, own) <= min(len(x), len(own)) // 20
            for x in (first.split(" ") for first in firsts)
        )
        by_words += near and not gone
        want[i] = "" if gone or near else line
        if line not in firsts:
            firsts.append(line)
    assert found == want and by_words > 20


def test_line_dedup_awkward(clashing, no_docs):
    found = line_dedup.without_duplicate_lines(clashing)
    assert found.columns == clashing.columns
    rows = {}
    for r in found.collect():
        rows.setdefault(r.doc_id, []).append(r.text)
    assert 1 not in rows and rows[4] == [None] and rows[5] == [""] and len(rows[3]) == 2
    assert rows[10] == ["x" * 100_000]
    assert line_dedup.without_duplicate_lines(no_docs).count() == 0


def many_near_copies() -> list[tuple]:
    """Lines with one beginning: a few far from each other, and copies near those."""
    import random

    rng = random.Random(9)
    head = "the very same beginning of all of these lines "
    tails = ["".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(7)]
    lines = [head + tail for tail in tails]
    for _ in range(150):
        line = list(rng.choice(lines[:7]))
        line[rng.randrange(len(head), len(line))] = rng.choice("uvwxyz")
        lines.append("".join(line))
    return [(i // 3, "\n".join(lines[i : i + 3])) for i in range(0, len(lines), 3)]


@pytest.mark.parametrize("edits,min_chars", [(2, 30), (1, 12), (2, 9), (4, 20)])
def test_line_dedup_by_finer_keys_alone(spark, monkeypatch, edits, min_chars):
    monkeypatch.setattr(line_dedup, "FEW", 0)
    test_line_dedup_against_all_pairs(spark, edits, min_chars)


def test_line_dedup_by_words_with_every_key_heavy(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "FEW", 0)
    test_line_dedup_threshold_grows_with_the_words(spark)


@pytest.mark.parametrize("words_an_edit", [None, 20])
def test_line_dedup_pairs_of_heavily_edited_copies(spark, monkeypatch, words_an_edit):
    import random

    rng, made, plain = random.Random(5), [], line_dedup.stored
    word = lambda: "".join(rng.choice("aeinorst") for _ in range(5))
    base, passage, lines = [word() for _ in range(90)], [word() for _ in range(40)], []
    for _ in range(150):
        own = list(base)
        for at in rng.sample(range(90), 8):
            own[at] = "".join(rng.sample(own[at], 5))
        lines.append(" ".join(own))
        # a passage in lines that have nothing else in common
        lines.append(" ".join([*(word() for _ in range(rng.randint(20, 60))), *passage, *(word() for _ in range(40))]))

    def counted(rows, purpose):
        found = plain(rows, purpose)
        if purpose == "lines-pairs":
            made.append(found.count())
        return found

    monkeypatch.setattr(line_dedup, "stored", counted)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(4)
    assert line_dedup.dedup_lines(docs, words_an_edit=words_an_edit).where("text = ''").count() == 0
    early, late = made
    assert early <= 10 * len(lines) and late < len(lines)


def test_line_dedup_does_not_pair_all_near_copies(spark, monkeypatch):
    rows = [(i, text) for i, (_, text) in enumerate(many_near_copies())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    made = []
    plain = line_dedup.stored

    def counted(found, purpose):
        kept = plain(found, purpose)
        if purpose == "lines-pairs":
            made.append(kept.count())
        return kept

    monkeypatch.setattr(line_dedup, "stored", counted)
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert found == plain_dedup(rows, 2, 30)
    n = sum(len(text.split("\n")) for _, text in rows)
    assert made and sum(made) <= 10 * n, (made, n)


@pytest.mark.parametrize("codes", [0xF0000, 5])
def test_word_distance_against_plain(spark, monkeypatch, codes):
    import random

    monkeypatch.setattr(line_dedup, "_CODES", codes)  # few: words of one code are told apart by their places
    rng, rows = random.Random(12), []
    for _ in range(200):
        a = rng.choices(["ä", "b", "😀", "dd", "e"], k=rng.randint(0, 12))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.choice([0, 1])] = rng.choice([[], ["new"]])
        rows.append((a, b, rng.randint(0, 3)))
    found = spark.createDataFrame(rows, "xs array<string>, ys array<string>, most int")
    for r in found.withColumn("d", F.expr(line_dedup.word_distance("xs", "ys", "most"))).collect():
        true = distance(r.xs, r.ys)
        assert r.d == (true if true <= r.most else -1), r


def test_line_dedup_scans_documents_once_for_texts_and_compiles_its_joins(spark, monkeypatch):
    rows = [(i, t) for i, (_, t) in enumerate(many_near_copies())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    plain, scans, sizes = line_dedup.stored, [], []
    codegen = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package").codegenStringSeq

    def seen(found, purpose):
        if purpose == "lines-texts":
            scans.append(purpose)
        if purpose == "lines-pairs":
            kept = plain(found, purpose)
            found.collect()  # so that the final plan is known
            parts = codegen(found._jdf.queryExecution().executedPlan())
            sizes.extend(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size()))
            return kept
        return plain(found, purpose)

    monkeypatch.setattr(line_dedup, "stored", seen)
    line_dedup.dedup_lines(docs, words_an_edit=20).count()
    assert len(scans) == 1
    assert sizes and max(sizes) < 8000  # the JVM interprets longer methods


def test_words_are_cut_as_elsewhere(spark):
    from tripstar.llm.common import words

    lines = ["", "a", " a  b ", "a\tb c", "a\x0bb\x0c\r c", "\t", "é  😀 x\u00a0y", None]
    rows = spark.createDataFrame([(t,) for t in lines], "line string").where("line IS NOT NULL")
    for r in rows.select("line", F.expr(line_dedup._words("line")).alias("found"), words(F.col("line")).alias("want")).collect():
        assert r.found == r.want, r


def test_line_dedup_has_few_keys_a_line(spark):
    import random

    rng = random.Random(3)
    text = "\n".join(" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(rng.randint(6, 60))) for _ in range(300))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    keys = line_dedup.LineDedup(docs, words_an_edit=20).firsts().select(F.size("keys")).collect()
    assert sum(r[0] for r in keys) <= 8 * len(keys)  # 15 by characters and a third of the words before
