"""Small tables with the awkward cases every operator has to take."""

from __future__ import annotations

import binascii
import random

import pytest

ALPHABET = "the of and to in is that for with as on by it be at from or an are this".split()


def words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
            if rng.random() < 0.7 else rng.choice(ALPHABET) for _ in range(n)]


def text(seed: int, lines: int = 5, per_line: int = 14) -> str:
    return "\n".join(" ".join(words(seed * 1000 + i, per_line)).capitalize() + "." for i in range(lines))


def awkward() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empties, a very long text, ties, repeats."""
    base, other = text(1), text(2)
    near = base.replace(base.split()[3], "zzz", 1)
    rows = [
        (0, base, "en", "a"), (1, base, "en", "b"), (2, near, "en", "a"), (3, other, None, None),
        (4, None, "de", "a"), (5, "", "de", "b"), (6, " \n\t ", None, "c"), (7, "one", "en", "a"),
        (8, "one two", "en", None), (9, "\n".join(text(50 + i) for i in range(200)), "en", "b"),
        (10, "x" * 100_000, "en", "a"), (11, "é ß ñ 漢字 😀. Ende!", "de", "c"),
        (3, other, None, None), (12, text(7), "de", "c"), (13, text(8) + "\n" + text(7).split("\n")[0], "de", "c"),
        (None, text(9), "en", "a"), (14, text(10), "fr", "ü"),
    ]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward_docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(awkward_docs):
    """The same rows with further columns whose names operators might use inside."""
    names = ["n", "node", "pattern", "size", "words", "kept", "place", "token", "start", "group", "spans", "base", "score", "th", "pos", "h1", "first", "line"]
    from pyspark.sql import functions as F

    return awkward_docs.select("*", *[F.lit(f"extra {n}").alias(n) for n in names])


def is_held_out(doc_id: int) -> bool:
    return binascii.crc32(str(doc_id).encode()) % 4 == 2
