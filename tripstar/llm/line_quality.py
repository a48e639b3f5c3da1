"""Line-first cleaning: drop failing lines, then reject documents that lose too much text.

Every line that holds a word is judged by itself: it must end in terminal punctuation
without shouting, must not be a menu, and must not be boilerplate or symbol noise. Lines
that fail go; a document is kept if the characters of the remaining lines are at least
``min_kept`` of all, and if it is neither very short nor mostly repeated word sequences.
Each document is handled in its own row, with built-in functions only and no shuffle.

Defined cases: null and empty texts, and texts without a word, have 0 everywhere and are
not kept. Repeated rows are judged each by itself. An empty table gives no rows. Other
columns pass through ``clean_lines``; a column named like a result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import SPACES, WORD, table, words

SYMBOLS = "#*$%&|<>"
SHORT_LINE = 300  # longer lines are prose: menus and notices are not looked for

# Phrases of menus and of notices, in lower case.
MENU_WORDS = [
    "home", "login", "log in", "sign in", "sign up", "register", "menu", "search", "next",
    "previous", "back to top", "read more", "share", "contact us", "about us", "site map",
]
NOTICES = [
    "all rights reserved", "cookie", "privacy policy", "terms of use", "terms of service",
    "licensed under", "copyright (c)", "©", "enable javascript", "subscribe to our",
]

COLUMNS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "base_failed", "kept_share", "clean_text", "kept",
)


def _count(text: Column, chars: str) -> Column:
    """Number of characters of a text that are among some characters."""
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def line_passes(line: Column) -> Column:
    """Whether a line that holds a word stays."""
    lower = F.lower(F.trim(line))
    ends = line.rlike(r"[.!?…:;][\"'»”)\]]*[\x20\x09-\x0D]*\z")
    shouts = F.regexp_count(line, F.lit(r"!!")) * 20 > F.char_length(line)
    noise = _count(line, SYMBOLS) * 20 > F.char_length(line)
    menu = (_count(line, "|") >= 2) | lower.contains(" » ") | lower.isin(MENU_WORDS)
    notice = F.lit(False)
    for phrase in NOTICES:
        notice = notice | lower.contains(phrase)
    short = F.char_length(line) <= SHORT_LINE
    return ends & ~shouts & ~noise & ~(short & (menu | notice))


def _window_hashes(own: Column) -> Column:
    """Hashes of the three-word windows of an array of words, in order."""
    return F.slice(
        F.transform(own, lambda w, i: F.xxhash64(w, F.get(own, i + 1), F.get(own, i + 2))),
        F.lit(1),
        F.greatest(F.size(own) - 2, F.lit(0)),
    )


def clean_lines(docs: DataFrame, text_col: str = "text", min_kept: float = 0.5) -> DataFrame:
    """Add the measures, the cleaned text, its share of the characters, and the verdict."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own, lines, passed = "__words", "__lines", "__passed"
    measured = (
        docs.withColumns({own: words(F.col(text_col)), lines: F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))})
        .withColumns({
            "n_words": F.size(own).cast("long"),
            "word_chars": F.char_length(F.translate(text, SPACES, "")).cast("long"),
            "n_symbols": _count(text, SYMBOLS).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "__windows": _window_hashes(F.col(own)),
            passed: F.filter(lines, line_passes),
        })
        .drop(own)
        # sorted only where a window comes twice: neighbours of equal hash are the repeats
        .withColumn(
            "__sorted",
            F.when(
                F.size(F.array_distinct("__windows")) < F.size("__windows"),
                F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
        )
        .drop("__windows")
    )
    measured = measured.withColumn(
        "__places",
        F.sort_array(
            F.transform(
                F.filter(
                    "__sorted",
                    lambda x, k: (x["h"] == F.get("__sorted", k - 1)["h"]) | (x["h"] == F.get("__sorted", k + 1)["h"]),
                ),
                lambda x: x["i"],
            )
        ),
    ).withColumns({
        # each repeated window adds the words that the one before it does not cover
        "n_repeat_words": F.aggregate(
            "__places",
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
            lambda a: a["n"],
        ),
        "clean_text": F.array_join(passed, "\n"),
        "kept_share": F.coalesce(
            F.char_length(F.array_join(passed, "")) / F.nullif(F.char_length(F.array_join(lines, "")), F.lit(0)),
            F.lit(0.0),
        ),
    })
    return (
        measured.withColumn(
            "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
        )
        .withColumn("kept", ~F.col("base_failed") & (F.col("kept_share") >= min_kept))
        .drop(lines, passed, "__sorted", "__places")
    )


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_share"
    )
