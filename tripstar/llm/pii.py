"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them.

Base matches of four kinds (email, ip, card, phone) are found in every whole text by
regular expressions with checks, and always stay. Looser candidates of the same kinds, such
as an address spelled with "at" and "dot" or a telephone number without a country code,
are judged: three groups of labelers (a regular expression for the strict shape, a
gazetteer of domains and area words, and the words around) vote for, against or not at all.
The votes of all candidates, reduced to counts of vote patterns, give the labelers'
reliabilities by expectation-maximisation; the posteriors then train the final span
classifier, a naive Bayes model over features of the candidate. Base matches take part in
the fit as candidates, and candidates that overlap a base match of their kind are dropped.

Built-in functions only. Each text is handled in its own row; the fit sees a table of at
most a few thousand patterns, whatever the size of the corpus.

Defined cases: null and empty texts have no span. Positions are code points, end exclusive.
Repeated rows are handled each by itself. A table without candidates leaves the priors.
An empty table gives no rows. Other columns pass through ``find_spans``.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log as _log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import stored, table

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 10
ACCEPT = 0.9
CONTEXT = 40  # characters before a candidate that the context labeler reads

_LOCAL = "[A-Za-z0-9._%+-]"
# A match starts where a run of its characters does, or where the match before it ended:
# the leftmost match always does, so nothing else has to be tried. Possessive repeats take
# what the greedy ones take here, without a stack frame for each repeat.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# what a text must hold for a kind to be looked for at all
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]{2}|[0-9][\x20-][0-9]", "phone": r"\+[0-9]"}

# Candidates in looser forms, never ending where a longer run of their characters goes on.
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._-])[a-z0-9._-]{2,64}+\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[a-z0-9-]{2,63}+"
    r"\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[a-z]{2,24}+(?![a-z0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\x20?\[\.\]\x20?[0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9./_-])[0-9]{4}+(?:[._/][0-9]{4}+){3}+(?![0-9])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9]|[.-][0-9])",
}
LOOSE_NEEDS = {"email": r"(?i)[\(\[\x20](?:at)[\)\]\x20]", "ip": r"\[\.\]", "card": r"[0-9][._/][0-9]", "phone": r"[0-9][.-][0-9]{4}"}

# Words that go before personal data of each kind, and words that speak against it.
CONTEXT_FOR = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|reach|address)\b",
    "ip": r"(?i)\b(?:ip|address|host|server|client|login|from)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|debit|payment|account)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|cell|fax|contact|number)\b",
}
CONTEXT_AGAINST = r"(?i)\b(?:version|isbn|issn|serial|invoice|order|build|release|part|model|meet|look)\b"
# A gazetteer of mail domains, private networks and issuer digits.
GAZETTEER = {
    "email": r"(?i)(?:gmail|yahoo|hotmail|outlook|example|proton|icloud|aol|mail)",
    "ip": r"^(?:10|127|169|172|192|198|203|8|1)\b",
    "card": r"^(?:4|5[1-5]|3[47]|6011|65|2[2-7])",
    "phone": r"^(?:\+|\()?[2-9]",
}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the sum of digits, every second one from the right doubled, ends in 0."""
    each = F.split(F.reverse(digits), "")
    weighed = F.transform(
        each, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((2 * d.cast("int")) % 10 + F.floor(d.cast("int") / 5).cast("int"))
    )
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(
            F.split(match, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.right(F.concat(F.lit("000"), p), F.lit(3)).cast("int") <= 255)
        )
    digits = _digits(match)
    if kind == "card":
        return F.length(digits).between(14, 19) & F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(10, 15)


def _passes(kind: str):
    return lambda x: _valid(kind, x["found"])


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, found) for all matches of a pattern, from the pieces between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def step(done: Column, x: Column) -> Column:
        start = F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(0)) + F.char_length(x["gap"])
        own = F.struct(start.alias("start"), (start + F.char_length(x["found"])).alias("end"), x["found"].alias("found"))
        return F.concat(done, F.array(own))

    # the piece after the last match has no match beside it
    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), found.alias("found")), lambda x: x["found"].isNotNull())
    nothing = F.array().cast("array<struct<start:int,end:int,found:string>>")
    return F.when(F.size(pairs) > 0, F.aggregate(pairs, nothing, step)).otherwise(nothing)


def _tagged(spans: Column, kind: int) -> Column:
    return F.transform(
        spans, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["found"].alias("found"))
    )


def base_spans(text: Column) -> Column:
    """Sorted array of (start, kind, end, found) of the base matches that pass their checks."""
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,found:string>>")
    parts = []
    for k, kind in enumerate(KINDS):
        found = F.filter(matches(text, BASE[kind]), _passes(kind))
        parts.append(F.when(text.rlike(NEEDS[kind]), _tagged(found, k)).otherwise(nothing))
    return F.sort_array(F.concat(*parts))


def loose_spans(text: Column, base: Column) -> Column:
    """Candidates in looser forms that overlap no base match."""
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,found:string>>")
    parts = [
        F.when(text.rlike(LOOSE_NEEDS[kind]), _tagged(matches(text, LOOSE[kind]), k)).otherwise(nothing)
        for k, kind in enumerate(KINDS)
    ]
    return F.filter(
        F.concat(*parts), lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    )


VOTES = ("shape", "gazetteer", "before", "against", "edges")
FEATURES = ("f_length", "f_digits", "f_left", "f_right", "f_before")


def _by_kind(kind: Column, of) -> Column:
    out = of(KINDS[-1])
    for k, name in reversed(list(enumerate(KINDS[:-1]))):
        out = F.when(kind == k, of(name)).otherwise(out)
    return out


def described(text: Column, x: Column, is_base: Column) -> dict[str, Column]:
    """Votes (1, 0, -1) and features (small numbers) of a candidate (start, kind, end, found)."""
    begin = F.greatest(x["start"] - CONTEXT, F.lit(0))
    before = F.substring(text, begin + 1, x["start"] - begin)
    left = F.substring(text, x["start"], F.when(x["start"] > 0, 1).otherwise(0))
    right = F.substring(text, x["end"] + 1, F.lit(1))
    n_digits = F.length(_digits(x["found"]))
    proper = _by_kind(
        x["kind"],
        lambda k: {
            "email": F.lit(True),
            "ip": n_digits.between(4, 12),
            "card": n_digits.between(14, 19) & F.when(n_digits.between(14, 19), _luhn(_digits(x["found"]))).otherwise(False),
            "phone": n_digits == 10,
        }[k],
    )
    spoken_for = _by_kind(x["kind"], lambda k: before.rlike(CONTEXT_FOR[k]))
    spoken_against = before.rlike(CONTEXT_AGAINST)
    known = _by_kind(x["kind"], lambda k: x["found"].rlike(GAZETTEER[k]))
    glued = left.rlike(r"[\p{L}\p{N}]") | right.rlike(r"[\p{L}\p{N}]")

    def edge(c: Column) -> Column:
        return F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"\p{P}"), 2).otherwise(3)

    return {
        "shape": F.when(is_base, 1).when(proper, 0).otherwise(-1),
        "gazetteer": F.when(known, 1).otherwise(0),
        "before": F.when(spoken_for, 1).otherwise(0),
        "against": F.when(spoken_against, -1).otherwise(0),
        "edges": F.when(glued, -1).otherwise(1),
        "f_length": F.least(F.floor(F.length(x["found"]) / 6).cast("int"), F.lit(6)),
        "f_digits": F.least(F.floor(n_digits / 3).cast("int"), F.lit(6)),
        "f_left": edge(left),
        "f_right": edge(right),
        "f_before": F.when(spoken_for & ~spoken_against, 2).when(spoken_against, 0).otherwise(1),
    }


@dataclass
class Spans:
    """The fitted classifier: log odds of each kind and of each (kind, feature, value)."""

    prior: dict[int, float]
    odds: dict[tuple[int, str, int], float]

    def score(self, kind: Column, features: dict[str, Column]) -> Column:
        def lookup(pairs: list[tuple[str, float]], key: Column) -> Column:
            if not pairs:
                return F.lit(0.0)
            known = F.create_map(*[F.lit(v) for pair in pairs for v in pair])
            return F.coalesce(F.element_at(known, key), F.lit(0.0))

        total = lookup([(str(k), v) for k, v in sorted(self.prior.items())], kind.cast("string"))
        for name in FEATURES:
            own = [(f"{k}:{value}", v) for (k, f, value), v in sorted(self.odds.items()) if f == name]
            total = total + lookup(own, F.concat_ws(":", kind, features[name]))
        return 1 / (1 + F.exp(-total))


def vote_patterns(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Stored counts n of candidates by kind, votes and features."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(text.alias("t")).withColumn("base", base_spans(F.col("t")))
    rows = rows.withColumn("loose", loose_spans(F.col("t"), F.col("base"))).where("size(base) + size(loose) > 0")
    each = rows.select(
        "t",
        F.explode(
            F.concat(
                F.transform("base", lambda x: F.struct(x.alias("x"), F.lit(True).alias("is_base"))),
                F.transform("loose", lambda x: F.struct(x.alias("x"), F.lit(False).alias("is_base"))),
            )
        ).alias("c"),
    )
    columns = described(F.col("t"), F.col("c.x"), F.col("c.is_base"))
    each = each.select(F.col("c.x.kind").alias("kind"), *[c.alias(n) for n, c in columns.items()])
    return stored(each.groupBy("kind", *VOTES, *FEATURES).agg(F.count("*").alias("n")), "pii-patterns")


def fit_spans(patterns: DataFrame, rounds: int = ROUNDS) -> Spans:
    """Labeler reliabilities by expectation-maximisation, then the classifier.

    Every round is one aggregation of the patterns to one row a kind; parameters are numbers.
    """
    votes = patterns.groupBy("kind", *VOTES).agg(F.sum("n").alias("n"))
    votes = stored(votes, "pii-votes")
    ratio = {  # log P(vote | personal) - log P(vote | not), the same for all kinds at first
        (k, v, x): {1: 1.5, 0: 0.0, -1: -2.0}[x] for k in range(len(KINDS)) for v in VOTES for x in (1, 0, -1)
    }
    prior = dict.fromkeys(range(len(KINDS)), 0.0)

    def posterior() -> Column:
        known = F.create_map(*[F.lit(y) for (k, v, x), r in ratio.items() for y in (f"{k}{v}{x}", r)])
        total = F.element_at(F.create_map(*[F.lit(y) for pair in prior.items() for y in pair]), F.col("kind"))
        for v in VOTES:
            total = total + F.element_at(known, F.concat(F.col("kind").cast("string"), F.lit(v), F.col(v).cast("string")))
        return 1 / (1 + F.exp(-total))

    for _ in range(rounds):
        weighed = votes.withColumn("p", posterior())
        sums = [F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p")).alias("yes")]
        for v in VOTES:
            for x in (1, 0, -1):
                hit = F.when(F.col(v) == x, F.col("n")).otherwise(0)
                sums += [F.sum(hit).alias(f"{v}{x}"), F.sum(hit * F.col("p")).alias(f"{v}{x}yes")]
        for r in weighed.groupBy("kind").agg(*sums).collect():
            yes, no = r.yes + 1.0, r.n - r.yes + 1.0
            prior[r.kind] = float(_log(yes / no))
            for v in VOTES:
                for x in (1, 0, -1):
                    own = r[f"{v}{x}yes"]
                    ratio[r.kind, v, x] = float(_log((own + 0.5) / (yes + 0.5)) - _log((r[f"{v}{x}"] - own + 0.5) / (no + 0.5)))
    soft = patterns.withColumn("p", posterior())
    pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("value")) for f in FEATURES])
    counts = (
        soft.select("kind", "n", "p", F.explode(pairs).alias("x"))
        .groupBy("kind", "x.f", "x.value")
        .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p")).alias("yes"))
        .collect()
    )
    total = {}
    for r in counts:
        if r.f == FEATURES[0]:
            n, yes = total.get(r.kind, (0.0, 0.0))
            total[r.kind] = (n + r.n, yes + r.yes)
    odds = {
        (r.kind, r.f, r.value): _log((r.yes + 0.5) / (total[r.kind][1] + 1.0))
        - _log((r.n - r.yes + 0.5) / (total[r.kind][0] - total[r.kind][1] + 1.0))
        for r in counts
    }
    return Spans({k: _log((yes + 0.5) / (n - yes + 0.5)) for k, (n, yes) in total.items()}, odds)


def find_spans(docs: DataFrame, model: Spans, text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """Add ``base`` and ``spans``, sorted arrays of (start, kind, end, found)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumn("base", base_spans(text))
    rows = rows.withColumn("__loose", loose_spans(text, F.col("base")))
    kept = F.filter("__loose", lambda x: model.score(x["kind"], described(text, x, F.lit(False))) >= accept)
    return rows.withColumn(
        "spans", F.when(F.size("__loose") > 0, F.sort_array(F.concat("base", kept))).otherwise(F.col("base"))
    ).drop("__loose")


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def _count_of(kind: int) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_spans(docs, fit_spans(vote_patterns(docs)))
    return found.select(
        "doc_id",
        *[_count_of(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
