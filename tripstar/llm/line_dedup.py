"""Line deduplication by a segment-partition edit join.

A line that holds a word is removed if an equal line comes earlier in the corpus, or if,
being the first of its kind, some earlier line lies within ``edits`` edits of it or, as long
lines may differ in more, if one word in ``words_an_edit`` of the shorter one is inserted,
deleted or replaced at most (not looked for without that parameter). Order is by doc_id, then by a hash of the text, then by place in
the text. Lines of fewer than ``min_chars`` characters are only compared for equality.

The edit join cuts every distinct line into edits + 1 segments. Two lines within the
threshold share one of them, at a place that moves by no more than the threshold, counted
from the nearer end of the line, so a line has keys for those places only. What meets under one
key is first held against the lengths and the counts of some letters;
the rest is verified by a banded bit-parallel edit distance: a band of 2 * edits + 1 rows
is a number whose bits are the vertical differences of a column.

The word join cuts words in the same way, into as many segments as edits are allowed and one
more. It has no bound on a line's length: with one edit in p words, two long lines share a run
of p / 2 words somewhere. Of the hashes of all shorter runs in such a stretch each line keeps
the least as a key, so both have that one, wherever the stretch lies. What meets is verified
by the edit distance of texts that have one character for each word.

Built-in functions only. Equal lines are joined by partial aggregation before anything is
compared, with keys in place of their texts. All keys are shuffled once, and only those of two
lines or more go on. A line needs but one earlier line near it, so under a key that many lines
share they are held against its first few, and only what these leave open against the rest.
For that, lines that share a key of characters get finer keys: of a line cut into many parts,
two edits leave all but two untouched, so edited copies of one line meet only if what they
share is nearly all of it. Lines that share words meet again if their numbers of words are alike.
Parities of the counts of words, or of pairs of characters, tell most of what meets apart, as an
edit changes few of them.

Defined cases: null and empty texts have no line. Blank lines are never removed and take
no part. White space around a line is ignored. Rows repeating an id with another text are
documents of their own, rows repeating id and text share one result. Null ids come first.
A document that loses all its lines has an empty text. Other columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstar.llm.common import SPACES, stored, table

EDITS = 2
MIN_CHARS = 30
WORDS_AN_EDIT = 20  # a line of so many words may differ in one of them, of twice as many in two
BROADCAST_LINES = 1_000_000  # hashes of candidate lines, 8 bytes each; beyond it they are joined

LENGTH_STEP = 8  # lengths whose lines are cut alike
COMPILED_CLASSES = 4  # of these, the ones of most lines: their keys are generated code, the others are interpreted
WORD_CLASSES = 8  # edits up to which words are cut into segments; longer lines have keys of stretches as well
FINE_PARTS = 16  # parts of a line whose first keys are shared by many
FEW = 8  # lines of a key that all others of it are held against; the rest only where these leave one open

# Letters whose counts two lines are held against first.
LETTERS = ["e", "t", "a"]
_COUNT_BITS = 7
_BAND_BITS = 32
_CHAR_LONGS, _WORD_LONGS = 2, 8  # of parities
_FIRST_CODE, _CODES = 0x10000, 0xF0000  # characters that stand for hashes of words: all of five digits
_FINE_EDITS = (1, 2)  # edits that finer keys are made for


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), pos, two hashes and the text of each line that holds a word."""
    rows = docs.selectExpr(
        "doc_id", "xxhash64(text) AS th", "posexplode(split(coalesce(text, ''), '\n')) AS (pos, raw)"
    ).withColumn("line", F.btrim("raw", F.lit(SPACES)))
    return rows.where("line <> ''").selectExpr(
        "doc_id", "th", "pos", "xxhash64(line) AS h1", "hash(line, 17) AS h2", "line"
    )


def segment_keys(edits: int, min_chars: int) -> str:
    """SQL array of the keys of a line of n characters, for lines of up to ``edits`` more or less.

    Lengths lie in steps. A line has the keys of its own step and, if a line shorter by
    ``edits`` is in the step below, of that one, so two lines have those of the shorter one.
    Of the parts that a step's least length gives, one is untouched with i edits at most
    before it and ``edits`` - i after it. It has moved by the smaller of both as seen from
    its own end of the line, and one of two lines has the other's key at such a move.
    """
    step = max(LENGTH_STEP, edits)
    both = []
    for less in (0, step):
        least = f"(n - pmod(n - {min_chars}, {step}) - {less})"
        part = f"CAST({least} DIV {edits + 1} AS INT)"
        keys = []
        for i in range(edits + 1):
            start = f"{i} * {part} + 1" if 2 * i <= edits else f"n - {edits + 1 - i} * {part} + 1"
            for move in range(min(i, edits - i) + 1):
                cut = f"substring(line, {start} + {move}, greatest({part} - {edits // 2}, 0))"
                keys.append(f"xxhash64({least}, {i}, {cut}) & -2L")
        both.append(f"array({', '.join(keys)})")
    below = f"n - {step} >= {min_chars} AND pmod(n - {min_chars}, {step}) < {edits}"
    none = "CAST(array() AS ARRAY<BIGINT>)"
    # each array once: a method of more than 8000 bytes is never compiled by the JVM
    return f"concat(IF(n < {min_chars}, {none}, {both[0]}), IF({below}, {both[1]}, {none}))"


def fine_keys(edits: int, min_chars: int) -> str:
    """SQL array of keys that two lines share only if they agree in all but two parts next to ``edits`` edits.

    Steps of lengths are those of :func:`segment_keys`. One or two edits lie in parts i < j of the
    shorter line, counted from its start. Then all before i is in place, all after j is in place as
    seen from the end, and what lies between has moved by one at most, as there is an edit in i.
    """
    step, most = max(LENGTH_STEP, edits), FINE_PARTS - 1
    both = []
    for less in (0, step):
        least = f"(n - pmod(n - {min_chars}, {step}) - {less})"
        part = f"CAST({least} DIV {FINE_PARTS} AS INT)"
        between = f"substring(line, (i + 1) * {part} + 1 + t, greatest((j - i - 1) * {part} - 1, 0))"
        after = f"substring(line, n - ({most} - j) * {part} + 1, ({most} - j) * {part})"
        key = f"xxhash64({least}, i, j, substring(line, 1, i * {part}), {between}, {after}) & -2L"
        moves = f"transform(sequence(0, IF(j > i + 1, 1, 0)), t -> {key})"
        # one edit is in one of two parts next to each other
        last = "i + 1" if edits == 1 else str(most)
        both.append(f"flatten(transform(sequence(0, {most - 1}), i -> flatten(transform(sequence(i + 1, {last}), j -> {moves}))))")
    below = f"n - {step} >= {min_chars} AND pmod(n - {min_chars}, {step}) < {edits}"
    return f"array_distinct(CASE WHEN {below} THEN concat({both[0]}, {both[1]}) ELSE {both[0]} END)"


def _word_classes(words_an_edit: int) -> int:
    """The most edits for which words are cut into segments as long as a run of the longer lines' keys."""
    most = 1
    for c in range(2, min(WORD_CLASSES, words_an_edit - 1) + 1):
        if words_an_edit * c // (c + 1) - c // 2 < max(words_an_edit // 2, 1):
            break
        most = c
    return most


def word_keys(words_an_edit: int) -> str:
    """SQL array of the keys of a line's m words ``ws``.

    With c edits allowed, the words are cut as :func:`segment_keys` cuts characters; lines
    with room for more edits have the least hashes of the runs in each stretch as well.
    """
    p, most = words_an_edit, _word_classes(words_an_edit)
    none = "CAST(array() AS ARRAY<BIGINT>)"
    segments = []
    for c in range(1, most + 1):
        part, keys = p * c // (c + 1), []
        for i in range(c + 1):
            start = f"{i * part + 1}" if 2 * i <= c else f"m - {(c + 1 - i) * part - 1}"
            for move in range(min(i, c - i) + 1):
                words = "ws" if c <= COMPILED_CLASSES else "w"
                keys.append(f"xxhash64({c}, {i}, slice({words}, {start} + {move}, {part - c // 2})) | 1L")
        # a line of the class below may be shorter by as many words as that class allows
        segments.append(f"IF(m >= {p * c} AND m < {p * (c + 1) + c}, array({', '.join(keys)}), {none})")
    run = p // 2
    window = max(run // 2, 1)
    width = run - window + 1
    runs = f"transform(sequence(0, m - {width}), i -> xxhash64({', '.join(f'get(hashes, i + {k})' for k in range(width))}) | 1L)"
    near = ", ".join(f"get(r, i + {k})" for k in range(window))
    least = f"least({near})" if window > 1 else near
    stretches = _let(runs, "r", f"array_distinct(transform(sequence(0, size(r) - {window}), i -> {least}))")
    stretches = _let("transform(w, x -> xxhash64(x))", "hashes", stretches)
    long = _let("ws", "w", f"concat({', '.join([*segments[COMPILED_CLASSES:], f'IF(m >= {p * (most + 1)}, {stretches}, {none})'])})")
    first = p * (min(COMPILED_CLASSES, most) + 1)
    return f"concat({', '.join(segments[:COMPILED_CLASSES])}, IF(m >= {first}, {long}, {none}))"


def _letters() -> str:
    """SQL: the letter counts of a line and its length, 7 bits each; they wrap for long lines."""
    full = (1 << _COUNT_BITS) - 1
    counts = [f"octet_length(line) - octet_length(replace(line, '{c}', ''))" for c in LETTERS]
    return " | ".join(
        f"shiftleft(CAST(({count}) & {full} AS BIGINT), {_COUNT_BITS * k})" for k, count in enumerate([*counts, "n"])
    )


def _close(edits: int) -> str:
    """SQL: the letter counts of x and y, and their lengths, differ by no more than edits allow."""
    full = (1 << _COUNT_BITS) - 1
    apart = []
    for k in range(len(LETTERS) + 1):
        a, b = (f"(shiftright({s}.letters, {_COUNT_BITS * k}) & {full})" for s in "xy")
        apart.append(f"abs({a} - {b})")
    # an edit changes two counts by one at most; a count that may have wrapped lets a pair pass
    *letters, length = apart
    wrapped = " OR ".join(f"{d} > {full - 2 * edits}" for d in letters)
    near = f"({length} <= {edits} OR {length} >= {full + 1 - edits})"
    return f"({near} AND ({' + '.join(letters)} <= {2 * edits} OR {wrapped}))"


_CLASS, _BIT = "shiftrightunsigned(h, 40)", "shiftleft(1L, CAST(shiftrightunsigned(h, 20) & 63 AS INT))"


def _word_parities(texts: DataFrame) -> DataFrame:
    """h1 and longs odd0, odd1 .. of each line, whose bits tell whether the words of each class occur an odd number of times."""
    each = [F.expr(f"bit_xor(IF({_CLASS} & {_WORD_LONGS - 1} = {k}, {_BIT}, 0L))") for k in range(_WORD_LONGS)]
    hashes = texts.select("id.*", F.explode("ws").alias("word")).selectExpr("h1", "h2", "xxhash64(word) AS h")
    return hashes.groupBy("h1", "h2").agg(*[x.alias(f"odd{k}") for k, x in enumerate(each)]).drop("h2")


def _char_parities(texts: DataFrame) -> DataFrame:
    """The same for pairs of characters, which are too many to be rows."""
    each = ", ".join(f"aggregate(hs, 0L, (s, h) -> IF({_CLASS} & {_CHAR_LONGS - 1} = {k}, s ^ {_BIT}, s))" for k in range(_CHAR_LONGS))
    hashes = _let("split(line, '')", "c", "zip_with(c, slice(c, 2, size(c)), (p, q) -> xxhash64(p, q))")
    odd = texts.select("h1", F.expr(_let(hashes, "hs", f"array({each})")).alias("odd"))
    return odd.select("h1", *[F.get("odd", F.lit(k)).alias(f"odd{k}") for k in range(_CHAR_LONGS)])


def _flips(longs: int) -> str:
    """SQL: the number of classes whose parities in x and y differ."""
    return " + ".join(f"bit_count(x.odd{k} ^ y.odd{k})" for k in range(longs))


def _words(line: str) -> str:
    """SQL: the words of a line, as :func:`tripstar.llm.common.words` gives them; cut at spaces alone where these are the only ones."""
    other = r"[\\x09-\\x0D]"
    cut = f"IF({line} RLIKE '{other}', split({line}, '[\\\\x20\\\\x09-\\\\x0D]+'), split({line}, ' '))"
    return f"array_remove({cut}, '')"


def _let(value: str, name: str, body: str) -> str:
    """SQL: the body with a name for a value, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _trimmed(xs: str, ys: str, most: str) -> str:
    """SQL: both arrays without what they begin and end with alike, at most so many; their edit distance is the same."""

    def alike(a: str, b: str, n: str) -> str:
        first = f"CAST(array_position(zip_with(slice({a}, 1, {n}), slice({b}, 1, {n}), (x, y) -> x = y), false) AS INT)"
        return _let(first, "f", f"IF(f = 0, {n}, f - 1)")

    left = ", ".join(f"'{k}', slice(t.{k}, p + 1, size(t.{k}) - p - e)" for k in ("xs", "ys"))
    ends = _let(alike("reverse(t.xs)", "reverse(t.ys)", "(l - p)"), "e", f"named_struct({left})")
    return _let(f"named_struct('xs', {xs}, 'ys', {ys})", "t", _let(most, "l", _let(alike("t.xs", "t.ys", "l"), "p", ends)))


def banded_distance(longer: str, shorter: str, edits: int) -> str:
    """SQL: edit distance of two texts if at most ``edits``, else more.

    The longer one holds more than ``edits`` characters and gives the rows. Column
    after column, bit 31 - k stands for row j + edits - k; a set bit of vp (vn) says that the
    row is one more (less) than the row above it. The last row of the band is followed down
    the diagonal while there are rows, then along the bottom row.
    """
    top, mask = _BAND_BITS - 1, f"{(1 << _BAND_BITS) - 1}L"
    start = f"{((1 << (edits + 1)) - 1) << (top - edits)}L"
    match = " | ".join(
        f"IF(get(t.xs, j - 1 + {edits - k}) <=> c, {1 << (top - k)}L, 0L)" for k in range(2 * edits + 1)
    )
    d0 = f"((((m & s.vp) + s.vp) ^ s.vp) | m | s.vn) & {mask}"
    hp, hn = f"(s.vn | (~(d0 | s.vp) & {mask}))", "(d0 & s.vp)"
    half = "shiftrightunsigned(d0, 1)"
    mark = f"shiftleft(1L, greatest({top} - (j + {edits} - size(t.xs)), 0))"
    step = f"""named_struct(
        'vp', {hn} | (~({half} | {hp}) & {mask}),
        'vn', {half} & {hp},
        'd', s.d + CASE WHEN j + {edits} <= size(t.xs) THEN IF((d0 & {1 << top}L) = 0, 1, 0)
             ELSE IF(({hp} & {mark}) <> 0, 1, 0) - IF(({hn} & {mark}) <> 0, 1, 0) END)"""
    # along the bottom row the distance falls by ``edits`` at most: beyond twice that nothing helps
    column = _let("get(t.ys, j - 1)", "c", _let(f"({match})", "m", _let(d0, "d0", step)))
    run = (
        f"aggregate(sequence(1, size(t.ys)), named_struct('vp', {start}, 'vn', 0L, 'd', {edits}), "
        f"(s, j) -> IF(s.d > {2 * edits}, s, {column}), s -> s.d)"
    )
    # bound to a name, the characters are split once; a column costs much more than a comparison
    most = f"greatest(least(size(t.xs) - {edits + 1}, size(t.ys) - 1), 0)"
    return _let(_trimmed(f"split({longer}, '')", f"split({shorter}, '')", most), "t", run)


def word_distance(xs: str, ys: str, edits: str) -> str:
    """SQL: edit distance of two arrays of words if at most ``edits``, else -1.

    Words become characters: by their hashes or, if two words of the pair have the same, by their places.
    """

    def hashed(own: str) -> str:
        text = f"decode(unhex(concat('000', array_join({own}, '000'))), 'UTF-32')"  # five digits each
        return f"IF(size({own}) = 0, '', {text})"

    def coded(own: str) -> str:
        # the place among the pair's words as a character; surrogates and byte order marks are left out
        place = _let("array_position(v, w)", "p", "lpad(hex(IF(p < 55296, p, p + 10240)), 8, '0')")
        return f"decode(unhex(array_join(transform({own}, w -> {place}), '')), 'UTF-32')"

    by_place = f"levenshtein({coded('d.xs')}, {coded('d.ys')}, {edits})"
    by_hash = f"levenshtein({hashed('h.xs')}, {hashed('h.ys')}, {edits})"
    codes = ", ".join(f"'{k}', transform(d.{k}, w -> hex({_FIRST_CODE}L + pmod(xxhash64(w), {_CODES}L)))" for k in ("xs", "ys"))
    told = "size(array_distinct(concat(h.xs, h.ys))) = size(v)"
    found = _let("array_distinct(concat(d.xs, d.ys))", "v", _let(f"named_struct({codes})", "h", f"IF({told}, {by_hash}, {by_place})"))
    return _let(_trimmed(xs, ys, "least(size(t.xs), size(t.ys))"), "d", found)


class LineDedup:
    """Decides line by line over (doc_id, text); see the module's text for the rule."""

    def __init__(
        self, docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, id_col="doc_id", text_col="text",
        words_an_edit: int | None = None,
    ):
        if not edits < min_chars:
            raise ValueError("lines must have more characters than edits")
        if edits > 15:
            raise ValueError("the band holds at most 15 edits to either side")
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        if words_an_edit is not None and words_an_edit < 2:
            raise ValueError("lines must have more words than edits")
        self.edits, self.min_chars, self.words_an_edit = edits, min_chars, words_an_edit

    def firsts(self) -> DataFrame:
        """Stored h1, h2, the first place, the keys and the counts of each distinct line; no text is shuffled."""
        lines = _lines(self.docs).withColumn("n", F.char_length("line"))
        chars = segment_keys(self.edits, self.min_chars)
        if self.words_an_edit:
            # fewer characters cannot hold so many words
            some = F.col("n") >= max(self.min_chars, 2 * self.words_an_edit - 1)
            lines = lines.withColumn("ws", F.when(some, F.expr(_words("line"))).otherwise(F.array().cast("array<string>")))
            lines = lines.withColumn("m", F.size("ws"))
            lines = lines.withColumn("keys", F.concat(F.expr(chars), F.expr(word_keys(self.words_an_edit))))
        else:
            lines = lines.withColumn("m", F.lit(0)).withColumn("keys", F.expr(chars))
        lines = lines.withColumn("letters", F.when(F.col("n") >= self.min_chars, F.expr(_letters())))
        found = lines.groupBy("h1", "h2").agg(
            F.min(F.struct("doc_id", "th", "pos")).alias("first"),
            *[F.first(c).alias(c) for c in ("letters", "m", "keys")],
        )
        return stored(found, "lines-first")

    def meetings(self, keys: DataFrame, firsts: DataFrame) -> DataFrame:
        """Stored key, h1 and signs of the lines that share a key, each with its place among them.

        Few keys are shared, so one shuffle of all (key, h1) leaves little. Keys of words are odd.
        """
        # a line may have a key twice
        met = keys.withColumn("last", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("last > 1").drop("last")
        met = stored(met, "lines-met")
        signs = firsts.select("h1", "letters", F.col("m").cast("long").alias("m"), F.col("first.doc_id").alias("doc_id"))
        order = Window.partitionBy("key").orderBy("doc_id", "h1")
        return stored(met.join(signs, "h1").withColumn("place", F.row_number().over(order)), "lines-met")

    def pairs(self, x: DataFrame, y: DataFrame, rule: str, parities: bool = False) -> DataFrame:
        """Stored pairs (a, b) of first line hashes that share a key and are close, by_words or by characters.

        Two lines of one 64-bit hash stay together here and are told apart when verified. Each kind
        is joined by itself, so that either test is short enough to be compiled.
        """
        # a character in the place of another changes two pairs and makes two, a word is but one
        alike = f"{_flips(_CHAR_LONGS)} <= {4 * self.edits} AND " if parities else ""
        tests = [(0, f"{alike}{_close(self.edits)}")]
        if self.words_an_edit:
            most = f"least(x.m, y.m) DIV {self.words_an_edit}"
            alike = f" AND {_flips(_WORD_LONGS)} <= 2 * ({most})" if parities else ""
            tests.append((1, f"abs(x.m - y.m) <= {most}{alike}"))
        kinds = []
        for kind, close in tests:
            left, right = (side.where(f"key & 1 = {kind}").alias(name) for side, name in ((x, "x"), (y, "y")))
            found = left.join(right, F.expr(f"x.key = y.key AND x.h1 <> y.h1 AND {rule} AND {close}"))
            kinds.append(found.selectExpr("least(x.h1, y.h1) AS a", "greatest(x.h1, y.h1) AS b", f"{kind} = 1 AS by_words"))
        return stored(reduce(DataFrame.unionByName, kinds).distinct(), "lines-pairs")

    def finer(self, rest: DataFrame, firsts: DataFrame, texts: DataFrame, signs: DataFrame | None) -> DataFrame:
        """The lines of rest as they meet again: under finer keys, or among lines of about as many words."""
        lines = []
        if self.words_an_edit:
            # the longer of two lines has at most one word in so many more, so its size is the same or the next
            size = f"CAST(floor(ln(m) / (ln(1 + 1D / {self.words_an_edit}) + 1e-9)) AS INT)"
            sizes = F.explode(F.expr(f"array({size}, {size} + 1)"))
            by_words = rest.where("key & 1 = 1").select("h1", "key", sizes.alias("size"))
            lines.append(by_words.selectExpr("xxhash64(key, size) | 1L AS key", "h1"))
        by_chars = rest.where("key & 1 = 0")
        if self.edits in _FINE_EDITS:
            own = texts.join(by_chars.select("h1").distinct(), "h1", "left_semi").withColumn("n", F.char_length("line"))
            lines.append(own.select(F.explode(F.expr(fine_keys(self.edits, self.min_chars))).alias("key"), "h1"))
        else:
            lines.append(by_chars.select("key", "h1"))
        met = self.meetings(reduce(DataFrame.unionByName, lines).distinct(), firsts)
        kept = met.where("key & 1 = 0")
        own = texts.join(kept.select("h1").distinct(), "h1", "left_semi")
        again = kept.join(stored(_char_parities(own), "lines-signs"), "h1")
        if signs is not None:
            again = again.unionByName(met.where("key & 1 = 1").join(signs.drop("m"), "h1"), allowMissingColumns=True)
        return stored(again.drop("place"), "lines-again")

    def near(self, firsts: DataFrame) -> DataFrame:
        """h1 and h2 of the distinct lines with an earlier line within the threshold.

        One such line is enough. So lines are held against the first few that have their
        key, and where more have it, only those still without one are held against the rest.
        """
        met = self.meetings(firsts.select(F.explode("keys").alias("key"), "h1"), firsts)
        early = self.pairs(met.where(F.col("place") <= FEW), met, "x.place < y.place")
        rest = met.where(F.col("place") > FEW)
        # all texts that are needed from here on, in one scan of the documents
        wanted = early.select(F.explode(F.array("a", "b")).alias("h1")).unionByName(rest.select("h1"))
        texts = self.texts(wanted.distinct(), firsts)
        signs = None
        if self.words_an_edit:
            signs = stored(_word_parities(texts).join(firsts.select("h1", "m"), "h1"), "lines-signs")
            early = self.alike(early, signs)
        found = stored(self.verified(early, texts), "lines-near")
        if rest.isEmpty():
            return found
        left = firsts.join(rest.select("h1").distinct(), "h1", "left_semi").join(found, ["h1", "h2"], "left_anti")
        again = self.finer(rest, firsts, texts, signs)
        open_ = again.join(left.select("h1").distinct(), "h1", "left_semi")
        # places go by document; lines of one document are compared either way
        late = self.pairs(again, open_, "(x.doc_id IS NULL OR x.doc_id <= y.doc_id)", parities=True)
        return stored(found.unionByName(self.verified(late, texts)).distinct(), "lines-near")

    def texts(self, ids: DataFrame, firsts: DataFrame) -> DataFrame:
        """Stored h1, id, the text and the first place of each distinct line whose h1 is among the ids."""
        ids = stored(ids, "lines-wanted")
        # a filter by so many ids needs no shuffle of the lines; more ids are joined
        wanted = F.broadcast(ids) if ids.count() <= BROADCAST_LINES else ids
        lines = _lines(self.docs).join(wanted, "h1", "left_semi").groupBy("h1", "h2").agg(F.first("line").alias("line"))
        found = lines.join(firsts.select("h1", "h2", "first", "m"), ["h1", "h2"])
        # cut into words once, not for every pair
        own = F.when(F.col("m") >= (self.words_an_edit or 1), F.expr(_words("line"))).alias("ws")
        return stored(found.select("h1", F.struct("h1", "h2").alias("id"), "line", "first", own), "lines-texts")

    def alike(self, pairs: DataFrame, signs: DataFrame) -> DataFrame:
        """The pairs without those by words that the parities of their words tell apart; no text is looked at for that."""
        both = pairs.where("by_words").join(signs.alias("x"), F.expr("a = x.h1")).join(signs.alias("y"), F.expr("b = y.h1"))
        both = both.where(f"{_flips(_WORD_LONGS)} <= 2 * (least(x.m, y.m) DIV {self.words_an_edit})")
        return pairs.where("NOT by_words").unionByName(both.select(*pairs.columns))

    def verified(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """h1 and h2 of the later lines of the pairs that lie within the threshold."""
        of = lambda h, k: texts.select(
            F.col("h1").alias(h), F.col("id").alias(f"i{k}"), F.col("line").alias(f"l{k}"), F.col("ws").alias(f"w{k}"), F.col("first").alias(f"f{k}")
        )
        later = F.when(F.col("fa") < F.col("fb"), F.col("ib")).otherwise(F.col("ia")).alias("later")
        swap = F.char_length("la") >= F.char_length("lb")
        by_chars = (
            pairs.where("NOT by_words")
            .join(of("a", "a").drop("wa"), "a")
            .join(of("b", "b").drop("wb"), "b")
            .select(
                later,
                F.when(swap, F.col("la")).otherwise(F.col("lb")).alias("longer"),
                F.when(swap, F.col("lb")).otherwise(F.col("la")).alias("shorter"),
            )
            .where(f"char_length(longer) - char_length(shorter) <= {self.edits}")
            .where(F.expr(banded_distance("longer", "shorter", self.edits)) <= self.edits)
        )
        found = by_chars.select("later")
        if self.words_an_edit:
            # each word that only one of them has takes an edit
            most = f"least(size(wa), size(wb)) DIV {self.words_an_edit}"
            by_words = (
                pairs.where("by_words")
                .join(of("a", "a").drop("la"), "a")
                .join(of("b", "b").drop("lb"), "b")
                .where(f"greatest(size(array_except(wa, wb)), size(array_except(wb, wa))) <= {most}")
                .where(F.expr(word_distance("wa", "wb", most)) >= 0)
            )
            found = found.unionByName(by_words.select(later))
        return found.select("later.h1", "later.h2").distinct()

    def places(self) -> DataFrame:
        """doc_id, th, the sorted places of the lines that stay, and the count of near ones."""
        firsts = self.firsts()
        near = self.near(firsts).withColumn("is_near", F.lit(True))
        return (
            firsts.join(near, ["h1", "h2"], "left")
            .groupBy("first.doc_id", "first.th")
            .agg(
                F.sort_array(F.collect_list(F.when(F.col("is_near").isNull(), F.col("first.pos")))).alias("kept"),
                F.count("is_near").alias("n_near"),
            )
        )


def _with_places(docs: DataFrame, places: DataFrame) -> DataFrame:
    """Rows of docs with their kept places and near count; none for rows without any."""
    own = docs.withColumn("__th", F.xxhash64("text"))
    found = places.select(
        F.col("doc_id").alias("__id"), F.col("th").alias("__of"), F.col("kept").alias("__kept"), F.col("n_near").alias("__near")
    )
    hit = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__th") == F.col("__of"))
    return own.join(found, hit, "left").drop("__id", "__of", "__th")


def dedup_lines(
    docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, words_an_edit: int | None = None
) -> DataFrame:
    """The documents with duplicate lines taken out of ``text``; blank lines stay."""
    lines = F.split(F.col("text"), "\n")
    blank = F.filter(
        F.sequence(F.lit(0), F.size("__lines") - 1), lambda i: F.btrim(F.get("__lines", i), F.lit(SPACES)) == ""
    )
    kept = F.sort_array(F.array_union(F.coalesce("__kept", F.array().cast("array<int>")), blank))
    found = _with_places(docs, LineDedup(docs, edits, min_chars, words_an_edit=words_an_edit).places()).withColumn("__lines", lines)
    text = F.array_join(F.transform(kept, lambda i: F.get("__lines", i)), "\n")
    return found.withColumn("text", F.when(F.col("text").isNotNull(), text)).select(*docs.columns)


def without_duplicate_lines(docs: DataFrame) -> DataFrame:
    """Deduplicated documents, ``n_chars`` brought up to date; those that lose all lines go."""
    before = docs.withColumn("__had", F.btrim(F.coalesce("text", F.lit("")), F.lit(SPACES)) != "")
    after = dedup_lines(before).where(~F.col("__had") | (F.btrim("text", F.lit(SPACES)) != ""))
    return after.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    n_lines = F.size(F.filter(lines, lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    # counted first, so that no text is joined
    counted = docs.withColumn("n_lines", n_lines.cast("long"))
    found = _with_places(counted, LineDedup(docs, words_an_edit=WORDS_AN_EDIT).places())
    return found.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("__kept"), F.lit(0)).cast("long").alias("n_kept"),
        F.coalesce("__near", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce(F.array_join("__kept", ","), F.lit("")).alias("kept_lines"),
    )
