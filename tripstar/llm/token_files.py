"""Token ids in seekable compressed files: independent frames, a seek table, checksums.

A file is a run of zstandard frames that decompress by themselves, each with the content
checksum of its format, followed by a document list in a skippable frame and by a seek table
in a second one, laid out as the public seekable format says: for each frame its compressed
size, its size and the low half of the XXH64 of its content, then a footer of nine bytes.
Any zstandard tool decompresses the whole file; a reader of one document reads the footer,
the seek table and the frames its ids lie in, nothing else.

Ids are little-endian unsigned 32-bit integers. A frame holds whole documents up to
``frame_ids`` ids; a longer document has frames of its own. The document list holds, in
order, each id (with a mark where it is null) and number of tokens.

Documents are dealt to files by ranges of their id, sorted inside, and encoded and written
by the task that holds the range, so ids are never shuffled. Files are written in the
folder that all executors share, under names of their own for each attempt; the manifest,
one row per file written as a table, names the attempts that count. Thus a lost executor or
a second attempt leaves at most a file that no manifest names.

Defined cases: null texts are empty. Every row is a document: rows repeating an id lie side
by side, ordered by their text. Rows without an id come first. An empty table gives no file
and no document. Other columns are ignored. A text's ids may not fill memory, as they are
encoded piece by piece; the text itself must fit.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstar.llm.common import splits, stored, table
from tripstar.session import scratch_dir

VOCABULARY, END_ID = "word_bpe_49k.json", 2
FRAME_IDS = 1 << 18
FILE_BYTES = 64 << 20  # of text
PIECE_CHARS = 1_000_000
CACHED_PARTS, LONG_WORD = 400_000, 64
LEVEL = 3

# only these blanks are known to be dropped by any such vocabulary; others stay with their words
_WORD = re.compile(r"[^ \t\n\x0b\f\r]+")
_COMMON = re.compile(r"[!-~À-ÖØ-öø-ÿ¡¿«»–—‘’“”…]+")
_LETTERS = "a-zß-öø-ÿ"
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")
_ODD_BLANK = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

# fixed values: how a vocabulary of this kind says that it normalises and cuts texts
CLIPPED = (
    {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)
# byte-level vocabularies write printable bytes as they are, the others as characters from 256 on
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_STANDING = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

# numbers of the public seekable format
SKIPPABLE, LIST_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A51, 0x184D2A5E, 0x8F92EAB1
_FOOTER, _HEAD = struct.Struct("<IBI"), struct.Struct("<II")
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
_LISTED = np.dtype([("doc_id", "<i8"), ("n_tokens", "<i8"), ("known", "u1")])
_LIST_SIZES = struct.Struct("<QQI")  # documents, packed bytes, XXH64's low half

MANIFEST = "part int, path string, n_docs long, n_tokens long, n_frames long, n_bytes long"
_DOCS = "part int, doc_id long, place long, n_tokens long, ids_crc32 long"


def storage(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class WordEncoder:
    """Ids of texts under a vocabulary that drops white space, with bounded caches of words.

    Such a vocabulary never joins what blanks keep apart, so words are encoded by themselves;
    most repeat and are found in the cache. When it is full, others are encoded each time, and
    so are words of more than ``LONG_WORD`` characters.

    Where the vocabulary lowers letters and cuts words as ``CLIPPED`` says, a word of common
    Latin characters is cut here and its parts go to the library's merges alone; all other
    words, and those that may hold a special token, pass the library as a whole.
    """

    def __init__(self, vocabulary: str, cached_parts: int = CACHED_PARTS):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        config = json.loads(self.library.to_str())
        self.clipped = (config["normalizer"], config["pre_tokenizer"]) == CLIPPED
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.cached_parts = cached_parts

    def _part(self, part: str) -> bytes:
        """Ids of a word's part by the merges; bytes are written as the characters standing for them."""
        ids = self.parts.get(part)
        if ids is None:
            written = part if part.isascii() else part.encode().decode("latin-1").translate(_STANDING)
            ids = np.array([t.id for t in self.library.model.tokenize(written)], dtype="<u4").tobytes()
            if len(self.parts) < self.cached_parts and len(part) <= LONG_WORD:
                self.parts[part] = ids
        return ids

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if self.clipped and "<|" not in word and _COMMON.fullmatch(word):
                ids = b"".join(map(self._part, _PARTS.findall(word.lower())))
            else:
                ids = np.array(self.library.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
            if len(self.words) < self.cached_parts and len(word) <= LONG_WORD:
                self.words[word] = ids
        return ids

    def pieces(self, text: str, n_chars: int = PIECE_CHARS) -> Iterator[str]:
        """A text cut at blanks into pieces of about so many characters."""
        start = 0
        while start < len(text):
            end = start + n_chars
            while end < len(text) and text[end] not in " \t\n\r":
                end += 1
            yield text[start:end]
            start = end

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids of a text, piece by piece, as little-endian uint32 bytes."""
        for piece in self.pieces(text):
            words = _WORD.findall(piece) if _ODD_BLANK.search(piece) else piece.split()
            found = list(map(self.words.get, words))
            if None in found:
                found = [self._word(w) if ids is None else ids for w, ids in zip(words, found, strict=True)]
            yield b"".join(found)


@lru_cache(maxsize=2)
def word_encoder(vocabulary: str) -> WordEncoder:
    """One encoder per worker process and vocabulary."""
    return WordEncoder(vocabulary)


def _skippable(magic: int, content: bytes) -> bytes:
    return _HEAD.pack(magic, len(content)) + content


def _check(content: bytes) -> int:
    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


class Writer:
    """Writes documents into one file, in the order given."""

    def __init__(self, sink, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        self.sink, self.frame_bytes = sink, 4 * frame_ids
        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.open, self.size = [], 0
        self.entries: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int]] = []
        self.n_bytes = self.n_tokens = 0

    def _write(self, content: bytes) -> None:
        self.sink.write(content)
        self.n_bytes += len(content)

    def _frame(self) -> None:
        if self.size:
            content = b"".join(self.open)
            packed = self.pack.compress(content)
            self._write(packed)
            self.entries.append((len(packed), len(content), _check(content)))
            self.open, self.size = [], 0

    def add(self, doc_id: int | None, pieces: Iterator[bytes]) -> None:
        """One document's ids, in pieces; held only up to a frame's size."""
        held, length, own = [], 0, 0  # what is not yet in a frame, and the whole length
        for piece in pieces:
            length += len(piece)
            held.append(piece)
            own += len(piece)
            if self.size and self.size + own > self.frame_bytes:
                self._frame()  # the frame of the documents before
            while own > self.frame_bytes:  # longer than a frame
                content = b"".join(held)
                self.open, self.size = [content[: self.frame_bytes]], self.frame_bytes
                self._frame()
                held, own = [content[self.frame_bytes :]], own - self.frame_bytes
        self.open += held
        self.size += own
        if length > self.frame_bytes:
            self._frame()  # no other document shares the end of a long one
        self.docs.append((doc_id or 0, length // 4, doc_id is not None))
        self.n_tokens += length // 4

    def close(self) -> None:
        self._frame()
        listed = np.array(self.docs, dtype=_LISTED).tobytes()
        packed = self.pack.compress(listed)
        self._write(_skippable(LIST_MAGIC, packed + _LIST_SIZES.pack(len(self.docs), len(packed), _check(listed))))
        entries = np.array(self.entries, dtype=_ENTRY).tobytes()
        # bit 7 of the descriptor: entries have checksums
        self._write(_skippable(TABLE_MAGIC, entries + _FOOTER.pack(len(self.entries), 0x80, FOOTER_MAGIC)))


@dataclass
class Frame:
    at: int
    packed: int
    size: int
    check: int


class Reader:
    """Reads documents of one file; ``read_bytes`` says how much of it was read."""

    def __init__(self, source):
        self.source, self.read_bytes = source, 0
        n = source.size()
        frames, flags, magic = _FOOTER.unpack(self._at(n - _FOOTER.size, _FOOTER.size))
        if magic != FOOTER_MAGIC or flags != 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        size = frames * _ENTRY.itemsize + _FOOTER.size
        head = self._at(n - size - _HEAD.size, _HEAD.size)
        if _HEAD.unpack(head) != (TABLE_MAGIC, size):
            raise ValueError("the seek table does not fit its frame")
        entries = np.frombuffer(self._at(n - size, size - _FOOTER.size), _ENTRY)
        starts = np.cumsum([0, *entries["packed"].tolist()])
        self.frames = [Frame(int(a), int(e["packed"]), int(e["size"]), int(e["check"])) for a, e in zip(starts, entries, strict=False)]
        self.ends = np.cumsum(entries["size"].astype(np.int64))
        self.list_end = n - size - _HEAD.size
        self._docs: np.ndarray | None = None

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        content = self.source.read(size)
        if len(content) != size:
            raise ValueError("the file ends early")
        self.read_bytes += size
        return content

    @property
    def docs(self) -> np.ndarray:
        """doc_id, n_tokens, known: the documents in order."""
        if self._docs is None:
            n, packed, check = _LIST_SIZES.unpack(self._at(self.list_end - _LIST_SIZES.size, _LIST_SIZES.size))
            content = self._at(self.list_end - _LIST_SIZES.size - packed, packed)
            content = zstandard.ZstdDecompressor().decompress(content)
            if _check(content) != check or len(content) != n * _LISTED.itemsize:
                raise ValueError("the document list is damaged")
            self._docs = np.frombuffer(content, _LISTED)
        return self._docs

    def frame(self, k: int) -> bytes:
        """Content of one frame, its checksum verified."""
        f = self.frames[k]
        content = zstandard.ZstdDecompressor().decompress(self._at(f.at, f.packed))
        if len(content) != f.size or _check(content) != f.check:
            raise ValueError(f"frame {k} is damaged")
        return content

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from a place on, frame by frame; other frames are not read."""
        begin, end = 4 * start, 4 * (start + n)
        k = int(np.searchsorted(self.ends, begin, side="right"))
        while begin < end:
            first = int(self.ends[k]) - self.frames[k].size
            part = self.frame(k)[begin - first : end - first]
            yield np.frombuffer(part, "<u4")
            begin += len(part)
            k += 1

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """doc_id, place, number and CRC-32 of the ids of every document, each frame read once."""
        frames = iter(range(len(self.frames)))
        content, at, place = b"", 0, 0
        for doc_id, n, known in self.docs.tolist():
            crc, left = 0, 4 * n
            while left:
                if at == len(content):
                    content, at = self.frame(next(frames)), 0
                part = content[at : at + left]
                crc = zlib.crc32(part, crc)
                at, left = at + len(part), left - len(part)
            yield (doc_id if known else None), place, n, crc
            place += n


def write_files(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    file_bytes: int = FILE_BYTES,
    frame_ids: int = FRAME_IDS,
) -> DataFrame:
    """Write the documents in ascending order of their id; returns the manifest, one row per file."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long") + 8)).first()[0] or 0
    # rows that repeat an id are told apart by their text, which is only hashed for the ranges
    ranged = rows.withColumn("place", F.xxhash64("text"))
    ranged = ranged.repartitionByRange(splits(size, file_bytes), F.col("id").asc_nulls_first(), "place")
    ranged = ranged.sortWithinPartitions(F.col("id").asc_nulls_first(), "place", "text")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, writer = word_encoder(vocabulary), None
        files, root = storage(folder)
        path = f"part-{part:08d}-{uuid.uuid4().hex}.ids.zst"
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                if writer is None:
                    files.create_dir(root, recursive=True)
                    sink = files.open_output_stream(f"{root}/{path}", compression=None)
                    writer = Writer(sink, frame_ids)
                writer.add(doc_id.as_py(), _ended(encoder.encode(text.as_py()), end))
        if writer is not None:
            writer.close()
            sink.close()
            row = (part, f"{folder}/{path}", len(writer.docs), writer.n_tokens, len(writer.entries), writer.n_bytes)
            types = [pa.int32(), pa.string(), *[pa.int64()] * 4]
            names = [f.split()[0] for f in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)

    # only the attempts whose rows this table has are ever read
    return stored(ranged.select("id", "text").mapInArrow(run, MANIFEST), "token-manifest")


def _ended(pieces: Iterator[bytes], end: bytes) -> Iterator[bytes]:
    yield from pieces
    yield end


def _reading(path: str, use: Callable[[Reader], Iterator]) -> Iterator:
    files, at = storage(path)
    with files.open_input_file(at) as source:
        yield from use(Reader(source))


def read_files(manifest: DataFrame) -> DataFrame:
    """part, doc_id, place in the file, n_tokens and ids_crc32 of every document of the files."""
    schema = pa.schema(
        [("part", pa.int32()), ("doc_id", pa.int64()), ("place", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows: list[tuple] = []
                for row in _reading(path, Reader.documents):
                    rows.append((part, *row))
                    if len(rows) == 50_000:
                        yield _batch(rows, schema)
                        rows = []
                if rows:
                    yield _batch(rows, schema)

    n = manifest.count()
    # files are of even size: one each to a task, in an order that rows cannot skew
    return manifest.select("part", "path").repartitionByRange(max(1, n), "part").mapInArrow(run, _DOCS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def file_starts(manifest: DataFrame) -> DataFrame:
    """part, before: ids of all files before each; the manifest has one row per file."""
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return manifest.select("part", F.coalesce(before, F.lit(0)).alias("before"))


def fetch(manifest: DataFrame, wanted: Column) -> DataFrame:
    """doc_id and ids of the documents whose ``doc_id`` satisfies a condition.

    Documents are listed from the files' lists; then only frames holding wanted ones are read.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                docs = next(_reading(path, lambda r: iter([r.docs])))
                place = np.cumsum(docs["n_tokens"]) - docs["n_tokens"]
                for a in range(0, len(docs), 100_000):
                    own = slice(a, a + 100_000)
                    ids = pa.array(docs["doc_id"][own], pa.int64(), mask=docs["known"][own] == 0)
                    columns = [pa.array([path] * len(ids)), ids, pa.array(place[own]), pa.array(docs["n_tokens"][own])]
                    yield pa.RecordBatch.from_arrays(columns, names=["path", "doc_id", "place", "n_tokens"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            for path, doc_id, place, n in zip(rows["path"], rows["doc_id"], rows["place"], rows["n_tokens"], strict=True):
                ids = list(_reading(path, lambda r, a=place, n=n: r.ids(a, n)))
                ids = np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([ids])], names=["doc_id", "ids"])

    picked = manifest.select("path").mapInArrow(listed, "path string, doc_id long, place long, n_tokens long")
    return picked.where(wanted).mapInArrow(read, "doc_id long, ids array<long>")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_files(table(spark, sf_dir, "documents"), scratch_dir(spark, "token-files"))
    read = read_files(manifest).join(file_starts(manifest), "part")
    return read.select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
