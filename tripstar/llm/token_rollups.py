"""Delta-maintained token totals by source, language and tokenizer version.

A batch of inserts, deletes and revised texts becomes signed rows per document and
tokenizer: minus what is on record for the document, plus its new counts. Their sums by
key are added to the rollup. Entries are kept in buckets by the hash of the document's id and
sorted by it; a batch reads those of its documents' buckets, and no text or total again.

Tables of a ledger, all append-only, under one shared folder:

* ``entries``: doc_id, source, lang, tokenizer, n_docs, n_tokens (signed), by attempt and bucket
* ``rollups``: the same summed over documents, by attempt
* ``commits``: one row (batch_id, attempt, number), written last; numbers ascend

A batch counts only by the commit row of its attempt, and of several only the first counts, by
number, so what was read once stays. Committing a batch id again is a no-op, and an attempt that died
leaves rows that nothing reads. There is one writer at a time.

Defined cases: a null text has 0 tokens; null sources and languages are keys of their own.
Several changes of one document in a batch: the one with the largest ``seq`` holds, ties by
the largest remaining values. An insert of a known document is a revision, a delete of an
unknown one does nothing. Rows without id are counted when inserted, never found again.
An empty batch commits and changes nothing. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import table
from tripstar.llm.tokens import counter, in_batches
from tripstar.session import scratch_dir

TOKENIZERS = {"byte_bpe_50k": "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k": "byte_bpe_multi_50k.tiktoken"}

KEYS = ["source", "lang", "tokenizer"]
ENTRIES = "doc_id long, source string, lang string, tokenizer string, n_docs long, n_tokens long, attempt string"
BUCKETS = 64
ROLLUPS = "source string, lang string, tokenizer string, n_docs long, n_tokens long, attempt string"
COMMITS = "batch_id string, attempt string, number long"


def with_counts(changes: DataFrame, tokenizers: dict[str, str] = TOKENIZERS) -> DataFrame:
    """Replace the text by an array of its token counts, one for each tokenizer."""
    ranks = tuple(tokenizers.values())
    kept = [f for f in changes.schema.fields if f.name != "text"]
    schema = pa.schema([
        *[("seq" if f.name == "seq" else f.name, pa.int64() if f.name in ("doc_id", "seq") else pa.string()) for f in kept],
        ("counts", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(ranks).count
        for batch in batches:
            at = batch.schema.get_field_index("text")
            counts = [count(t) for run in in_batches(batch.column(at).to_pylist()) for t in run]
            own = [c for i, c in enumerate(batch.columns) if i != at]
            columns = [c.cast(f.type) for c, f in zip(own, schema, strict=False)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.list_(pa.int64()))], schema=schema)

    ddl = ", ".join(f"{f.name} {'long' if f.name in ('doc_id', 'seq') else 'string'}" for f in kept)
    return changes.withColumn("text", F.coalesce("text", F.lit(""))).mapInArrow(run, f"{ddl}, counts array<long>")


def bucket(doc_id: Column) -> Column:
    """The bucket of a document's entries; rows without an id, never found again, go with id 0's."""
    return F.pmod(F.xxhash64(F.coalesce(doc_id, F.lit(0))), F.lit(BUCKETS)).cast("int")


class TokenLedger:
    """Totals kept in a folder; see the module's text for its tables."""

    def __init__(self, spark: SparkSession, path: str, tokenizers: dict[str, str] = TOKENIZERS):
        self.spark, self.path, self.tokenizers = spark, path.rstrip("/"), tokenizers
        for name, schema in (("entries", ENTRIES), ("rollups", ROLLUPS), ("commits", COMMITS)):
            # a folder without rows, made once: every table can be read from the start
            place = self._folder(name, "none") if name != "commits" else f"{self.path}/{name}"
            rows = spark.createDataFrame([], schema).drop("attempt" if name != "commits" else "")
            rows.write.mode("ignore").parquet(f"{place}/bucket=0" if name == "entries" else place)

    def _folder(self, name: str, attempt: str) -> str:
        return f"{self.path}/{name}/attempt={attempt}"

    def commits(self) -> DataFrame:
        """The attempt that counts, for each committed batch."""
        rows = self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits")
        return rows.groupBy("batch_id").agg(F.min_by("attempt", F.struct("number", "attempt")).alias("attempt"))

    def _committed(self, name: str, schema: str) -> DataFrame:
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        return rows.join(self.commits().select("attempt"), "attempt", "left_semi").drop("attempt")

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch of (doc_id, op, text, source, lang[, seq]); False if it was committed before.

        ``op`` is insert, revise or delete.
        """
        if not self.commits().where(F.col("batch_id") == batch_id).isEmpty():
            return False
        seq = F.col("seq").cast("long") if "seq" in changes.columns else F.lit(0).cast("long")
        named = changes.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("op").cast("string").alias("op"),
            F.when(F.col("op") != "delete", F.col("text")).alias("text"),
            F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
            F.coalesce(seq, F.lit(0)).alias("seq"),
        )
        counted = with_counts(named, self.tokenizers)
        # the last change of a document; rows without id stay apart
        order = F.struct("seq", "op", "source", "lang", "counts")
        last = (
            counted.groupBy("doc_id", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("row"))
            .agg(F.max(order).alias("last"))
            .select("doc_id", "last.*")
        )
        names = F.array(*[F.lit(n) for n in self.tokenizers])
        added = (
            last.where("op IN ('insert', 'revise')")
            .select("doc_id", "source", "lang", F.explode(F.arrays_zip(names.alias("t"), F.col("counts").alias("n"))).alias("x"))
            .select("doc_id", "source", "lang", F.col("x.t").alias("tokenizer"), F.lit(1).cast("long").alias("n_docs"), F.col("x.n").alias("n_tokens"))
        )
        delta = added
        if not self.commits().isEmpty():
            changed = changes.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
            touched = [r.b for r in changed.select(bucket(F.col("doc_id")).alias("b")).distinct().collect()]
            recorded = (
                self._committed("entries", f"{ENTRIES}, bucket int")
                .where(F.col("bucket").isin(touched))
                .join(changed, "doc_id", "left_semi")
                .groupBy("doc_id", *KEYS)
                .agg((-F.sum("n_docs")).alias("n_docs"), (-F.sum("n_tokens")).alias("n_tokens"))
                .where("n_docs <> 0 OR n_tokens <> 0")
            )
            delta = added.unionByName(recorded)
        attempt = uuid.uuid4().hex
        placed = delta.withColumn("bucket", bucket(F.col("doc_id"))).hint("rebalance", "bucket")
        folder = self._folder("entries", attempt)
        placed.sortWithinPartitions("bucket", "doc_id").write.partitionBy("bucket").parquet(folder)
        entries = self.spark.read.schema(ENTRIES.rpartition(",")[0]).parquet(folder)
        sums = entries.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        sums.where("n_docs <> 0 OR n_tokens <> 0").write.parquet(self._folder("rollups", attempt))
        done = self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits").agg(F.max("number")).first()[0] or 0
        self.spark.createDataFrame([(batch_id, attempt, done + 1)], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs and n_tokens over all committed batches."""
        return (
            self._committed("rollups", ROLLUPS)
            .groupBy(*KEYS)
            .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            .where("n_docs <> 0")
        )


def changes_of(docs: DataFrame) -> list[DataFrame]:
    """The batches of the registered query, whose net effect is the whole table.

    All documents come in, an eighth of them with an older text (in upper case); then these are
    revised to what they are and another eighth is deleted; then the deleted ones come again.
    """
    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 8
    named = docs.select("doc_id", "text", "source", "lang", part.alias("part"))
    older = F.when((F.col("part") == 2) & F.col("doc_id").isNotNull(), F.upper("text")).otherwise(F.col("text"))
    known = named.where("doc_id IS NOT NULL")
    op = F.when(F.col("part") == 1, "delete").otherwise("revise")
    return [
        named.withColumns({"op": F.lit("insert"), "text": older}).drop("part"),
        known.where("part IN (1, 2)").withColumn("op", op).drop("part"),
        known.where("part = 1").withColumn("op", F.lit("insert")).drop("part"),
    ]


def op9_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = TokenLedger(spark, scratch_dir(spark, "token-ledger"))
    first, second, third = changes_of(table(spark, sf_dir, "documents"))
    ledger.commit("0001", first)
    ledger.commit("0002", second)
    ledger.commit("0002", second)  # sent again: no-op
    ledger.commit("0003", third)
    return ledger.totals()
