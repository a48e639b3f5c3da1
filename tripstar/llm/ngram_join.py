"""N-gram Jaccard self-join by vertical partitioning, down to linked components.

Every document is the set of its word shingles, in one global order: rare shingles first,
by how many documents fall into a shingle's bucket, counted over all documents. Texts with
equal sets are one node, so copies are never compared.

1. *Candidates.* A pair at or above the threshold shares a shingle of the first fragment of
   both sets, their prefix. Shingles that only one prefix holds are dropped. A node's lonely
   prefix shingles bound its overlap with any node whose prefix reaches further, so most
   pairs of heavily edited copies are never formed.
2. *Stars.* Each node is compared with one hub, a node of many common shingles that it
   shares most with.
3. *Across components.* Pairs of nodes that are still in different components are formed
   from the shared shingles that come early enough in both sets and compared; pairs inside a component need no test, since
   only components are asked for. Two nodes of one hub that differ too much from it can
   only be linked by shingles that the hub lacks, so a group of heavily edited copies is
   not paired through what all of them have from their source.
4. *Vertical partitioning.* The order is cut into fragments at pivots of equal mass. Only
   nodes in a candidate pair send their fragments; the overlap of a pair is counted in each
   fragment by itself, and the counts are summed per pair.

Defined cases: a text with fewer words than ``width`` is one shingle; null, empty and blank
texts have no shingle and are linked with nothing. Rows are nodes by their text, so repeated
rows and rows repeating an id with another text are handled; the component of a row is the
least id it reaches. Null ids are never the name of a component unless they are alone. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstar.llm.common import stored, table
from tripstar.llm.graph import components
from tripstar.llm.shingles import mixed, shingle_set

BUCKET_BITS = 19  # buckets of the global order; 2 MB of counts from each task
FLAG_BITS = 23  # 1 MB of flags for the nodes whose sets are wanted again
FRAGMENTS = 8
ROWS_AT_ONCE = 512  # texts whose sets a task holds at a time
_CHUNK = 1 << 13  # buckets a row of partial counts
_SIGN = np.uint64(1 << 63)


def _node(shingles: np.ndarray) -> bytes | None:
    """128-bit name of a set of shingles."""
    if not len(shingles):
        return None
    again = mixed(shingles ^ np.uint64(0xA5A5A5A55A5A5A5A))
    return int(shingles.sum(dtype=np.uint64)).to_bytes(8, "little") + int(again.sum(dtype=np.uint64)).to_bytes(8, "little")


class Order:
    """The global order as an array of bucket ranks, and the pivots of its fragments."""

    def __init__(self, counts: np.ndarray, fragments: int):
        places = np.argsort(counts, kind="stable")
        self.rank = np.empty(len(counts), dtype=np.uint64)
        self.rank[places] = np.arange(len(counts), dtype=np.uint64)
        self.shift = np.uint64(64 - int(len(counts)).bit_length() + 1)
        mass = np.cumsum(counts[places])
        cuts = np.searchsorted(mass, mass[-1] * np.arange(1, fragments) / fragments)
        self.pivots = self._signed(cuts.astype(np.uint64) << self.shift)

    @staticmethod
    def _signed(tokens: np.ndarray) -> np.ndarray:
        return (tokens ^ _SIGN).view(np.int64)

    def tokens(self, shingles: np.ndarray) -> np.ndarray:
        """The set as sorted numbers whose order is the global one."""
        low = shingles & ((np.uint64(1) << self.shift) - np.uint64(1))
        own = (self.rank[shingles >> self.shift] << self.shift) | low
        return np.sort(self._signed(own))

    def cut(self, tokens: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """The fragments that hold any of the tokens."""
        edges = np.concatenate(([0], np.searchsorted(tokens, self.pivots), [len(tokens)]))
        return [(f, tokens[i:j]) for f, (i, j) in enumerate(zip(edges, edges[1:], strict=False)) if j > i]


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in small batches: sets are many times a text, and what a task makes of a batch it makes at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)
    pa.default_memory_pool().release_unused()  # the worker goes on to other stages


def _flag_of(nodes: list[bytes], bits: int) -> np.ndarray:
    firsts = np.array([int.from_bytes(x[:8], "little") for x in nodes], dtype=np.uint64)
    return (mixed(firsts) >> np.uint64(64 - bits)).astype(np.int64)


class NgramJoin:
    """One join over (doc_id, text); ``percent`` is the least Jaccard similarity."""

    def __init__(self, docs: DataFrame, width: int, percent: int, id_col: str = "doc_id", text_col: str = "text"):
        self.docs = docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th")
        )
        self.spark, self.width, self.percent = docs.sparkSession, width, percent

    def sets(self) -> DataFrame:
        """Stored doc_id, th (hash of the text), n and node of each row; sets the global order on the way."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(1 << BUCKET_BITS, dtype=np.int32)
            names = ["doc_id", "th", "n", "node", "chunk", "counts"]
            for batch in batches:
                n, nodes = [], []
                for text in batch.column(1):
                    own = shingle_set(text.as_py(), width)
                    np.add.at(counts, (own >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), 1)
                    n.append(len(own))
                    nodes.append(_node(own))
                empty = pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), *empty], names=names
                )
            rows = len(counts) // _CHUNK
            parts = [counts[i * _CHUNK : (i + 1) * _CHUNK] for i in range(rows)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(rows, pa.int64())] * 3, pa.nulls(rows, pa.binary()),
                 pa.array(range(rows), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                names=names,
            )

        found = stored(
            self.docs.mapInArrow(run, "doc_id long, th long, n long, node binary, chunk int, counts binary"), "ngram-sets"
        )

        def add(key, pdf):
            import pandas as pd

            total = np.zeros(_CHUNK, dtype=np.int64)
            for raw in pdf["counts"]:
                total += np.frombuffer(raw, dtype=np.int32)
            return pd.DataFrame({"chunk": [key[0]], "counts": [total.tobytes()]})

        # one row of counts for each chunk of buckets: a fixed size, whatever the input
        sums = (
            found.where("chunk IS NOT NULL").select("chunk", "counts")
            .groupBy("chunk").applyInPandas(add, "chunk int, counts binary").collect()
        )
        counts = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for row in sums:
            counts[row.chunk * _CHUNK : (row.chunk + 1) * _CHUNK] = np.frombuffer(row.counts, dtype=np.int64)
        self.order = self.spark.sparkContext.broadcast(Order(counts, FRAGMENTS))
        return found.where("chunk IS NULL").select("doc_id", "th", "n", "node")

    def prefixes(self) -> DataFrame:
        """A row (token, node, n, last, place) for each token of the prefix of each node."""
        width, percent, order = self.width, self.percent, self.order

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ordered, seen = order.value, set()
            for batch in _few(batches):
                tokens, nodes, sizes = [np.zeros(0, dtype=np.int64)], [], []
                lasts, lengths = [], []
                for text in batch.column(0):
                    own = shingle_set(text.as_py(), width)
                    node = _node(own)
                    if node is None or node in seen:  # a copy within the task
                        continue
                    seen.add(node)
                    n = len(own)
                    prefix = ordered.tokens(own)[: n + percent * -n // 100 + 1]
                    tokens.append(prefix)
                    nodes.append(node)
                    sizes.append(n)
                    lasts.append(prefix[-1])
                    lengths.append(len(prefix))
                repeat = np.repeat(np.arange(len(nodes)), lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens)),
                        pa.array(nodes, pa.binary()).take(pa.array(repeat)),
                        pa.array(np.array(sizes, dtype=np.int64)[repeat]),
                        pa.array(np.array(lasts, dtype=np.int64)[repeat]),
                        pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *map(np.arange, lengths)])),
                    ],
                    names=["token", "node", "n", "last", "place"],
                )

        return self.docs.select("text").mapInArrow(run, "token long, node binary, n long, last long, place long")

    def shared(self) -> DataFrame:
        """Stored prefix rows whose token is in another prefix too.

        ``lonely`` counts the node's other prefix tokens, ``known`` tells how common its
        prefix tokens are.
        """
        # the sets are made and their tokens shuffled once; most tokens end here
        of_token = Window.partitionBy("token")
        met = self.prefixes().withColumns(
            {"a": F.min("node").over(of_token), "b": F.max("node").over(of_token), "common": F.count("*").over(of_token)}
        )
        kept = stored(met.where("a <> b").drop("a", "b").distinct(), "ngram-shared")
        own = kept.groupBy("node").agg(
            (F.max(self.prefix_length("n")) - F.count("*")).alias("lonely"), F.sum("common").alias("known")
        )
        return stored(kept.drop("common").join(own, "node"), "ngram-shared")

    def prefix_length(self, n: str) -> Column:
        return F.col(n) - F.ceil(F.col(n) * self.percent / F.lit(100)) + 1

    def possible(self, x: str, y: str, unmet: str = "lonely") -> str:
        """SQL: rows x and y may reach the threshold by their sizes and unmet prefix tokens.

        The node whose prefix ends first cannot share its unmet tokens with the other.
        """
        p = self.percent
        need = f"({p} * ({x}.n + {y}.n)) / {100 + p}D"
        return (
            f"(least({x}.n, {y}.n) * 100 >= greatest({x}.n, {y}.n) * {p} AND "
            f"CASE WHEN {x}.last <= {y}.last THEN {x}.n - {x}.{unmet} ELSE {y}.n - {y}.{unmet} END >= {need} - 1e-6)"
        )

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v[, last]) with their overlap, stored; ``hit`` if they reach the threshold.

        ``met`` are the common tokens up to ``last``, none without that column.
        """
        width, order, bits = self.width, self.order, FLAG_BITS
        wanted = pairs.select("u").union(pairs.select("v")).distinct()

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            flags = np.zeros(1 << bits, dtype=bool)
            for batch in batches:
                if batch.num_rows:
                    flags[_flag_of(batch.column(0).to_pylist(), bits)] = True
            if flags.any():
                yield pa.RecordBatch.from_arrays([pa.array([np.packbits(flags).tobytes()], pa.binary())], names=["flags"])

        # flags of a fixed size tell which nodes' sets are wanted; more are sent than wanted, never fewer
        flags = np.zeros((1 << bits) // 8, dtype=np.uint8)
        for row in wanted.mapInArrow(mark, "flags binary").toLocalIterator():
            flags |= np.frombuffer(row.flags, dtype=np.uint8)
        if not flags.any():
            return pairs.selectExpr("u", "v", "0L AS n_u", "0L AS n_v", "0L AS both", "array(0L) AS met", "false AS hit")
        marked = self.spark.sparkContext.broadcast(flags)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            flags, ordered, seen = np.unpackbits(marked.value).view(bool), order.value, set()
            for batch in _few(batches):
                rows = []
                for text in batch.column(0):
                    own = shingle_set(text.as_py(), width)
                    node = _node(own)
                    if node is None or node in seen or not flags[_flag_of([node], bits)[0]]:
                        continue
                    seen.add(node)
                    rows += [(node, len(own), f, part) for f, part in ordered.cut(ordered.tokens(own))]
                nodes, sizes, fragments, parts = zip(*rows, strict=True) if rows else ([], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(fragments, pa.int32()),
                     pa.array(parts, pa.list_(pa.int64()))],
                    names=["node", "n", "fragment", "tokens"],
                )

        sent = self.docs.select("text").mapInArrow(cut, "node binary, n long, fragment int, tokens array<long>")
        sets = sent.join(wanted.withColumnRenamed("u", "node"), "node", "left_semi").dropDuplicates(["node", "fragment"])
        sets = stored(sets, "ngram-fragments")
        left = sets.selectExpr("node AS u", "n AS n_u", "fragment", "tokens AS tokens_u")
        right = sets.selectExpr("node AS v", "n AS n_v", "fragment", "tokens AS tokens_v")
        last = F.col("last") if "last" in pairs.columns else F.lit(None).cast("long")
        common = (
            pairs.select("u", "v", last.alias("last"))
            .join(left, "u")
            .join(right, ["v", "fragment"])
            .withColumn("common", F.array_intersect("tokens_u", "tokens_v"))
        )
        total = common.groupBy("u", "v", "n_u", "n_v").agg(
            F.sum(F.size("common").cast("long")).alias("both"),
            F.flatten(F.collect_list(F.filter("common", lambda t: t <= F.col("last")))).alias("met"),
        )
        hit = F.col("both") * 100 >= self.percent * (F.col("n_u") + F.col("n_v") - F.col("both"))
        return stored(total.withColumn("hit", hit), "ngram-overlaps")

    def stars(self, shared: DataFrame) -> DataFrame:
        """Stored pairs of a node u and its hub v, with the last token of u's prefix."""
        hubs = shared.groupBy("token").agg(F.max(F.struct("known", "node", "n", "last", "lonely")).alias("h"))
        met = (
            shared.alias("x")
            .join(hubs.select("token", "h.*").alias("h"), "token")
            .where("x.node <> h.node")
            .where(self.possible("x", "h"))
            .groupBy("x.node", "x.last", F.col("h.node").alias("hub"), F.col("h.known").alias("hub_known"))
            .agg(F.count("*").alias("n_met"))
        )
        best = met.groupBy("node", "last").agg(F.max_by("hub", F.struct("n_met", "hub_known", "hub")).alias("hub"))
        return stored(best.selectExpr("node AS u", "hub AS v", "last"), "ngram-stars")

    def across(self, shared: DataFrame, compared: DataFrame, known: DataFrame) -> DataFrame:
        """Stored pairs of nodes in different components that may reach the threshold."""
        tried = compared.select(F.col("u").alias("node"), F.col("v").alias("hub"), "met")
        in_hub = tried.select("node", F.explode("met").alias("token"), F.lit(True).alias("in_hub"))
        apart = tried.select("node", "hub", F.size("met").alias("n_met"))
        named = (
            shared.join(known, "node", "left")
            .join(apart, "node", "left")
            .join(in_hub, ["node", "token"], "left")
            .withColumn("component", F.coalesce("component", "node"))
            .withColumn("prefix", self.prefix_length("n"))
            .withColumn("foreign", F.coalesce(F.col("prefix") - F.col("n_met"), "lonely"))
        )
        split = named.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b")
        open_rows = stored(named.join(split.select("token"), "token"), "ngram-open")
        # by a token of their common hub, only if that hub's tokens may do
        closed = f"(x.hub IS NOT NULL AND x.hub <=> y.hub AND NOT {self.possible('x', 'y', 'foreign')})"
        rule = (
            "x.token = y.token AND x.node < y.node AND x.component <> y.component AND "
            f"{self.possible('x', 'y')} AND NOT ({closed} AND x.in_hub IS NOT NULL)"
        )
        # the first token of two linked nodes has enough of both sets from its place on
        early = "least(x.n - x.place, y.n - y.place) >= need - 1e-6"
        # what the node whose prefix ends first can share apart from the tokens met here
        rest = "CASE WHEN x.last <= y.last THEN x.n - IF({0}, x.foreign, x.prefix) ELSE y.n - IF({0}, y.foreign, y.prefix) END"
        p = self.percent
        need = f"({p} * (x.n + y.n)) / {100 + p}D"
        found = (
            open_rows.alias("x")
            .join(open_rows.alias("y"), F.expr(f"{rule} AND ({closed} OR {early.replace('need', need)})"))
            .selectExpr("x.node AS u", "y.node AS v", f"{closed} AS closed", f"{rest.format(closed)} AS rest", f"{need} AS need")
            .distinct()
        )
        # then all tokens of both prefixes count, of closed pairs those that the hub lacks
        own = open_rows.groupBy("node").agg(
            F.collect_list("token").alias("tokens"), F.collect_list(F.expr("IF(in_hub IS NULL, token, NULL)")).alias("outside")
        )
        left, right = own.selectExpr("node AS u", "tokens AS all_u", "outside AS out_u"), own.selectExpr("node AS v", "tokens AS all_v")
        met = F.expr("size(array_intersect(IF(closed, out_u, all_u), all_v))")
        pairs = found.join(left, "u").join(right, "v").where(met + F.col("rest") >= F.col("need") - 1e-6).select("u", "v")
        tested = compared.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        return stored(pairs.join(tested, ["u", "v"], "left_anti"), "ngram-pairs")

    def named(self) -> DataFrame:
        """doc_id, th, n and the name of the component of each row; no name without shingles."""
        rows = self.sets()
        shared = self.shared()
        compared = self.linked(self.stars(shared))
        links = compared.where("hit").select("u", "v")
        more = self.linked(self.across(shared, compared, components(links))).where("hit")
        final = components(links.unionByName(more.select("u", "v")))
        # a row without a link is its own component; copies share their node
        return rows.join(final, "node", "left").select("doc_id", "th", "n", F.coalesce("component", "node").alias("name"))

    def run(self) -> DataFrame:
        """doc_id, n_shingles and component_id of each row."""
        joined = self.named()
        least = joined.where("name IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("component_id"))
        return joined.join(least, "name", "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
        )


def ngram_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (least id reachable by links) of each row."""
    return NgramJoin(docs, width, percent).run()


def one_of_each_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Of each component the row of the least id and hash of the text; rows without id stay.

    A row is told by its id and text, so another text of the same id is judged by itself.
    Rows repeating both are kept once.
    """
    rows = stored(NgramJoin(docs, width, percent).named().where("doc_id IS NOT NULL AND name IS NOT NULL"), "ngram-rows")
    row = F.struct("doc_id", "th")
    first = rows.groupBy("name").agg(F.min(row).alias("first"))
    gone = rows.join(first, "name").where(row != F.col("first")).select("doc_id", "th").distinct()
    own = (docs["doc_id"].cast("long") == gone["doc_id"]) & (F.xxhash64(docs["text"]) == gone["th"])
    kept = docs.join(gone, own, "left_anti")
    place = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    once = kept.withColumn("__place", F.row_number().over(place)).where("__place = 1 OR doc_id IS NULL")
    return once.select(*docs.columns)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), width=3, percent=90)
