"""Mixing overlapping sources to target weights by a min-cost flow.

Documents are aggregated by membership pattern, the set of sources they belong to. Tokens
flow from patterns to the sources they are members of, up to each source's quota. Going
through a pattern's documents for the k-th time costs k squared a token, so that a document
is repeated only when nothing unused can serve a quota. As costs lie on a pattern's passes
alone, the cheapest flow opens the passes one after another and, in each, routes as much as
augmenting paths can. Then documents are taken in seeded order until their pattern's flow
is used up; the last one is taken in part, so that quotas are met to the word.

The flow has a node for each pattern and source, not for each document; it is solved on the
driver from one aggregated row a pattern. Running totals inside a pattern are taken in two
steps, over hash ranges and inside each range, so no task holds a whole pattern.

Defined cases: a null text has size 0; a document of size 0 is taken 0 times; null is a
source like any other, last in order; repeated rows are documents of their own; an empty
table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import json
from collections import defaultdict, deque

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import n_words, splits, stored, table

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
PASSES = 2
SEED = 7
ROWS_A_RANGE = 2000


def weighted_targets(sizes: dict[str | None, int], weights=WEIGHTS, budget: float = BUDGET, passes: int = PASSES):
    """Share ``budget`` times all words by weight; no source gets over ``passes`` times its size.

    Weights repeat over the sources in code point order, null last. What a full source
    leaves is shared again by weight until none is above its limit.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_ = budget * sum(sizes.values()), list(order)
    targets: dict[str | None, float] = {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if passes * sizes[s] < weight[s] * share]
        if not above:
            targets.update({s: weight[s] * share for s in open_})
            break
        targets.update({s: float(passes * sizes[s]) for s in above})
        left -= sum(passes * sizes[s] for s in above)
        open_ = [s for s in open_ if s not in targets]
    return targets


def route(patterns: list[tuple[tuple, int]], quotas: dict, passes: int = PASSES) -> list[dict]:
    """Words from each pattern (members, size) to each member source, at the least cost.

    Passes open in order of their cost. Inside a pass, a path leads from a source in need
    over patterns that serve it: one with room ends the path, one that serves another
    source passes its words on and the search goes on for that source.
    """
    need = dict(quotas)
    flow: list[dict] = [defaultdict(int) for _ in patterns]
    of_source = defaultdict(list)
    for p, (members, _) in enumerate(patterns):
        for s in members:
            of_source[s].append(p)
    for _ in range(passes):
        room = [size for _, size in patterns]
        for target in sorted(need, key=lambda s: (s is None, s or "")):
            while need[target] > 0:
                came: dict = {target: None}  # source -> (pattern, source it frees words for)
                queue, end = deque([target]), None
                while queue and end is None:
                    s = queue.popleft()
                    for p in of_source[s]:
                        if room[p] > 0:
                            end = (p, s)
                            break
                        for other, words in flow[p].items():
                            if words > 0 and other not in came:
                                came[other] = (p, s)
                                queue.append(other)
                if end is None:
                    break
                p, s = end
                steps, amount = [], min(room[p], need[target])
                while came[s] is not None:
                    q, before = came[s]
                    steps.append((q, s, before))
                    amount = min(amount, flow[q][s])
                    s = before
                room[p] -= amount
                flow[p][end[1]] += amount
                for q, s, before in steps:
                    flow[q][s] -= amount
                    flow[q][before] += amount
                need[target] -= amount
    return flow


def _range_of(key: Column, n: int) -> Column:
    """Hash range of a document's place in seeded order: keeps the order, evenly filled."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * n / F.lit(2**32)).cast("int")


def mix(sized: DataFrame, make_quotas, passes: int = PASSES) -> DataFrame:
    """Add pattern and taken to stored rows of (doc_id, members array<string>, size, place).

    ``make_quotas`` turns the size of each source into its quota in words.
    """
    spark = sized.sparkSession
    sized = sized.withColumn("pattern", F.to_json("members"))
    found = sized.groupBy("pattern").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    found.sort(key=lambda r: r.pattern)
    patterns = [(tuple(json.loads(r.pattern)), r.size) for r in found]
    source_sizes: dict = defaultdict(int)
    for members, size in patterns:
        for s in members:
            source_sizes[s] += size
    flows = route(patterns, make_quotas(dict(source_sizes)), passes)
    used = [(r.pattern, sum(f.values())) for r, f in zip(found, flows, strict=True)]
    flow = spark.createDataFrame(used, "pattern string, flow long")
    ranges = splits(max((r.n for r in found), default=0), ROWS_A_RANGE)
    sized = sized.withColumn("range", _range_of(F.col("place"), ranges))
    starts = (
        sized.groupBy("pattern", "range")
        .agg(F.sum("size").alias("words"))
        .selectExpr(
            "pattern",
            "range",
            "coalesce(sum(words) OVER (PARTITION BY pattern ORDER BY range "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS start",
            "sum(words) OVER (PARTITION BY pattern) AS pattern_size",
        )
        .join(flow, "pattern", "left")
    )
    placed = sized.join(starts, ["pattern", "range"]).withColumn(
        "before",
        F.col("start")
        + F.expr(
            "coalesce(sum(size) OVER (PARTITION BY pattern, range ORDER BY place, doc_id, size "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"
        ),
    )
    taken = sum(
        (
            F.greatest(
                F.lit(0),
                F.least(
                    F.col("size"),
                    F.least(F.coalesce("flow", F.lit(0)) - F.lit(k) * F.col("pattern_size"), F.col("pattern_size"))
                    - F.col("before"),
                ),
            )
            for k in range(passes)
        ),
        F.lit(0),
    )
    return placed.withColumn("taken", taken.cast("long")).drop("range", "start", "before", "flow", "pattern_size")


def sized_documents(docs: DataFrame, members: Column, seed: int = SEED, carry: bool = False) -> DataFrame:
    """Rows that ``mix`` takes, with the word count of whole texts; ``row`` carries the input's."""
    return docs.select(
        *([F.struct(*docs.columns).alias("row")] if carry else []),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.array_sort(F.array_distinct(members)).alias("members"),
        n_words(F.col("text")).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("place"),
    )


def mix_by_weight(sized: DataFrame) -> DataFrame:
    """Add source_size, target and taken to sized documents of one source each."""
    spark = sized.sparkSession
    plan: list[tuple[str | None, int, float]] = []

    def quotas(sizes: dict) -> dict:
        targets = weighted_targets(sizes)
        plan.extend((s, sizes[s], targets[s]) for s in sizes)
        return {s: int(t + 0.5) for s, t in targets.items()}

    mixed = mix(sized, quotas)
    targets = spark.createDataFrame(plan, "source string, source_size long, target double")
    return mixed.join(targets, mixed["members"][0].eqNullSafe(targets["source"])).drop("source")


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows the mix takes, whole: once for each pass.

    The document at the end of a quota is taken once more if the quota holds half of its words
    or more, and left out otherwise, so no text is cut and a quota is missed by half a document.
    """
    mixed = mix_by_weight(sized_documents(docs, F.array(F.col("source")), seed, carry=True))
    rest = F.col("taken") % F.col("size")
    times = F.expr("CAST(taken DIV size AS INT)") + (2 * rest >= F.col("size")).cast("int")
    taken = mixed.where("taken > 0").withColumn("times", times).where("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = stored(sized_documents(docs, F.array(F.col("source"))), "mixing-sizes")
    return mix_by_weight(sized).select("doc_id", "size", "source_size", "target", "taken")
