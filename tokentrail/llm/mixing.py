"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources get integer numbers of equal-token blocks by the highest quotients target / (2 q + 1); within a source,
shards get theirs from the source's number in the same way by their sizes. In each shard documents stand in a
seeded order and their words are cut into blocks; a quota above the number of blocks repeats all of them, and a
seeded permutation of the blocks chooses the rest. Nothing depends on partitions or time, so reruns agree.

A source has MAX_SHARDS shards at most, so that the driver sees few rows: at 100 TB in three sources a shard's window
holds about a million rows of four numbers.
Nulls: a null text has no words; a null source is a source of its own and the last; a null doc_id sorts first.
Empty texts take nothing. Rows with one doc_id, or none, are rows of their own: each has its own plan and text.
An empty table gives no rows. Other columns, of any names, are kept by mixed_documents and left out by mix.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, written

WEIGHTS = (5, 2, 1)
#: Words in a block, and words in a shard; a source has MAX_SHARDS shards at most.
BLOCK_WORDS, SHARD_WORDS, MAX_SHARDS = 64, 1 << 20, 4096


def sources_targets(sizes: list[tuple[str | None, int]], share: float = 1.5, cap: float = 2.0, weights=WEIGHTS) -> dict:
    """Target words of each source: weights repeat over the sources by code point, null last; no target is above
    cap times its source's size, and what is over goes to the other sources by weight until none is above."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    left, open_, out = share * sum(n for _, n in order), dict(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s, n in open_.items() if left * weight[s] / total > cap * n]
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = cap * open_.pop(s)
        left = share * sum(n for _, n in order) - sum(out.values())
    return out


def sainte_lague(weights: list[float], seats: int, most: list[int] | None = None) -> list[int]:
    """seats given one by one to the highest weight / (2 q + 1); ties to the first; none gets over its most.

    All start at a number that no quotient order can undercut, so few seats are dealt singly.
    """
    most = most or [seats] * len(weights)
    total = sum(weights)
    q = [min(m, max(0, int(w / total * seats - len(weights) / 2 - 1))) if total > 0 else 0 for w, m in zip(weights, most, strict=True)]
    heap = [(-w / (2 * k + 1), i) for i, (w, k, m) in enumerate(zip(weights, q, most, strict=True)) if w > 0 and k < m]
    heapq.heapify(heap)
    for _ in range(seats - sum(q)):
        if not heap:
            break
        _, i = heap[0]
        q[i] += 1
        if q[i] < most[i]:
            heapq.heapreplace(heap, (-weights[i] / (2 * q[i] + 1), i))
        else:
            heapq.heappop(heap)
    return q


def document_sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def mixed(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, seed: int = 7, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds source_size, target, passes (whole repeats), start (place of the first word in its shard), blocks, step,
    shift, rest (blocks chosen beyond the passes), shard_size and taken to (doc_id, source, size).

    ties are columns that order rows of one doc_id and size. sizes is read three times and should be a stored table. The driver sees one row for each source and shard.
    """
    spark = sizes.sparkSession
    per_source = [(r[0], r[1]) for r in sizes.groupBy("source").agg(F.sum("size")).collect()]
    targets = sources_targets(per_source, share, cap)
    n_shards = {s: max(1, min(MAX_SHARDS, -(-n // shard_words))) for s, n in per_source}
    kind = T.StructType([T.StructField("m_source", T.StringType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()), T.StructField("n_shards", T.IntegerType())])
    # one row a source: broadcast while that is few rows, else a join that Spark plans
    few = F.broadcast if len(per_source) <= 10_000 else lambda x: x
    meta = few(spark.createDataFrame([(s, n, float(targets[s]), n_shards[s]) for s, n in per_source], kind))
    key = F.xxhash64(F.lit(seed), "doc_id")
    placed = sizes.join(meta, sizes.source.eqNullSafe(meta.m_source)).withColumn("shard", F.pmod(key, F.col("n_shards").cast("long")).cast("int"))
    per_shard = sorted(((r[0], r[1], r[2]) for r in placed.groupBy("source", "shard").agg(F.sum("size")).collect()), key=lambda x: (x[0] is None, x[0] or "", x[1]))
    blocks = {(s, k): max(1, round(n / block_words)) if n else 0 for s, k, n in per_shard}
    order = sorted(targets, key=lambda s: (s is None, s or ""))
    seats = sainte_lague([targets[s] for s in order], round(sum(targets.values()) / block_words))
    rows, shards_of = [], {s: [] for s in order}
    for x in per_shard:
        shards_of[x[0]].append(x)
    for source, q in zip(order, seats, strict=True):
        own = shards_of[source]
        quota = sainte_lague([x[2] for x in own], q, [int(cap * blocks[x[:2]]) for x in own])
        for (_, k, n), given in zip(own, quota, strict=True):
            b = max(1, blocks[source, k])
            step = _step(b)
            rows.append((source, k, n, b, given // b, given % b, step, (seed * 2654435761 + k * 40503) % b))
    kind = T.StructType([T.StructField("s_source", T.StringType()), T.StructField("s_shard", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("shard_size", "blocks", "passes", "rest", "step", "shift"))])
    quotas = spark.createDataFrame(rows, kind)
    quotas = F.broadcast(quotas) if len(rows) <= 50_000 else quotas
    w = Window.partitionBy("source", "shard").orderBy(key, "doc_id", "size", *ties).rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumn("start", F.coalesce(F.sum("size").over(w), F.lit(0)))
    out = out.join(quotas, out.source.eqNullSafe(quotas.s_source) & (out.shard == quotas.s_shard))
    return out.withColumn("taken", F.col("passes") * F.col("size") + F.coalesce(_overlap(), F.lit(0))).drop("m_source", "s_source", "s_shard", "n_shards")


def _step(blocks: int) -> int:
    """A number near the golden section of blocks without a common divisor: i -> i * step spreads evenly."""
    from math import gcd

    step = max(1, int(blocks * 0.6180339887498949))
    while gcd(step, blocks) != 1:
        step += 1
    return step


def chosen_spans(size: str = "size"):
    """Spans [a, b) of the document's own words in chosen blocks, one for each block that it meets."""
    first = F.floor(F.col("start") * F.col("blocks") / F.col("shard_size")).cast("long")
    last = F.floor((F.col("start") + F.col(size) - 1) * F.col("blocks") / F.col("shard_size")).cast("long")
    edge = lambda i: F.floor((i * F.col("shard_size")) / F.col("blocks")).cast("long")
    near = F.sequence(F.greatest(first - 1, F.lit(0)), F.least(last + 1, F.col("blocks") - 1))
    chosen = F.filter(near, lambda i: F.pmod(i * F.col("step") + F.col("shift"), F.col("blocks")) < F.col("rest"))
    spans = F.transform(chosen, lambda i: F.struct(F.greatest(edge(i) - F.col("start"), F.lit(0)).alias("a"), F.least(edge(i + 1) - F.col("start"), F.col(size)).alias("b")))
    return F.when((F.col(size) > 0) & (F.col("rest") > 0), F.filter(spans, lambda x: x["b"] > x["a"]))


def _overlap():
    return F.aggregate(chosen_spans(), F.lit(0).cast("long"), lambda acc, x: acc + x["b"] - x["a"])


def mix(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    sizes = written(document_sizes(docs), "sizes")
    return mixed(sizes, **options).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, spark: SparkSession, **options) -> DataFrame:
    """The mix itself, with the columns of documents: a row for each whole pass over a document, and one more with
    the text from the first to the last word of each run of chosen blocks, runs joined by one line end."""
    columns = docs.columns
    # rows that are equal in all columns share a key; they take the plans of that key one by one
    every = [F.col(c) for c in columns]
    whole_hash = F.xxhash64(*(c.isNull() for c in every), *every)
    keyed = docs.select(F.struct(*every).alias("row"), F.col("doc_id").alias("id"), "source", F.col("text").alias("text"), whole_hash.alias("hash"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    sizes = written(keyed.select(F.col("id").alias("doc_id"), "source", size, "hash"), "sizes")
    spans = F.coalesce(chosen_spans(), F.array().cast("array<struct<a:bigint,b:bigint>>"))
    plan = F.struct("start", "passes", spans.alias("spans"))
    plans = mixed(sizes, ties=("hash",), **options).filter("taken > 0").select(F.coalesce("doc_id", F.lit(0)).alias("key"), "hash", plan.alias("plan"))
    plans = plans.groupBy("key", "hash").agg(F.array_sort(F.collect_list("plan")).alias("plans"))
    keyed = keyed.withColumn("key", F.coalesce("id", F.lit(0)))
    nth = F.row_number().over(Window.partitionBy("key", "hash").orderBy(F.lit(0)))
    both = keyed.withColumn("nth", nth).join(plans, ["key", "hash"]).withColumn("plan", F.try_element_at("plans", "nth"))
    both = both.filter("plan IS NOT NULL").select("row", "text", "plan.passes", "plan.spans")
    whole = F.transform(F.sequence(F.lit(1), F.greatest(F.col("passes"), F.lit(1))), lambda i: F.when(i <= F.col("passes"), F.col("text")))
    parts = F.concat(whole, F.array(F.when(F.size("spans") > 0, _cut("spans"))))
    out = both.withColumn("taken_text", F.explode(F.filter(parts, lambda x: x.isNotNull())))
    changed = {"text": F.col("taken_text"), "n_chars": F.char_length("taken_text").cast(dict(docs.dtypes).get("n_chars", "bigint"))}
    return out.select(*[(changed[c] if c in changed else F.col("row").getField(c)).alias(c) for c in columns])


def _cut(spans: str):
    """The chosen words with the white space between them. Spans of neighbouring blocks run on as one."""
    merged = F.aggregate(
        spans,
        F.array().cast("array<struct<a:bigint,b:bigint>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["b"] == x["a"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["a"].alias("a"), x["b"].alias("b"))))).otherwise(F.concat(acc, F.array(x))),
    )
    word = F.regexp_extract_all("text", F.lit(rf"({WORD}[\x20\x09-\x0D]*)"), F.lit(1))
    return F.array_join(F.transform(merged, lambda x: F.rtrim(F.array_join(F.slice(word, (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")), ""))), "\n")
