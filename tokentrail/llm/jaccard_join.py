"""Exact set-similarity self-join of word-shingle sets, with set-relation skipping.

A document's set holds the hashes of its distinct shingles. Two documents link when 100 * |A & B| >= percent * |A | B|.

1. Equal sets are one class with its least doc_id as representative; copies take no further part.
2. Shingles have one order: rare ones by hash, then frequent ones by how often they occur (those that stand in many
   prefixes under the order of hashes alone). Linked sets share an element of their first n - ceil(percent n / 100) + 1
   elements. Elements in one prefix only are left out by a filter of bounded size.
3. Answers against the heads: the head of an index list is the set with the fewest elements of its own, of equal ones
   that with the least doc_id, so that a head is like what a group has in common. Each set is held against the head of
   most of its lists, if these are a quarter of its prefix, so that a group of near copies costs a pair for each of its
   sets. A head that links with a set leads it; the set's `plus` counts the elements that its leader lacks.
4. Answers between groups: of each list one entry a leader is left, and lists within one component go. Entries stand
   in blocks of one size, by the place of the element. A probe steps over whole blocks: those too large, those whose
   sizes need more further elements than its own place leaves; and of a block it takes only the entries before the
   place from which on too few are left. Lists longer than LONG also hold leaders against each other by how many
   elements they have in each of BUCKETS.
5. A member's answers are derived from its leader's. Leaders are held against each other in full. A member m of leader a
   shares with a set b what a shares with it, and of the elements that a lacks those that m and b both have, at most. So
   only these few differences are indexed, and m is held against b where they meet in an element of enough rarity that
   the two could link, or where the leader's count alone would do; then in the same way b's members against such m.
6. Components of the links are found by star contraction.

The set element is a 64-bit hash. Nulls: a null text, or one without words, has an empty set that links with
nothing; a text of fewer words than a shingle is one shingle of all. A null doc_id takes no part and its component is
null. Rows with one doc_id are one document, whose set is that of the text with the least hash; each row keeps its own
n_shingles. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from . import filters
from .common import drop_written, mix64, partitions, shingle_set, slices, unmix64, utf8, written

WORDS, PERCENT = 4, 85
#: Prefixes that a frequent shingle stands in; frequent shingles at most; entries of a list that is long; buckets of a
#: set's element counts; pairs that are held at once.
OFTEN, FREQUENT, LONG, BUCKETS, TOGETHER = 5, 1 << 19, 48, 512, 400_000


def _set(text: bytes, words: int) -> np.ndarray:
    return shingle_set(text.lower(), words)


def _head(n: int, percent: int) -> int:
    """Elements of which linked sets share one."""
    return n - (percent * n + 99) // 100 + 1


def _need(a, b, percent: int):
    """The least number of elements that linked sets of these sizes share."""
    return (percent * (a + b) + 99 + percent) // (100 + percent)


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, signature, prefix): equal sets have equal signatures, an empty set has none; prefix holds
    the first elements by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = [_set(t, words) for t in utf8(b.column(1))]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            firsts = [s[: _head(len(s), percent)].tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, sets), pa.int64()), pa.array(digests, pa.binary()), pa.array(firsts, pa.binary())], names=["doc_id", "n_shingles", "signature", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, signature binary, prefix binary")


def frequent_shingles(firsts: DataFrame, least: int = OFTEN, most: int = FREQUENT) -> np.ndarray:
    """Elements that stand in many prefixes by hash, the rarest first: `most` of them, those in most prefixes. An
    element of d sets is in the prefixes of a fixed share of them, so all sets are counted."""
    n = partitions(firsts.sparkSession)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1024):
            yield filters.blobs(mix64(np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint64)), n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            for part, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(part, []).append(np.frombuffer(raw, np.uint64))
        for part in sorted(held):
            v, c = np.unique(np.concatenate(held.pop(part)), return_counts=True)
            v, c = v[c >= least], c[c >= least]
            yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(c.astype(np.int64))], names=["value", "n"])

    blobs = firsts.select("prefix").mapInArrow(values, filters.BLOBS).repartitionById(n, "part")
    rows = blobs.mapInArrow(count, "value long, n long").orderBy(F.col("n").desc(), "value").limit(most).toPandas()
    order = np.lexsort((rows["value"].to_numpy(), rows["n"].to_numpy()))
    return unmix64(rows["value"].to_numpy(np.int64)[order].view(np.uint64))


class Order:
    """The order of shingles: rare ones by a scattered hash, then frequent ones as given."""

    def __init__(self, frequent: np.ndarray) -> None:
        self.place = np.argsort(frequent, kind="stable")
        self.sorted = frequent[self.place]

    def __call__(self, values: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return values
        at = np.minimum(np.searchsorted(self.sorted, values), len(self.sorted) - 1)
        often = self.sorted[at] == values
        return np.concatenate([values[~often], values[often][np.argsort(self.place[at[often]])]])


def prefixes(texts: DataFrame, firsts: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n, prefix): the first elements, by the order of shingles, of the sets that firsts (doc_id, ...) names."""
    frequent = frequent_shingles(firsts)
    if not len(frequent):
        return firsts.select("doc_id", F.col("n_shingles").alias("n"), "prefix")
    sent = texts.sparkSession.sparkContext.broadcast((frequent, filters.of_ids(firsts.select("doc_id"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(sent.value[0])
        for b in slices(batches):
            b = filters.chosen(b, sent.value[1])
            sets = [_set(t, words) for t in utf8(b.column(1))]
            cut = [order(s)[: _head(len(s), percent)].tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, sets), pa.int64()), pa.array(cut, pa.binary())], names=["doc_id", "n", "prefix"])

    found = texts.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, prefix binary")
    return found.join(firsts.select("doc_id").hint("merge"), "doc_id", "left_semi")


def postings(heads: DataFrame) -> DataFrame:
    """(element, size, at, doc_id, own, before) of prefix elements that another set's prefix may have: the set's size,
    the element's place in it, how many of the set's prefix no other has, and the element before (0 at the first place)."""
    n = partitions(heads.sparkSession)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1024):
            yield filters.blobs(mix64(np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint64)), n)

    shared = heads.sparkSession.sparkContext.broadcast(filters.build(heads.select("prefix").mapInArrow(values, filters.BLOBS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 512):
            raw = b.column(2).to_pylist()
            counts = np.array([len(x) // 8 for x in raw], np.int64)
            element = np.frombuffer(b"".join(raw), np.uint64)
            ends = np.cumsum(counts)
            at = np.arange(len(element)) - np.repeat(ends - counts, counts)
            before = np.concatenate([[np.uint64(0)], element[:-1]]) if len(element) else element
            before = np.where(at == 0, np.uint64(0), before)
            keep = shared.value.maybe(mix64(element))
            size = np.repeat(b.column(1).to_numpy(), counts)
            doc = np.repeat(b.column(0).to_numpy(), counts)
            common = np.concatenate([[0], np.cumsum(keep)])
            own = np.repeat(counts - (common[ends] - common[ends - counts]), counts)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (element.view(np.int64), size, at, doc, own, before.view(np.int64))], names=["element", "size", "at", "doc_id", "own", "before"])

    return heads.select("doc_id", "n", "prefix").mapInArrow(run, "element long, size long, at long, doc_id long, own long, before long")


def lists(rows: DataFrame) -> DataFrame:
    """The index lists of two sets or more: rows with the list's head, the set with the fewest elements of its own.
    Heads are found with partial sums, and joined back, so no list has to be in one task."""
    heads = rows.groupBy("element").agg(F.min(F.struct("own", "doc_id")).alias("h"), F.count(F.lit(1)).alias("length")).filter("length > 1")
    return rows.drop("own").join(heads.select("element", F.col("h.doc_id").alias("head")).hint("merge"), "element")


def stars(index: DataFrame, percent: int) -> DataFrame:
    """(a, b): each set b with the head a of most of its lists, if that is a quarter of its prefix or more."""
    each = index.filter("doc_id <> head").groupBy(F.col("head").alias("a"), F.col("doc_id").alias("b"), "size").agg(F.count(F.lit(1)).alias("c"))
    best = each.groupBy("b", "size").agg(F.max(F.struct("c", (-F.col("a")).alias("least"))).alias("best"))
    prefix = F.col("size") - F.ceil(percent * F.col("size") / 100) + 1
    return best.filter(4 * F.col("best.c") >= prefix).select((-F.col("best.least")).alias("a"), "b")


# ---- pairs of entries, block by block ----


def _expanded(probe: np.ndarray, start: np.ndarray, count: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (probe, start + 0 ... count - 1), about `most` at once."""
    live = np.flatnonzero(count)
    probe, start, count = probe[live], start[live], count[live]
    total, at = np.cumsum(count), 0
    while at < len(probe):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, side="right")))
        c = count[at:end]
        yield np.repeat(probe[at:end], c), np.repeat(start[at:end] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
        at = end


def block_pairs(element: np.ndarray, low: np.ndarray, high: np.ndarray, rest: np.ndarray, percent: int, most: int = TOGETHER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j, of entries in one list that can link by their sizes (low to high) and by how many elements
    each has left from this one on at most. Rows are sorted by element, low and falling rest."""
    if not len(element):
        return
    opens = np.concatenate([[True], (element[1:] != element[:-1]) | (low[1:] != low[:-1])])
    starts = np.flatnonzero(opens)
    block = np.cumsum(opens) - 1
    scale = int(rest.max()) + 2
    key = block * scale - rest  # ascending over all rows
    probe, at = np.arange(len(element)), block
    while len(probe):
        need = _need(low[probe], low[starts[at]], percent)
        # within the block, entries with enough left stand first: one search steps over the others
        cut = np.searchsorted(key, at * scale - need, side="right")
        start = np.maximum(starts[at], probe + 1)
        yield from _expanded(probe, start, np.where(rest[probe] >= need, np.maximum(cut - start, 0), 0), most)
        at = at + 1
        on = at < len(starts)
        probe, at = probe[on], at[on]
        on = (element[starts[at]] == element[probe]) & (percent * low[starts[at]] <= 100 * high[probe])
        probe, at = probe[on], at[on]


_ENTRY = ["element", "low", "high", "rest", "leader", "component", "before", "reach"]


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches, cut where a list ends."""
    parts: list[list[np.ndarray]] = []
    for b in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if not len(cols[0]):
            continue
        cut = int(np.searchsorted(cols[0], cols[0][-1]))
        if cut or (parts and parts[-1][0][-1] != cols[0][0]):
            parts.append([c[:cut] for c in cols])
            yield [np.concatenate(x) for x in zip(*parts, strict=True)]
            parts = []
        parts.append([c[cut:] for c in cols])
    if parts:
        yield [np.concatenate(x) for x in zip(*parts, strict=True)]


def leader_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of leaders of different components that can have linked members. With a column counts, leaders are
    also held against each other by these."""
    columns = [*_ENTRY, *(["counts"] if "counts" in entries.columns else [])]
    n = partitions(entries.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for element, low, high, rest, leader, component, before, reach, *vectors in _whole_lists(batches):
            table = Counts(vectors[0]) if vectors else None
            for i, j in block_pairs(element, low, high, rest, percent):
                # an element before this one that both have: an earlier list has the pair
                ok = (component[i] != component[j]) & ((before[i] != before[j]) | (before[i] == 0))
                i, j = i[ok], j[ok]
                if table is not None and len(i):
                    shared = np.concatenate([np.minimum(table[i[k : k + 4096]], table[j[k : k + 4096]]).sum(axis=1, dtype=np.int64) for k in range(0, len(i), 4096)])
                    ok = shared + reach[i] + reach[j] >= _need(low[i], low[j], percent)
                    i, j = i[ok], j[ok]
                if len(i):
                    a, b = np.unique(np.stack([np.minimum(leader[i], leader[j]), np.maximum(leader[i], leader[j])]), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    dealt = entries.select(*columns).repartition(n, "element").sortWithinPartitions("element", "low", F.desc("rest"), "leader")
    return dealt.mapInArrow(run, "a long, b long").distinct()


# ---- counts of elements ----


def _counts(s: np.ndarray, most: int = 255) -> bytes:
    """How many elements fall in each of BUCKETS. Two sets share no more than the sum of the lesser counts."""
    counts = np.bincount((s % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    return counts.astype(np.uint8 if counts.max() <= most else np.uint32).tobytes()


class Counts:
    """Rows of element counts: a byte each, and four in the vectors of very large sets."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.wide = np.array([len(v) > BUCKETS for v in vectors], bool)
        self.narrow = np.frombuffer(b"".join(vectors[~self.wide]), np.uint8).reshape(-1, BUCKETS)
        self.large = np.frombuffer(b"".join(vectors[self.wide]), np.uint32).reshape(-1, BUCKETS)
        self.place = np.where(self.wide, np.cumsum(self.wide), np.cumsum(~self.wide)) - 1

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        wide = self.wide[i]
        if not wide.any():
            return self.narrow[self.place[i]]
        out = np.empty((len(i), BUCKETS), np.uint32)
        out[wide], out[~wide] = self.large[self.place[i[wide]]], self.narrow[self.place[i[~wide]]]
        return out


def bucket_counts(texts: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(doc_id, counts) of the documents that ids names, and of few others."""
    sent = texts.sparkSession.sparkContext.broadcast(filters.of_ids(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            b = filters.chosen(b, sent.value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_counts(_set(t, words)) for t in utf8(b.column(1))], pa.binary())], names=["doc_id", "counts"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, counts binary")


# ---- whole sets ----


def _both(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, text_a, text_b) of pairs (a, b). Texts that no pair names stay where they are: a filter of bounded size goes
    to the scan. Joins are by sorting, so that no stage holds two Python functions."""
    sent = texts.sparkSession.sparkContext.broadcast(filters.of_ids(pairs))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield filters.chosen(b, sent.value)

    found = texts.select("doc_id", "text").mapInArrow(some, "doc_id long, text string")
    a, b = (found.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}")).hint("merge") for x in "ab")
    return pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The two sets of each row of _both; neighbours mostly share the first."""
    last, own = None, None
    for x, ta, tb in zip(batch.column(0).to_pylist(), utf8(batch.column(2)), utf8(batch.column(3)), strict=True):
        if x != last:
            last, own = x, _set(ta, words)
        yield own, _set(tb, words)


def overlaps(texts: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """(a, b, shared, n_a, n_b) of pairs (a, b), by their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)) for x, y in _sets(batch, words)]
            counts = np.array(out, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(counts[:, k]) for k in range(3))], names=["a", "b", "shared", "n_a", "n_b"])

    return _both(texts, pairs).mapInArrow(run, "a long, b long, shared long, n_a long, n_b long")


def differences(texts: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """(a, b, element): the elements of b that a lacks, of pairs (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.setdiff1d(y, x, assume_unique=True) for x, y in _sets(batch, words)]
            who = np.repeat(np.arange(len(found)), [len(x) for x in found])
            element = np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(who)), batch.column(1).take(pa.array(who)), pa.array(element)], names=["a", "b", "element"])

    return _both(texts, pairs).mapInArrow(run, "a long, b long, element long")


def _linked(percent: int):
    return 100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))


def _need_of(a, b, percent: int):
    return F.ceil(percent * (a + b) / (100 + percent))


def groups(answers: DataFrame, percent: int) -> DataFrame:
    """(doc_id, leader, plus, size) of sets that link with a leader, a set without a smaller linked one."""
    linked = answers.filter(_linked(percent))
    least = linked.join(linked.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
    return least.groupBy(F.col("b").alias("doc_id")).agg(F.min(F.struct(F.col("a").alias("leader"), (F.col("n_b") - F.col("shared")).alias("plus"), F.col("n_b").alias("size"))).alias("g")).select("doc_id", "g.*")


def _apart(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """The pairs (a, b) that links leave in different components."""
    found = connected_components(links, "a", "b")
    for x in "ab":
        pairs = pairs.join(found.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}")), x, "left").withColumn(f"c_{x}", F.coalesce(f"c_{x}", x))
    return pairs.filter("c_a <> c_b").drop("c_a", "c_b")


def links_between(texts: DataFrame, index: DataFrame, answers: DataFrame, words: int, percent: int, long: int) -> DataFrame:
    """(a, b) of all further links that join components which the answers against the heads leave apart."""
    links = answers.filter(_linked(percent)).select("a", "b")
    place = connected_components(links, "a", "b")
    member = written(groups(answers, percent), "groups")
    reach = member.groupBy("leader").agg(F.max("plus").alias("reach"), F.min("size").alias("least"), F.count(F.lit(1)).alias("members"))
    node = place.join(member.select(F.col("doc_id").alias("node"), "leader"), "node", "left").withColumn("leader", F.coalesce("leader", "node"))
    node = node.join(reach.select("leader", "reach"), "leader", "left").select(F.col("node").alias("doc_id"), "leader", "component", F.coalesce("reach", F.lit(0)).alias("reach"))
    rows = index.join(node, "doc_id", "left")
    rows = rows.withColumns({"leader": F.coalesce("leader", "doc_id"), "component": F.coalesce("component", "doc_id"), "reach": F.coalesce("reach", F.lit(0))})
    entries = rows.groupBy("element", "leader", "component", "reach").agg(F.min("size").alias("low"), F.max("size").alias("high"), F.max(F.col("size") - F.col("at")).alias("rest"), F.when(F.count(F.lit(1)) == 1, F.max("before")).otherwise(0).alias("before"))
    entries = written(entries, "entries")
    mixed = entries.groupBy("element").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.count(F.lit(1)).alias("n_entries")).filter("c1 <> c2").select("element", "n_entries")
    entries = entries.join(mixed.hint("merge"), "element")
    pairs = leader_pairs(entries.filter(F.col("n_entries") <= long), percent)
    crowded = written(entries.filter(F.col("n_entries") > long).select(*_ENTRY), "crowded")
    if not crowded.isEmpty():
        counts = bucket_counts(texts, crowded.select("leader").distinct(), words).withColumnRenamed("doc_id", "leader")
        pairs = pairs.union(leader_pairs(crowded.join(counts.hint("merge"), "leader"), percent)).distinct()
    pairs = written(pairs, "pairs")
    told = answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "shared", F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"), F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"))
    new = overlaps(texts, pairs.join(told.select("a", "b"), ["a", "b"], "left_anti"), words)
    between = written(pairs.join(told, ["a", "b"]).unionByName(new), "between")
    found = written(links.union(between.filter(_linked(percent)).select("a", "b")), "links")
    # members whose answers the leaders' do not settle; of two groups the larger is a's
    near = between.filter(~_linked(percent)).select("a", "b", "shared", "n_a", "n_b")
    for x in "ab":
        near = near.join(reach.select(F.col("leader").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("members", "reach", "least"))), x, "left")
        near = near.withColumns({f"members_{x}": F.coalesce(f"members_{x}", F.lit(0)), f"reach_{x}": F.coalesce(f"reach_{x}", F.lit(0)), f"least_{x}": F.least(F.coalesce(f"least_{x}", f"n_{x}"), f"n_{x}")})
    sides = [F.struct(*(F.col(f"{c}_{x}").alias(c) for c in ("members", "n", "reach", "least")), F.col(x).alias("id")) for x in "ab"]
    near = near.select("shared", F.greatest(*sides).alias("x"), F.least(*sides).alias("y")).filter("x.members > 0")
    near = near.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), "shared", F.col("x.n").alias("n_a"), F.col("x.reach").alias("reach_a"), F.col("x.least").alias("least_a"), F.col("y.reach").alias("reach_b"), F.col("y.least").alias("least_b"))
    open_ = written(_apart(near.filter(F.col("shared") + F.col("reach_a") + F.col("reach_b") >= _need_of(F.col("least_a"), F.col("least_b"), percent)), found), "open")
    if open_.isEmpty():
        return found
    first = written(overlaps(texts, member_pairs(texts, open_, member, words, percent), words), "first")
    found = written(found.union(first.filter(_linked(percent)).select("a", "b")), "links")
    # what was held against a leader b, with b's members
    again = first.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared", F.col("n_a").alias("least_b")).union(open_.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared", F.col("n_a").alias("least_b"))).distinct()
    again = again.join(reach.select(F.col("leader").alias("a"), F.col("reach").alias("reach_a"), F.col("least").alias("least_a")), "a").withColumn("reach_b", F.lit(0))
    again = again.filter(F.col("shared") + F.col("reach_a") >= _need_of(F.col("least_a"), F.col("least_b"), percent))
    again = written(_apart(again, found), "again")
    if again.isEmpty():
        return found
    second = overlaps(texts, _apart(member_pairs(texts, again, member, words, percent), found), words)
    return found.union(second.filter(_linked(percent)).select("a", "b"))


def member_pairs(texts: DataFrame, open_: DataFrame, member: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of a leader's member and a set that the leader was held against, which can link (or of which the
    member can link with a set that has reach_b elements more than b). open_ has a, b, shared, least_a, reach_b, least_b."""
    group = written(member.join(open_.select(F.col("a").alias("leader")).distinct(), "leader", "left_semi"), "group")
    lacks = lambda size: _need_of(size, F.col("least_b"), percent) - F.col("reach_b") - F.col("shared")
    enough = open_.filter(lacks(F.col("least_a")) <= 0).join(group.withColumnRenamed("leader", "a"), "a")
    enough = enough.filter(lacks(F.col("size")) <= 0).select(F.col("doc_id").alias("a"), "b")
    own = written(differences(texts, group.select(F.col("leader").alias("a"), F.col("doc_id").alias("b")), words), "own")
    often = own.groupBy("a", "element").agg(F.count(F.lit(1)).alias("often"))
    lacking = differences(texts, open_.select("a", "b"), words).join(often, ["a", "element"]).groupBy("a", "b").agg(F.array_sort(F.collect_list(F.struct("often", "element"))).alias("rare"))
    # to have n elements in common with a member, b must have one of all but its n - 1 commonest
    least = F.greatest(lacks(F.col("least_a")), F.lit(1))
    firsts = lacking.join(open_, ["a", "b"]).withColumn("k", (F.size("rare") - least + 1).cast("int")).filter("k > 0")
    firsts = firsts.select("a", "b", F.explode(F.slice("rare", F.lit(1), F.col("k"))).alias("e")).select("a", "b", "e.element")
    met = firsts.join(own.withColumnRenamed("b", "m"), ["a", "element"]).select(F.col("m").alias("a"), "b")
    return written(enough.union(met).distinct(), "members")


def similarity_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, long: int = LONG) -> DataFrame:
    """(doc_id, n_shingles, component_id): the least doc_id that links reach."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    signed = written(signatures(texts, words, percent), "signatures")
    texts, members = texts.filter("doc_id IS NOT NULL"), signed.filter("doc_id IS NOT NULL")
    repeated = not members.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    if repeated:
        texts = written(texts.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")), "texts")
        members = written(signatures(texts, words, percent), "signatures")
    classes = members.filter("n_shingles > 0").groupBy("signature", "n_shingles").agg(F.min("doc_id").alias("representative"))
    classes = written(classes, "classes")
    firsts = members.join(classes.select(F.col("representative").alias("doc_id")).hint("merge"), "doc_id", "left_semi").select("doc_id", "n_shingles", "prefix")
    firsts = written(firsts, "firsts")
    rows = written(signed.drop("prefix"), "rows")
    members = members.drop("prefix") if repeated else rows.filter("doc_id IS NOT NULL")
    drop_written(signed)
    heads = written(prefixes(texts, firsts, words, percent), "prefixes")
    index = written(lists(postings(heads)), "lists")
    for done in (firsts, heads):
        drop_written(done)
    answers = written(overlaps(texts, written(stars(index, percent), "stars"), words), "answers")
    links = written(links_between(texts, index, answers, words, percent, long), "links")
    found = connected_components(links, "a", "b")
    whole = classes.join(found, classes.representative == found.node, "left").select(F.col("signature").alias("c_signature"), F.col("n_shingles").alias("c_n"), F.coalesce("component", "representative").alias("component_id"))
    placed = members.join(whole, (F.col("signature") == F.col("c_signature")) & (F.col("n_shingles") == F.col("c_n")), "left")
    placed = placed.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    if repeated:
        placed = rows.select("doc_id", "n_shingles").join(placed.select("doc_id", "component_id"), "doc_id", "left")
    else:
        placed = placed.union(rows.filter("doc_id IS NULL").select("doc_id", "n_shingles", F.lit(None).cast("long")))
    return placed
