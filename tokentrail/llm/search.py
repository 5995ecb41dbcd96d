"""Ranked lexical search over documents that recursive graph bisection has put in order.

Index. Documents that hold the same terms should stand together. A node of documents is cut in two halves; documents are
exchanged between the halves while that makes the logarithms of the gaps in their terms' lists smaller; then each half is
cut on. The top nodes are fitted on a sample of SAMPLE documents (those with the least hashes, of at most SAMPLE_BYTES
each), whose terms' weights lead every document down to a place in their order. The documents of a task, in this order, are
cut into blocks of BLOCK_BYTES or BLOCK_DOCS, however few or many the sample promised; each block is bisected itself. In the new order,
CLUSTER documents are a cluster. A block's row has its terms by hash, and for each term and cluster the highest impact and
the list of (place, occurrences).

Search. A cluster's bound for an item is the sum of weight times highest impact over the item's terms. 1. The FIRST clusters
with the highest bounds are visited for each item, which gives a threshold, the score of rank k. 2. In every block, clusters
are visited from the highest bound down, until the bound is below the threshold, which rises with what the task finds;
clusters whose bound is equal are visited, as ties are won by the least doc_id. So the result is exact at every threshold.
Places are mapped back to doc_id with the block's list. Items are taken in batches of about BATCH terms; only a batch's
terms, its thresholds and its FIRST visits are sent to all tasks.

Scores are those of the contract of op11: integer, with N and L of all documents. Terms are told apart by hashes of 64 bits.

Nulls: a null text has no terms; documents without terms are not ranked and don't count in N. A null doc_id comes before
others in ties. Rows with one doc_id are documents of their own, equal rows as well; of equal items one is kept, items with
one item_id and other texts are ranked each for itself. Empty items give no rows. Very long texts are read whole; each is in
one block. Empty tables give no rows. Other columns, of any names, are left out.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby, tee
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, trim, utf8, work_path, written

CLUSTER, FIRST, TOP = 64, 4, 10
BLOCK_BYTES, BLOCK_DOCS = 8 << 20, 4096
#: Documents and bytes of each in the sample that the top of the tree is fitted on, its depth and terms at most.
SAMPLE, SAMPLE_BYTES, DEPTH, TREE_TERMS = 2048, 1 << 16, 6, 16_384
#: Terms of a batch of items, and rounds of exchange at a node.
BATCH, ROUNDS = 65_536, 6
_NULL = -(2**63)
#: Bits of a block's number for its place in its task, and of a cluster's number.
_IN_TASK, _CLUSTERS = 20, 12
#: Letters of A-Z to lower case, other bytes of no term to spaces; bytes from 128 on are parts of letters.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))

INDEX = "block long, n_docs int, ids binary, ms binary, terms binary, entry_ends binary, clusters binary, highest binary, starts binary, places binary, tfs binary"
_INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


# ---- bisection ----


def _gather(off: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the rows of docs in a list that off cuts, which of docs each is of)."""
    sizes = off[docs + 1] - off[docs]
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    return np.arange(n) + np.repeat(off[docs] - (ends - sizes), sizes), np.repeat(np.arange(len(docs)), sizes)


def halves(who: np.ndarray, terms: np.ndarray, n_docs: int, n_terms: int, left: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(whether each document is in the first half, how many of the first half hold each term). who and terms are the
    postings of n_docs documents; the first left of them are the first half at the beginning."""
    side = np.arange(n_docs) < left
    x = np.arange(n_docs + 2)
    cost_l, cost_r = x * np.log2(left / (x + 1)), x * np.log2((n_docs - left) / (x + 1))
    deg = np.bincount(terms, minlength=n_terms)
    for _ in range(rounds):
        on_left = side[who]
        deg_l = np.bincount(terms[on_left], minlength=n_terms)
        deg_r = deg - deg_l
        now = cost_l[deg_l] + cost_r[deg_r]
        to_r = now - cost_l[np.maximum(deg_l - 1, 0)] - cost_r[deg_r + 1]
        to_l = now - cost_l[deg_l + 1] - cost_r[np.maximum(deg_r - 1, 0)]
        gain = np.bincount(who, weights=np.where(on_left, to_r[terms], to_l[terms]), minlength=n_docs)
        a, b = np.flatnonzero(side), np.flatnonzero(~side)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        pairs = min(len(a), len(b))
        swaps = int((gain[a[:pairs]] + gain[b[:pairs]] > 1e-9).sum())
        if not swaps:
            break
        side[a[:swaps]], side[b[:swaps]] = False, True
    return side, np.bincount(terms[side[who]], minlength=n_terms)


def bisected(off: np.ndarray, terms: np.ndarray, n_terms: int, leaf: int = CLUSTER) -> np.ndarray:
    """The documents in the order of recursive bisection down to leaf documents. terms holds the distinct terms of document
    i at off[i]:off[i + 1]."""
    n = len(off) - 1
    df = np.bincount(terms, minlength=n_terms)
    told = (df > 1) & (df < n)  # other terms pull to no side
    kept = told[terms]
    off, terms = np.concatenate([[0], np.cumsum(kept)])[off], terms[kept]
    order, place, seen = np.arange(n), np.zeros(n_terms, np.int64), np.zeros(n_terms, bool)
    nodes = [(0, n)]
    while nodes:
        lo, hi = nodes.pop()
        if hi - lo <= leaf:
            continue
        left = -(-(hi - lo) // leaf) // 2 * leaf
        docs = order[lo:hi]
        at, who = _gather(off, docs)
        here = terms[at]
        seen[here] = True
        known = np.flatnonzero(seen)
        seen[known] = False
        place[known] = np.arange(len(known))
        side, _ = halves(who, place[here], hi - lo, len(known), left)
        order[lo:hi] = np.concatenate([docs[side], docs[~side]])
        nodes += [(lo, lo + left), (lo + left, hi)]
    return order


@dataclass
class Tree:
    """The top of the bisection: nodes in heap order, each with a weight a term and a threshold; share of each leaf."""

    depth: int
    places: dict[bytes, int]
    weights: np.ndarray
    thresholds: np.ndarray
    bytes_share: np.ndarray
    docs_share: np.ndarray

    def leaf(self, terms) -> int:
        node = 0
        if self.depth:
            at = np.array([p for p in map(self.places.get, terms) if p is not None], np.int64)
            for _ in range(self.depth):
                score = self.weights[node, at].mean() if len(at) else 0.0
                node = 2 * node + 1 + int(score < self.thresholds[node])
        return node - (1 << self.depth) + 1


def fit_tree(texts: list[bytes], depth: int) -> Tree:
    """The tree of a sample. A document goes to the half whose terms it has more of, cut at the sample's middle."""
    sets = [list(dict.fromkeys(terms_of(t))) for t in texts]
    df = Counter(chain.from_iterable(sets))
    told = sorted((t for t, c in df.items() if c > 1), key=lambda t: (-df[t], t))[:TREE_TERMS]
    places = {t: i for i, t in enumerate(told)}
    rows = [np.array([places[t] for t in s if t in places], np.int64) for s in sets]
    nodes = (1 << depth) - 1
    weights, thresholds = np.zeros((nodes, len(told)), np.float32), np.zeros(nodes)
    members = {0: np.arange(len(sets))}
    for node in range(nodes):
        docs = members.pop(node)
        side = np.arange(len(docs)) < len(docs) // 2
        if len(docs) > 1:
            who = np.repeat(np.arange(len(docs)), [len(rows[d]) for d in docs])
            terms = np.concatenate([rows[d] for d in docs])
            left = len(docs) // 2
            _, deg_l = halves(who, terms, len(docs), len(told), left)
            deg_r = np.bincount(terms, minlength=len(told)) - deg_l
            weights[node] = np.log2((deg_l + 1) / left) - np.log2((deg_r + 1) / (len(docs) - left))
            scores = np.array([weights[node, rows[d]].mean() if len(rows[d]) else 0.0 for d in docs])
            thresholds[node] = np.median(scores)
            side = scores >= thresholds[node]
        members[2 * node + 1], members[2 * node + 2] = docs[side], docs[~side]
    leaves = [members.get(i, np.empty(0, np.int64)) for i in range(nodes, 2 * nodes + 1)]
    sizes = np.array([len(t) for t in texts], np.float64)
    share = lambda x: (x + 1) / (x + 1).sum()
    return Tree(depth, places, weights, thresholds, share(np.array([sizes[x].sum() for x in leaves])), share(np.array([float(len(x)) for x in leaves])))


# ---- index ----


@dataclass
class Index:
    blocks: DataFrame
    n_docs: int
    n_terms: int


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _narrow(x: np.ndarray) -> bytes:
    """Whole numbers as a byte of their width and the numbers in it."""
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if not len(x) or x.max() <= np.iinfo(t).max)
    return bytes([np.dtype(kind).itemsize]) + x.astype(kind).tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def block_row(ids: Iterable[int], texts: Iterable[bytes], n_docs: int, n_terms: int) -> dict | None:
    """A block's part of the index, without its number. Of a text that has been read only its counts are held."""
    vocabulary: dict[bytes, int] = {}
    found, sizes, held = [], [], []
    for doc, text in zip(ids, texts, strict=True):
        words = terms_of(text)
        if words:
            counts = Counter(words)
            known = np.fromiter((vocabulary.setdefault(t, len(vocabulary)) for t in counts), np.int32, len(counts))
            found.append((known, np.fromiter(counts.values(), np.int32, len(counts))))
            sizes.append(len(words))
            held.append(doc)
    if not found:
        return None
    off = np.concatenate([[0], np.cumsum([len(k) for k, _ in found])])
    terms, tf = (np.concatenate([x[c] for x in found]).astype(np.int64) for c in (0, 1))
    found.clear()
    order = bisected(off, terms, len(vocabulary))
    at, place = _gather(off, order)
    terms, tf = terms[at], tf[at]
    ms = np.array([10 + 90 * sizes[i] * n_docs // n_terms for i in order], np.int64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, vocabulary), np.uint64, len(vocabulary))
    by_hash = np.argsort(hashes, kind="stable")
    rank = np.empty(len(by_hash), np.int64)
    rank[by_hash] = np.arange(len(by_hash))
    terms = rank[terms]
    sort = np.argsort(terms, kind="stable")  # places come in order
    terms, place, tf = terms[sort], place[sort], tf[sort]
    cluster = place // CLUSTER
    starts = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (cluster[1:] != cluster[:-1])]))
    return {
        "n_docs": len(order), "ids": np.array(held, np.int64)[order].tobytes(), "ms": _narrow(ms), "terms": hashes[by_hash].tobytes(),
        "entry_ends": _narrow(np.searchsorted(terms[starts], np.arange(len(by_hash)), "right")), "clusters": _narrow(cluster[starts]),
        "highest": _narrow(np.maximum.reduceat(impacts(tf, ms[place]), starts)), "starts": _narrow(np.append(starts, len(terms))), "places": _narrow(place % CLUSTER), "tfs": _narrow(tf),
    }


def build_index(docs: DataFrame, path: str | None = None) -> Index:
    """The index of all documents, one row a block, written at path or in the shared folder."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, size = 0, 0, 0
        for b in slices(batches):
            for text in utf8(b.column(0)):
                words = len(terms_of(text))
                n, total, size = n + (words > 0), total + words, size + len(text)
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (n, total, size)], names=["n", "terms", "bytes"])

    n, total, size = docs.select("text").mapInArrow(sums, "n long, terms long, bytes long").agg(F.sum("n"), F.sum("terms"), F.sum("bytes")).first()
    if not n:
        return Index(spark.createDataFrame([], INDEX), 0, 0)
    wanted = max(size / BLOCK_BYTES, n / BLOCK_DOCS)
    depth = min(DEPTH, int(math.log2(max(1, wanted))))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for b in batches for t in utf8(b.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_tree(texts, depth))], pa.binary())], names=["tree"])

    sample = docs.filter(F.octet_length("text").between(1, SAMPLE_BYTES)).orderBy(F.xxhash64("doc_id", "text"), "doc_id").limit(SAMPLE)
    fitted = sample.select("text").coalesce(1).mapInArrow(fit, "tree binary").first() if depth else None
    tree = pickle.loads(fitted.tree) if fitted else fit_tree([], 0)
    sent = spark.sparkContext.broadcast(tree)  # DEPTH and TREE_TERMS bound it
    blocks = np.ceil(np.maximum(tree.bytes_share * size / BLOCK_BYTES, tree.docs_share * n / BLOCK_DOCS)).astype(np.int64)
    first = np.cumsum(blocks) - blocks

    def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()  # blocks of a leaf are dealt in turn, so that copies make none large
        for b in slices(batches):
            out = []
            for text in utf8(b.column(1)):
                leaf = sent.value.leaf(dict.fromkeys(terms_of(text)))
                out.append(int(first[leaf] + turn % blocks[leaf]))
                turn += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int32()), b.column(0), b.column(1)], names=["block", "doc_id", "text"])

    kinds = pa.schema([(c, {"block": pa.int64(), "n_docs": pa.int32()}.get(c, pa.binary())) for c in _INDEX_NAMES])

    def numbered(rows: Iterator[tuple]) -> Iterator[tuple]:
        number, docs, size = TaskContext.get().partitionId() << _IN_TASK, 0, 0
        for doc, text in rows:
            if docs == BLOCK_DOCS or size >= BLOCK_BYTES:
                number, docs, size = number + 1, 0, 0
            docs, size = docs + 1, size + len(text)
            yield number, doc, text

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in slices(batches) for r in zip(b.column(1).to_pylist(), utf8(b.column(2)), strict=True))
        for block, group in groupby(numbered(rows), itemgetter(0)):
            ids, texts = tee(group)  # read side by side
            row = block_row((r[1] for r in ids), (r[2] for r in texts), n, total)
            yield pa.RecordBatch.from_pylist([{"block": block} | row] if row else [], schema=kinds)
            del row, ids, texts
            trim()

    # rows of a block come one after the other, so that no task holds its texts; Spark splits what is too much for a task
    rows = docs.mapInArrow(led, "block int, doc_id long, text string").hint("rebalance", "block").sortWithinPartitions("block").mapInArrow(indexed, INDEX)
    path = path or work_path(spark, "search")
    rows.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)
    return Index(spark.read.schema(INDEX).parquet(path), n, total)


# ---- search ----


@dataclass
class Batch:
    """Items with the numbers and weights of their terms; hashes of all these terms, ascending."""

    hashes: np.ndarray
    items: list[np.ndarray]
    weights: np.ndarray


class Block:
    """The lists of a batch's terms in one block."""

    def __init__(self, row: dict, batch: Batch):
        terms = np.frombuffer(row["terms"], np.uint64)
        at = np.searchsorted(terms, batch.hashes)
        there = np.flatnonzero(terms[np.minimum(at, len(terms) - 1)] == batch.hashes)
        ends = _wide(row["entry_ends"])
        last = ends[at[there]]
        start = np.where(at[there] > 0, ends[at[there] - 1], 0)
        entries, term = _gather_spans(start, last)
        clusters = _wide(row["clusters"])[entries]
        self.n_clusters = -(-row["n_docs"] // CLUSTER)
        self.entry = np.full((len(there), self.n_clusters), -1, np.int64)
        self.entry[term, clusters] = entries
        self.bound = np.zeros((len(there), self.n_clusters), np.int64)
        self.bound[term, clusters] = _wide(row["highest"])[entries] * batch.weights[there][term]
        self.weights = batch.weights[there]
        self.mine = np.full(len(batch.hashes), -1, np.int64)
        self.mine[there] = np.arange(len(there))
        self.row = row
        self.lists: tuple | None = None

    def terms(self, item: np.ndarray) -> np.ndarray:
        mine = self.mine[item]
        return mine[mine >= 0]

    def bounds(self, terms: np.ndarray) -> np.ndarray:
        return self.bound[terms].sum(axis=0)

    def scores(self, terms: np.ndarray, cluster: int) -> tuple[np.ndarray, np.ndarray]:
        """(doc_ids, scores) of the documents of a cluster with a score above 0."""
        if self.lists is None:
            self.lists = tuple(_wide(self.row[c]) for c in ("starts", "places", "tfs", "ms")) + (np.frombuffer(self.row["ids"], np.int64),)
        starts, places, tfs, ms, ids = self.lists
        entries = self.entry[terms, cluster]
        some = entries >= 0
        entries = entries[some]
        at, which = _gather_spans(starts[entries], starts[entries + 1])
        place = places[at]
        total = np.zeros(CLUSTER, np.int64)
        np.add.at(total, place, self.weights[terms[some]][which] * impacts(tfs[at], ms[cluster * CLUSTER + place]))
        found = np.flatnonzero(total)
        return ids[cluster * CLUSTER + found], total[found]


def _gather_spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = stop - start
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    return np.arange(n) + np.repeat(start - (ends - sizes), sizes), np.repeat(np.arange(len(start)), sizes)


class Best:
    """The k best (score, doc_id) of an item so far; at least gives what a cluster must reach."""

    def __init__(self, k: int, least: int = 0):
        self.k, self.least, self.rows = k, least, []

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        some = scores >= self.least
        if some.any():
            self.rows += zip((-scores[some]).tolist(), ids[some].tolist(), strict=True)
            self.rows.sort()
            del self.rows[self.k :]
            if len(self.rows) == self.k:
                self.least = max(self.least, -self.rows[-1][0])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield {c: b.column(c)[i].as_py() for c in b.schema.names}


def _found(best: dict[int, Best]) -> pa.RecordBatch:
    rows = [(i, d, -s) for i, x in best.items() for s, d in x.rows]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[c] for r in rows], pa.int64()) for c in (1, 2))], names=["item", "doc_id", "score"])


_FOUND = "item int, doc_id long, score long"


def _highest(rows: DataFrame, k: int, *order) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)


def _best_of(found: DataFrame, k: int) -> DataFrame:
    return _highest(found, k, F.desc("score"), "doc_id")


def _document_counts(blocks: DataFrame, hashes: np.ndarray) -> np.ndarray:
    """How many documents hold each of the terms with these ascending hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(hashes), np.int64)
        for row in _rows(batches):
            terms = np.frombuffer(row["terms"], np.uint64)
            at = np.searchsorted(terms, hashes)
            there = np.flatnonzero(terms[np.minimum(at, len(terms) - 1)] == hashes)
            lists = np.concatenate([[0], _wide(row["starts"])[_wide(row["entry_ends"])]])
            df[there] += lists[at[there] + 1] - lists[at[there]]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], names=["term", "df"])

    out = np.zeros(len(hashes), np.int64)
    for r in blocks.select("terms", "entry_ends", "starts").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df
    return out


def _search_batch(index: Index, texts: list[bytes], k: int) -> DataFrame:
    """(item, doc_id, score, rank) of the items with these texts."""
    sets = [np.unique(np.fromiter(map(xxhash.xxh64_intdigest, set(terms_of(t))), np.uint64)) for t in texts]
    hashes = np.unique(np.concatenate(sets))
    df = _document_counts(index.blocks, hashes)
    weights = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    sent = index.blocks.sparkSession.sparkContext.broadcast(Batch(hashes, [np.searchsorted(hashes, s) for s in sets], weights))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {i: Best(FIRST, 1) for i in range(len(sent.value.items))}
        for row in _rows(batches):
            block = Block(row, sent.value)
            for i, item in enumerate(sent.value.items):
                high = block.bounds(block.terms(item))
                top = np.argsort(-high, kind="stable")[:FIRST]
                best[i].add((row["block"] << _CLUSTERS) + top, high[top])
        yield _found(best)

    named = "block", "n_docs", "terms", "entry_ends", "clusters", "highest"
    heads = _highest(index.blocks.select(*named).mapInArrow(bounds, _FOUND), FIRST, F.desc("score"), "doc_id").collect()  # FIRST rows an item
    visits: dict[int, list[tuple[int, int]]] = {}
    for r in heads:
        visits.setdefault(r.doc_id >> _CLUSTERS, []).append((r.item, r.doc_id & ((1 << _CLUSTERS) - 1)))

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {}
        for row in _rows(batches):
            block = Block(row, sent.value)
            for i, cluster in visits.get(row["block"], []):
                best.setdefault(i, Best(k)).add(*block.scores(block.terms(sent.value.items[i]), cluster))
        yield _found(best)

    seen = _best_of(index.blocks.filter(F.col("block").isin(list(visits))).mapInArrow(head, _FOUND), k).collect()  # k rows an item
    least: dict[int, int] = {r.item: r.score for r in seen if r["rank"] == k}
    done = {(b, i, c) for b, x in visits.items() for i, c in x}

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {i: Best(k, least.get(i, 1)) for i in range(len(sent.value.items))}
        for row in _rows(batches):
            block = Block(row, sent.value)
            for i, item in enumerate(sent.value.items):
                terms = block.terms(item)
                high = block.bounds(terms)
                for c in np.argsort(-high, kind="stable").tolist():
                    if high[c] < best[i].least:
                        break
                    if (row["block"], i, c) not in done:
                        best[i].add(*block.scores(terms, c))
        yield _found(best)

    known = index.blocks.sparkSession.createDataFrame([(r.item, r.doc_id, r.score) for r in seen], _FOUND)
    return _best_of(index.blocks.mapInArrow(rest, _FOUND).union(known), k)


def search(index: Index, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents with a score above 0 of each item (item_id, text)."""
    spark = items.sparkSession
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    # a term and what is around it are two characters at least
    size = items.agg(F.sum(F.char_length("text"))).first()[0] if index.n_docs else None
    if not size:
        return empty
    n = -(-size // (2 * BATCH))
    out = empty
    for batch in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == batch).orderBy("item_id", "text").collect()
        rows = [r for r in rows if terms_of(r.text.encode())]
        if rows:
            found = _search_batch(index, [r.text.encode() for r in rows], k)
            ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], "item int, item_id long")
            found = found.join(F.broadcast(ids), "item")
            out = out.union(found.select("item_id", F.col("rank").cast("int"), F.when(F.col("doc_id") != _NULL, F.col("doc_id")).alias("doc_id"), "score"))
    return out if n == 1 else written(out, "ranked")
