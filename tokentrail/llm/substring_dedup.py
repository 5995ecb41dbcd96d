"""Removal of repeated word windows with compressed FM-indexes.

A window is WINDOW consecutive words. A word goes if a window that covers it also starts earlier, in a document
with a smaller doc_id or further up in its own. Windows are judged on the input, not on what is left.

1. Each window has an anchor: the least hash among its runs of ANCHOR words, the first of equals. Windows with the
   same words have the same anchor at the same offset, so only anchors that occur twice matter. A filter of
   repeated anchors, of bounded size, tells them: a false alarm costs time and changes no result.
2. A document's stretches around repeated anchors (contexts) go to shards by the anchor. Windows of a heavy anchor,
   one with a sixteenth of its range's occurrences or more, go one by one by the hash of all their words, so that no
   anchor's contexts all meet in one task. A task sends of equal contexts the earliest; the others are repeats.
3. Each shard's contexts, each distinct one once, in order of their first places, become a compressed FM-index. Then
   all contexts are streamed against it: backward search over its wavelet matrix gives matching statistics, and an
   interval of full length is a repeat for every occurrence that is later than the interval's earliest place.
4. Spans of repeated words go back to their documents.

Nulls: a null text has no words; a null doc_id sorts first. Rows with one doc_id and one text get the same result
and are no repeats of each other; other rows with one doc_id are in the order of their text's hash. Texts of fewer than
WINDOW words stay. An empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import filters
from .common import gram_hashes, partitions, slices, utf8, word_hashes
from .fm_index import FMIndex

WINDOW, ANCHOR = 20, 8
#: Words of one FM-index; distinct contexts that a task holds before it sends them.
SHARD_WORDS, HELD = 150_000, 60_000
_NULL = -(2**63)


def anchors(hashes: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, last window) for each run of windows with one anchor."""
    grams = gram_hashes(hashes, anchor)
    span = window - anchor + 1
    if len(grams) < span:
        e = np.empty(0, np.int64)
        return grams[:0], e, e
    at = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1) + np.arange(len(grams) - span + 1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return grams[at[first]], first, np.concatenate([first[1:], [len(at)]]) - 1


def repeated_anchors(docs: DataFrame, window: int, anchor: int) -> filters.Filter:
    """The filter of anchors that occur twice. Their hashes move as blobs, one for each range and batch."""
    n = partitions(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1024):
            found = [anchors(word_hashes(t.split()), window, anchor)[0] for t in utf8(b.column(0))]
            yield filters.blobs(np.concatenate([*found, np.empty(0, np.uint64)]), n)

    return filters.build(docs.select("text").mapInArrow(run, filters.BLOBS))


_CONTEXT = "shard int, anchor long, context binary, doc_id long, text_hash long, first long, windows int"
_TYPES = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
_SPAN = ["doc_id", "text_hash", "first", "last"]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def contexts(docs: DataFrame, repeated: filters.Filter, window: int, anchor: int, held: int = HELD) -> DataFrame:
    """The words of the windows of each anchor in the filter. Of equal contexts that a task holds at one time the
    earliest is given; a row without context is one of the others, whose windows are all repeats."""
    sent = docs.sparkSession.sparkContext.broadcast(repeated)
    n = partitions(docs.sparkSession)

    def rows_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = zip(*rows, strict=True) if rows else [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES, strict=True)], names=[c.split()[0] for c in _CONTEXT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        seen: dict[tuple[int, bytes], tuple[int, int, int, int]] = {}
        late: list[tuple] = []

        def put(h: int, words: list[bytes], place: tuple[int, int, int, int]) -> None:
            key = h, b" ".join(words)
            other = seen.get(key)
            if other is None:
                seen[key] = place
            elif other[:3] != place[:3]:
                if place < other:
                    seen[key], place = place, other
                late.append(((place[0] * 0x9E3779B1 + place[2]) % n, None, None, *place))

        def all_seen() -> Iterator[pa.RecordBatch]:
            for part in itertools.batched(seen.items(), 10_000):
                yield rows_of([(h % n, _signed(h), c, *place) for (h, c), place in part])
            seen.clear()

        for b in slices(batches):
            for d, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2)), strict=True):
                d = _NULL if d is None else d
                words = text.split()
                hashes = word_hashes(words)
                found, first, last = anchors(hashes, window, anchor)
                if not len(found):
                    continue
                keep = np.flatnonzero(known.maybe(found))
                hot = known.is_heavy(found[keep])
                if hot.any():
                    whole = gram_hashes(hashes, window)
                    for x, y in zip(first[keep[hot]].tolist(), last[keep[hot]].tolist(), strict=True):
                        for i in range(x, y + 1):
                            put(int(whole[i]), words[i : i + window], (d, key, i, 1))
                    keep = keep[~hot]
                for h, x, y in zip(found[keep].tolist(), first[keep].tolist(), last[keep].tolist(), strict=True):
                    put(h, words[x : y + window], (d, key, x, y - x + 1))
            if late:
                yield rows_of(late)
                late.clear()
            if len(seen) >= held:
                yield from all_seen()
        yield from all_seen()

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, _CONTEXT)


def _spans(doc: np.ndarray, key: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (doc, key, first, last)], names=_SPAN)


def _judge(group: list[tuple[bytes, list[tuple]]], window: int) -> pa.RecordBatch:
    """The spans of repeated windows among (context, its occurrences in order); occurrences are (doc_id, text_hash,
    first, windows)."""
    group.sort(key=lambda x: x[1][0])
    ids: dict[bytes, int] = {}
    sequences = [np.array([ids.setdefault(w, len(ids) + 1) for w in c.split()], np.int64) for c, _ in group]
    index = FMIndex(sequences, window)
    _, found = index.matching_statistics(sequences)
    occurrences = np.array([o for _, own in group for o in own], np.int64)
    of = np.repeat(np.arange(len(group)), [len(own) for _, own in group])
    # documents by rank, so that a place is one number: rank << 32 | word
    _, rank = np.unique(np.stack([occurrences[:, 0], occurrences[:, 1]], axis=1), axis=0, return_inverse=True)
    place = rank.reshape(-1) << 32 | occurrences[:, 2]
    head = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    windows = occurrences[head, 3]
    rows = np.concatenate([r[:m] for r, m in zip(found, windows.tolist(), strict=True)])
    ends = np.cumsum(windows)
    offset = np.arange(len(rows)) - np.repeat(ends - windows, windows)
    # an interval of one is the context's own first place, one of several gives the earliest
    at = index.first_places(rows)
    at = np.where(at < 0, np.repeat(index.starts, windows) + offset, at)
    source = np.searchsorted(index.starts, at, side="right") - 1
    earliest = place[head][source] + at - index.starts[source]
    # every occurrence's windows against the earliest places of its context's
    m = windows[of]
    own = np.cumsum(m)
    i = np.arange(int(own[-1])) - np.repeat(own - m, m)
    late = earliest[np.repeat((ends - windows)[of], m) + i] < np.repeat(place, m) + i
    edge = np.concatenate([[True], i[1:] == 0])
    opens = np.flatnonzero(late & (edge | ~np.concatenate([[False], late[:-1]])))
    closes = np.flatnonzero(late & (np.append(edge[1:], True) | ~np.append(late[1:], False)))
    who = np.repeat(np.arange(len(of)), m)[opens]
    return _spans(occurrences[who, 0], occurrences[who, 1], occurrences[who, 2] + i[opens], occurrences[who, 2] + i[closes])


def repeated_spans(rows: DataFrame, window: int) -> DataFrame:
    """(doc_id, text_hash, first, last): windows that also start earlier. Contexts of one anchor meet in one index."""
    n = partitions(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, list[tuple]]] = []  # distinct contexts of whole anchors
        words, own, last = 0, [], None

        def close() -> None:
            nonlocal words, own
            for c, places in own if len(own) > 1 or (own and len(own[0][1]) > 1) else ():
                held.append((c, places))
                words += window - 1 + places[0][3]
            if len(own) == 1 and len(own[0][1]) == 1 and own[0][1][0][3] > 1:
                # windows of one context alone: they differ unless it goes round in a circle
                parts = own[0][0].split()
                if len(set(parts)) < len(parts):
                    held.extend(own)
                    words += len(parts)
            own = []

        for b in slices(batches, 4096):
            anchor = b.column(1)
            if anchor.null_count:
                known = b.filter(anchor.is_null())
                d, key, first, m = (known.column(i).to_numpy() for i in (3, 4, 5, 6))
                yield _spans(d, key, first, first + m - 1)
                b = b.filter(anchor.is_valid())
            for a, c, *place in zip(*(b.column(i).to_pylist() for i in range(1, 7)), strict=True):
                if a != last:
                    close()
                    last = a
                    if words >= SHARD_WORDS:
                        yield _judge(held, window)
                        held.clear()
                        words = 0
                place = tuple(place)
                if not own or own[-1][0] != c:
                    own.append((c, [place]))
                elif own[-1][1][-1][:3] != place[:3]:
                    own[-1][1].append(place)
        close()
        if held:
            yield _judge(held, window)

    dealt = rows.repartitionById(n, "shard").sortWithinPartitions("shard", "anchor", "context", "doc_id", "text_hash", "first")
    return dealt.mapInArrow(run, "doc_id long, text_hash long, first long, last long")


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): kept is the words left, joined by one space."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spans = repeated_spans(contexts(base, repeated_anchors(base, window, anchor), window, anchor), window)
    spans = spans.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    spans = spans.withColumnsRenamed({"doc_id": "s_id", "text_hash": "s_hash"})
    both = base.join(spans, (F.coalesce("doc_id", F.lit(_NULL)) == F.col("s_id")) & (F.xxhash64("text") == F.col("s_hash")), "left").select("doc_id", "text", "spans.first", "spans.last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            n_words, n_removed, kept = [], [], []
            for text, first, last in zip(utf8(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                words = text.split()
                n_words.append(len(words))
                if first:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, np.array(first), 1)
                    np.add.at(edge, np.array(last) + window, -1)
                    stay = np.cumsum(edge)[:-1] == 0
                    words = list(itertools.compress(words, stay.tolist()))
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            arrays = [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array([sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return both.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
