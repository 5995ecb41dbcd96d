"""Removal of repeated runs of lines by winnowing.

Lines are compared without white space at their ends; blank lines are skipped in comparing and stay where they
are, unless the lines around them go. Every RUN lines in a row (a run; RUN = GRAM + WINDOW - 1) hold WINDOW hashes of
GRAM lines; the least, the last of equals, is selected as fingerprint, so two equal runs have it at one offset.

1. Only selected positions are kept, each once, with the lines before and behind it that its runs reach.
2. Positions of one fingerprint are joined with its first place, and the match is extended to the left and to the
   right, line by line, until the two texts differ. An extent of RUN lines or more is a repeat; the later one goes.
3. Where a position's own text goes on otherwise than at the first place, its runs there are left over. These few are
   joined in the same way on all their lines, with the first place that has them.
So a line goes if and only if it is in RUN lines in a row that also start earlier: in a document with a smaller doc_id,
or further up in its own. Matches that touch are one run. With words, a repeat of fewer lines counts as well if it has
that many words; such runs are fingerprints of their own. The report's rule is the plain one, which its SQL has; the
pipeline takes WORDS. Runs are judged on the input. Lines are cut at \\n only.

Nulls: a null text stays null and has no lines; a null doc_id sorts first. Rows with one doc_id and one text get
the same result and are no repeats of each other; others with one doc_id are in the order of their text's hash. Texts
of fewer than RUN lines stay, unless words are given. An empty table gives no rows. Other columns, of any names, are
kept by without_repeats and left out by report.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, gram_hashes, slices, utf8, written

GRAM, WINDOW = 2, 2
#: Words with which a run of fewer lines counts in the pipeline.
WORDS = 50
_NULL = -(2**63)
_POSITION = "print long, lines int, slack int, doc_id long, text_hash long, at int, first int, last int, left array<long>, right array<long>"


def line_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lines that are not blank, and their numbers among all lines."""
    lines = [x.strip() for x in text.split(b"\n")]
    at = [i for i, x in enumerate(lines) if x]
    return np.fromiter((xxhash.xxh64_intdigest(lines[i]) for i in at), np.uint64, len(at)), np.array(at, np.int64)


def line_words(text: bytes) -> np.ndarray:
    """The numbers of words of the lines that are not blank."""
    counts = np.array([len(x.split()) for x in text.split(b"\n")], np.int64)
    return counts[counts > 0]


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """For each run of window values, the place of its least one, the last of equals."""
    runs = np.lib.stride_tricks.sliding_window_view(grams, window)[:, ::-1]
    return np.arange(len(runs)) + window - 1 - runs.argmin(axis=1)


def _ragged(values: np.ndarray, start: np.ndarray, size: np.ndarray, step: int) -> np.ndarray:
    """values[start], values[start + step], ... of each row, size of them, end to end."""
    ends = np.cumsum(size)
    i = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size)
    return values[np.repeat(start, size) + step * i]


def positions(hashes: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, ...]:
    """(fingerprint, place, first and last run that selected it) of each selected position of one text."""
    grams = gram_hashes(hashes, gram)
    if len(grams) < window:
        none = np.empty(0, np.int64)
        return grams[:0], none, none, none
    chosen = winnow(grams, window)
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.append(first[1:], len(chosen)) - 1
    return grams[chosen[first]], chosen[first], first, last


def fingerprint_rows(docs: DataFrame, gram: int, window: int, words: int | None = None) -> DataFrame:
    """A row for each selected position: its fingerprint, the runs (first to last) that selected it, and the hashes of
    the lines before it, nearest first, and behind it that these runs reach. lines is the least length of a repeat,
    slack how many lines that is more than the fingerprint's own. Runs of fewer lines with enough words have no slack."""
    run_lines = gram + window - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1024):
            parts: list[list[np.ndarray]] = [[] for _ in range(8)]
            left, right = [], []
            for i, text in enumerate(utf8(b.column(2))):
                hashes, _ = line_hashes(text)
                prints, at, first, last = positions(hashes, gram, window)
                before, behind = at - first, last + window - 1 - at
                left.append(_ragged(hashes, at - 1, before, -1))
                right.append(_ragged(hashes, at + gram, behind, 1))
                found = [(prints, run_lines, window - 1, at, first, last, before, behind)]
                sums = np.concatenate([[0], np.cumsum(line_words(text))]) if words else [0]
                for lines in range(1, min(run_lines, len(sums))):
                    at = np.flatnonzero(sums[lines:] - sums[:-lines] >= words)
                    if len(at):
                        none = np.zeros(len(at), np.int64)
                        found.append((gram_hashes(hashes, lines)[at], lines, 0, at, at, at, none, none))
                for prints, lines, slack, at, first, last, before, behind in found:
                    for c, v in zip(parts, (prints.view(np.int64), np.full(len(at), lines), np.full(len(at), slack), np.full(len(at), i), at, np.stack([first, last]), before, behind), strict=True):
                        c.append(v)
            prints, lines, slack, i, at = (np.concatenate(c) if c else np.empty(0, np.int64) for c in parts[:5])
            first, last = np.concatenate(parts[5], axis=1) if parts[5] else np.empty((2, 0), np.int64)
            arrays = []
            for sizes, values in ((parts[6], left), (parts[7], right)):
                cuts = np.concatenate([[0], *sizes]).cumsum().astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate([np.empty(0, np.uint64), *values]).view(np.int64))))
            who = pa.array(i)
            small = [pa.array(x.astype(np.int32)) for x in (lines, slack, at, first, last)]
            yield pa.RecordBatch.from_arrays([pa.array(prints), *small[:2], b.column(0).take(who), b.column(1).take(who), *small[2:], *arrays], names=[c.split()[0] for c in _POSITION.split(", ")])

    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)), F.xxhash64("text"), "text").mapInArrow(run, _POSITION)


def _alike(a: Column, b: Column) -> Column:
    """How many elements two arrays have in common from their beginning on."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False).cast("int")
    return F.when(differs == 0, F.size(a)).otherwise(differs - 1)


def matches(rows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, at, lines, from_doc, from_at): extents that also stand at an earlier place.

    First places are found with partial sums in each task, so a very common line moves a few rows only; the join back
    has one row for each repeated fingerprint on its right, and Spark may split its left side. rows is read twice and
    should be a stored table.
    """
    first = rows.groupBy("print", "lines").agg(F.min(F.struct("doc_id", "text_hash", "at", "left", "right")).alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    pairs = rows.join(first, ["print", "lines"]).filter((F.col("head.doc_id") != F.col("doc_id")) | (F.col("head.text_hash") != F.col("text_hash")) | (F.col("head.at") != F.col("at")))
    pairs = pairs.withColumns({"back": _alike(F.col("left"), F.col("head.left")), "on": _alike(F.col("right"), F.col("head.right"))})
    # the runs of this position within the extent
    pairs = pairs.withColumns({"m1": F.greatest("first", F.col("at") - F.col("back")), "m2": F.least("last", F.col("at") + F.col("on") - F.col("slack"))})
    pairs = written(pairs.drop("back", "on"), "met")
    long = pairs.filter("m1 <= m2").select("doc_id", "text_hash", F.col("m1").alias("at"), (F.col("m2") - F.col("m1") + F.col("lines")).alias("lines"), F.col("head.doc_id").alias("from_doc"), (F.col("head.at") + F.col("m1") - F.col("at")).alias("from_at"))
    over = F.filter(F.sequence("first", "last"), lambda k: (F.col("m1") > F.col("m2")) | (k < F.col("m1")) | (k > F.col("m2")))
    rest = pairs.filter(F.size(over) > 0).withColumn("k", F.explode(over))
    rest = rest.select("doc_id", "text_hash", F.col("k").alias("at"), "lines", F.xxhash64("print", F.col("at") - F.col("k"), F.slice("left", F.lit(1), F.col("at") - F.col("k")), F.slice("right", F.lit(1), F.col("k") + F.col("slack") - F.col("at"))).alias("run"))
    here = F.struct("doc_id", "text_hash", "at")
    others = rest.groupBy("run", "lines").agg(F.min(here).alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    late = rest.join(others, ["run", "lines"]).filter(F.col("head") != here)
    return long.union(late.select("doc_id", "text_hash", "at", "lines", F.col("head.doc_id"), F.col("head.at")))


def cut_lines(text: bytes, found: list[int]) -> tuple[bytes, int, int, int]:
    """(text without the extents, lines, lines removed, runs after joining those that touch), by extents as
    start << 32 | lines. A blank line between two lines that go is removed with them."""
    lines = text.split(b"\n")
    _, at = line_hashes(text)
    edge = np.zeros(len(at) + 1, np.int64)
    starts, run_lines = np.array(found, np.int64) >> 32, np.array(found, np.int64) & 0xFFFFFFFF
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + run_lines, -1)
    gone = np.cumsum(edge)[:-1] > 0
    drop = np.zeros(len(lines), bool)
    drop[at[gone]] = True
    for i, j in zip(at[:-1], at[1:], strict=True):
        if drop[i] and drop[j]:
            drop[i:j] = True
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return b"\n".join(x for x, d in zip(lines, drop, strict=True) if not d), len(lines), int(drop.sum()), runs


def _joined(docs: DataFrame, gram: int, window: int, words: int | None) -> DataFrame:
    """docs with one more column, last: the extents of each row's text that go, or null."""
    extent = F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("lines").cast("long"))
    found = matches(written(fingerprint_rows(docs, gram, window, words), "prints")).groupBy("doc_id", "text_hash").agg(F.collect_list(extent).alias("extents"))
    names = {c: fresh(docs.columns, f"_{c}") for c in found.columns}
    found = found.withColumnsRenamed(names)
    same = (F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)) == F.col(names["doc_id"])) & (F.xxhash64("text") == F.col(names["text_hash"]))
    return docs.join(found, same, "left").drop(names["doc_id"], names["text_hash"])


def report(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """(doc_id, n_lines, n_removed, n_runs, text): the text without later repeated runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for d, text, found in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist(), strict=True):
                kept, lines, removed, runs = cut_lines(text, found) if found else (text, 0 if text is None else text.count(b"\n") + 1, 0, 0)
                out.append((d, lines, removed, runs, kept))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*arrays[:4], arrays[4].cast(pa.string())], names=["doc_id", "n_lines", "n_removed", "n_runs", "text"])

    joined = _joined(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), gram, window, words)
    return joined.mapInArrow(run, "doc_id long, n_lines long, n_removed long, n_runs long, text string")


def without_repeats(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, words: int | None = WORDS) -> DataFrame:
    """docs with the columns it has; text without later repeated runs, n_chars brought up to date. A document of
    which nothing is left goes."""
    columns = docs.columns
    text = columns.index("text")
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column(text).cast(pa.binary()).to_pylist()
            cut = [cut_lines(t, s)[0] if s else t for t, s in zip(texts, b.column(len(columns)).to_pylist(), strict=True)]
            keep = pa.array([c == t or bool(c.strip()) for c, t in zip(cut, texts, strict=True)])
            arrays = [pa.array(cut, pa.binary()).cast(pa.string()) if i == text else b.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(keep)

    out = _joined(docs, gram, window, words).mapInArrow(run, schema)
    return out.withColumn("n_chars", F.char_length("text").cast(schema["n_chars"].dataType)) if "n_chars" in columns else out
