"""Filters of 64-bit values with a bounded size: no value of the set is missed, a few others pass."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mix64, partitions

#: Bits for a value, and bits of a whole filter at most (64 MB).
VALUE_BITS, MOST_BITS = 16, 1 << 29
#: A value with this part of its range's values or more is heavy, if it has so many: SHARE heavy values a range at most.
SHARE, LEAST_HEAVY = 16, 64


def part_of(values: np.ndarray, n: int) -> np.ndarray:
    return (((values >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def blobs(values: np.ndarray, n: int) -> pa.RecordBatch:
    """Values as (part, hashes): one row of 8-byte integers for each of n ranges that has any."""
    part = part_of(values, n)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(n + 1))
    rows = [(k, values[order[x:y]].tobytes()) for k, (x, y) in enumerate(itertools.pairwise(cuts)) if y > x]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["part", "hashes"])


BLOBS = "part int, hashes binary"


def _probes(values: np.ndarray, bits: np.ndarray | int) -> list[np.ndarray]:
    return [(values >> np.uint64(s)) % np.asarray(bits, np.uint64) for s in (0, 13, 29)]


@dataclass
class Filter:
    """A bit map for each range of values, end to end, and the values that are heavy."""

    sizes: np.ndarray
    flat: np.ndarray
    heavy: np.ndarray

    def maybe(self, values: np.ndarray) -> np.ndarray:
        part = part_of(values, len(self.sizes))
        size = self.sizes[part]
        out = size > 0
        if len(self.flat):
            starts = np.cumsum(self.sizes) - self.sizes
            for p in _probes(values, np.maximum(size, 1)):
                place = np.where(out, starts[part] + p.astype(np.int64), 0)
                out &= (self.flat[place >> 3] >> (place & 7) & 1).astype(bool)
        return out

    def is_heavy(self, values: np.ndarray) -> np.ndarray:
        if not len(self.heavy):
            return np.zeros(len(values), bool)
        at = np.minimum(np.searchsorted(self.heavy, values), len(self.heavy) - 1)
        return self.heavy[at] == values


def build(rows: DataFrame, least: int = 2) -> Filter:
    """The filter of the values that occur least times in (part, hashes) rows. Each range's values meet in one task,
    which keeps 8 bytes a value; the driver gets MOST_BITS and SHARE heavy values a range at most."""
    n = partitions(rows.sparkSession)
    most = MOST_BITS // n

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            for part, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(part, []).append(np.frombuffer(raw, np.uint64))
        for part in sorted(held):
            values = np.sort(np.concatenate(held.pop(part)))
            starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
            counts = np.diff(np.append(starts, len(values)))
            found = values[starts[counts >= least]]
            heavy = values[starts[counts >= max(LEAST_HEAVY, len(values) / SHARE)]]
            if len(found):
                bits = min(most, max(64, len(found) * VALUE_BITS)) // 8 * 8
                marks = np.zeros(bits, bool)
                for p in _probes(found, bits):
                    marks[p] = True
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary()), pa.array([heavy.tobytes()], pa.binary())], names=["part", "bits", "heavy"])

    maps, heavy = [np.empty(0, np.uint8)] * n, [np.empty(0, np.uint64)]
    # one job for all ranges: what they give is bounded as a whole
    for r in rows.repartitionById(n, "part").mapInArrow(meet, "part int, bits binary, heavy binary").collect():
        maps[r.part] = np.frombuffer(bytes(r.bits), np.uint8)
        heavy.append(np.frombuffer(bytes(r.heavy), np.uint64))
    return Filter(np.array([8 * len(m) for m in maps], np.int64), np.concatenate(maps), np.sort(np.concatenate(heavy)))


def of_ids(ids: DataFrame) -> Filter:
    """The filter of the integers in all columns of ids."""
    n = partitions(ids.sparkSession)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield blobs(mix64(np.unique(np.concatenate([c.to_numpy() for c in b.columns])).view(np.uint64)), n)

    return build(ids.mapInArrow(values, BLOBS), 1)


def chosen(batch: pa.RecordBatch, known: Filter) -> pa.RecordBatch:
    """The rows whose first column, an integer, passes a filter of_ids."""
    return batch.filter(pa.array(known.maybe(mix64(batch.column(0).to_numpy().view(np.uint64)))))
