"""SentencePiece encoding and decoding with N-best segmentation.

A model's pieces and scores span a lattice over the text. Forward Viterbi gives each place the best score of any
path to it. These scores are exact heuristics for a backward A* search from the end, so complete paths come off
its queue best first: the N best segmentations. The first of them never leaves the edges that lose nothing against the
heuristic; so many chunks' first paths are traced at once, and the search itself runs for the others. Where no piece
goes on over a boundary (between a character and a following space mark, and around a line end) the lattice falls apart
in chunks; a worker solves each chunk once, and a text's N best are the N best combinations of its chunks' own.

A byte-pair model has ranks of merges and no likelihoods. A piece's score is the worth of the merges that make it up,
each 1 / rank ** 2, so that early merges outweigh all later ones as they do in merging: the best path is then the
library's segmentation for more than nine words in ten. A character without a piece is its UTF-8 bytes, each with a
score below all pieces. A space is the mark U+2581, and one is put before the text; a mark in the text itself is
written as bytes. So decoding gives back every text.

Nulls: a null text is empty. An empty text has no pieces, score 0 and one segmentation. Ties go to the longer last
piece. Rows are independent, repeated ones and rows with one doc_id too; an empty table gives no rows; columns other than
doc_id and text are left out. A very long text is held by one worker, with its chunks.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

MARK = "▁"
CACHE_CHUNKS, N_BEST = 60_000, 3
BLOCK, LONGEST_IN_BLOCK, TOGETHER = 2048, 32, 400_000  # chunks, characters of one, characters of texts split at once
BUCKET_BITS, FAR, NONE = 18, 1 << 60, -(1 << 50)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Scores are multiples of 1 / UNIT, which add up without rounding in any order.
UNIT = 1 << 32
_CHUNKS = re.compile(r"\n| *[^ \n]+| +")


def merge_worth(piece: str, rank: dict[str, float]) -> int:
    """The sum of 1 / rank ** 2 over the merges that lead from a piece's characters to it, of the lowest rank first and
    of equal ones the leftmost."""
    parts, worth = list(piece), 0
    while len(parts) > 1:
        r, i = min((rank.get(parts[i] + parts[i + 1], np.inf), i) for i in range(len(parts) - 1))
        if r == np.inf:
            return worth  # the merges do not make this piece
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        worth += max(1, round(UNIT / r**2))
    return worth


class PieceModel:
    def __init__(self, path: str, n_best: int = N_BEST) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n_best, self.ids, self.raw, self.bytes = n_best, {}, [], [0] * 256
        n = sp.get_piece_size()
        scores = [sp.get_score(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        rank = {sp.id_to_piece(i): 1 + min(-scores[i], n) for i in normal}
        self.ids = {sp.id_to_piece(i): (i, merge_worth(sp.id_to_piece(i), rank)) for i in normal}
        self.byte_score = -UNIT
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            else:
                self.raw.append(piece.replace(MARK, " ").encode())
        if not any(self.bytes):
            raise ValueError("the model has no byte pieces")
        self.prefixes = dict.fromkeys(p[:i] for p in self.ids for i in range(1, len(p)))
        self.prefixes.update(self.ids)
        self.inside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.longest = max(map(len, self.ids), default=1)
        self.apart = not any(MARK in p.lstrip(MARK) or "\n" in p for p in self.ids)
        keys = np.array([self._hash(p) for p in self.ids], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.key_ids = np.array([i for i, _ in self.ids.values()], np.int32)[order]
        self.key_scores = np.array([s for _, s in self.ids.values()], np.int64)[order]
        # the first key of each bucket of leading bits; one last key lets a walk in a bucket end
        bucket = (self.keys >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        self.first = np.full(1 << BUCKET_BITS, -1, np.int32)
        self.first[bucket[::-1]] = np.arange(len(bucket), dtype=np.int32)[::-1]
        self.fullest = int(np.bincount(bucket).max())
        self.keys = np.append(self.keys, np.uint64((1 << 64) - 1))
        self.single = np.zeros(0x110000, bool)
        self.single[[ord(p) for p in self.ids if len(p) == 1]] = True
        self.solved: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}
        self.lists: dict[str, list] = {}

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h + ord(c)) * int(_ODD) & (1 << 64) - 1
        return h

    def chunks(self, text: str) -> list[str]:
        text = f" {text}"
        return _CHUNKS.findall(text) if self.apart else [text]

    def _edges(self, chunk: str, end: int) -> Iterator[tuple[int, int, tuple]]:
        """(start, score, ids) of the pieces that end at end."""
        marked = chunk.replace(MARK, "\0").replace(" ", MARK)
        for start in range(max(0, end - self.longest), end):
            found = self.ids.get(marked[start:end])
            if found:
                yield start, found[1], (found[0],)
            elif start == end - 1:
                raw = chunk[start].encode()
                yield start, self.byte_score * len(raw), tuple(self.bytes[x] for x in raw)

    def _forward(self, chunk: str) -> list[int]:
        """Best score of a path to each place."""
        best, get, longest = [0], self.ids.get, self.longest
        marked = chunk.replace(MARK, "\0").replace(" ", MARK)
        for end in range(1, len(chunk) + 1):
            top = None
            for start in range(max(0, end - longest), end):
                found = get(marked[start:end])
                if found:
                    s = best[start] + found[1]
                elif start == end - 1:
                    s = best[start] + self.byte_score * len(chunk[start].encode())
                else:
                    continue
                if top is None or s > top:
                    top = s
            best.append(top)
        return best

    def search(self, chunk: str, n: int) -> list[tuple[int, tuple]]:
        """The n best (score, ids) of a chunk: A* backward from its end, with forward scores as heuristics."""
        best = self._forward(chunk)
        queue, made, out = [(-best[-1], 0, len(chunk), 0, ())], 0, []
        while queue and len(out) < n:
            _, _, at, behind, ids = heapq.heappop(queue)
            if at == 0:
                out.append((behind, ids))
                continue
            for start, score, piece in self._edges(chunk, at):
                made += 1
                heapq.heappush(queue, (-(best[start] + score + behind), made, start, score + behind, piece + ids))
        return out

    def solve(self, chunk: str) -> tuple[bytes, int, int]:
        """(ids, score, how far the second segmentation is behind, FAR without one) of a chunk."""
        got = self.solved.get(chunk)
        if got is None:
            got = self.solved[chunk] = self.older.get(chunk) or self._solve(chunk)
        return got

    def solve_all(self, chunks: set[str]) -> None:
        """Makes sure that all these chunks are in solved; those of usual lengths are solved in blocks."""
        if len(self.solved) >= CACHE_CHUNKS:
            self.older, self.solved = self.solved, {}
        new, older = [], self.older
        for chunk in chunks - self.solved.keys():
            got = older.get(chunk) if older else None
            if got is None and len(chunk) <= LONGEST_IN_BLOCK:
                new.append(chunk)
            else:
                self.solved[chunk] = got or self._solve(chunk)
        new.sort(key=len, reverse=True)
        for at in range(0, len(new), BLOCK):
            self._solve_block(new[at : at + BLOCK])

    def _lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, pieces) of the hashes in h that are pieces."""
        at = self.first[h.ravel() >> np.uint64(64 - BUCKET_BITS)]
        places = np.flatnonzero(at >= 0)
        at, found = at[places], h.ravel()[places]
        for _ in range(self.fullest - 1):
            at += self.keys[at] < found
        same = self.keys[at] == found
        return places[same], at[same]

    def _solve_block(self, chunks: list[str]) -> None:
        """As _solve, for chunks in falling order of length, with a row for each place and a column for each chunk."""
        n, width = len(chunks), len(chunks[0])
        lengths = np.fromiter(map(len, chunks), np.int64, n)
        marked = "".join([c.ljust(width, "\0") for c in chunks]).replace(MARK, "\0").replace(" ", MARK)
        codes = np.ascontiguousarray(np.frombuffer(marked.encode("utf-32-le"), "<u4").reshape(n, width).T)
        whole = (self.single[codes] | (np.arange(width)[:, None] >= lengths)).all(0)  # no character needs bytes
        codes = codes.astype(np.uint64)
        edges, h = [], np.zeros((width, n), np.uint64)
        for k in range(1, min(self.longest, width) + 1):
            h = (h[: width - k + 1] + codes[k - 1 :]) * _ODD
            places, at = self._lookup(h)
            score, piece = np.full(h.size, NONE), np.zeros(h.size, np.int32)
            score[places], piece[places] = self.key_scores[at], self.key_ids[at]
            edges.append((score.reshape(h.shape), piece.reshape(h.shape)))
        best = np.full((width + 1, n), NONE)
        best[0] = 0
        second, back, taken = np.full((width + 1, n), NONE), np.zeros((width + 1, n), np.int64), np.zeros((width + 1, n), np.int32)
        reach = np.searchsorted(-lengths, -np.arange(width + 1), "right")  # chunks at least as long as each place
        for end in range(1, width + 1):
            m = reach[end]
            top, next_ = best[end, :m], second[end, :m]
            for k in range(min(self.longest, end), 0, -1):
                score, piece = edges[k - 1]
                s = best[end - k, :m] + score[end - k, :m]
                np.maximum(next_, np.minimum(top, s), out=next_)
                better = s > top
                np.maximum(top, s, out=top)
                np.copyto(back[end, :m], k, where=better)
                np.copyto(taken[end, :m], piece[end - k, :m], where=better)
        gap = np.where(second > NONE // 2, best - second, FAR)
        at, each, least = lengths.copy(), np.arange(n), np.full(n, FAR)
        steps = []
        while at.any():  # place 0 has piece 0 and no step, so paths that are done stay there
            np.minimum(least, np.where(at > 0, gap[at, each], FAR), out=least)
            steps.append(np.where(at > 0, taken[at, each], -1))
            at = at - back[at, each]
            at[~whole] = 0
        ids = np.array(steps[::-1]).T
        kept = ids >= 0
        ends = np.cumsum(kept.sum(1)).tolist()
        raw, totals, least, whole = ids[kept].astype("<u2").tobytes(), best[lengths, each].tolist(), least.tolist(), whole.tolist()
        start = 0
        for i, chunk in enumerate(chunks):
            self.solved[chunk] = (raw[2 * start : 2 * ends[i]], totals[i], least[i]) if whole[i] else self._solve(chunk)
            start = ends[i]

    def _solve(self, chunk: str) -> tuple[bytes, int, int]:
        """One pass: a second path leaves the best one at some place by an edge that is the best there but for one."""
        marked = chunk.replace(MARK, "\0").replace(" ", MARK)
        # no piece holds both characters of such a pair, so every segmentation is cut there
        cuts = [i for i in range(1, len(marked)) if marked[i - 1 : i + 1] not in self.inside]
        if cuts:
            parts = [self.solve(chunk[x:y]) for x, y in itertools.pairwise([0, *cuts, len(chunk)])]
            return b"".join(p[0] for p in parts), sum(p[1] for p in parts), min(p[2] for p in parts)
        get, n, no = self.prefixes.get, len(marked), ()
        best: list = [0] + [None] * n
        second: list = [None] * (n + 1)
        back: list = [None] * (n + 1)
        for start in range(n):
            base = best[start]
            for end in range(start + 1, n + 1):
                found = get(marked[start:end], no)
                if found is no or found is None:
                    if end == start + 1:
                        raw = chunk[start].encode()
                        s, link = base + self.byte_score * len(raw), (start, raw)
                    elif found is no:
                        break
                    else:
                        continue
                else:
                    s, link = base + found[1], (start, found[0])
                top = best[end]
                if top is None or s > top:
                    best[end], second[end], back[end] = s, top, link
                elif second[end] is None or s > second[end]:
                    second[end] = s
                if found is no:
                    break
        at, ids, least = n, [], FAR
        while at:
            if second[at] is not None:
                least = min(least, best[at] - second[at])
            at, piece = back[at]
            if isinstance(piece, bytes):
                ids.extend(self.bytes[x] for x in reversed(piece))
            else:
                ids.append(piece)
        return np.array(ids[::-1], "<u2").tobytes(), best[n], least

    def encode(self, text: str) -> tuple[bytes, int, list[tuple[int, bytes]]]:
        """(ids of the best segmentation as 16-bit integers, its score, (score, ids) of the n best)."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[tuple[bytes, int, list[tuple[int, bytes]]]]:
        """encode of each text; chunks that are new are solved together."""
        split = [self.chunks(text) if text else [] for text in texts]
        self.solve_all(set(itertools.chain.from_iterable(split)))
        out = []
        for chunks in split:
            if chunks:
                ids, scores, gaps = zip(*map(self.solved.__getitem__, chunks), strict=True)
                total, first = sum(scores), b"".join(ids)
                best = [(total, first)]
                for loss, changed in self._combine(chunks, gaps)[1:]:
                    parts = list(ids)
                    for i, other in changed:
                        parts[i] = other
                    best.append((total - loss, b"".join(parts)))
                out.append((first, total, best))
            else:
                out.append((b"", 0, [(0, b"")]))
        return out

    def n_best_of(self, text: str, n: int | None = None) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a text: (score, ids)."""
        if not text:
            return [(0.0, [])]
        n = n or self.n_best
        parts = [self.search(c, n) for c in self.chunks(text)]
        found: list[tuple[int, tuple]] = [(0, ())]
        for options in parts:
            found = heapq.nlargest(n, ((s + t, a + b) for s, a in found for t, b in options), key=lambda x: x[0])
        return [(s / UNIT, list(ids)) for s, ids in found]

    def _options(self, chunk: str) -> list[tuple[int, bytes]]:
        """The n best segmentations of a chunk as (score lost, ids), the solved one first."""
        out = self.lists.get(chunk)
        if out is None:
            if len(self.lists) >= CACHE_CHUNKS // 4:
                self.lists.clear()
            own, score, _ = self.solved[chunk]
            found = [(score - s, np.array(ids, "<u2").tobytes()) for s, ids in self.search(chunk, self.n_best)]
            others = [x for x in found if x[1] != own]
            out = self.lists[chunk] = [(0, own), *others[: len(found) - 1]]
        return out

    def _combine(self, chunks: list[str], gaps: tuple[int, ...]) -> list[tuple[int, tuple]]:
        """The n best as (score lost, chunks that differ from the best and their ids): n - 1 chunks with the nearest
        second segmentations can take part, no others."""
        n = self.n_best
        if n < 2:
            return [(0, ())]
        far = np.array(gaps)
        near = sorted(np.argpartition(far, n - 2)[: n - 1].tolist()) if len(far) >= n else range(len(far))
        found: list[tuple[int, tuple]] = [(0, ())]
        for i in near:
            if gaps[i] < FAR:
                found = sorted(((a + b, (*x, (i, ids)) if k else x) for a, x in found for k, (b, ids) in enumerate(self._options(chunks[i]))), key=lambda y: (y[0], len(y[1])))[:n]
        return found

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u2").tolist()))
        return raw.decode()[1:]


def _groups(texts: list[str | None]) -> Iterator[list[str]]:
    """The texts in order, as many together as have TOGETHER characters; nulls are empty."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= TOGETHER:
            yield group
            group, size = [], 0
    yield group


@lru_cache(maxsize=2)
def load(path: str, n_best: int = N_BEST) -> PieceModel:
    return PieceModel(path, n_best)


def encode_pieces(docs: DataFrame, model_path: str, n_best: int = N_BEST) -> DataFrame:
    """(doc_id, n_pieces, ids, ids_crc32, score, n_best_scores, n_best_ids, n_best_crc32, round_trip) of each whole text:
    ids are 16-bit little-endian integers, checksums are over 32-bit ones; the n best are in falling order of score, the
    first is ids; round_trip tells whether decoding any of them gives back the text."""

    def wide(ids: bytes) -> int:
        return zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path, n_best)
        for b in slices(batches):
            out = []
            for texts in _groups(b.column(1).to_pylist()):
                for text, (ids, score, best) in zip(texts, model.encode_all(texts), strict=True):
                    scores, each = zip(*best, strict=True)
                    crc = [wide(x) for x in each]
                    out.append((len(ids) // 2, ids, crc[0], score / UNIT, [s / UNIT for s in scores], each, crc, all(model.decode(x) == text for x in each)))
            types = [pa.int64(), pa.binary(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.bool_()]
            names = ["n_pieces", "ids", "ids_crc32", "score", "n_best_scores", "n_best_ids", "n_best_crc32", "round_trip"]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[i] for r in out], t) for i, t in enumerate(types))], names=["doc_id", *names])

    schema = "doc_id long, n_pieces long, ids binary, ids_crc32 long, score double, n_best_scores array<double>, n_best_ids array<binary>, n_best_crc32 array<long>, round_trip boolean"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
