"""Language identification by cross-parsing against suffix automata.

A bounded sample of whole labelled texts of each language becomes a suffix automaton. A text is parsed, against each of
them, into the longest phrases that occur in the sample; a character that does not is a phrase. A phrase costs the bits
of a place in the sample, the logarithm of its size, so that samples of unequal sizes compare; the language with the
least normalised number of phrases wins.

Automata are dense transition tables over the ALPHABET commonest characters, whose missing transitions already hold the
way on (end a phrase, and start the next one with this character), and sorted lists for other characters. A long text is
one parse: its segments go through the tables side by side from the start state, and are then gone through again from
the state in which the one before them really ends, until both ways meet.

The sample: by a hash of doc_id, at most SAMPLE_DOCS whole texts a language of at most TEXT_CHARS characters, until
SAMPLE_CHARS are reached, or its part of ALL_CHARS; a language with longer texts only gives its shortest one.
Nulls: a null text, or one without a letter, is `und` with score 0. Rows with null lang are never learned from.
Ties go to the language first by code point. Without anything to learn from, all is `und`. Rows with one doc_id are rows
of their own, and equal texts have equal results. An empty table gives no rows; columns other than doc_id, text and lang
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices

UNDETERMINED = "und"
#: Bounds of the sample: texts of a language, characters of a text, of a language, and of all languages.
SAMPLE_DOCS, TEXT_CHARS, SAMPLE_CHARS, ALL_CHARS = 200, 2_000, 40_000, 320_000
#: Characters of a segment, segments that go side by side, and characters with a column of their own.
SEGMENT, LANES, ALPHABET = 512, 2_048, 64


def held_out(doc_id: str = "doc_id", of: int = 3, fold: int = 1):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % of == fold, F.lit(False))


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, text_chars: int = TEXT_CHARS, sample_chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """The sample of each language, whole texts put together by line ends."""
    known = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.char_length("text").alias("size"), F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"))
    known = known.withColumn("over", F.greatest(F.col("size") - text_chars, F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("over", "h", "t", "text"))
    rows = known.withColumn("rank", rank).filter((F.col("rank") <= sample_docs) & ((F.col("over") == 0) | (F.col("rank") == 1))).select("lang", "rank", "text").collect()
    most = min(sample_chars, ALL_CHARS // max(1, len({r.lang for r in rows})))
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.rank)):
        own = out.setdefault(r.lang, [])
        if not own or sum(map(len, own)) + len(r.text) <= most:
            own.append(r.text.lower())
    return {lang: "\n".join(parts) for lang, parts in out.items() if any(parts)}


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the start."""
    to: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(to)
        to.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in to[p]:
            to[p][c] = cur
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(to)
                to.append(dict(to[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return to


class CrossParser:
    """Counts phrases of texts against each language's sample."""

    def __init__(self, samples: dict[str, str]) -> None:
        self.langs = sorted(samples)
        points = [np.frombuffer(samples[x].encode("utf-32-le", "replace"), "<u4") for x in self.langs]
        counts = np.bincount(np.concatenate(points)) if points else np.zeros(1, np.int64)
        commonest = np.argsort(-counts, kind="stable")[: ALPHABET - 1]
        self.columns = np.zeros(len(counts), np.uint8)  # 0: any other character
        self.columns[commonest] = np.arange(1, len(commonest) + 1)
        self.columns[counts == 0] = 0
        self.known = counts > 0
        self.bits = np.array([np.log2(max(2, len(x))) for x in points])
        self.tables, self.rare = [], []
        for text in points:
            to = suffix_automaton(text.tolist())
            table = np.zeros((len(to), ALPHABET), np.int32)
            for c in commonest.tolist():
                table[:, self.columns[c]] = ~to[0].get(c, 0)  # below zero: a phrase begins with this character
            table[:, 0] = ~0
            keys, states = [], []
            for s, edges in enumerate(to):
                for c, t in edges.items():
                    if self.columns[c]:
                        table[s, self.columns[c]] = t if s else ~t
                    else:
                        keys.append(s << 21 | c)
                        states.append(t if s else ~t)
            order = np.argsort(np.array(keys, np.int64))
            self.tables.append(table.ravel())
            self.rare.append((np.array(keys, np.int64)[order], np.array(states, np.int32)[order]))

    def _next(self, lang: int, state: np.ndarray, column: np.ndarray, point: np.ndarray | None) -> np.ndarray:
        """States after a character, below zero where it begins a phrase. point: characters, if any is rare."""
        out = self.tables[lang][state * ALPHABET + column]
        keys, states = self.rare[lang]
        if point is not None and len(keys):
            odd = np.flatnonzero(column == 0)
            for s in (np.zeros(len(odd), np.int64), state[odd].astype(np.int64)):  # a new phrase, unless this one goes on
                key = s << 21 | point[odd]
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                out[odd[hit]] = states[at[hit]]
        return out

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of each text (rows) for each language (columns)."""
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        coded = [np.frombuffer(t.encode("utf-32-le", "replace"), "<u4") for t in texts]
        lanes = [(k, i) for k, x in enumerate(coded) for i in range(0, len(x), SEGMENT)]
        ends = np.zeros(len(self.langs), np.int32)  # of the last lane before, for a text that goes on
        for at in range(0, len(lanes), LANES):
            part = lanes[at : at + LANES]
            owner = np.array([k for k, _ in part])
            sizes = np.array([min(SEGMENT, len(coded[k]) - i) for k, i in part])
            points = np.zeros((int(sizes.max()), len(part)), np.int64)
            for j, (k, i) in enumerate(part):
                points[: sizes[j], j] = coded[k][i : i + SEGMENT]
            inside = np.minimum(points, len(self.columns) - 1)
            columns = np.where(points < len(self.columns), self.columns[inside], np.uint8(0))
            odd = (columns == 0) & self.known[inside] & (points < len(self.columns))
            follows = np.array([i > 0 for _, i in part])
            for lang in range(len(self.langs)):
                count, ends[lang] = self._parse(lang, columns, points if odd.any() else None, sizes, follows, ends[lang])
                out[:, lang] += np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64)
        return out

    def _parse(self, lang: int, columns: np.ndarray, points: np.ndarray | None, sizes: np.ndarray, follows: np.ndarray, carried: int) -> tuple[np.ndarray, int]:
        """(phrases that begin in each lane, state behind the last one). A lane that follows goes on from the state
        behind the one before it, the first from carried."""
        lanes, steps = columns.shape[1], columns.shape[0]
        after = np.zeros((steps, lanes), np.int32)
        state, count = np.zeros(lanes, np.int32), np.zeros(lanes, np.int64)

        def step(k: int, who: np.ndarray, now: np.ndarray) -> np.ndarray:
            return self._next(lang, now, columns[k, who], None if points is None else points[k, who])

        order = np.argsort(-sizes, kind="stable")
        active = np.searchsorted(-sizes[order], -np.arange(1, steps + 1), side="right")
        for k, n in enumerate(active.tolist()):
            who = order[:n]
            nxt = step(k, who, state[who])
            after[k, who] = nxt
            count[who] += nxt < 0
            state[who] = nxt ^ (nxt >> 31)
        entered = np.zeros(lanes, np.int32)
        while True:
            enter = np.where(follows, np.concatenate([[carried], state[:-1]]), 0).astype(np.int32)
            who = np.flatnonzero(enter != entered)
            if not len(who):
                return count, int(state[-1])
            entered = enter
            now, k = enter[who], 0
            while len(who):
                nxt, was = step(k, who, now), after[k, who]
                count[who] += (nxt < 0).astype(np.int64) - (was < 0)
                now = nxt ^ (nxt >> 31)
                after[k, who] = nxt
                apart = now != was ^ (was >> 31)
                done = apart & (sizes[who] == k + 1)
                state[who[done]] = now[done]
                on = apart & ~done
                who, now, k = who[on], now[on], k + 1

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        known = [i for i, t in enumerate(texts) if t and self.langs and any(map(str.isalpha, t))]
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if known:
            cost = self.phrases([texts[i].lower() for i in known]) * self.bits
            best = cost.argmin(axis=1)
            # what the others cost more, in phrases of the best, as bits: shares of 2 ** -cost
            more = (cost - cost.min(axis=1, keepdims=True)) / self.bits[best][:, None]
            share = 1 / np.exp2(-np.minimum(more, 60.0)).sum(axis=1)
            for i, k, s in zip(known, best, share, strict=True):
                langs[i], scores[i] = self.langs[k], float(s)
        return langs, scores


_PARSERS: dict[int, CrossParser] = {}


def predict_languages(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """(doc_id, lang_pred, score) of each whole text. samples is bounded by ALL_CHARS, or one text a language, and goes
    with the tasks."""
    sent = docs.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(frozenset(sent.value.items()))
        if key not in _PARSERS:
            _PARSERS.clear()
            _PARSERS[key] = CrossParser(sent.value)
        for b in slices(batches, 512):
            langs, scores = _PARSERS[key].predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learns from documents outside the held-out fold and predicts all: (doc_id, held_out, lang_pred, score)."""
    samples = learn(docs.filter(~held_out()))
    return predict_languages(docs, samples).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
