"""Token ids in directly addressable codes.

A file holds many documents. Each id is cut into chunks of 8 bits, lowest first. Level k holds chunk k of
every id that reaches it, a bitmap that tells which of them go on to level k + 1, and a rank directory: the
number of set bits before every block of 512. Chunk k + 1 of an entry stands in level k + 1 at the rank of
its bit, so one token is read from a few places in the file and no block is decoded.

Layout, little-endian: b"DAC1", header length (4 bytes), JSON header with the places of all sections, then the
sections: document ids (int64), document offsets (int64, one more than documents), and for each level its
chunks (uint8), bitmap (lowest bit first) and directory (uint32). The last level has no bitmap.

Nulls: a null text is empty; a null doc_id sorts first. Rows with one doc_id stay apart, in the order of a hash of their
ids and then of the ids; many of them are split over shards by that hash. An empty table gives no files and no rows.
Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import itertools
import json
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, ranges, slices

BLOCK = 512
CHUNK = 8
#: Words kept with their ids by each worker, in each of two generations; words encoded in one call.
CACHE_WORDS, TOGETHER = 600_000, 2_000
TOKENS_PER_FILE = 1_000_000
MARKS = "!\"#$%&()*+,-./:;=?@[]^_`{}~"
#: Letters that are letters in every version of Unicode and stay letters, one for one, in lower case; so not U+0130.
LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f\u0400-\u0481]+"


# ---- the codes ----


def dac_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap, directory) of each level."""
    out, rest = [], np.asarray(ids, np.uint32)
    while True:
        more = rest >> CHUNK
        goes_on = more > 0
        last = not goes_on.any()
        bitmap = np.packbits(goes_on, bitorder="little") if not last else np.empty(0, np.uint8)
        if not last:
            sums = np.add.reduceat(goes_on, np.arange(0, len(rest), BLOCK), dtype=np.uint32)
            directory = np.concatenate([[0], np.cumsum(sums)[:-1]]).astype("<u4")
        else:
            directory = np.empty(0, "<u4")
        out.append(((rest & 255).astype(np.uint8), bitmap, directory))
        if last:
            return out
        rest = more[goes_on]


def dac_file(doc_ids: list, offsets: np.ndarray, ids: np.ndarray) -> bytes:
    docs = np.array([-(2**63) if d is None else d for d in doc_ids], "<i8")
    sections, at, parts = [], 0, []
    for part in [docs, offsets.astype("<i8"), *(x for level in dac_levels(ids) for x in level)]:
        raw = part.tobytes()
        sections.append([at, len(raw)])
        parts.append(raw)
        at += len(raw)
    head = json.dumps({"docs": len(docs), "tokens": len(ids), "sections": sections}).encode()
    return b"".join([b"DAC1", len(head).to_bytes(4, "little"), head, *parts])


class DacFile:
    """Reads a file by ranges: source has seek() and read(), so a remote file is not read whole."""

    def __init__(self, source) -> None:
        self.source = source
        source.seek(0)
        if source.read(4) != b"DAC1":
            raise ValueError("not a token file")
        size = int.from_bytes(source.read(4), "little")
        head = json.loads(source.read(size))
        self.base, self.sections = 8 + size, head["sections"]
        self.n_docs, self.n_tokens = head["docs"], head["tokens"]
        self.n_levels = (len(self.sections) - 2) // 3

    def _part(self, section: int, start: int, size: int) -> bytes:
        self.source.seek(self.base + self.sections[section][0] + start)
        return self.source.read(size)

    def _whole(self, section: int, kind: str) -> np.ndarray:
        return np.frombuffer(self._part(section, 0, self.sections[section][1]), kind)

    def doc_ids(self) -> np.ndarray:
        return self._whole(0, "<i8")

    def offsets(self) -> np.ndarray:
        return self._whole(1, "<i8")

    def token(self, i: int) -> int:
        """The id at place i, from one chunk, one directory entry and at most one bitmap block a level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = 0
        for level in range(self.n_levels):
            s = 2 + 3 * level
            value |= self._part(s, i, 1)[0] << (CHUNK * level)
            if not self.sections[s + 1][1]:
                return value
            block = i // BLOCK
            bits = int.from_bytes(self._part(s + 1, block * BLOCK // 8, i // 8 - block * BLOCK // 8 + 1), "little")
            if not bits >> (i % BLOCK) & 1:
                return value
            before = int.from_bytes(self._part(s + 2, 4 * block, 4), "little")
            i = before + (bits & ((1 << (i % BLOCK)) - 1)).bit_count()
        return value

    def all_tokens(self) -> np.ndarray:
        """Every id, level by level."""
        out = where = None
        for level in range(self.n_levels):
            s = 2 + 3 * level
            chunks = self._whole(s, np.uint8).astype(np.uint32)
            if level == 0:
                out, where = chunks, np.arange(len(chunks))
            else:
                out[where] |= chunks << np.uint32(CHUNK * level)
            if not self.sections[s + 1][1]:
                break
            where = where[np.unpackbits(self._whole(s + 1, np.uint8), count=len(where), bitorder="little").astype(bool)]
        return out


# ---- tables ----


def _filesystem(path: str):
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class Words:
    """The ids of pieces of text without white space, as bytes of integers; of two generations of CACHE_WORDS pieces the
    older one goes.

    The tokenizer cuts between a letter and a mark, and lowers letters. So LETTERS with ASCII marks behind them are looked
    up apart and in lower case, which lets a word's forms share an entry. Each such run of letters is one word for the
    tokenizer, so new ones are encoded many at a time, with spaces between them. Pieces with other characters go to it
    one by one as they are: in lower case some letters end in a mark that joins the one behind.
    """

    def __init__(self, tokenizer, kind: str) -> None:
        self.encode, self.kind = tokenizer.encode, kind
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _one(self, piece: str) -> bytes:
        return np.array(self.encode(piece, add_special_tokens=False).ids, self.kind).tobytes()

    def _runs(self, pieces: list[str]) -> list[bytes]:
        """The ids of runs of letters."""
        found = self.encode(" ".join(pieces), add_special_tokens=False)
        counts = np.bincount(np.array(found.word_ids, np.int64), minlength=len(pieces))
        if len(counts) != len(pieces) or not counts.all():
            return list(map(self._one, pieces))
        raw, size = np.array(found.ids, self.kind).tobytes(), np.dtype(self.kind).itemsize
        return [raw[a:b] for a, b in itertools.pairwise(np.concatenate([[0], counts.cumsum() * size]).tolist())]

    def _many(self, pieces: list[str], runs: bool) -> list[bytes]:
        known, older = self.known, self.older
        if len(known) + len(pieces) > CACHE_WORDS:
            self.known, self.older = known, older = {}, known
        new = [p for p in pieces if p not in known]
        if older:
            known.update((p, older[p]) for p in new if p in older)
            new = [p for p in new if p not in known]
        for at in range(0, len(new), TOGETHER):
            part = new[at : at + TOGETHER]
            known.update(zip(part, self._runs(part) if runs else map(self._one, part), strict=True))
        return list(map(known.__getitem__, pieces))

    def ids_of(self, pieces: pa.Array) -> list[bytes]:
        letters = pc.utf8_rtrim(pieces, characters=MARKS)
        plain = pc.match_substring_regex(letters, rf"\A{LETTERS}\z")
        forms = pc.utf8_lower(letters.filter(plain)).dictionary_encode()
        runs = self._many(forms.dictionary.to_pylist(), True)
        out = np.empty(len(pieces), object)
        out[plain.to_numpy(zero_copy_only=False)] = list(map(runs.__getitem__, forms.indices.to_pylist()))
        odd = pc.invert(plain)
        out[odd.to_numpy(zero_copy_only=False)] = self._many(pieces.filter(odd).to_pylist(), False)
        marked = np.flatnonzero(pc.and_(plain, pc.not_equal(pc.binary_length(pieces), pc.binary_length(letters))))
        some = pa.array(marked)
        marks = [word[len(run) :] for word, run in zip(pieces.take(some).to_pylist(), letters.take(some).to_pylist(), strict=True)]
        each = dict(zip(found := sorted(set(marks)), self._many(found, False), strict=True))
        own = out.tolist()
        for i, m in zip(marked.tolist(), marks, strict=True):
            own[i] += each[m]
        return own


@lru_cache(maxsize=1)
def load(tokenizer_path: str, end_id: int) -> tuple[Words, int]:
    """The words of a tokenizer, which a worker keeps for its next tasks, and the bytes of an id."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    width = 2 if max(tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    return Words(tokenizer, f"<u{width}"), width


def _ids_of(texts: pa.Array, words: Words, width: int) -> list[bytes]:
    """The ids of each text. Words are told apart in Arrow, so that Python sees each word of the batch once."""
    split = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
    flat = split.flatten().dictionary_encode()
    unique = words.ids_of(flat.dictionary)
    sizes = np.fromiter(map(len, unique), np.int64, len(unique)) // width
    starts = np.cumsum(sizes) - sizes
    index = flat.indices.to_numpy()
    counts = sizes[index]
    ends = np.cumsum(counts)
    tokens = np.frombuffer(b"".join(unique), f"<u{width}")
    raw = tokens[np.repeat(starts[index] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
    cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])] * width
    return [raw[a:b] for a, b in itertools.pairwise(cuts.tolist())]


def shard_of(doc_ids: np.ndarray, hashes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The range between cuts that a row falls in, by doc_id; rows of a doc_id that is several cuts at once are dealt to
    the ranges between these by their hash."""
    low, high = np.searchsorted(cuts, doc_ids, side="left"), np.searchsorted(cuts, doc_ids, side="right")
    return (low + ((hashes >> np.uint64(32)) * np.maximum(high - low, 1).astype(np.uint64) >> np.uint64(32)).astype(np.int64)).astype(np.int32)


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, cuts: list | None = None) -> DataFrame:
    """(doc_id, shard, width, hash, ids) of every document: ids end with end_id, as integers of width bytes.

    The tokenizer drops white space and never joins across it, so each piece between spaces and line ends is
    encoded by the library once a worker and its ids are reused. shard numbers the range of doc_id between cuts.
    """
    cuts = cuts or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, width = load(tokenizer_path, end_id)
        end = int(end_id).to_bytes(width, "little")
        edges = np.array(cuts, np.int64)
        for b in slices(batches, 2048):
            ids = [x + end for x in _ids_of(b.column(1), words, width)]
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, ids), np.uint64, len(ids))
            shard = shard_of(np.array(b.column(0).fill_null(-(2**63)), np.int64), hashes, edges)
            # the order of signed integers is that of the unsigned hashes by which rows are dealt
            signed = (hashes ^ np.uint64(1 << 63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shard), pa.array([width] * len(ids), pa.int32()), pa.array(signed), pa.array(ids, pa.binary())], names=["doc_id", "shard", "width", "hash", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, shard int, width int, hash long, ids binary")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, tokens_per_file: int = TOKENS_PER_FILE) -> None:
    """Encodes documents into token files under path, in ascending doc_id order, with a table of the files.

    Only ids are shuffled. Each task writes files of its own names, and the table, which Spark commits, names
    those of the tasks that succeeded; so lost or doubled tasks leave nothing that is read.
    """
    n = partitions(docs.sparkSession)
    encoded = encode_documents(docs, tokenizer_path, end_id, ranges(docs, "doc_id", n, repeats=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(path)
        doc_ids, ids, total, seq = [], [], 0, 0

        def flush(shard: int, width: int) -> pa.RecordBatch:
            counts = np.array([len(x) // width for x in ids], np.int64)
            name = f"tokens-{shard:05d}-{seq:05d}-{uuid.uuid4().hex}.dac"
            with fs.open_output_stream(f"{base}/{name}") as out:
                out.write(dac_file(doc_ids, np.concatenate([[0], np.cumsum(counts)]), np.frombuffer(b"".join(ids), f"<u{width}")))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((shard, pa.int32()), (seq, pa.int32()), (name, pa.string()), (len(doc_ids), pa.int64()), (int(counts.sum()), pa.int64()))], names=["shard", "seq", "file", "n_docs", "n_tokens"])

        fs.create_dir(base, recursive=True)
        shard = width = 0
        for b in slices(batches, 1024):
            for d, s, width, _, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if doc_ids and (s != shard or total >= tokens_per_file):
                    yield flush(shard, width)
                    doc_ids, ids, total, seq = [], [], 0, seq + 1
                shard = s
                doc_ids.append(d)
                ids.append(x)
                total += len(x) // width
        if doc_ids:
            yield flush(shard, width)

    encoded.repartitionById(n, "shard").sortWithinPartitions("shard", "doc_id", "hash", "ids").mapInArrow(run, "shard int, seq int, file string, n_docs long, n_tokens long").write.mode("overwrite").parquet(f"{path}/files")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of each document; start counts the ids of all documents before it."""
    files = spark.read.parquet(f"{path}/files")
    before = F.sum("n_tokens").over(Window.orderBy("shard", "seq").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("file", F.coalesce(before, F.lit(0)).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(path)
        for b in batches:
            for name, start in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with fs.open_input_file(f"{base}/{name}") as source:
                    f = DacFile(source)
                    docs, at, ids = f.doc_ids(), f.offsets(), f.all_tokens()
                for i in range(0, len(docs), 512):
                    d, a = docs[i : i + 512], at[i : i + 513]
                    raw = [ids[x:y].astype("<u4").tobytes() for x, y in zip(a[:-1], a[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(d, mask=d == -(2**63)), pa.array(start + a[:-1]), pa.array(np.diff(a)), pa.array(raw, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    n = max(1, min(1 << 16, spark.read.parquet(f"{path}/files").count()))
    return files.repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def with_crc32(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the checksum is of the ids as little-endian 32-bit integers."""
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


__all__ = ["DacFile", "dac_file", "dac_levels", "encode_documents", "read_tokens", "with_crc32", "write_tokens"]
