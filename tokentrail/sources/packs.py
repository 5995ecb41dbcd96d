"""Objects of a repository in pack files, read and written by tasks.

Reading. A pack's index is read in slices, a task each, as rows (pack, object_id, offset). Rows are dealt by CHUNK bytes of
their pack, so tasks are in proportion to bytes, and each reads its part of the pack once, from its first entry to its last.
Entries that are differences to others are made whole by joins with their bases, one round for each step of the longest
chain; loose objects are read beside them. Every object is held against its id.

Writing. Each task puts objects into packs of about PACK_BYTES, with their indexes, in a staged folder; the driver moves
the packs of the tasks that succeeded to their place, indexes last, and removes the rest. A pack is named after the ids in
it, so what a failed run has left or a second one writes again does no harm.

Any file system works that pyarrow and Spark both open by the same path.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..store import filesystem, stored

#: Numbers of kinds in packs; 6 and 7 are differences, to an entry at a distance and to one with an id.
KINDS = {"commit": 1, "tree": 2, "blob": 3, "tag": 4}
_KIND_OF = {n: k for k, n in KINDS.items()}
_NEAR, _BY_ID = 6, 7
CHUNK, PACK_BYTES, SLICE = 64 << 20, 64 << 20, 1 << 20
_FANOUT = 8 + 1024


# ---- one entry ----


def entry_head(data: bytes, at: int = 0) -> tuple[int, int, int]:
    """(kind, size when inflated, place of what follows)."""
    byte = data[at]
    kind, size, shift = byte >> 4 & 7, byte & 15, 4
    while byte & 128:
        at += 1
        byte = data[at]
        size |= (byte & 127) << shift
        shift += 7
    return kind, size, at + 1


def near_distance(data: bytes, at: int) -> tuple[int, int]:
    """(distance to the base, place of what follows)."""
    byte = data[at]
    distance = byte & 127
    while byte & 128:
        at += 1
        byte = data[at]
        distance = (distance + 1) << 7 | byte & 127
    return distance, at + 1


def apply_difference(base: bytes, difference: bytes) -> bytes:
    """The object that a difference makes of its base: pieces copied from it and pieces given."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = difference[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if not byte & 128:
                return value

    if number() != len(base):
        raise ValueError("a difference to another base")
    size, out = number(), []
    while at < len(difference):
        op = difference[at]
        at += 1
        if op & 128:
            fields = []
            for bit in range(7):
                fields.append(difference[at] if op >> bit & 1 else 0)
                at += op >> bit & 1
            start, length = int.from_bytes(bytes(fields[:4]), "little"), int.from_bytes(bytes(fields[4:]), "little") or 1 << 16
            out.append(base[start : start + length])
        elif op:
            out.append(difference[at : at + op])
            at += op
        else:
            raise ValueError("a difference with an unknown step")
    whole = b"".join(out)
    if len(whole) != size:
        raise ValueError("a difference that gives another size")
    return whole


def packed(kind: str, content: bytes) -> bytes:
    size = len(content)
    head = [KINDS[kind] << 4 | size & 15]
    size >>= 4
    while size:
        head[-1] |= 128
        head.append(size & 127)
        size >>= 7
    return bytes(head) + zlib.compress(content)


# ---- reading ----


def _listed(path: str, pattern: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files below path/objects/<pattern folder> with its suffix."""
    import pyarrow.fs as pafs

    fs, base = filesystem(path)
    found = fs.get_file_info(pafs.FileSelector(f"{base}/objects/pack", allow_not_found=True))
    return sorted((f.path, f.size) for f in found if f.path.endswith(pattern))


def _open(root: str, file: str):
    return filesystem(root)[0].open_input_file(file)


def index_rows(spark: SparkSession, path: str) -> DataFrame:
    """(pack, object_id, offset) of all objects in packs of the repository at path."""
    slices = []
    for index, _ in _listed(path, ".idx"):
        with _open(path, index) as f:
            n = struct.unpack(">I", f.read_at(4, _FANOUT - 4))[0]
        slices += [(index, i, n) for i in range(0, n, SLICE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for index, first, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with _open(path, index) as f:
                    if f.read_at(8, 0) != b"\377tOc\0\0\0\2":
                        raise ValueError(f"{index} is no index of version 2")
                    m = min(SLICE, n - first)
                    ids = f.read_at(20 * m, _FANOUT + 20 * first)
                    offsets = list(struct.unpack(f">{m}I", f.read_at(4 * m, _FANOUT + 24 * n + 4 * first)))
                    for i, o in enumerate(offsets):
                        if o >> 31:  # beyond 2 GB: a place in the table of long offsets
                            offsets[i] = struct.unpack(">Q", f.read_at(8, _FANOUT + 28 * n + 8 * (o & 0x7FFFFFFF)))[0]
                    names = [ids[20 * i : 20 * i + 20].hex() for i in range(m)]
                    yield pa.RecordBatch.from_arrays([pa.array([index.removesuffix("idx") + "pack"] * m), pa.array(names), pa.array(offsets, pa.int64())], names=["pack", "object_id", "offset"])

    rows = spark.createDataFrame(slices, "index string, first long, n long")
    return rows.repartition(max(1, len(slices))).mapInArrow(run, "pack string, object_id string, offset long")


def _entries(path: str, rows: DataFrame, n: int) -> DataFrame:
    """(pack, offset, object_id, kind, base, base_id, data): what stands in the packs; base is an offset."""
    schema = "pack string, offset long, object_id string, kind int, base long, base_id string, data binary"
    types = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, opened = None, None
        for b in batches:
            out, size = [], 0
            for pack, offset, oid in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if pack != opened:
                    file, opened = _open(path, pack), pack
                out.append((pack, offset, oid, *_entry(file, offset)))
                size += len(out[-1][-1])
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    dealt = rows.repartition(n, "pack", F.floor(F.col("offset") / CHUNK)).sortWithinPartitions("pack", "offset").select("pack", "offset", "object_id")
    return dealt.mapInArrow(run, schema)


def _entry(file, offset: int) -> tuple[int, int | None, str | None, bytes]:
    """(kind, base, base_id, inflated data) of the entry at an offset."""
    file.seek(offset)
    data = file.read(1 << 12)
    kind, size, at = entry_head(data)
    base = base_id = None
    if kind == _NEAR:
        distance, at = near_distance(data, at)
        base = offset - distance
    elif kind == _BY_ID:
        base_id, at = data[at : at + 20].hex(), at + 20
    inflate, out = zlib.decompressobj(), []
    data = data[at:]
    while data:
        out.append(inflate.decompress(data))
        if inflate.eof:
            break
        data = file.read(1 << 18)
    whole = b"".join(out)
    if not inflate.eof or len(whole) != size:
        raise ValueError(f"a damaged entry at {offset}")
    return kind, base, base_id, whole


def _loose(spark: SparkSession, path: str) -> DataFrame:
    """(object_id, kind, content) of loose objects."""
    import pyarrow.fs as pafs

    fs, base = filesystem(path)
    folders = [f.path for f in fs.get_file_info(pafs.FileSelector(f"{base}/objects")) if len(f.base_name) == 2 and f.type == pafs.FileType.Directory]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = filesystem(path)[0]
        for b in batches:
            for folder in b.column(0).to_pylist():
                for f in own.get_file_info(pafs.FileSelector(folder)):
                    if len(f.base_name) == 38:
                        with own.open_input_stream(f.path) as s:
                            head, _, content = zlib.decompress(s.read()).partition(b"\0")
                        yield pa.RecordBatch.from_arrays([pa.array([folder[-2:] + f.base_name]), pa.array([head.split()[0].decode()]), pa.array([content], pa.binary())], names=["object_id", "kind", "content"])

    rows = spark.createDataFrame([(f,) for f in folders], "folder string")
    return rows.repartition(max(1, min(256, len(folders)))).mapInArrow(run, "object_id string, kind string, content binary")


def _applied(rows: DataFrame) -> DataFrame:
    """(pack, offset, object_id, kind, content) of differences that have met their base's content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            content = [apply_difference(x, d) for x, d in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(content, pa.binary())], names=["pack", "offset", "object_id", "kind", "content"])

    return rows.select("pack", "offset", "object_id", "kind", "content", "data").mapInArrow(run, "pack string, offset long, object_id string, kind int, content binary")


def objects(spark: SparkSession, path: str) -> DataFrame:
    """(repo, object_id, kind, size, content) of all objects of the repository at path (the folder that holds objects/),
    each id once."""
    packs = _listed(path, ".pack")
    rows = stored(index_rows(spark, path), "index")
    n = max(1, sum(-(-size // CHUNK) for _, size in packs))
    found = stored(_entries(path, rows, n), "entries")
    known = found.filter(F.col("kind") < _NEAR).select("pack", "offset", "object_id", "kind", F.col("data").alias("content"))
    places = rows.select("pack", F.col("object_id").alias("base_id"), F.col("offset").alias("at"))
    late = found.filter(F.col("kind") >= _NEAR).select("pack", "offset", "object_id", "base", "base_id", "data")
    late = stored(late.join(places, ["pack", "base_id"], "left").select("pack", "offset", "object_id", F.coalesce("base", "at").alias("base"), "data"), "late")
    out, waiting = known, late.count()
    while waiting:
        bases = known.select("pack", F.col("offset").alias("base"), "kind", "content")
        known = stored(_applied(late.join(bases, ["pack", "base"])), "made")
        made = known.count()
        if not made:
            raise ValueError(f"{waiting} entries have no base")
        out, waiting = out.unionByName(known), waiting - made
        if waiting:
            late = stored(late.join(known.select("pack", "offset"), ["pack", "offset"], "left_anti"), "late")
    names = F.create_map(*(F.lit(x) for pair in _KIND_OF.items() for x in pair))
    whole = out.select("object_id", names[F.col("kind")].alias("kind"), "content").unionByName(_loose(spark, path)).dropDuplicates(["object_id"])
    size = F.octet_length("content")
    sha = F.sha1(F.concat(F.concat_ws(" ", "kind", size.cast("string")).cast("binary"), F.lit(b"\0"), F.col("content")))
    checked = F.when(sha == F.col("object_id"), F.col("object_id")).otherwise(F.raise_error(F.concat(F.lit("a damaged object: "), F.col("object_id"))))
    return whole.select(F.lit(path).alias("repo"), checked.alias("object_id"), "kind", size.cast("long").alias("size"), "content")


def object_ids(spark: SparkSession, path: str) -> DataFrame:
    """(object_id) of what the repository has."""
    return index_rows(spark, path).select("object_id").union(_loose(spark, path).select("object_id")).distinct()


# ---- writing ----


class PackBuilder:
    """Objects one by one to a pack and its index."""

    def __init__(self) -> None:
        self.parts: list[bytes] = []
        self.rows: list[tuple[bytes, int, int]] = []
        self.size = 12

    def add(self, object_id: str, kind: str, content: bytes) -> None:
        entry = packed(kind, content)
        self.rows.append((bytes.fromhex(object_id), zlib.crc32(entry), self.size))
        self.parts.append(entry)
        self.size += len(entry)

    def finish(self) -> tuple[str, bytes, bytes]:
        """(name, pack, index)."""
        body = b"PACK" + struct.pack(">II", 2, len(self.rows)) + b"".join(self.parts)
        pack = body + hashlib.sha1(body).digest()
        rows = sorted(self.rows)
        ids = [r[0] for r in rows]
        fanout, at = [], 0
        for first in range(256):
            while at < len(ids) and ids[at][0] <= first:
                at += 1
            fanout.append(at)
        short = [o if o < 1 << 31 else None for *_, o in rows]
        far = [o for *_, o in rows if o >= 1 << 31]
        places = iter(range(len(far)))
        index = b"\377tOc\0\0\0\2" + struct.pack(">256I", *fanout) + b"".join(ids) + struct.pack(f">{len(rows)}I", *(r[1] for r in rows))
        index += struct.pack(f">{len(rows)}I", *(1 << 31 | next(places) if o is None else o for o in short)) + struct.pack(f">{len(far)}Q", *far) + pack[-20:]
        return hashlib.sha1(b"".join(ids)).hexdigest(), pack, index + hashlib.sha1(index).digest()


class GitPacks(DataSource):
    """Writes (object_id, kind, content) as packs of the repository at path."""

    @classmethod
    def name(cls) -> str:
        return "git_packs"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _PackWriter(self.options["path"], int(self.options.get("packbytes", str(PACK_BYTES))))


class _Packs(WriterCommitMessage):
    def __init__(self, names: list[str]) -> None:
        self.names = names


class _PackWriter(DataSourceArrowWriter):
    def __init__(self, path: str, most: int) -> None:
        self.path, self.most = path, most
        self.base = filesystem(path)[1]
        self.staged = f"{self.base}/staged-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, builder, names = filesystem(self.path)[0], PackBuilder(), []
        own = f"{self.staged}/{uuid.uuid4().hex}"  # a second try of a task has a folder of its own

        def flush() -> None:
            name, *both = builder.finish()
            fs.create_dir(own, recursive=True)
            for data, suffix in zip(both, ("pack", "idx"), strict=True):
                with fs.open_output_stream(f"{own}/pack-{name}.{suffix}") as f:
                    f.write(data)
            names.append(f"{own}/pack-{name}")

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("object_id", "kind", "content")), strict=True):
                builder.add(*row)
                if builder.size >= self.most:
                    flush()
                    builder = PackBuilder()
        if builder.rows:
            flush()
        return _Packs(names)

    def commit(self, messages) -> None:
        import pyarrow.fs as pafs

        fs = filesystem(self.path)[0]
        folder = f"{self.base}/objects/pack"
        fs.create_dir(folder, recursive=True)
        for suffix in ("pack", "idx"):  # readers look for indexes, so these come last
            for name in (n for m in messages for n in m.names):
                target = f"{folder}/{name.rpartition('/')[2]}.{suffix}"
                if fs.get_file_info(target).type == pafs.FileType.NotFound:
                    fs.move(f"{name}.{suffix}", target)
        self.abort(messages)

    def abort(self, messages) -> None:
        import pyarrow.fs as pafs

        fs = filesystem(self.path)[0]
        if fs.get_file_info(self.staged).type != pafs.FileType.NotFound:
            fs.delete_dir(self.staged)


def create(path: str, head: str = "refs/heads/main") -> None:
    """A bare repository at path, if there is none."""
    import pyarrow.fs as pafs

    fs, base = filesystem(path)
    if fs.get_file_info(f"{base}/HEAD").type != pafs.FileType.NotFound:
        return
    for folder in ("objects/pack", "objects/info", "refs/heads", "refs/tags"):
        fs.create_dir(f"{base}/{folder}", recursive=True)
    for name, text in (("config", "[core]\n\trepositoryformatversion = 0\n\tfilemode = true\n\tbare = true\n"), ("HEAD", f"ref: {head}\n")):
        with fs.open_output_stream(f"{base}/{name}") as f:
            f.write(text.encode())


def write_objects(found: DataFrame, path: str, pack_bytes: int = PACK_BYTES) -> None:
    """Adds the objects (object_id, kind, content) that the repository at path does not have; ids name contents, so a run
    that died can be repeated."""
    spark = found.sparkSession
    create(path)
    new = found.select("object_id", "kind", "content").dropDuplicates(["object_id"]).join(object_ids(spark, path), "object_id", "left_anti")
    spark.dataSource.register(GitPacks)
    new.write.format("git_packs").option("path", path).option("packbytes", pack_bytes).mode("append").save()


def write_refs(refs: DataFrame, path: str) -> DataFrame:
    """Writes (ref_name, new_target, symref) as files of the repository; (file_path, status)."""
    from ..store import write_files

    line = F.when(F.col("symref").isNotNull(), F.concat(F.lit("ref: "), "symref")).otherwise(F.col("new_target"))
    return write_files(refs.select(F.col("ref_name").alias("file_path"), F.concat(line, F.lit("\n")).alias("content")), path, overwrite=True)
