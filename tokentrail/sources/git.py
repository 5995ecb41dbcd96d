"""A repository's objects, refs, tracked files and blame as tables. Repositories are on paths that all executors see."""

from __future__ import annotations

import subprocess
import threading
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ENVIRONMENT = {"TZ": "UTC", "LC_ALL": "C.UTF-8", "PATH": "/usr/bin:/bin:/usr/local/bin", "GIT_CONFIG_COUNT": "1", "GIT_CONFIG_KEY_0": "safe.directory", "GIT_CONFIG_VALUE_0": "*"}
TREE, GITLINK, REGULAR = "40000", "160000", ("100644", "100755")


def git(repo: str, *args: str) -> subprocess.Popen:
    return subprocess.Popen(["git", "-C", repo, *args], stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.PIPE, env=ENVIRONMENT)


def records(process: subprocess.Popen, end: bytes) -> Iterator[bytes]:
    """The output of a process in records, as they come; a failure raises after the last one. What it says of errors is
    read beside, so that it never waits for a reader."""
    said: list[bytes] = []
    listener = threading.Thread(target=lambda: said.append(process.stderr.read()), daemon=True)
    listener.start()
    rest = b""
    while chunk := process.stdout.read1(1 << 20):
        *found, rest = (rest + chunk).split(end)
        yield from found
    if rest:
        yield rest
    listener.join()
    if process.wait():
        raise OSError(f"git failed with {process.returncode}: {b''.join(said).decode('utf-8', 'replace').strip()}")


class GitObjects(DataSource):
    """(repo, object_id, kind, size, content) of all objects; each repository's are dealt to `shards` tasks by id.
    Content over `limit` bytes is null."""

    @classmethod
    def name(cls) -> str:
        return "git_objects"

    def schema(self) -> str:
        return "repo string, object_id string, kind string, size long, content binary"

    def reader(self, schema) -> DataSourceReader:
        return _ObjectReader(self.options)


class _ObjectReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.paths, self.shards = options["path"].split(","), int(options.get("shards", "8"))
        self.kinds, self.limit = set(options.get("kinds", "blob,tree,commit,tag").split(",")), int(options.get("limit", str(50 << 20)))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition((p, k)) for p in self.paths for k in range(self.shards)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        repo, shard = partition.value
        listed = git(repo, "cat-file", "--batch-all-objects", "--unordered", "--batch-check=%(objectname) %(objecttype) %(objectsize)")
        large, small = [], []
        for line in records(listed, b"\n"):
            oid, kind, size = line.decode().split()
            if int(oid[:4], 16) % self.shards == shard and kind in self.kinds:
                (large if int(size) > self.limit else small).append((oid, kind, int(size)))
        yield from ((repo, *x, None) for x in large)
        batch = git(repo, "cat-file", "--batch")

        def ask() -> None:
            for oid, _, _ in small:
                batch.stdin.write(oid.encode() + b"\n")
            batch.stdin.close()

        threading.Thread(target=ask, daemon=True).start()
        for oid, kind, size in small:
            head = batch.stdout.readline().split()
            if head[:1] != [oid.encode()]:
                raise OSError(f"git lost {oid}")
            yield repo, oid, kind, size, batch.stdout.read(size)
            batch.stdout.read(1)
        batch.wait()


class GitRefs(DataSource):
    """(repo, ref_name, object_id, symref) of all refs and HEAD; symref is the ref that a symbolic one names."""

    @classmethod
    def name(cls) -> str:
        return "git_refs"

    def schema(self) -> str:
        return "repo string, ref_name string, object_id string, symref string"

    def reader(self, schema) -> DataSourceReader:
        return _RefReader(self.options["path"].split(","))


class _RefReader(DataSourceReader):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        repo = partition.value
        for line in records(git(repo, "for-each-ref", "--format=%(refname)%09%(objectname)%09%(symref)"), b"\n"):
            name, oid, symref = line.decode("utf-8", "replace").split("\t")
            yield repo, name, oid, symref or None
        head = git(repo, "symbolic-ref", "-q", "HEAD").communicate()[0].decode().strip()
        yield repo, "HEAD", None, head or None


def objects(spark: SparkSession, path: str, kinds: str = "blob,tree,commit,tag", limit: int = 50 << 20, shards: int = 8) -> DataFrame:
    spark.dataSource.register(GitObjects)
    return spark.read.format("git_objects").option("path", path).option("kinds", kinds).option("limit", limit).option("shards", shards).load()


def refs(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(GitRefs)
    return spark.read.format("git_refs").option("path", path).load()


def parse_tree(content: bytes) -> list[tuple[str, bytes, str]]:
    """(mode, name, object id) of each entry."""
    out, at = [], 0
    while at < len(content):
        space, end = content.index(b" ", at), content.index(b"\0", at)
        out.append((content[at:space].decode(), content[space + 1 : end], content[end + 1 : end + 21].hex()))
        at = end + 21
    return out


def parse_headers(content: bytes) -> tuple[dict[str, list[bytes]], bytes]:
    """Header lines by name, lines that go on joined, and the message."""
    head, _, message = content.partition(b"\n\n")
    found: dict[str, list[bytes]] = {}
    last = ""
    for line in head.split(b"\n"):
        if line.startswith(b" ") and last:
            found[last][-1] += b"\n" + line[1:]
        else:
            name, _, value = line.partition(b" ")
            last = name.decode("latin-1")
            found.setdefault(last, []).append(value)
    return found, message


def _parsed(df: DataFrame, parse, schema: str) -> DataFrame:
    """One row or more for each (repo, object_id, content) by parse(id, content)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    full = f"repo string, {schema}"
    df.sparkSession  # noqa: B018
    kinds = to_arrow_schema(_parse_datatype_string(full))

    def run(batches):
        for b in batches:
            rows = [(repo, *row) for repo, oid, content in zip(*(c.to_pylist() for c in b.columns), strict=True) for row in parse(oid, content)]
            columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, kinds, strict=True)], names=kinds.names)

    return df.select("repo", "object_id", "content").mapInArrow(run, full)


def tree_entries(found: DataFrame) -> DataFrame:
    """(repo, tree, name binary, mode, object_id): the entries of all tree objects."""
    return _parsed(found.filter("kind = 'tree'"), lambda oid, c: [(oid, name, mode, entry) for mode, name, entry in parse_tree(c)], "tree string, name binary, mode string, object_id string")


def commit_objects(found: DataFrame) -> DataFrame:
    """(repo, cid, tree, parents, author, committer, encoding, message): raw bytes but for ids."""

    def parse(oid: str, content: bytes) -> list[tuple]:
        head, message = parse_headers(content)
        one = lambda name: head.get(name, [None])[0]
        return [(oid, one("tree").decode(), [p.decode() for p in head.get("parent", [])], one("author"), one("committer"), one("encoding"), message)]

    return _parsed(found.filter("kind = 'commit'"), parse, "cid string, tree string, parents array<string>, author binary, committer binary, encoding binary, message binary")


def tag_objects(found: DataFrame) -> DataFrame:
    """(repo, tag_id, target, target_kind, tag, tagger, message)."""

    def parse(oid: str, content: bytes) -> list[tuple]:
        head, message = parse_headers(content)
        one = lambda name: head.get(name, [None])[0]
        return [(oid, one("object").decode(), one("type").decode(), one("tag"), one("tagger"), message)]

    return _parsed(found.filter("kind = 'tag'"), parse, "tag_id string, target string, target_kind string, tag binary, tagger binary, message binary")


def recursive_entries(entries: DataFrame, roots: DataFrame, store, rounds: int = 512) -> DataFrame:
    """(repo, root, path, mode, object_id) of all that is below each root tree (repo, root), level by level. store()
    writes a level where all executors read it."""
    level = roots.select("repo", "root", F.col("root").alias("tree"), F.lit("").alias("prefix"))
    out = None
    for _ in range(rounds):
        found = store(level.join(entries, ["repo", "tree"]).select("repo", "root", F.concat("prefix", F.col("name").cast("string")).alias("path"), "mode", "object_id"))
        out = found if out is None else out.unionByName(found)
        level = found.filter(F.col("mode") == TREE).select("repo", "root", F.col("object_id").alias("tree"), F.concat("path", F.lit("/")).alias("prefix"))
        if level.isEmpty():
            return out
    raise ValueError("trees are nested too deeply")


def tracked_files(entries: DataFrame, roots: DataFrame, mask: str, store) -> DataFrame:
    """(repo, root, path, object_id) of the regular files of a root whose path matches the mask."""
    return recursive_entries(entries, roots, store).filter(F.col("mode").isin(*REGULAR) & F.col("path").rlike(mask)).select("repo", "root", "path", "object_id")
