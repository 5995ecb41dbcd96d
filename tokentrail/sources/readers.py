"""Sources: git histories, SQLite files, blame files, sources and the provenance sidecar."""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Iterator
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text as fn
from ..operators.walk import decoded
from ..schema import PROVENANCE
from ..store import read_files
from . import git

GIT_LOG = "cid string, autname string, autemail string, autdate string, comname string, comemail string, comdate string, summary string, parents array<string>, log string, footers array<struct<key:string,value:string>>"


class GitLog(DataSource):
    """Commits of all refs of repositories on paths that executors see; one partition a repository, whose log streams.
    Dates are in the time zone of option zone, UTC if unset."""

    @classmethod
    def name(cls) -> str:
        return "git_log"

    def schema(self) -> str:
        return GIT_LOG

    def reader(self, schema) -> DataSourceReader:
        return _GitReader(self.options["path"].split(","), self.options.get("zone", "UTC"))


class _GitReader(DataSourceReader):
    def __init__(self, paths: list[str], zone: str) -> None:
        self.paths, self.zone = paths, zone

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        form = "%x1f".join(["%H", "%an", "%ae", "%at", "%cn", "%ce", "%ct", "%s", "%P", "%B", "%(trailers:only,unfold,separator=%x1e)"])
        zone = ZoneInfo(self.zone)
        date = lambda at: datetime.fromtimestamp(int(at), zone).strftime("%Y-%m-%d %H:%M:%S")
        for record in git.records(git.git(partition.value, "log", "--all", "-z", f"--format={form}"), b"\0"):
            f = record.decode("utf-8", "replace").split("\x1f")
            if len(f) == 11:
                trailers = [(k, v.strip()) for k, _, v in (t.partition(":") for t in f[10].split("\x1e") if ":" in t)]
                yield (*f[:3], date(f[3]), *f[4:6], date(f[6]), f[7], f[8].split(), f[9], trailers)


def git_history(spark: SparkSession, path: str, zone: str = "UTC") -> dict[str, DataFrame]:
    """commits, parents, logs and footers of a repository; one trailing space of a name goes."""
    spark.dataSource.register(GitLog)
    g = spark.read.format("git_log").option("path", path).option("zone", zone).load()
    name = lambda c: fn.without_last_space(F.col(c)).alias(c)
    return {
        "commits": g.select("cid", name("autname"), "autemail", "autdate", name("comname"), "comemail", "comdate", "summary", (F.size("parents") > 1).alias("ismerge")),
        "parents": g.select("cid", F.posexplode("parents").alias("idx", "parent")),
        "logs": g.select("cid", "log"),
        "footers": g.select("cid", F.posexplode("footers").alias("idx", "f")).select("cid", "idx", "f.key", "f.value"),
    }


class SqliteTable(DataSource):
    """A table of a SQLite file, cut by rowid into numPartitions ranges."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def _columns(self) -> list[tuple[str, str]]:
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            found = db.execute(f"PRAGMA table_info({_quoted(self.options['dbtable'])})").fetchall()
        if not found:
            raise ValueError(f"{self.options['path']} has no table {self.options['dbtable']}")
        return [(r[1], r[2].upper()) for r in found]

    def schema(self) -> str:
        kind = lambda t: "long" if "INT" in t else "double" if any(x in t for x in ("REAL", "FLOA", "DOUB")) else "boolean" if "BOOL" in t else "string"
        return ", ".join(f"`{n}` {kind(t)}" for n, t in self._columns())

    def reader(self, schema) -> DataSourceReader:
        return _SqliteReader(self.options["path"], self.options["dbtable"], int(self.options.get("numpartitions", "1")), [f.dataType.typeName() for f in schema.fields])


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class _SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str, n: int, kinds: list[str]) -> None:
        self.path, self.table, self.n, self.kinds = path, table, n, kinds

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self) -> list[InputPartition]:
        """Ranges of rowid, so that each reads its own pages; a table without rowid is one."""
        try:
            with self._open() as db:
                low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}").fetchone()
        except sqlite3.OperationalError:
            return [InputPartition(None)]
        if low is None:
            return []
        edges = [low + (high + 1 - low) * i // self.n for i in range(self.n + 1)]
        return [InputPartition((a, b)) for a, b in zip(edges[:-1], edges[1:], strict=True) if b > a]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        make = [(lambda x: None if x is None else bool(x)) if k == "boolean" else (lambda x: None if x is None else str(x)) if k == "string" else (lambda x: x) for k in self.kinds]
        where, args = ("", ()) if partition.value is None else ("WHERE rowid >= ? AND rowid < ?", partition.value)
        with self._open() as db:
            for row in db.execute(f"SELECT * FROM {_quoted(self.table)} {where}", args):
                yield tuple(f(x) for f, x in zip(make, row, strict=True))


def sqlite_table(spark: SparkSession, path: str, table: str, n: int = 1) -> DataFrame:
    with open(path, "rb") as f:
        if f.read(16) not in (b"SQLite format 3\0", b""):
            raise ValueError(f"{path} is not a SQLite file")
    spark.dataSource.register(SqliteTable)
    return spark.read.format("sqlite_table").option("path", path).option("dbtable", table).option("numPartitions", n).load()


def source_files(spark: SparkSession, root: str) -> DataFrame:
    """(file_path, text, had_bom, repairable) of all files under root; repairable: strict UTF-8, no mark, not .rs."""
    b = read_files(spark, root)
    bom = F.substring("content", 1, 3) == F.lit(b"\xef\xbb\xbf")
    return b.select("file_path", decoded(F.col("content")).alias("text"), bom.alias("had_bom"), (~bom & F.is_valid_utf8(F.col("content").cast("string")) & ~F.lower("file_path").endswith(".rs")).alias("repairable"))


def blame_files(spark: SparkSession, root: str) -> DataFrame:
    """(file_path, line_no, line) of the .blame files under root."""
    lines = F.split(F.regexp_replace(decoded(F.col("content")), r"\n\z", ""), "\n")
    return read_files(spark, root, ".blame").select("file_path", F.posexplode(lines).alias("line_no", "line"))


def provenance(path: str | None, project: str) -> dict[str, str]:
    """The sidecar's fields of a project. Without a sidecar all are blank; a project it lacks is an error."""
    if path is None:
        return dict.fromkeys(PROVENANCE, "")
    with open(path, encoding="utf-8") as f:
        known = json.load(f)
    if project not in known:
        raise KeyError(f"{path} has no project {project}")
    return {p: str(known[project].get(p) or "") for p in PROVENANCE}
