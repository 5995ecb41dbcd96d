"""Tables and files in folders that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only a local session may leave it unset: no folder of one machine would do on a
    cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tokentrail-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """df, written once and read again; its files go when the session ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    p, fs = _path(spark, path)
    fs.deleteOnExit(p)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def publish(spark: SparkSession, tables: dict[str, DataFrame], base: str) -> int:
    """Writes a set of tables as one new version under base, or none of them: all are complete before one rename makes
    the version visible. Returns its number."""
    staged = f"{base}/_staged-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{staged}/{name}")
    version = latest(spark, base) + 1
    source, fs = _path(spark, staged)
    target, _ = _path(spark, f"{base}/version-{version:08d}")
    if fs.exists(target) or not fs.rename(source, target):
        fs.delete(source, True)
        raise ValueError(f"version {version} was published meanwhile")
    return version


def latest(spark: SparkSession, base: str) -> int:
    """The number of the newest version under base, 0 without any."""
    p, fs = _path(spark, base)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return max((int(n[8:]) for n in names if n.startswith("version-")), default=0)


def published(spark: SparkSession, base: str, name: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(f"{base}/version-{version or latest(spark, base):08d}/{name}")


def filesystem(path: str):
    """(pyarrow file system, path in it)."""
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def write_files(rows: DataFrame, root: str, suffix: str = "", overwrite: bool = False) -> DataFrame:
    """Writes (file_path, content) rows as files root/file_path + suffix and gives (file_path, status): written, or done
    if the file is there and overwrite is not set. A file appears whole: it is moved to its name from one beside it. Rows
    that have a status already keep it, and no file is written for them.
    The result is stored, so the files are written once and when this returns."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        fs, base = filesystem(root)
        made = set()  # folders are made once a task
        for b in batches:
            status = []
            for path, content, known in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if known is not None:
                    status.append(known)
                    continue
                target = f"{base}/{path}{suffix}"
                if not overwrite and fs.get_file_info(target).type == pafs.FileType.File:
                    status.append("done")
                    continue
                folder = target.rpartition("/")[0]
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                part = f"{target}.{uuid.uuid4().hex}.part"
                with fs.open_output_stream(part) as out:
                    out.write(content or b"")
                fs.move(part, target)
                status.append("written")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(status, pa.string())], names=["file_path", "status"])

    known = F.col("status") if "status" in rows.columns else F.lit(None).cast("string").alias("status")
    return stored(rows.select("file_path", F.col("content").cast("binary"), known).mapInArrow(run, "file_path string, status string"), "files")


#: Files and bytes that one task reads, about, and bytes of contents that are held at once.
TASK_FILES, TASK_BYTES, HELD_BYTES = 4096, 1 << 27, 1 << 22


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """(file_path, size) of all files under root, hidden ones left out as Spark does. Tasks list a level of folders at a time:
    the driver never holds the names."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        fs, base = filesystem(root)
        for b in batches:
            for folder in b.column(0).to_pylist():
                found = fs.get_file_info(pafs.FileSelector(f"{base}/{folder}" if folder else base))
                names = [f for f in found if not (f.base_name.startswith(".") or f.base_name.startswith("_") and "=" not in f.base_name or f.base_name.endswith("._COPYING_"))]
                for i in range(0, len(names), 10_000):
                    part = names[i : i + 10_000]
                    columns = [[f"{folder}/{f.base_name}".lstrip("/") for f in part], [None if f.type == pafs.FileType.Directory else f.size for f in part]]
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64())], names=["file_path", "size"])

    schema = "file_path string, size long"
    folders, files = spark.createDataFrame([("",)], "file_path string"), None
    while True:
        # folders are few beside their files, so a task each
        level = stored(folders.mapInArrow(run, schema), "listed")
        found = level.filter("size IS NOT NULL")
        files = found if files is None else files.unionByName(found)
        folders = level.filter("size IS NULL").select("file_path")
        n = folders.count()
        if not n:
            return files
        folders = folders.repartition(min(n, 10_000), "file_path")


def read_files(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """(file_path, content) of the files under root whose names end in suffix, which file_path leaves out. Many small files
    are read by one task; a partition a few of them would cost more than their bytes."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(root)
        of = lambda rows: pa.RecordBatch.from_arrays([pa.array([p.removesuffix(suffix) for p, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.binary())], names=["file_path", "content"])
        for b in batches:
            rows, size = [], 0
            for path in b.column(0).to_pylist():
                with fs.open_input_stream(f"{base}/{path}") as f:
                    rows.append((path, f.read()))
                size += len(rows[-1][1])
                if size >= HELD_BYTES:
                    yield of(rows)
                    rows, size = [], 0
            if rows:
                yield of(rows)

    files = _listed(spark, root).filter(F.col("file_path").endswith(suffix))
    n, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = max(1, -(-n // TASK_FILES), -(-size // TASK_BYTES), min(n, spark.sparkContext.defaultParallelism))
    return files.select("file_path").repartition(tasks, "file_path").mapInArrow(run, "file_path string, content binary")
