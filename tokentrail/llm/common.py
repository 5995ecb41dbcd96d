"""Helpers shared by the training-text operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of bytes other than space and \t \n \v \f \r. bytes.split() cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; it goes when the session ends. Only a local session may
    leave spark.checkpoint.dir unset: on a cluster no folder of one machine would do."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tokentrail-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """df, written as Parquet in the shared folder and read again: it cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = path or work_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def drop_written(df: DataFrame) -> None:
    """Deletes the files of a table that written() gave and that nothing reads any more."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(df._written_to)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def fresh(columns: Iterable[str], name: str) -> str:
    """name, or a longer one, that none of the columns has in any case."""
    known = {c.lower() for c in columns}
    while name.lower() in known:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Texts are long: Spark's 10,000 rows a batch would hold tens of MB in each Python worker, or far more. The session
    keeps the smaller batches; they change no result."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 1024:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trim() -> None:
    """Gives unused memory back, as workers wait for other tasks; only glibc has this."""
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give:
        give(0)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that Python holds few texts at a time; unused memory goes back."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        pa.default_memory_pool().release_unused()
    trim()


def utf8(column: pa.Array) -> list[bytes]:
    """A string column as bytes; nulls are empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that scatters neighbouring values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def unmix64(x: np.ndarray) -> np.ndarray:
    """The inverse of mix64."""
    inverse = [np.uint64(pow(int(m), -1, 1 << 64)) for m in (_M1, _M2)]
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
        x = x * inverse[1]
        x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
        x = x * inverse[0]
        return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n values; none if there are fewer."""
    m = len(hashes) - n + 1
    if m <= 0:
        return hashes[:0]
    with np.errstate(over="ignore"):
        out = hashes[:m].copy()
        for i in range(1, n):
            out *= _MIX
            out += hashes[i : i + m]
    return mix64(out)


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """The sorted hashes of the distinct n-word shingles; a shorter text is one shingle, an empty one none."""
    words = text.split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(word_hashes(words), min(n, len(words))))


def ranges(df: DataFrame, column: str, n: int, repeats: bool = False) -> list:
    """At most n - 1 values of an integer column that cut its rows in n parts, in order; with repeats a value that takes
    the place of several stands as often. Only that column is read."""
    if n < 2:
        return []
    at = df.select(F.percentile_approx(column, [i / n for i in range(1, n)], 20_000)).first()[0]
    return sorted(at or []) if repeats else sorted(set(at or []))
