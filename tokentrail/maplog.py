"""Maps as a log of segments: a run appends its new rows, and what is there is not written again.

A manifest, one small file for each version, lists the segments of all maps; the newest one is the state. Segments are
Parquet folders. A version is there when its manifest is, which is created in one step and never over another; all
data are complete before that. Whoever loses a race for a number gets an error and tries again from the new state. So
readers see whole versions, and no folder is renamed, as object stores cannot do that in one step.

Segments of like size are merged as the log grows: a new segment swallows the ones before it until these are GROWTH times
as large as it is. Each row is so written again a number of times that grows with the logarithm of the map. Segments are
sorted by key, so lookups skip most row groups by their bounds.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from .store import filesystem

GROWTH = 2
#: The keys of the maps of a rewrite.
KEYS = {"blob_map": ["orig_blob", "path"], "tree_map": ["orig_tree"], "commit_map": ["repo", "orig_commit"]}


class Conflict(Exception):
    """Another writer has published this version."""


def _manifests(base: str) -> list[int]:
    import pyarrow.fs as pafs

    fs, root = filesystem(base)
    found = fs.get_file_info(pafs.FileSelector(f"{root}/manifests", allow_not_found=True))
    return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json"))


def manifest(base: str, version: int | None = None) -> dict:
    """{"version", "segments": {map: [[folder, rows], ...]}}, segments from the oldest."""
    known = _manifests(base)
    if not known:
        return {"version": 0, "segments": {}}
    fs, root = filesystem(base)
    with fs.open_input_stream(f"{root}/manifests/{version or known[-1]:012d}.json") as f:
        return json.loads(f.read())


def _create(spark: SparkSession, path: str, text: str) -> None:
    """A file that must not be there yet, whole or not at all."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(p.getParent())
    if path.startswith("/") or path.startswith("file:"):  # a local name is linked to the whole file, which fails if it is taken
        import os

        local = path.removeprefix("file://").removeprefix("file:")
        whole = f"{local}.{uuid.uuid4().hex}"
        with open(whole, "x") as f:
            f.write(text)
        try:
            os.link(whole, local)
        except FileExistsError:
            raise Conflict(path) from None
        finally:
            os.remove(whole)
        return
    try:
        out = fs.create(p, False)
    except Exception as e:
        if "FileAlreadyExists" in str(e) or "already exists" in str(e):
            raise Conflict(path) from None
        raise
    out.write(bytearray(text.encode()))
    out.close()


def read(spark: SparkSession, base: str, name: str, version: int | None = None) -> DataFrame | None:
    """A map as it is, or was at a version; None if it has no rows."""
    state = manifest(base, version)
    folders = [f"{base}/{folder}" for folder, _ in state["segments"].get(name, [])]
    return spark.read.parquet(*folders) if folders else None


def append(spark: SparkSession, base: str, tables: dict[str, DataFrame], keys: dict[str, list[str]] | None = None, growth: int = GROWTH) -> dict[str, int]:
    """Adds the rows whose keys the maps do not have, as one version: all maps or none. Returns the rows written of each map,
    with those written again by merging. Of rows with one key in a table any one is added."""
    state = manifest(base)
    segments = {n: list(s) for n, s in state["segments"].items()}
    written = {}
    for name, df in tables.items():
        key = (keys or KEYS)[name]
        new = df.dropDuplicates(key)
        old = read(spark, base, name, state["version"] or None)
        if old is not None:
            new = new.join(old.select(*key), key, "left_anti").select(*df.columns)
        folder = f"segments/{name}-{uuid.uuid4().hex}"
        _write(new, f"{base}/{folder}", key)
        rows = written[name] = spark.read.schema(df.schema).parquet(f"{base}/{folder}").count()
        if not rows:
            continue
        live = segments.setdefault(name, [])
        merged = [[folder, rows]]
        while live and live[-1][1] < growth * sum(r for _, r in merged):
            merged.insert(0, live.pop())
        if len(merged) > 1:
            folder, rows = f"segments/{name}-{uuid.uuid4().hex}", sum(r for _, r in merged)
            _write(spark.read.parquet(*(f"{base}/{f}" for f, _ in merged)), f"{base}/{folder}", key)
            written[name] += rows
        live.append([folder, rows])
    state = {"version": state["version"] + 1, "segments": segments}
    _create(spark, f"{base}/manifests/{state['version']:012d}.json", json.dumps(state))
    return written


def _write(df: DataFrame, path: str, key: list[str]) -> None:
    df.sortWithinPartitions(*key).write.option("compression", "zstd").parquet(path)


def vacuum(spark: SparkSession, base: str, keep: int = 1) -> int:
    """Removes the manifests before the newest `keep`, and segments that none of those left names: what merging has replaced
    and what failed runs have left. No writer may be at work. Returns how many segments went."""
    import pyarrow.fs as pafs

    fs, root = filesystem(base)
    versions = _manifests(base)
    left = versions[-keep:]
    named = {folder.rpartition("/")[2] for v in left for s in manifest(base, v)["segments"].values() for folder, _ in s}
    for v in versions[: len(versions) - len(left)]:
        fs.delete_file(f"{root}/manifests/{v:012d}.json")
    gone = [f for f in fs.get_file_info(pafs.FileSelector(f"{root}/segments", allow_not_found=True)) if f.base_name not in named]
    for f in gone:
        fs.delete_dir(f.path)
    return len(gone)
