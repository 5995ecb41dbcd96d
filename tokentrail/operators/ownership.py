"""Blame as tables: who wrote each line of each version of a file, over histories with merges and renames.

1. A file's content at a commit is a version of its own if no parent has the same content there; else it stands for the
   version of the first such parent, which is found by doubling pointers.
2. An edge goes from a version to the files that its commit's parents have of the name. A file that no parent has may
   come from one that is gone: with the same content, or with at least half of the lines that only these two have.
3. Lines of the two ends of an edge are aligned once for each pair of contents: what both begin and end with, then lines
   that are unique in both, in the longest order that rises, then the same between them; where no line is unique, the
   longest run around the rarest one.
4. A line points to its place in the first parent that has it, and belongs to the commit where the pointers end. A task
   follows those of a file through the versions that it holds at once, a bounded number of lines; what leads on from there,
   as at renames and in very long files, is followed by doubling, so rounds grow with the logarithm of a history's length.

Pointers are arrays, a row for the lines of a version that lead to one other; lines are a row each in the result only.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import stored

#: The share of their own lines that a file and its new name have in common.
ALIKE = 0.5


# ---- versions ----


def followed(links: DataFrame, keys: list[str]) -> DataFrame:
    """The ends of pointers: links has the columns keys, and to_<key> for each of them. What nothing points on from is an
    end. Pointers may not go in a circle."""
    source, target = keys, [f"to_{k}" for k in keys]
    while True:
        onward = links.select(*(F.col(s).alias(t) for s, t in zip(source, target, strict=True)), *(F.col(t).alias(f"on_{t}") for t in target), F.lit(True).alias("moved"))
        links = links.join(onward, target, "left")
        links = stored(links.select(*source, *(F.coalesce(f"on_{t}", t).alias(t) for t in target), F.coalesce("moved", F.lit(False)).alias("moved")), "links")
        if links.filter("moved").isEmpty():
            return links.drop("moved")
        links = links.drop("moved")


def nearest(files: DataFrame, parents: DataFrame) -> DataFrame:
    """(cid, path, blob, idx, parent, from_blob): each file at each commit with each parent, and what the parent has under its
    name, if anything. files: (cid, path, blob) at all commits, parents: (cid, idx, parent)."""
    before = files.select(F.col("cid").alias("parent"), "path", F.col("blob").alias("from_blob"))
    rows = files.join(parents, "cid", "left").join(before, ["parent", "path"], "left")
    return stored(rows.select("cid", "path", "blob", "idx", "parent", "from_blob"), "nearest")


def unchanged(near: DataFrame) -> DataFrame:
    """(cid, path, to_cid) of the files that stand for the version of another commit."""
    same = near.filter("blob = from_blob").groupBy("cid", "path").agg(F.min_by("parent", "idx").alias("to_cid"))
    return followed(same.select("cid", "path", "to_cid", F.col("path").alias("to_path")), ["cid", "path"]).drop("to_path")


def versions(files: DataFrame, ends: DataFrame) -> DataFrame:
    """(cid, path, blob, version) of all files at all commits (cid, path, blob): version is the commit whose content it is.
    ends: as unchanged gives them."""
    return files.join(ends, ["cid", "path"], "left").select("cid", "path", "blob", F.coalesce("to_cid", "cid").alias("version"))


def edges(near: DataFrame, ends: DataFrame, files: DataFrame, lines: DataFrame) -> DataFrame:
    """(cid, path, idx, from_cid, from_path, blob, from_blob) from versions to the files that their commit's parents have, of
    their own name or of the name that they had. Where a parent has none, idx is -1 and from_blob the version's own. Ends of
    edges may stand for the version of another commit. lines: (blob, lines)."""
    own = near.join(ends, ["cid", "path"], "left_anti")
    there = F.col("from_blob").isNotNull()
    of = lambda c, x: F.when(there, F.col(x)).alias(c)
    named = own.select("cid", "path", F.when(there, F.col("idx")).otherwise(-1).alias("idx"), of("from_cid", "parent"), of("from_path", "path"), "blob", F.coalesce("from_blob", "blob").alias("from_blob"))
    if near.filter("parent IS NOT NULL AND from_blob IS NULL").isEmpty():
        return named
    added = own.filter("parent IS NOT NULL AND from_blob IS NULL").join(near.filter(there).select("cid", "path"), ["cid", "path"], "left_anti")
    added = stored(added.select("cid", "path", "blob", "idx", "parent"), "added")
    before = files.select(F.col("cid").alias("parent"), F.col("path").alias("from_path"), F.col("cid").alias("from_cid"), F.col("blob").alias("from_blob"))
    gone = stored(added.select("cid", "idx", "parent").distinct().join(before, "parent").drop("parent"), "before")
    if gone.isEmpty():
        return named
    gone = stored(gone.join(files.select("cid", F.col("path").alias("from_path")), ["cid", "from_path"], "left_anti"), "gone")
    added = added.select("cid", "path", "blob").distinct()
    exact = added.join(gone.withColumn("blob", F.col("from_blob")), ["cid", "blob"]).groupBy("cid", "path", "blob", "idx").agg(F.min(F.struct("from_path", "from_cid", "from_blob")).alias("f"))
    exact = stored(exact.select("cid", "path", "idx", "f.from_cid", "f.from_path", "blob", "f.from_blob"), "exact")
    rest = added.join(exact.select("cid", "path"), ["cid", "path"], "left_anti")
    return named.unionByName(exact).unionByName(_alike(rest, gone, lines))


def _alike(added: DataFrame, gone: DataFrame, lines: DataFrame) -> DataFrame:
    """Edges of renames with changes. Lines are counted that stand in one file only of each side, so that each meets one
    other at most, however many files a commit moves."""
    line = F.explode(F.array_distinct(F.filter("lines", lambda x: x.rlike(r"\w")))).alias("line")
    kept = lambda side, keys, who: side.join(lines, "blob").select(*keys, *who, line).groupBy(*keys, "line").agg(F.count(F.lit(1)).alias("n"), *(F.min(c).alias(c) for c in who)).filter("n = 1").drop("n")
    new = stored(kept(added, ["cid"], ["path", "blob"]), "new")
    old = stored(kept(gone.withColumn("blob", F.col("from_blob")), ["cid", "idx"], ["from_path", "from_cid", "from_blob"]), "old")
    met = new.join(old, ["cid", "line"]).groupBy("cid", "path", "blob", "idx", "from_path", "from_cid", "from_blob").agg(F.count(F.lit(1)).alias("common"))
    met = met.join(new.groupBy("cid", "path").agg(F.count(F.lit(1)).alias("a")), ["cid", "path"]).join(old.groupBy("cid", "idx", "from_path").agg(F.count(F.lit(1)).alias("b")), ["cid", "idx", "from_path"])
    good = met.filter(F.col("common") >= ALIKE * F.greatest("a", "b")).groupBy("cid", "path", "blob", "idx").agg(F.min(F.struct((-F.col("common")).alias("minus"), "from_path", "from_cid", "from_blob")).alias("f"))
    return good.select("cid", "path", "idx", "f.from_cid", "f.from_path", "blob", "f.from_blob")


# ---- lines ----


def _rising(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of (i, j) pairs, in order of i, whose j rise."""
    ends, at, back = [], [], [-1] * len(places)
    for k, (_, j) in enumerate(places):
        n = bisect_left(ends, j)
        if n == len(ends):
            ends.append(j)
            at.append(k)
        else:
            ends[n], at[n] = j, k
        back[k] = at[n - 1] if n else -1
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(places[k])
        k = back[k]
    return out[::-1]


def aligned_lines(old: list[str], new: list[str]) -> list[int]:
    """For each line of new its place in old, or -1; places rise."""
    out = [-1] * len(new)
    parts = [(0, len(old), 0, len(new))]
    while parts:
        a, b, c, d = parts.pop()
        while a < b and c < d and old[a] == new[c]:
            out[c] = a
            a, c = a + 1, c + 1
        while a < b and c < d and old[b - 1] == new[d - 1]:
            b, d = b - 1, d - 1
            out[d] = b
        if a == b or c == d:
            continue
        left, right = Counter(old[a:b]), Counter(new[c:d])
        where = {x: i for i, x in enumerate(old[a:b], a) if left[x] == 1 == right.get(x)}
        anchors = _rising([(j, where[x]) for j, x in enumerate(new[c:d], c) if x in where])
        if anchors:
            for j, i in anchors:
                out[j] = i
            bounds = [(a - 1, c - 1), *((i, j) for j, i in anchors), (b, d)]
            parts += [(i + 1, i2, j + 1, j2) for (i, j), (i2, j2) in zip(bounds, bounds[1:], strict=False)]
            continue
        common = [x for x in right if x in left]
        if not common:
            continue
        rarest = min(common, key=lambda x: (left[x] * right[x], new.index(x, c, d)))
        j, best = new.index(rarest, c, d), (0, 0, 0)
        for i in (i for i in range(a, b) if old[i] == rarest):
            lo = hi = 0
            while i - lo - 1 >= a and j - lo - 1 >= c and old[i - lo - 1] == new[j - lo - 1]:
                lo += 1
            while i + hi < b and j + hi < d and old[i + hi] == new[j + hi]:
                hi += 1
            best = max(best, (lo + hi, -(i - lo), -(j - lo)))
        n, i, j = best[0], -best[1], -best[2]
        out[j : j + n] = range(i, i + n)
        parts += [(a, i, c, j), (i + n, b, j + n, d)]
    return out


def alignments(found: DataFrame, lines: DataFrame) -> DataFrame:
    """(cid, path, idx, from_cid, from_path, places) of edges: places as aligned_lines gives them, or -1 for all lines without
    a from_cid. A text moves as one string: its lines, each with an end, in which line ends and backslashes are escaped."""
    import pyarrow as pa

    line = lambda x: F.concat(F.coalesce(F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\\0")), F.lit("\n"))
    texts = lines.select("blob", F.array_join(F.transform("lines", line), "").alias("text")).dropDuplicates(["blob"])
    both = found.join(texts.withColumnRenamed("text", "new"), "blob").join(texts.select(F.col("blob").alias("from_blob"), F.col("text").alias("old")), "from_blob")
    keys = ["cid", "path", "idx", "from_cid", "from_path"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places = []
            for source, old, new in zip(*(b.column(c).to_pylist() for c in ("from_cid", "old", "new")), strict=True):
                lines = new.split("\n")[:-1]
                places.append([-1] * len(lines) if source is None else aligned_lines(old.split("\n")[:-1], lines))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keys), pa.array(places, pa.list_(pa.int32()))], names=[*keys, "places"])

    kinds = {f.name: f.dataType.simpleString() for f in found.schema}
    return both.select(*keys, "old", "new").mapInArrow(run, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "places array<int>"]))


#: Lines that are followed at once, of one file or of several small ones.
HELD, SMALL = 1 << 20, 1 << 16
_ARRAYS = ["line_nos", "to_lines"]


def _followed_here(rows: list[tuple]) -> tuple[list[np.ndarray], list, np.ndarray, np.ndarray]:
    """Follows the pointers of some versions' lines as far as these versions go. rows: (path, cid, idx, from_cid, from_path,
    places), a version's by idx; places is None where it stands for from_cid. Gives lines in groups of a version and an end:
    (version, end, whether it goes on from there) of each group, names of both, starts of groups, (line, line at its end)."""
    number: dict[tuple, int] = {}
    names: list[tuple] = []
    same = {(r[1], r[0]): (r[3], r[4]) for r in rows if r[5] is None}
    links = [r for r in rows if r[5] is not None]
    sizes: list[int] = []
    for path, cid, *_, places in links:
        if (cid, path) not in number:
            number[cid, path] = len(names)
            names.append((cid, path))
            sizes.append(len(places))
    n = len(names)
    off = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    of = np.repeat(np.arange(n), sizes)
    ends, line = of.copy(), np.arange(off[-1]) - off[of]  # where a line's pointer leads, first to itself
    for path, cid, _, source, source_path, places in links:
        if source is None:
            continue
        target = (source, source_path)
        target = same.get(target, target)
        if target not in number:
            number[target] = len(names)
            names.append(target)
        v = number[cid, path]
        at = np.asarray(places, np.int64)
        some = np.flatnonzero((at >= 0) & (ends[off[v] : off[v + 1]] == v)) + off[v]  # the first parent that has it
        ends[some], line[some] = number[target], at[some - off[v]]
    inside = ends < n
    onward = np.where(inside, off[np.minimum(ends, n - 1)] + line, np.arange(len(of)))
    while True:
        further = onward[onward]
        if (further == onward).all():
            break
        onward = further
    ends, line = ends[onward], line[onward]
    order = np.lexsort((np.arange(len(of)), ends, of))
    of, ends, nos, line = of[order], ends[order], (order - off[of[order]]), line[order]
    starts = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (ends[1:] != ends[:-1])])) if len(of) else np.empty(0, np.int64)
    return [of[starts], ends[starts], ends[starts] >= n], names, np.append(starts, len(of)), np.stack([nos, line])


def _links(aligned: DataFrame, ends: DataFrame) -> DataFrame:
    """(cid, path, to_cid, to_path, open, line_nos, to_lines): the lines of a version that have come to a line of one other, or
    to themselves; open if they may go on from there. Rows of one path meet in a task, which follows them through all that it
    holds at once: all versions, but for the largest files."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    rows = aligned.unionByName(ends.select("cid", "path", F.lit(-2).alias("idx"), F.col("to_cid").alias("from_cid"), F.col("path").alias("from_path")), allowMissingColumns=True)
    rows = rows.select("path", "cid", "idx", "from_cid", "from_path", "places").hint("rebalance", "path").sortWithinPartitions("path", "cid", "idx")
    kinds = {f.name: f.dataType for f in rows.schema}
    schema = ", ".join(f"{c} {kinds[k].simpleString()}" for c, k in (("cid", "cid"), ("path", "path"), ("to_cid", "cid"), ("to_path", "path"))) + ", open boolean, line_nos array<int>, to_lines array<int>"

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        held, size = [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and (size >= HELD and row[:2] != held[-1][:2] or size >= SMALL and row[0] != held[-1][0]):
                    yield held
                    held, size = [], 0
                held.append(row)
                size += 1 + len(row[5] or ())
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in chunks(batches):
            (of, to, goes_on), names, starts, places = _followed_here(held)
            lists = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(p, pa.int32())) for p in places]
            cids, paths = (pa.array([x[i] for x in names], to_arrow_type(kinds[k])) for i, k in enumerate(("cid", "path")))
            if len(of):
                yield pa.RecordBatch.from_arrays([cids.take(pa.array(of)), paths.take(pa.array(of)), cids.take(pa.array(to)), paths.take(pa.array(to)), pa.array(goes_on), *lists], names=["cid", "path", "to_cid", "to_path", "open", *_ARRAYS])

    return rows.mapInArrow(run, schema)


def _joined(asking: DataFrame, known: DataFrame) -> DataFrame:
    """Moves the pointers of asking on by those of known. A line that known does not have is an end."""
    import pyarrow as pa

    keys = ["cid", "path", "to_cid", "to_path"]
    onward = known.select(F.col("cid").alias("to_cid"), F.col("path").alias("to_path"), F.col("to_cid").alias("on_cid"), F.col("to_path").alias("on_path"), F.col("open").alias("on"), F.col("line_nos").alias("nos"), F.col("to_lines").alias("onto"))
    met = asking.drop("open").join(onward, ["to_cid", "to_path"], "left").select("cid", "path", F.coalesce("on_cid", "to_cid").alias("to_cid"), F.coalesce("on_path", "to_path").alias("to_path"), F.coalesce("on", F.lit(False)).alias("open"), *_ARRAYS, "nos", "onto")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, out = [], ([], [])
            for i, (mine, to, nos, onto) in enumerate(zip(*(b.column(c) for c in range(5, 9)), strict=True)):
                mine, to = (np.asarray(x.values) for x in (mine, to))
                if nos.is_valid:
                    nos, onto = (np.asarray(x.values) for x in (nos, onto))
                    at = np.searchsorted(nos, to)
                    some = nos[np.minimum(at, len(nos) - 1)] == to
                    mine, to = mine[some], onto[at[some]]
                if len(mine):
                    rows.append(i)
                    out[0].append(mine)
                    out[1].append(to)
            kept = b.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns[:5], *(pa.array(x, pa.list_(pa.int32())) for x in out)], names=[*keys, "open", *_ARRAYS])

    return met.mapInArrow(run, asking.schema)


def owners(files: DataFrame, parents: DataFrame, lines: DataFrame, near: DataFrame | None = None, ends: DataFrame | None = None) -> DataFrame:
    """(cid, path, line_no, commit_sha, old_path, old_line) of every line of every version: the commit that wrote it, and
    the file and line where it stood then. files: (cid, path, blob) at all commits, parents: (cid, idx, parent), lines:
    (blob, lines). near and ends: as nearest and unchanged give them, if they are there already."""
    lines = lines.select("blob", "lines")
    near = near or nearest(files, parents)
    ends = ends or unchanged(near)
    first = stored(_links(alignments(edges(near, ends, files, lines), lines), ends), "links")
    done, going = first.filter("NOT open"), first.filter("open")
    if not going.isEmpty():
        to = ends.select(F.col("cid").alias("to_cid"), F.col("path").alias("to_path"), F.col("to_cid").alias("version"))
        going = stored(going.join(to, ["to_cid", "to_path"], "left").withColumn("to_cid", F.coalesce("version", "to_cid")).select(*first.columns), "going")
        while True:
            links = stored(_joined(going, done.unionByName(going)), "links")
            done, going = done.unionByName(links.filter("NOT open")), links.filter("open")
            if going.isEmpty():
                break
    out = done.select("cid", "path", "to_cid", "to_path", F.inline(F.arrays_zip(*_ARRAYS)))
    return out.select("cid", "path", F.col("line_nos").alias("line_no"), F.col("to_cid").alias("commit_sha"), F.col("to_path").alias("old_path"), F.col("to_lines").alias("old_line"))


def blame_of(tips: DataFrame, files: DataFrame, parents: DataFrame, lines: DataFrame) -> DataFrame:
    """(cid, path, line_no, commit_sha, old_path, old_line, line) of the files at some commits (cid); old_path is empty
    where it is the file's own."""
    near = nearest(files, parents)
    ends = unchanged(near)
    found = versions(files, ends).join(tips.select("cid"), "cid", "left_semi")
    own = owners(files, parents, lines, near, ends).withColumnRenamed("cid", "version")
    text = lines.select("blob", F.posexplode("lines").alias("line_no", "line"))
    out = found.join(own, ["version", "path"]).join(text, ["blob", "line_no"])
    return out.select("cid", "path", "line_no", "commit_sha", F.when(F.col("old_path") == F.col("path"), "").otherwise(F.col("old_path")).alias("old_path"), "old_line", "line")
