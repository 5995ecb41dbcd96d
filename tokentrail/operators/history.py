"""Commit history: footers of former ids, grafts, parents, and the chain of rewritten commits."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as fn
from ..store import stored
from .ordering import numbered


def commit_map(logs: DataFrame) -> DataFrame:
    """(cid, originalcid, repo) from the last line of each message."""
    return logs.select("cid", fn.former_commit(F.col("cid"), F.col("log")).alias("originalcid"), F.lit(None).cast("string").alias("repo"))


def graft_rows(lines: DataFrame) -> DataFrame:
    """(cid, idx, parent) of graft lines (value): child and parents between blanks; shorter lines are ignored."""
    parts = F.split(F.trim("value"), r"\s+")
    return lines.filter(F.size(parts) >= 2).select(parts[0].alias("cid"), F.posexplode(F.slice(parts, 2, 1 << 20)).alias("idx", "parent"))


def grafted(parents: DataFrame, grafts: DataFrame) -> DataFrame:
    """Parents, with all rows of a grafted commit replaced."""
    return parents.join(grafts.select("cid").distinct(), "cid", "left_anti").unionByName(grafts)


def merge_flags(parents: DataFrame) -> DataFrame:
    return parents.groupBy("cid").agg((F.count(F.lit(1)) > 1).alias("ismerge"))


def frontier(commits: DataFrame, mapped: DataFrame) -> DataFrame:
    """Commits that are not mapped yet."""
    return commits.join(mapped.select(F.col("orig_commit").alias("cid")), "cid", "left_anti")


def unresolved_parents(parents: DataFrame, mapped: DataFrame) -> DataFrame:
    """Parents that neither map holds; a rewrite may go on only if there are none."""
    return parents.join(mapped.select(F.col("orig_commit").alias("parent")), "parent", "left_anti").select("cid", "parent")


def stale_refs(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Our refs in tracked name spaces that the source has no longer."""
    return ours.filter(F.col("ref_name").rlike("^refs/(heads|tags)/")).join(theirs.select("ref_name"), "ref_name", "left_anti")


def projected_refs(refs: DataFrame, mapped: DataFrame) -> DataFrame:
    """Refs with the new ids of their commits; refs to unmapped commits go."""
    return refs.join(mapped.select(F.col("orig_commit"), "new_commit"), "orig_commit")


def git_object_id(kind: str, body: bytes) -> str:
    return hashlib.sha1(f"{kind} {len(body)}\0".encode() + body).hexdigest()


def _sort_key() -> Column:
    """Git's order of entries, where a directory's name sorts as if it ended in a slash."""
    return F.concat(F.col("name").cast("binary"), F.when(F.col("mode") == "40000", F.lit("/").cast("binary")).otherwise(F.lit("").cast("binary")))


def _entry() -> Column:
    return F.concat(F.col("mode").cast("binary"), F.lit(" ").cast("binary"), F.col("name").cast("binary"), F.lit(b"\0"), F.unhex("object_id"))


def tree_ids(entries: DataFrame) -> DataFrame:
    """(tree, new_tree) as tree_bodies gives them, without the bodies: a tree's entries are sorted by Spark and go through its
    task one by one, so that a tree may have any number of them."""
    import pyarrow as pa

    sizes = entries.groupBy("tree").agg(F.coalesce(F.sum(F.octet_length(_entry())), F.lit(0)).alias("size")).withColumn("k", F.lit(None).cast("binary"))
    # the size is hashed before the entries: its row comes before theirs, as a null does
    rows = sizes.select("tree", "k", "size", F.col("k").alias("e")).unionByName(entries.select("tree", _sort_key().alias("k"), F.lit(None).cast("long").alias("size"), _entry().alias("e")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = made = None
        of = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], names=["tree", "new_tree"])
        for b in batches:
            done = []
            for name, size, e in zip(*(b.column(c).to_pylist() for c in ("tree", "size", "e")), strict=True):
                if size is not None:
                    if made:
                        done.append((tree, made.hexdigest()))
                    tree, made = name, hashlib.sha1(f"tree {size}\0".encode())
                elif e is not None:
                    made.update(e)
            if done:
                yield of(done)
        if made:
            yield of([(tree, made.hexdigest())])

    return rows.repartition("tree").sortWithinPartitions("tree", F.col("size").isNull(), "k", "e").select("tree", "size", "e").mapInArrow(run, "tree string, new_tree string")


def tree_bodies(entries: DataFrame) -> DataFrame:
    """(tree, body, new_tree) from (tree, name, mode, object_id): entries in git's order. A body is held whole; tree_ids does
    without."""
    g = entries.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct(_sort_key().alias("k"), _entry().alias("e")))).alias("es"))
    body = F.unhex(F.array_join(F.transform("es", lambda x: F.hex(x["e"])), ""))  # adding up bytes one by one would be quadratic
    g = g.select("tree", body.alias("body"))
    head = F.concat(F.lit("tree ").cast("binary"), F.octet_length("body").cast("string").cast("binary"), F.lit(b"\0"))
    return g.withColumn("new_tree", F.sha1(F.concat(head, F.col("body"))))


def assembled_trees(entries: DataFrame, new_ids: DataFrame) -> DataFrame:
    """(tree, new_tree) bottom up: (tree, name, mode, object_id) with blobs replaced by new_ids (object_id, new_id);
    blobs without a new id, which were excluded, leave their tree."""
    from . import rewrite

    spark = entries.sparkSession
    none = lambda schema: spark.createDataFrame([], schema)
    below = entries.filter("mode = '40000'").select(F.col("object_id").alias("tree")).distinct()
    roots = entries.select("tree").distinct().join(below, "tree", "left_anti").withColumnRenamed("tree", "root")
    trees = none("orig_tree string, new_tree string, processed_at long")
    plan = rewrite.plan_trees(entries.withColumn("name", F.col("name").cast("binary")), roots, "", trees, none("orig_blob string, path string, new_blob string"))
    blobs = plan.filter("plan = 'miss'").select(F.col("object_id").alias("orig_blob"), "path").distinct()
    blobs = blobs.join(new_ids.select(F.col("object_id").alias("orig_blob"), F.col("new_id").alias("new_blob")).dropDuplicates(["orig_blob"]), "orig_blob")
    return rewrite.assemble(plan, blobs, trees).select(F.col("orig_tree").alias("tree"), "new_tree")


def rewritten_commits(rows: list[dict]) -> dict[str, str]:
    """Old to new ids of a small history (cid, tree, parents, author, committer, message), of text, in any order; tables
    go through rewrite.fold_commits."""
    from .rewrite import Fold

    fold = Fold()
    for r in rows:
        for _ in fold.add({k: v.encode() if k in ("author", "committer", "message") else v for k, v in r.items()}):
            pass
    fold.close()
    return fold.new


def corrected_dates(commits: DataFrame, parents: DataFrame, every: int = 8) -> DataFrame:
    """(cid, at): the dates of commits (cid, at, in seconds), put off where needed so that each is later than those of all
    parents (cid, idx, parent). Parents that are not among the commits count for nothing.

    A round takes the commits that the last one moved, and no others, one step on to their children. A long row of such
    commits would take as many rounds, so where after some rounds more than half as many commits move as before, what a
    commit owes to its first parent, that one's first parent and so on is found by doubling. Rounds end when nothing moves; a
    circle of parents is an error.
    """
    dates = stored(commits.select("cid", F.col("at").cast("long").alias("at")), "dates")
    edges = parents.select("cid", "idx", "parent").join(dates.withColumnRenamed("at", "own"), "cid")
    edges = stored(edges.join(dates.select(F.col("cid").alias("parent"), F.col("at").alias("before")), "parent"), "edges")
    latest, n = dates.agg(F.max("at"), F.count(F.lit(1))).first()
    moved, sizes = [], []  # dates that were put off, the newer ones behind
    fresh = stored(edges.filter("before >= own").groupBy("cid").agg((F.max("before") + 1).alias("at")), "moved")
    turn, at_check = 0, None
    while True:
        last, some = fresh.agg(F.max("at"), F.count(F.lit(1))).first()
        if not some:
            return _put_off(dates, moved)
        if last > latest + n:  # no chain of parents is longer than the number of commits
            raise ValueError("commits are parents of each other")
        moved, sizes = _merged([*moved, fresh], [*sizes, some])
        turn += 1
        if turn % every == 0:
            if at_check and 2 * some > at_check:
                state = stored(_put_off(dates, moved), "dates")
                path = _along_first_parents(state, edges, n)
                fresh = stored(path.join(state.withColumnRenamed("at", "was"), "cid").filter("at > was").select("cid", "at"), "moved")
                at_check = None
                continue
            at_check = some
        to = fresh.select(F.col("cid").alias("parent"), F.col("at").alias("put"))
        least = stored(edges.drop("before").join(to, "parent").filter("put >= own").groupBy("cid").agg((F.max("put") + 1).alias("at")), "least")
        known = _union(moved).join(least.select("cid"), "cid").groupBy("cid").agg(F.max("at").alias("was"))
        fresh = stored(least.join(known, "cid", "left").filter("was IS NULL OR at > was").select("cid", "at"), "moved")


def _union(tables: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, tables)


def _merged(tables: list[DataFrame], sizes: list[int]) -> tuple[list[DataFrame], list[int]]:
    """Tables of dates with the last ones put together, where they have grown to the size of what is before them: each date
    is written a logarithmic number of times."""
    k = len(sizes) - 1
    while k > 0 and 2 * sum(sizes[k:]) > sizes[k - 1]:
        k -= 1
    if len(sizes) - k < 2:
        return tables, sizes
    one = stored(_union(tables[k:]).groupBy("cid").agg(F.max("at").alias("at")), "moved")
    return [*tables[:k], one], [*sizes[:k], one.count()]


def _put_off(dates: DataFrame, moved: list[DataFrame]) -> DataFrame:
    if not moved:
        return dates
    best = _union(moved).groupBy("cid").agg(F.max("at").alias("put"))
    return dates.join(best, "cid", "left").select("cid", F.coalesce("put", "at").alias("at"))


def _along_first_parents(state: DataFrame, edges: DataFrame, n: int) -> DataFrame:
    """The dates that chains of first parents ask for: the highest of each ancestor's date and its distance."""
    first = edges.groupBy("cid").agg(F.min_by("parent", "idx").alias("to"))
    path = stored(state.join(first, "cid", "left").select("cid", "to", F.lit(1).cast("long").alias("far"), F.col("at").alias("best")), "paths")
    reach = 1
    while not path.filter("to IS NOT NULL").isEmpty():
        if reach > n:
            raise ValueError("commits are parents of each other")
        on = path.select(F.col("cid").alias("to"), F.col("to").alias("to2"), F.col("far").alias("far2"), F.col("best").alias("best2"))
        path = stored(path.join(on, "to", "left").select("cid", F.col("to2").alias("to"), (F.col("far") + F.coalesce("far2", F.lit(0))).alias("far"), F.greatest("best", F.col("best2") + F.col("far")).alias("best")), "paths")
        reach *= 2
    return path.select("cid", F.col("best").alias("at"))


def ordinals(commits: DataFrame, parents: DataFrame) -> DataFrame:
    """(cid, ordinal): parents before children, else by date; commits are (cid, autdate) and dates may be wrong."""
    at = F.coalesce(F.unix_seconds(F.try_to_timestamp("autdate")), F.lit(0))
    return numbered(corrected_dates(commits.select("cid", at.alias("at")), parents), ["at", "cid"], "ordinal").select("cid", "ordinal")


def shards(commits: DataFrame, parents: DataFrame, n: int) -> DataFrame:
    """(cid, ordinal, shard): shard k has ordinals from floor(k m / n) up to floor((k + 1) m / n) - 1."""
    rows = stored(ordinals(commits, parents), "ordinals")
    return rows.withColumn("shard", F.floor(((F.col("ordinal") + 1) * n - 1) / F.lit(max(rows.count(), 1))).cast("long"))
