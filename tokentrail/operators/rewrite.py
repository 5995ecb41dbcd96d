"""Rewriting a history: one token a line in every masked blob, all else as it was.

The rewrite is a chain of tables. Trees that the maps do not know are planned level by level; the blobs they miss are
tokenized once for each content; trees are put together by height; commits are a fold in the order of
parents, one task a repository; refs follow their commits. Maps hold what is known, so a second run does what is new
only, and object ids name contents, so any order of tasks gives the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import maplog
from ..functions import text as fn
from ..sources import packs
from ..sources.git import GITLINK, TREE
from ..store import stored
from . import history, mapping

#: The id of a tree without entries.
EMPTY_TREE = "4b825dc642cb6eb9a060e54bf8d69288fbee4904"
UNKNOWN_TAGGER = b"unknown <unknown> 0 +0000"


def git_id(kind: str, body: Column) -> Column:
    """The object id of a body of bytes."""
    return F.sha1(F.concat(F.lit(f"{kind} ").cast("binary"), F.octet_length(body).cast("string").cast("binary"), F.lit(b"\0"), body))


# ---- planning ----


def plan_trees(entries: DataFrame, roots: DataFrame, mask: str, tree_map: DataFrame, blob_map: DataFrame, rounds: int = 512) -> DataFrame:
    """(depth, tree, path, name, mode, object_id, plan, new_id) for every entry of the trees below roots (root) that
    tree_map does not know; each tree once, under the first of its paths on the level where it is met.

    plan: subtree; gitlink (kept, of another repository); unchanged (its name does not match the mask); hit (blob_map
    has its new id) or miss.
    """
    level = roots.select(F.col("root").alias("tree"), F.lit("").alias("prefix")).distinct()
    known = tree_map.select(F.col("orig_tree").alias("tree"))
    seen = out = None
    hits = blob_map.select(F.col("orig_blob").alias("object_id"), "path", F.col("new_blob").alias("new_id"))
    for depth in range(rounds):
        level = level.join(known, "tree", "left_anti")
        if seen is not None:
            level = level.join(seen, "tree", "left_anti")
        level = stored(level.groupBy("tree").agg(F.min("prefix").alias("prefix")), "level")
        if level.isEmpty():
            return out if out is not None else _no_plan(entries)
        seen = level.select("tree") if seen is None else seen.unionByName(level.select("tree"))
        found = level.join(entries, "tree").withColumn("path", F.concat("prefix", F.col("name").cast("string")))
        plan = F.when(F.col("mode") == TREE, "subtree").when(F.col("mode") == GITLINK, "gitlink").when(~F.col("name").cast("string").rlike(mask), "unchanged")
        found = found.withColumn("plan", plan)
        columns = [F.lit(depth).alias("depth"), "tree", "path", "name", "mode", "object_id", "plan", "new_id"]
        # only names that match may be hits, all others do not move
        asked = found.filter("plan IS NULL").join(hits, ["object_id", "path"], "left").withColumn("plan", F.when(F.col("new_id").isNotNull(), "hit").otherwise("miss"))
        found = found.filter("plan IS NOT NULL").withColumn("new_id", F.lit(None).cast("string")).select(columns).unionByName(asked.select(columns))
        found = stored(found, "plan")
        out = found if out is None else out.unionByName(found)
        level = found.filter("plan = 'subtree'").select(F.col("object_id").alias("tree"), F.concat("path", F.lit("/")).alias("prefix"))
    raise ValueError("trees are nested too deeply")


def _no_plan(entries: DataFrame) -> DataFrame:
    none = entries.limit(0)
    text = F.lit("")
    return none.select(F.lit(0).alias("depth"), "tree", text.alias("path"), "name", "mode", "object_id", text.alias("plan"), text.alias("new_id"))


# ---- tokenizing ----


def resolve_misses(plan: DataFrame, blobs: DataFrame, tokenize: Callable[[DataFrame], DataFrame], denied: DataFrame | None = None, limit: int = mapping.OVERSIZED, failed: DataFrame | None = None, now: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(blob_map rows, exclusions, new blobs as objects) for the misses of a plan. Each (blob, path) counts once, each content and extension
    is tokenized once. tokenize turns (content_sha, ext, content) into (content_sha, ext, status, tokens); blobs are
    (object_id, size, content). Blobs that are denied, oversized, or failed before are excluded, and so are those whose
    tokenizer now fails; they get no row."""
    misses = plan.filter("plan = 'miss'").select(F.col("object_id").alias("orig_blob"), "path").distinct()
    rows = misses.join(blobs.select(F.col("object_id").alias("orig_blob"), "size", "content"), "orig_blob")
    rows = mapping.screened(rows, denied, limit, failed).withColumn("ext", fn.extension(F.col("path"))).withColumn("content_sha", F.sha1("content"))
    good = rows.filter("exclusion IS NULL")
    tokens = stored(tokenize(good.select("content_sha", "ext", "content").dropDuplicates(["content_sha", "ext"])), "tokens")
    done = good.join(tokens, ["content_sha", "ext"], "left")
    body = F.concat(F.array_join("tokens", "\n"), F.lit("\n")).cast("binary")
    new = F.when(F.col("tokens").isNull() | (body == F.col("content")), F.col("orig_blob")).otherwise(git_id("blob", body))
    status = F.coalesce("status", F.lit("tokenizer-error"))
    mapped = done.filter(status.isin("ok", "skip")).select("orig_blob", "path", new.alias("new_blob"), F.lit(now).cast("long").alias("processed_at"))
    excluded = rows.filter("exclusion IS NOT NULL").select("orig_blob", "path", "exclusion")
    excluded = excluded.unionByName(done.filter(~status.isin("ok", "skip")).select("orig_blob", "path", status.alias("exclusion")))
    objects = done.filter((status == "ok") & (new != F.col("orig_blob"))).select(new.alias("object_id"), F.lit("blob").alias("kind"), body.alias("content"))
    return mapped, excluded, objects


def identity_rows(plan: DataFrame, now: int = 0) -> DataFrame:
    """blob_map rows of the blobs that stay as they are."""
    same = plan.filter("plan = 'unchanged'").select(F.col("object_id").alias("orig_blob"), "path").distinct()
    return same.select("orig_blob", "path", F.col("orig_blob").alias("new_blob"), F.lit(now).cast("long").alias("processed_at"))


# ---- trees ----


def assemble(plan: DataFrame, blob_map: DataFrame, tree_map: DataFrame, now: int = 0, bodies: bool = False) -> DataFrame:
    """(orig_tree, new_tree, processed_at) of the planned trees, with their bytes (body) if asked for.

    Trees are made by height: each round, those whose sub-trees all have new ids. So a tree may stand on any number of
    levels, above and below others. Excluded blobs, which have no new id, leave their tree; a tree without entries is the
    empty tree. A sub-tree that is neither planned nor known is an error, and nothing is given up in silence."""
    known = tree_map.select(F.col("orig_tree").alias("object_id"), F.col("new_tree").alias("new_id"))
    new = plan.filter("plan = 'miss'").drop("new_id").join(blob_map.select(F.col("orig_blob").alias("object_id"), "path", F.col("new_blob").alias("new_id")), ["object_id", "path"])
    leaves = plan.filter("plan = 'hit'").unionByName(new).unionByName(plan.filter("plan IN ('unchanged', 'gitlink')").withColumn("new_id", F.col("object_id")))
    leaves = stored(leaves.select("tree", "name", "mode", "new_id"), "leaves")
    planned = plan.select("tree").distinct()
    below = plan.filter("plan = 'subtree'").select("tree", "name", "mode", "object_id")
    # what is known or empty is there from the beginning; all else must be planned
    ends = below.join(known, "object_id", "left").withColumn("new_id", F.coalesce("new_id", F.when(F.col("object_id") == EMPTY_TREE, F.col("object_id"))))
    ends = stored(ends.join(planned.select(F.col("tree").alias("object_id"), F.lit(True).alias("planned")), "object_id", "left"), "below")
    lost = ends.filter("new_id IS NULL AND planned IS NULL").first()
    if lost:
        raise ValueError(f"tree {lost.object_id} in {lost.tree} is not among the entries")
    ready = ends.filter("new_id IS NOT NULL").select("tree", "name", "mode", "new_id")
    open_ = ends.filter("new_id IS NULL").select("tree", "name", "mode", "object_id")
    todo, built, total, count = stored(planned, "todo"), None, planned.count(), 0
    while count < total:
        trees = todo.join(open_.select("tree").distinct(), "tree", "left_anti")
        own = leaves.join(trees, "tree").unionByName(ready.join(trees, "tree"))
        own = own.select("tree", "name", "mode", F.col("new_id").alias("object_id"))
        made = history.tree_bodies(own).select("tree", "new_tree", "body") if bodies else history.tree_ids(own)
        made = trees.join(made, "tree", "left").withColumn("new_tree", F.coalesce("new_tree", F.lit(EMPTY_TREE)))
        made = stored(made.withColumn("body", F.coalesce("body", F.lit(b""))) if bodies else made, "trees")
        found = made.count()
        if not found:
            raise ValueError(f"{total - count} trees hold each other")
        count += found
        built = made if built is None else built.unionByName(made)
        if count < total:
            met = stored(open_.join(made.select(F.col("tree").alias("object_id"), F.col("new_tree").alias("new_id")), "object_id", "left"), "met")
            ready = ready.unionByName(met.filter("new_id IS NOT NULL").drop("object_id"))
            open_ = met.filter("new_id IS NULL").drop("new_id")
            todo = stored(todo.join(made.select("tree"), "tree", "left_anti"), "todo")
    columns = [F.col("tree").alias("orig_tree"), "new_tree", F.lit(now).cast("long").alias("processed_at"), *(["body"] if bodies else [])]
    if built is None:
        built = planned.select("tree", F.lit("").alias("new_tree"), F.lit(b"").alias("body"))
    return built.select(*columns)


# ---- commits and refs ----


def with_footer(message: bytes, cid: str) -> bytes:
    """The message with the former id: in its trailing block if that holds a trailer, else as a block of its own."""
    last = message.rsplit(b"\n\n", 1)[-1].decode("utf-8", "replace")
    inside = any(fn.re.fullmatch(r"[A-Za-z0-9-]+: *.*", line) for line in last.split("\n"))
    return message + (b"\n" if inside else b"\n\n") + f"Former-commit-id: {cid}".encode()


def commit_body(tree: str, parents: list[str], author: bytes, committer: bytes, encoding: bytes | None, message: bytes) -> bytes:
    """A commit with its people, its encoding if that is not UTF-8, and no other headers."""
    head = [b"tree " + tree.encode(), *(b"parent " + p.encode() for p in parents), b"author " + author, b"committer " + committer]
    if encoding and encoding.upper().replace(b"-", b"") != b"UTF8":
        head.append(b"encoding " + encoding)
    return b"\n".join(head) + b"\n\n" + message


class Fold:
    """Commits in any order to new ids: a commit is hashed as soon as all its parents are, and waits until then."""

    def __init__(self) -> None:
        self.new: dict[str, str] = {}
        self.waiting: dict[str, tuple[int, dict]] = {}
        self.children: dict[str, list[str]] = {}

    def known(self, cid: str, new: str) -> Iterator[tuple[str, str, bytes]]:
        self.new[cid] = new
        yield from self._settle(cid)

    def add(self, row: dict) -> Iterator[tuple[str, str, bytes]]:
        """(cid, new id, bytes) of the commit and of those that waited for it."""
        missing = {p for p in row["parents"] if p not in self.new}
        if missing:
            self.waiting[row["cid"]] = (len(missing), row)
            for p in missing:
                self.children.setdefault(p, []).append(row["cid"])
            return
        yield self._hash(row)
        yield from self._settle(row["cid"])

    def _hash(self, row: dict) -> tuple[str, str, bytes]:
        message = with_footer(row["message"], row["cid"])
        body = commit_body(row["tree"], [self.new[p] for p in row["parents"]], row["author"], row["committer"], row.get("encoding"), message)
        self.new[row["cid"]] = history.git_object_id("commit", body)
        return row["cid"], self.new[row["cid"]], body

    def _settle(self, cid: str) -> Iterator[tuple[str, str, bytes]]:
        ready = [cid]
        while ready:
            for child in self.children.pop(ready.pop(), ()):
                left, row = self.waiting[child]
                if left > 1:
                    self.waiting[child] = (left - 1, row)
                else:
                    del self.waiting[child]
                    yield self._hash(row)
                    ready.append(child)

    def close(self) -> None:
        if self.waiting:
            cid, (_, row) = next(iter(self.waiting.items()))
            lost = [p for p in row["parents"] if p not in self.new and p not in self.waiting]
            raise ValueError(f"{len(self.waiting)} commits wait for parents, {cid} for {lost or 'a circle'}")


def fold_commits(commits: DataFrame, tree_map: DataFrame, commit_map: DataFrame, now: int = 0, bodies: bool = False) -> DataFrame:
    """(repo, orig_commit, new_commit, processed_at) of the commits that commit_map (repo, orig_commit, new_commit) does
    not have, with their bytes (body) if asked for. Each id hashes its parents', so a repository is one task; it keeps two ids a commit, and the rows of those
    only that come before their parents, which in the order of committer dates are few. The root tree must be mapped."""
    import pyarrow as pa

    mapped = commit_map.select("repo", F.col("orig_commit").alias("cid"), F.col("new_commit").alias("new_id"))
    fresh = commits.join(mapped.select("repo", "cid"), ["repo", "cid"], "left_anti")
    fresh = fresh.join(tree_map.select(F.col("orig_tree").alias("tree"), F.col("new_tree").alias("root")), "tree", "left")
    when = F.coalesce(F.try_element_at(F.split(F.col("committer").cast("string"), " "), F.lit(-2)).try_cast("long"), F.lit(0))
    columns = ["parents", "author", "committer", "encoding", "message"]
    rows = fresh.select("repo", "cid", F.lit(None).cast("string").alias("new_id"), F.col("root").alias("tree"), *columns, when.alias("at"))
    old = mapped.select("repo", "cid", "new_id", F.lit(None).cast("string").alias("tree"), F.array().cast("array<string>").alias("parents"), *(F.lit(None).cast("binary").alias(c) for c in columns[1:]), F.lit(-(2**62)).alias("at"))

    types = [pa.string()] * 3 + [pa.binary()] * bodies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repo, fold = None, Fold()
        for b in batches:
            out: list[tuple] = []
            for r in b.to_pylist():
                if r["repo"] != repo:
                    fold.close()
                    repo, fold = r["repo"], Fold()
                if r["new_id"]:
                    found = fold.known(r["cid"], r["new_id"])
                elif r["tree"] is None:
                    raise ValueError(f"the tree of commit {r['cid']} has no new id")
                else:
                    found = fold.add(r)
                out += [(repo, *x)[: len(types)] for x in found]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["repo", "orig_commit", "new_commit", "body"][: len(types)])
        fold.close()

    dealt = rows.unionByName(old).repartition("repo").sortWithinPartitions("repo", "at", "cid")
    return dealt.mapInArrow(run, "repo string, orig_commit string, new_commit string" + ", body binary" * bodies).withColumn("processed_at", F.lit(now).cast("long"))


def project_refs(refs: DataFrame, tags: DataFrame, commit_map: DataFrame, now: int = 0, rounds: int = 16, bodies: bool = False) -> DataFrame:
    """(repo, ref_name, kind, orig_target, new_target, orig_commit, new_commit, symref, recorded, processed_at): refs of
    mapped commits, directly or through tags. kind: head, lightweight_tag, annotated_tag, or symbolic, which keeps its
    target's name. A tag is written anew for its commit, with a stand-in where it has no tagger. recorded: refs of
    branches, tags and remotes, which the ref map keeps and a mirror prunes. With bodies, the bytes of new tags."""
    plain = refs.filter("symref IS NULL AND object_id IS NOT NULL")
    tags = tags.withColumnsRenamed({"target": "to", "target_kind": "to_kind"})
    at = plain.select("repo", "ref_name", F.col("object_id").alias("orig_target"), F.col("object_id").alias("peeled"))
    for _ in range(rounds):  # a tag of a tag of a commit
        chain = at.join(tags.select("repo", F.col("tag_id").alias("peeled"), "to"), ["repo", "peeled"], "left")
        if chain.filter("to IS NOT NULL").isEmpty():
            break
        at = chain.select("repo", "ref_name", "orig_target", F.coalesce("to", "peeled").alias("peeled"))
    found = at.join(commit_map.select("repo", F.col("orig_commit").alias("peeled"), "new_commit"), ["repo", "peeled"])
    found = found.join(tags.select("repo", F.col("tag_id").alias("orig_target"), "tag", "tagger", "message"), ["repo", "orig_target"], "left")
    line = lambda name, value: F.concat(F.lit(f"{name} ").cast("binary"), value, F.lit(b"\n"))
    body = F.concat(line("object", F.col("new_commit").cast("binary")), F.lit(b"type commit\n"), line("tag", F.col("tag")), line("tagger", F.coalesce("tagger", F.lit(UNKNOWN_TAGGER))), F.lit(b"\n"), F.col("message"))
    annotated = F.col("tag").isNotNull()
    kind = F.when(annotated, "annotated_tag").when(F.col("ref_name").startswith("refs/tags/"), "lightweight_tag").otherwise("head")
    direct = found.select("repo", "ref_name", kind.alias("kind"), "orig_target", F.when(annotated, git_id("tag", body)).otherwise(F.col("new_commit")).alias("new_target"), F.col("peeled").alias("orig_commit"), "new_commit", F.lit(None).cast("string").alias("symref"), *([F.when(annotated, body).alias("body")] if bodies else []))
    none = F.lit(None).cast("string")
    symbolic = refs.filter("symref IS NOT NULL").select("repo", "ref_name", F.lit("symbolic").alias("kind"), *(none.alias(c) for c in ("orig_target", "new_target", "orig_commit", "new_commit")), "symref", *([F.lit(None).cast("binary").alias("body")] if bodies else []))
    recorded = F.col("ref_name").rlike("^refs/(heads|tags|remotes)/") & F.col("symref").isNull()
    return direct.unionByName(symbolic).withColumn("recorded", recorded).withColumn("processed_at", F.lit(now).cast("long"))


# ---- whole runs ----


def shard_of(commits: DataFrame, k: int, n: int, parents: DataFrame | None = None) -> DataFrame:
    """The commits of one shard of n: ranges of the history's order, parents first. Shards' tree runs are merged by their
    maps. Parents (cid, idx, parent) are taken from the commits' own column if they are not given."""
    if parents is None:
        parents = commits.select("cid", F.posexplode("parents").alias("idx", "parent"))
    return commits.join(history.shards(commits.select("cid", "autdate"), parents, n).filter(F.col("shard") == k).select("cid"), "cid", "left_semi")


def rewrite_trees(entries: DataFrame, roots: DataFrame, blobs: DataFrame, tokenize, mask: str, tree_map: DataFrame, blob_map: DataFrame, warm_trees: DataFrame | None = None, warm_blobs: DataFrame | None = None, **options) -> dict[str, DataFrame]:
    """New rows of tree_map and blob_map for the trees below roots, the new blobs and trees as objects (object_id, kind,
    content), exclusions and the plan. Warm maps, of an earlier run,
    are asked where the own ones have nothing; nothing is added to them."""
    now = options.pop("now", 0)
    blob_columns, tree_columns = ["orig_blob", "path", "new_blob", "processed_at"], ["orig_tree", "new_tree", "processed_at"]
    known_blobs = blob_map.select(*blob_columns) if warm_blobs is None else mapping.insert_or_ignore(blob_map.select(*blob_columns), warm_blobs.select(*blob_columns), blob_columns[:2])
    known_trees = tree_map.select(*tree_columns) if warm_trees is None else mapping.insert_or_ignore(tree_map.select(*tree_columns), warm_trees.select(*tree_columns), tree_columns[:1])
    plan = plan_trees(entries, roots, mask, known_trees, known_blobs)
    made, excluded, objects = resolve_misses(plan, blobs, tokenize, now=now, **options)
    made, excluded = stored(made, "blobs"), stored(excluded, "excluded")
    trees = assemble(plan, made, known_trees, now, bodies=True)
    objects = objects.unionByName(trees.select(F.col("new_tree").alias("object_id"), F.lit("tree").alias("kind"), F.col("body").alias("content")))
    trees = trees.drop("body")
    new_blobs = mapping.insert_or_ignore(made, identity_rows(plan, now), blob_columns[:2])
    return {"plan": plan, "blob_map": new_blobs.join(blob_map.select(*blob_columns[:2]), blob_columns[:2], "left_anti"), "tree_map": trees, "exclusions": excluded, "objects": objects}


def rewrite(commits: DataFrame, entries: DataFrame, blobs: DataFrame, refs: DataFrame, tags: DataFrame, tokenize, mask: str, maps: dict[str, DataFrame], now: int = 0, **options) -> dict[str, DataFrame]:
    """All maps after a run over the commits that commit_map does not have, with exclusions, the run's statistics and the
    objects (object_id, kind, content) that its new ids name: tokenized and copied blobs, trees, commits and tags. A run
    without new commits projects the refs again and adds nothing else."""
    todo = commits.join(maps["commit_map"].select("repo", F.col("orig_commit").alias("cid")), ["repo", "cid"], "left_anti")
    found = rewrite_trees(entries, todo.select(F.col("tree").alias("root")).distinct(), blobs, tokenize, mask, maps["tree_map"], maps["blob_map"], now=now, **options)
    tree_map = stored(maps["tree_map"].select("orig_tree", "new_tree", "processed_at").unionByName(found["tree_map"]), "tree_map")
    folded = stored(fold_commits(commits, tree_map, maps["commit_map"], now, bodies=True), "commits")
    new = folded.drop("body")
    commit_map = maps["commit_map"].select("repo", "orig_commit", "new_commit", "processed_at").unionByName(new)
    tagged = stored(project_refs(refs, tags, commit_map, now, bodies=True), "refs")
    projected = tagged.drop("body")
    blob_map = maps["blob_map"].select("orig_blob", "path", "new_blob", "processed_at").unionByName(found["blob_map"])
    out = {"blob_map": blob_map, "tree_map": tree_map, "commit_map": commit_map, "ref_map": projected.filter("recorded").drop("symref", "recorded"), "refs": projected}
    copied = originals(found["blob_map"]).join(blobs.select("object_id", F.lit("blob").alias("kind"), "content"), "object_id")
    objects = found["objects"].unionByName(copied)
    for kind, rows, oid in (("commit", folded, "new_commit"), ("tag", tagged.filter("body IS NOT NULL"), "new_target")):
        objects = objects.unionByName(rows.select(F.col(oid).alias("object_id"), F.lit(kind).alias("kind"), F.col("body").alias("content")))
    out["objects"] = objects.dropDuplicates(["object_id"])
    out["new"] = {"blob_map": found["blob_map"], "tree_map": found["tree_map"], "commit_map": new}
    return out | {"exclusions": found["exclusions"], "statistics": walk_statistics(found["plan"], found["blob_map"], found["exclusions"], new, maps["commit_map"], projected, blobs)}


def rewrite_into(base: str, target: str, commits: DataFrame, entries: DataFrame, blobs: DataFrame, refs: DataFrame, tags: DataFrame, tokenize, mask: str, now: int = 0, **options) -> dict[str, DataFrame]:
    """A rewrite whose maps are a log at base and whose objects are a repository at target. Objects come first, then the
    maps' new rows as one version, then refs: a run that dies at any place is repeated, and no map names what is not there.
    What is written is in proportion to what is new."""
    spark = commits.sparkSession
    schemas = {"blob_map": "orig_blob string, path string, new_blob string, processed_at long", "tree_map": "orig_tree string, new_tree string, processed_at long", "commit_map": "repo string, orig_commit string, new_commit string, processed_at long"}
    maps = {name: maplog.read(spark, base, name) for name in schemas}
    maps = {name: spark.createDataFrame([], schemas[name]) if df is None else df for name, df in maps.items()}
    out = rewrite(commits, entries, blobs, refs, tags, tokenize, mask, maps, now, **options)
    packs.write_objects(out["objects"], target)
    if not out["new"]["commit_map"].isEmpty():
        maplog.append(spark, base, out["new"])
    packs.write_refs(out["refs"], target)
    return out


def walk_statistics(plan: DataFrame, new_blobs: DataFrame, exclusions: DataFrame, new_commits: DataFrame, old_commits: DataFrame, refs: DataFrame, blobs: DataFrame, aborted: bool = False) -> DataFrame:
    """One row: what a run did. Originals are the blobs that a new tree names by their old id; each counts once as moved
    and, for other paths, as already there."""
    p = plan.agg(F.count_if(F.col("plan") == "hit").alias("blobs_cache_hit"), F.count_if(F.col("plan") == "miss").alias("misses"))
    e = exclusions.groupBy(F.lit(1).alias("x")).pivot("exclusion", ["timeout", "oversized", "denylisted", "parser-crash", "tokenizer-error"]).agg(F.countDistinct("orig_blob", "path"))
    e = e.select(*(F.coalesce(F.sum(f"`{a}`"), F.lit(0)).alias(b) for a, b in (("timeout", "blobs_timed_out"), ("oversized", "blobs_oversized"), ("denylisted", "blobs_denylisted"), ("parser-crash", "blobs_parser_crashed"), ("tokenizer-error", "blobs_tokenizer_failed"))))
    same = new_blobs.filter("orig_blob = new_blob").join(blobs.select(F.col("object_id").alias("orig_blob"), "size"), "orig_blob", "left")
    first = F.row_number().over(_by("orig_blob", "path")) == 1
    o = same.withColumn("first", first).agg(F.count(F.lit(1)).alias("original_requests"), F.count_if("first").alias("original_copies"), F.count_if(~F.col("first")).alias("original_already_present"), F.coalesce(F.sum(F.when(F.col("first"), F.col("size"))), F.lit(0)).alias("original_bytes"), F.coalesce(F.sum(F.when(~F.col("first"), F.col("size"))), F.lit(0)).alias("original_bytes_avoided"))
    b = new_blobs.agg(F.count_if(F.col("orig_blob") != F.col("new_blob")).alias("blobs_tokenized"))
    c, m, r = (d.agg(F.count(F.lit(1)).alias(n)) for d, n in ((new_commits, "commits_processed"), (old_commits, "commits_already_mapped"), (refs.filter("ref_name <> 'HEAD'"), "refs_projected")))
    out = c
    for d in (m, p, b, e, o, r):  # one row each
        out = out.crossJoin(F.broadcast(d))
    executed = F.col("misses") - F.col("blobs_oversized") - F.col("blobs_denylisted")
    return out.withColumn("blob_executions", executed).withColumn("aborted", F.lit(aborted)).drop("misses")


def _by(key: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(order)


def originals(blob_map: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """(object_id) of the old blobs that the target must get: those that new trees name and it does not have. A target
    that borrows the source's objects needs none of them."""
    named = blob_map.filter(f"NOT ({mapping.TOKENIZED})").select(F.col("orig_blob").alias("object_id")).distinct()
    return named if present is None else named.join(present.select("object_id"), "object_id", "left_anti")


def merged_objects(parts: list[DataFrame]) -> DataFrame:
    """The objects of several stores as one: ids name contents, so of equal ids any row stays."""
    return mapping.merged_shards(parts, ["object_id"])


def published(out: dict[str, DataFrame], path: str) -> None:
    """A rewrite's objects and refs as a repository at path: objects first, so every ref that can be seen is whole. A run
    that died in between is repeated; what is there already is not written again."""
    packs.write_objects(out["objects"], path)
    packs.write_refs(out["refs"], path)
