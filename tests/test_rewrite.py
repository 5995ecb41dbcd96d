"""Rewriting, blame, sinks, pages, commands and options, on small repositories and files."""

import os
import shutil
import sqlite3
import stat
import subprocess
import sys
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from tokentrail.functions import text as fn
from tokentrail.operators import blame, commands, contributors, grammar, identity, lexers, mapping, ordering, render, rewrite, walk
from tokentrail.sources import git as source
from tokentrail.sources import readers, sinks
from tokentrail.store import latest, publish, published, shared_folder, stored, write_files

ENV = os.environ | {f"GIT_{w}_{k}": v for w in ("AUTHOR", "COMMITTER") for k, v in (("NAME", "Ann Lee"), ("EMAIL", "a@x.org"), ("DATE", "2020-01-02T03:04:05+0200"))}
MASK = fn.file_mask()


def git(path, *args, **more):
    return subprocess.run(["git", "-C", str(path), *args], check=True, capture_output=True, env=ENV, **more).stdout.decode().strip()


@pytest.fixture(scope="module")
def repo(tmp_path_factory):
    """Two branches and a merge, nested folders, an annotated tag, a tag of a tag, a name that is no UTF-8, a bad file."""
    path = tmp_path_factory.mktemp("repo")
    git(path, "init", "-q", "-b", "main")
    (path / "a/b").mkdir(parents=True)
    (path / "a/b/x.c").write_text("int x = 1;\n")
    (path / "a/y.rs").write_text("fn y() {}\n")
    (path / "a.txt").write_text("plain\n")
    (path / "only").mkdir()
    (path / "only/bad.am").write_text("[never ends")
    git(path, "add", ".")
    git(path, "commit", "-qm", "One\n\nSigned-off-by: A <a@x.org>")
    git(path, "checkout", "-qb", "side")
    (path / "a/b/x.c").write_text("int x = 2;\nint z;\n")
    git(path, "commit", "-qam", "Two")
    git(path, "checkout", "-q", "main")
    (path / os.fsdecode(b"n\xff.c")).write_bytes(b"int caf\xe9;\n")
    git(path, "add", ".")
    git(path, "-c", "i18n.commitEncoding=ISO-8859-1", "commit", "-qF", "-", input=b"Dr\xe4i\n\nbody")
    git(path, "merge", "-q", "side", "-m", "Merge")
    git(path, "tag", "-a", "v1", "-m", "First")
    git(path, "tag", "-a", "v2", "v1", "-m", "Of a tag")
    git(path, "tag", "light", "side")
    return str(path)


def empty(spark):
    schemas = {"blob_map": "orig_blob string, path string, new_blob string, processed_at long", "tree_map": "orig_tree string, new_tree string, processed_at long", "commit_map": "repo string, orig_commit string, new_commit string, processed_at long"}
    return {k: spark.createDataFrame([], v) for k, v in schemas.items()}


def run(spark, repo, maps, **options):
    found = stored(source.objects(spark, repo, shards=3))
    blobs = found.filter("kind = 'blob'").select("object_id", "size", "content")
    return rewrite.rewrite(source.commit_objects(found), stored(source.tree_entries(found).drop("repo").distinct()), blobs, source.refs(spark, repo), source.tag_objects(found), lexers.lexed, MASK, maps, **options)


def test_objects(spark, repo):
    found = source.objects(spark, repo, shards=3)
    rows = {r.object_id: r for r in found.collect()}
    listed = [line.split() for line in git(repo, "cat-file", "--batch-all-objects", "--batch-check").split("\n")]
    assert {(r.object_id, r.kind, r.size) for r in rows.values()} == {(o, k, int(n)) for o, k, n in listed}
    assert all(git(repo, "hash-object", "-t", r.kind, "--stdin", input=bytes(r.content)) == o for o, r in list(rows.items())[:6])
    assert source.objects(spark, repo, limit=5).filter("content IS NULL AND size <= 5").count() == 0
    head = git(repo, "rev-parse", "HEAD^{tree}")
    entries = source.tree_entries(found)
    roots = spark.createDataFrame([(repo, head)], "repo string, root string")
    below = source.recursive_entries(entries, roots, stored).collect()
    want = subprocess.run(["git", "-C", repo, "ls-tree", "-rtz", "HEAD"], capture_output=True, check=True).stdout.split(b"\0")[:-1]
    assert sorted((r.path, r.object_id) for r in below) == sorted((w.split(b"\t")[1].decode("utf-8", "replace"), w.split()[2].decode()) for w in want)
    tracked = source.tracked_files(entries, roots, MASK, stored).collect()
    assert {r.path for r in tracked} == {"a/b/x.c", "a/y.rs", "n\ufffd.c"}
    refs = {r.ref_name: r for r in source.refs(spark, repo).collect()}
    assert refs["HEAD"].symref == "refs/heads/main" and refs["refs/tags/v1"].object_id == git(repo, "rev-parse", "v1")
    with pytest.raises(Exception, match="git failed"):
        source.refs(spark, "/nowhere").collect()


def test_rewrite(spark, repo, tmp_path):
    out = run(spark, repo, empty(spark), now=7)
    commits = {r.orig_commit: r.new_commit for r in out["commit_map"].collect()}
    assert set(commits) == set(git(repo, "rev-list", "--all").split())
    trees = {r.orig_tree: r.new_tree for r in out["tree_map"].collect()}
    listed = subprocess.run(["git", "-C", repo, "rev-list", "--all", "--objects", "--filter=blob:none"], capture_output=True, check=True).stdout
    assert set(trees) == {line[:40].decode() for line in listed.split(b"\n")[:-1]} - set(commits) - {git(repo, "rev-parse", t) for t in ("v1", "v2")}
    # the same objects made by git itself
    target = tmp_path / "target"
    subprocess.run(["git", "clone", "-q", "--bare", repo, str(target)], check=True)
    blobs = {(r.orig_blob, r.path): r.new_blob for r in out["blob_map"].collect()}
    excluded = [tuple(r) for r in out["exclusions"].collect()]
    assert excluded == [] and ("a.txt" in {p for _, p in blobs})
    x = subprocess.run(["git", "-C", repo, "rev-parse", "side:a/b/x.c"], capture_output=True, check=True).stdout.decode().strip()
    lines = lexers.token_lines("int x = 2;\nint z;\n", "C")
    assert blobs[x, "a/b/x.c"] == git(target, "hash-object", "-w", "--stdin", input=("\n".join(lines) + "\n").encode())
    for content, language in ((b"int x = 1;\n", "C"), (b"fn y() {}\n", "Rust"), (b"int caf\xef\xbf\xbd;\n", "C")):
        git(target, "hash-object", "-w", "--stdin", input=("\n".join(lexers.token_lines(content.decode(), language)) + "\n").encode())
    by_new = {(o, p): n for (o, p), n in blobs.items()}

    def tree(oid, prefix=""):
        rows = subprocess.run(["git", "-C", repo, "ls-tree", "-z", oid], capture_output=True, check=True).stdout.split(b"\0")[:-1]
        lines = []
        for row in rows:
            head, name = row.split(b"\t", 1)
            mode, kind, o = head.decode().split()
            path = prefix + name.decode("utf-8", "replace")
            new = tree(o, path + "/") if kind == "tree" else by_new.get((o, path))
            if new:
                lines.append(f"{mode} {kind} {new}\t".encode() + name + b"\0")
        return git(target, "mktree", "-z", "--missing", input=b"".join(lines))

    for c in commits:
        old = git(repo, "rev-parse", f"{c}^{{tree}}")
        assert trees[old] == tree(old)
    for c, new in commits.items():
        raw = subprocess.run(["git", "-C", repo, "cat-file", "commit", c], capture_output=True, check=True).stdout
        for old, n in {**trees, **commits}.items():
            raw = raw.replace(old.encode(), n.encode())
        message = raw.split(b"\n\n", 1)[1]
        mark = b"\n" if message.rsplit(b"\n\n", 1)[-1].startswith(b"Signed-off-by") else b"\n\n"
        body = raw + mark + f"Former-commit-id: {c}".encode()
        assert new == git(target, "hash-object", "-w", "-t", "commit", "--stdin", input=body)
    refs = {r.ref_name: r for r in out["refs"].collect()}
    assert refs["refs/heads/main"].new_target == commits[git(repo, "rev-parse", "main")] and refs["HEAD"].symref == "refs/heads/main"
    v1 = subprocess.run(["git", "-C", repo, "cat-file", "tag", "v1"], capture_output=True, check=True).stdout
    made = v1.replace(git(repo, "rev-parse", "v1^{}").encode(), commits[git(repo, "rev-parse", "v1^{}")].encode())
    assert refs["refs/tags/v1"].new_target == git(target, "hash-object", "-w", "-t", "tag", "--stdin", input=made)
    assert refs["refs/tags/v2"].orig_commit == git(repo, "rev-parse", "main") and refs["refs/tags/v2"].kind == "annotated_tag" and refs["refs/tags/light"].kind == "lightweight_tag"
    s = out["statistics"].first()
    assert (s.commits_processed, s.commits_already_mapped, s.blobs_cache_hit, s.blobs_tokenized, s.aborted) == (4, 0, 0, 4, False) and s.original_requests == 2
    # a second run over the maps does nothing new, and a run in two parts gives the same
    maps = {k: stored(out[k]) for k in ("blob_map", "tree_map", "commit_map")}
    again = run(spark, repo, maps)
    assert again["statistics"].first().commits_processed == 0 and again["commit_map"].count() == 4
    first = maps | {"commit_map": maps["commit_map"].filter(F.col("orig_commit") == git(repo, "rev-parse", "side~1")), "tree_map": maps["tree_map"].limit(0)}
    part = run(spark, repo, first)
    assert {r.orig_commit: r.new_commit for r in part["commit_map"].collect()} == commits
    assert part["statistics"].first().blobs_cache_hit > 0


def test_exclusions_and_shards(spark, repo):
    found = stored(source.objects(spark, repo))
    blobs, entries, commits = found.filter("kind = 'blob'").select("object_id", "size", "content"), stored(source.tree_entries(found).drop("repo").distinct()), source.commit_objects(found)
    roots = commits.select(F.col("tree").alias("root")).distinct()
    wide = fn.file_mask(("C", "C++", "Java", "Rust", "M4"))
    x = git(repo, "rev-parse", "side:a/b/x.c")
    maps = empty(spark)
    denied = spark.createDataFrame([(x.upper(),)], "object_id string")
    out = rewrite.rewrite_trees(entries, roots, blobs, lexers.lexed, wide, maps["tree_map"], maps["blob_map"], denied=denied, limit=11)
    assert {(r.path, r.exclusion) for r in out["exclusions"].collect()} == {("a/b/x.c", "denylisted"), ("a/b/x.c", "oversized"), ("only/bad.am", "oversized")}
    failing = rewrite.rewrite_trees(entries, roots, blobs, lexers.lexed, wide, maps["tree_map"], maps["blob_map"])
    assert [tuple(r)[1:] for r in failing["exclusions"].collect()] == [("only/bad.am", "tokenizer-error")]
    # a folder with nothing left is the empty tree
    assert "4b825dc642cb6eb9a060e54bf8d69288fbee4904" in {r.new_tree for r in failing["tree_map"].collect()}
    whole = {r.orig_tree: r.new_tree for r in failing["tree_map"].collect()}
    dated = commits.withColumn("autdate", F.col("cid"))
    parts = [rewrite.rewrite_trees(entries, rewrite.shard_of(dated, k, 2).select(F.col("tree").alias("root")), blobs, lexers.lexed, wide, maps["tree_map"], maps["blob_map"]) for k in range(2)]
    merged = mapping.merged_shards([p["tree_map"] for p in parts], ["orig_tree"])
    assert {r.orig_tree: r.new_tree for r in merged.collect()} == whole
    refold = rewrite.fold_commits(commits, merged, maps["commit_map"])
    assert refold.count() == 4
    warm = rewrite.rewrite_trees(entries, roots, blobs, lexers.lexed, wide, maps["tree_map"], maps["blob_map"], warm_trees=merged, warm_blobs=maps["blob_map"])
    assert warm["plan"].count() == 0 and warm["tree_map"].count() == 0
    with pytest.raises(ValueError, match="warm"):
        mapping.warm_maps(maps, {"command": "a", "mask": "b"}, "a", "c")


def test_fold_refuses_lost_parents(spark):
    rows = [("r", "b", "t", ["a"], b"A <a> 5 +0000"), ("r", "c", "t", ["b"], b"A <a> 4 +0000")]
    commits = spark.createDataFrame([(*x[:4], x[4], x[4], None, b"m") for x in rows], "repo string, cid string, tree string, parents array<string>, author binary, committer binary, encoding binary, message binary")
    maps = empty(spark)
    trees = spark.createDataFrame([("t", "u", 0)], "orig_tree string, new_tree string, processed_at long")
    with pytest.raises(Exception, match="wait for parents"):
        rewrite.fold_commits(commits, trees, maps["commit_map"]).collect()
    known = spark.createDataFrame([("r", "a", "n", 0)], "repo string, orig_commit string, new_commit string, processed_at long")
    assert rewrite.fold_commits(commits, trees, known).count() == 2
    with pytest.raises(Exception, match="no new id"):
        rewrite.fold_commits(commits, trees.limit(0), known).collect()


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 13).alias("k"), "id")
    got = ordering.numbered(df, [F.desc("k"), "id"], "n", 5).collect()
    assert [(r.k, r.id) for r in sorted(got, key=lambda r: r.n)] == sorted(((r.k, r.id) for r in got), key=lambda x: (-x[0], x[1])) and sorted(r.n for r in got) == list(range(1000))


def test_publish_is_all_or_nothing(spark):
    base = f"{shared_folder(spark)}/maps"
    assert latest(spark, base) == 0
    assert publish(spark, {"a": spark.range(3), "b": spark.range(2)}, base) == 1
    with pytest.raises(Exception):
        publish(spark, {"a": spark.range(9), "b": spark.range(2).select(F.raise_error(F.lit("no")))}, base)
    assert latest(spark, base) == 1 and published(spark, base, "a").count() == 3
    assert publish(spark, {"a": spark.range(5), "b": spark.range(2)}, base) == 2 and published(spark, base, "a").count() == 5 and published(spark, base, "a", 1).count() == 3


def test_memo_and_identity(spark, tmp_path):
    path = str(tmp_path / "memo")
    assert mapping.read_memo(spark, path).isEmpty()
    files = spark.createDataFrame([("a.c", bytearray(b"int x;")), ("b.am", bytearray(b"["))], "path string, content binary")
    mapping.append_memo(lexers.tokenized(files), path)
    memo = mapping.read_memo(spark, path)
    assert [r.ext for r in memo.collect()] == ["c"]
    blobs = files.select(F.sha1("content").alias("content_sha"), F.substring_index("path", ".", -1).alias("ext"), "content")
    asked = []
    got = mapping.memoised(blobs, memo, lambda new: (asked.append(new.count()), lexers.lexed(new))[1]).collect()
    assert asked == [1] and {(r.ext, r.status) for r in got} == {("c", "ok"), ("am", "tokenizer-error")}
    m = spark.createDataFrame([("1", "a.c", "2", 0), ("3", "b.rs", "4", 0), ("5", "c.txt", "5", 0)], "orig_blob string, path string, new_blob string, processed_at long")
    objects = spark.createDataFrame([("2",)], "object_id string")
    assert mapping.widened(m, "x", "x").count() == 3 and mapping.widened(m, fn.file_mask(), fn.file_mask(("C", "Rust", "M4")), objects.union(spark.createDataFrame([("4",)]))).count() == 2
    with pytest.raises(ValueError, match="lacks 4"):
        mapping.widened(m, fn.file_mask(), fn.file_mask(("C", "Rust", "M4")), objects)
    assert mapping.retokenized(m, ["rs"], ["rs"], objects).count() == 2  # the row that goes may dangle
    with pytest.raises(ValueError, match="lacks 2"):
        mapping.retokenized(m, ["rs"], [], objects.filter("object_id = 'x'"))
    with pytest.raises(ValueError, match="another project"):
        mapping.retokenized(m, ["rs"], [], purge={"examined": 3, "deleted": 0}, own_memo=False)
    assert mapping.emptied({"blob_map": m, "tree_map": m}, m.limit(1))["tree_map"].isEmpty()
    left = mapping.purged(memo, spark.createDataFrame([("1", "a.c", "2")], "orig_blob string, path string, new_blob string"), spark.createDataFrame([("1", bytearray(b"int x;"))], "object_id string, content binary"), ["c"])
    assert left.isEmpty()
    digest = mapping.tokenizer_identity({"c": [b"x", b"y"]})["c"]
    rows = spark.createDataFrame([("c", 2, bytearray(b"y")), ("c", 1, bytearray(b"x"))], "ext string, seq int, content binary")
    assert mapping.identity_digests(rows).first().digest == digest and mapping.parse_identity(f"c={digest}") == {"c": digest}


# ---- blame ----


@pytest.fixture(scope="module")
def blamed(tmp_path_factory):
    path = tmp_path_factory.mktemp("blamed")
    git(path, "init", "-q")
    block = "".join(f"int function_number_{i}(int value) {{ return value * {i}; }}\n" for i in range(12))
    (path / "old.c").write_text("int first;\n" + block)
    git(path, "add", ".")
    git(path, "commit", "-qm", "one")
    one = git(path, "rev-parse", "HEAD")
    (path / "old.c").write_text("int first;\n")
    (path / "new file;.c").write_text("int second;\n" + block)
    git(path, "add", ".")
    git(path, "commit", "-qm", "two")
    return str(path), one, git(path, "rev-parse", "HEAD")


def test_blame_credits_the_writer(spark, blamed, tmp_path):
    path, one, two = blamed
    files = spark.createDataFrame([(path, "old.c", 11, 0), (path, "new file;.c", 700, 1), (path, "none.c", 5, 2)], "repo string, path string, size long, ordinal int")
    got = {r.file_path: r for r in blame.blame_files(files).collect()}
    assert got["none.c"].how == "failed" and got["none.c"].content is None
    lines = bytes(got["new file;.c"].content).decode().split("\n")[:-1]
    assert lines[0] == f"{two};;\tint second;" and lines[1].startswith(f"{one};old.c;\tint function_number_0") and len(lines) == 13
    plain = blame.blame_one(path, "new file;.c", ())
    assert plain[0] == "copies" and plain[1].decode().split("\n")[1].startswith(two)
    assert blame.blame_one(path, "new file;.c", limit=0)[0] == "plain"


def test_blame_limit_interrupts(blamed, tmp_path, monkeypatch):
    """A blame that says nothing, and one that says much on the other stream, end by the limit or by themselves."""
    path, _, two = blamed
    real = shutil.which("git")
    script(tmp_path / "git", f"""import os, sys, time
if any(a.startswith("-C1") for a in sys.argv):
    sys.stderr.write("x" * 300_000) and sys.stderr.flush()
    time.sleep(60)
os.execv({real!r}, sys.argv)""")
    monkeypatch.setitem(source.ENVIRONMENT, "PATH", f"{tmp_path}:{os.environ['PATH']}")
    began = time.monotonic()
    how, records = blame.blame_one(path, "new file;.c", limit=2.0)
    assert how == "plain" and records.decode().split("\n")[1].startswith(two) and time.monotonic() - began < 30


def test_blame_tables(spark, blamed, tmp_path):
    path, one, two = blamed
    files = spark.createDataFrame([(path, "old.c", 11, 0), (path, "new file;.c", 700, 1), (path, "none.c", 5, 2)], "repo string, path string, size long, ordinal int")
    table = blame.records_table(blame.blame_files(files)).filter("file_path = 'old.c'").collect()
    assert [(r.line_no, r.line) for r in table] == [(0, f"{one};;\tint first;")]
    out = str(tmp_path / "out")
    assert {tuple(r) for r in blame.publish_blame(blame.blame_files(files), out).collect()} == {("old.c", "written"), ("new file;.c", "written")}
    assert (tmp_path / "out/old.c.blame").read_text() == f"{one};;\tint first;\n"
    done = blame.publish_blame(blame.blame_files(files, command=lambda *_: ("own", b"x")), out)
    assert {r.status for r in done.filter("file_path <> 'none.c'").collect()} == {"done"} and (tmp_path / "out/none.c.blame").read_text() == "x"
    assert {r.status for r in blame.publish_blame(blame.blame_files(files), out, overwrite=True).collect()} == {"written"}
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.endswith(".part")]


def test_moved_blocks_without_git(spark, blamed):
    path, one, two = blamed
    old = git(path, "show", f"{one}:old.c").split("\n")
    new = git(path, "show", f"{two}:new file;.c").split("\n")
    rows = [("old.c", i, t, True) for i, t in enumerate(old)] + [("new.c", i, t, False) for i, t in enumerate(new)] + [("other.c", 3, "}", True)]
    moved = blame.moved_blocks(spark.createDataFrame(rows, "file_path string, line_no int, text string, parent boolean"))
    assert [tuple(r) for r in moved.collect()] == [("new.c", 1, 12, "old.c", 1)]
    added = spark.createDataFrame([("new.c", i, two) for i in range(len(new))], "file_path string, line_no int, commit_sha string")
    owners = spark.createDataFrame([("old.c", i, one) for i in range(len(old))], "file_path string, line_no int, commit_sha string")
    got = {r.line_no: (r.commit_sha, r.old_path) for r in blame.credited(added, moved, owners).collect()}
    assert got == {i: (one, "old.c") if i else (two, "") for i in range(len(new))}


def test_porcelain_quotes():
    lines = [b"a" * 40 + b" 1 1 1", b'filename "caf\\303\\251.c"', b"\tint a;", b"b" * 40 + b" 1 2 1", b"filename other;name.c", b"\tx", b"a" * 40 + b" 3 3", b"\ty"]
    records = list(blame.porcelain_records(iter(lines), "café.c".encode()))
    assert records == [b"a" * 40 + b";;\tint a;", b"b" * 40 + b";other;name.c;\tx", b"a" * 40 + b";;\ty"]
    assert fn.unquote_bytes(b'"a\\tb\\\\"') == b"a\tb\\"


# ---- commands and options ----


def script(path, text):
    path.write_text(f"#!{sys.executable}\n{text}")
    path.chmod(path.stat().st_mode | stat.S_IXUSR)
    return str(path)


def test_commands(spark, tmp_path):
    echo = script(tmp_path / "echo", "import sys, os\nt = sys.stdin.buffer.read()\nsys.exit(33) if b'crash' in t else sys.exit(3) if b'bad' in t else None\nsys.stdout.buffer.write(t if b'same' in t else b'tokens of ' + os.environ['BFG_FILENAME'].encode() + b'\\n')")
    slow = script(tmp_path / "slow", "import subprocess, time\nsubprocess.Popen(['sleep', '60'])\ntime.sleep(60)")
    began = time.monotonic()
    done = commands.run([slow], b"", 1)
    assert done.killed and time.monotonic() - began < 8
    assert commands.run([echo], b"bad", 5).status == 3
    rows = spark.createDataFrame([(w, "c", bytearray(w.encode())) for w in ("crash", "bad", "same", "other")], "content_sha string, ext string, content binary")
    got = {r.content_sha: (r.status, r.tokens) for r in lexers.by_command([echo], 20)(rows).collect()}
    assert got == {"crash": ("parser-crash", None), "bad": ("tokenizer-error", None), "same": ("skip", None), "other": ("ok", ["tokens of content.c"])}


def test_worker(spark, tmp_path):
    worker = script(tmp_path / "worker", """import sys, time
i, o = sys.stdin.buffer, sys.stdout.buffer
o.write(b"READY\\n"); o.flush()
while head := i.readline().split():
    n, m, s = map(int, head[1:])
    name, body = i.read(m), i.read(n)
    if body == b"die": sys.exit(1)
    if body == b"hang": time.sleep(60)
    out = b"" if body == b"bad" else name + b":" + body.upper()
    o.write(b"RES %d %d 3\\n" % (2 if body == b"bad" else 0, len(out)) + out + b"err"); o.flush()
""")
    w = commands.Worker([worker])
    assert w.ask("a.c", b"x" * 200_000, 5).out == b"a.c:" + b"X" * 200_000 and w.ask("b", b"bad", 5).status == 2
    assert w.ask("c", b"die", 5).killed and w.ask("d", b"y", 5).out == b"d:Y"  # started anew
    late, commands.LATE = commands.LATE, 0.2
    try:
        assert w.ask("e", b"hang", 1).killed
    finally:
        commands.LATE = late
    w.close()
    rows = spark.createDataFrame([(str(i), "c", bytearray(f"t{i}".encode())) for i in range(9)], "content_sha string, ext string, content binary").repartition(2)
    assert {(r.status, tuple(r.tokens)) for r in lexers.by_worker([worker])(rows).collect()} == {("ok", (f"content.c:T{i}",)) for i in range(9)}
    assert mapping.outcome_of(False, 0, b"", b"x") == "parser-crash" and mapping.outcome_of(False, -11, b"", b"x") == "parser-crash" and mapping.outcome_of(False, 2, b"", b"x", True) == "abort"


def test_watchdog(spark):
    import pandas as pd

    def sleep(batches):
        time.sleep(30)
        yield from batches

    told = []
    with pytest.raises(Exception):
        with commands.Watchdog(spark, "stalled", 2, told.append, 0.3) as dog:
            spark.range(1).mapInPandas(sleep, "id long").collect()
    assert dog.stalled and told and pd is not None
    with commands.Watchdog(spark, "fine", 60) as dog:
        assert spark.range(5).count() == 5
    assert not dog.stalled
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert commands.stall_window(600) == 1800 and commands.stall_window(4000) == 12000
    with pytest.raises(ValueError):
        commands.stall_window(600, 100, True)


# ---- sinks and pages ----


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "x.db")
    df = spark.range(25).select("id", F.concat(F.lit("v"), "id").alias("v"))
    assert sinks.write_sqlite(df, path, "t", ["id"], window=10) == 25 and sinks.write_sqlite(df.limit(7), path, "t") == 7
    with pytest.raises(Exception):
        sinks.write_sqlite(df.select(F.raise_error(F.lit("no")).alias("id")), path, "t")
    with sqlite3.connect(path) as db:
        assert db.execute("SELECT count(*) FROM t").fetchone() == (7,)
    assert readers.sqlite_table(spark, path, "t", 4).count() == 7
    ids = spark.createDataFrame([("Ann Lee", "ann lee", "a@x", "a@x", "a", "x", 2, 1, 3, "ann lee"), ("Al", "al at a@x", "a@x", "a@x", "a", "x", 1, 0, 1, "ann lee")], "name string, name_key string, email string, lcemail string, userid string, domain string, authored long, committed long, total long, personid string")
    book = str(tmp_path / "x.xlsx")
    sinks.write_spreadsheet({"identities": identity.identities_sheet(ids).orderBy("row"), "stats & more": identity.stats_sheet(ids)}, book)
    with zipfile.ZipFile(book) as z:
        sheet, stats = (z.read(f"xl/worksheets/sheet{i}.xml").decode() for i in (1, 2))
        assert z.testzip() is None and "stats &amp; more" in z.read("xl/workbook.xml").decode()
    assert sheet.count("<row>") == 3 and sheet.index("Ann Lee") < sheet.index(">Al<") and "<v>4</v>" in stats
    tokens = spark.createDataFrame([("d/a.c", ["x|y", "z"])], "file_path string, tokens array<string>")
    assert sinks.write_token_files(tokens, str(tmp_path / "t")).first().status == "written" and (tmp_path / "t/d/a.c.token").read_text() == "x|y\nz\n"
    assert write_files(tokens.select("file_path", F.lit("new").alias("content")), str(tmp_path / "t"), ".token").first().status == "done"


def test_site(spark, tmp_path):
    rows = [("a.c", 0, "DECL", "function|f", 1, ""), ("a.c", 1, "name", "x", 0, "x<"), ("b.c", 0, "name", "y", 0, "y"), ("c.txt", 0, "name", "z", 0, "z"), ("e.c", 0, "name", "z", 0, "z")]
    rows = spark.createDataFrame([(*r, "o", "p", "d", "s", "Ann", "ann", "k") for r in rows], "file_path string, token_index int, token_type string, token_value string, is_structural int, source_text string, original string, repo string, autdate string, summary string, personname string, personid string, commit_sha string")
    files = spark.createDataFrame([("a.c", 5), ("b.c", 5), ("c.txt", 5), ("d.c", 5), ("e.c", 0)], "file_path string, size long")
    root = str(tmp_path / "site")
    status = render.write_site(rows, contributors.colours(rows), files, MASK, root)
    assert {tuple(r) for r in status.collect()} == {("a.c", "written"), ("b.c", "written"), ("c.txt", "masked"), ("d.c", "no-blame"), ("e.c", "empty")}
    assert render.site_summary(status) == {"written": 2, "done": 0, "skipped": 3}
    page = (tmp_path / "site/a.c.html").read_text()
    assert "x&lt;" in page and "<td>Ann</td><td>1</td><td>100.00%</td><td>1</td>" in page and "<td>Total</td>" in page and page.endswith("</html>")
    again = render.write_site(rows, contributors.colours(rows), files, MASK, root, make=lambda r, c: r.select("file_path").distinct().withColumn("html", F.lit("own")))
    assert render.site_summary(again)["done"] == 2 and (tmp_path / "site/a.c.html").read_text() == page
    totals = contributors.with_totals(contributors.file_report(rows), ["file_path"]).filter("file_path = 'a.c'").orderBy("place").collect()
    assert [(r.person, r.tokens) for r in totals] == [("Ann", 1), ("Total", 1)]


def test_pages_are_made_once(spark, tmp_path):
    """The status of skipped files does not have all pages made again, and masked files have none made."""
    made = spark.sparkContext.accumulator(0)

    def look(rows, colours):
        def run(batches):
            for b in batches:
                made.add(b.num_rows)
                yield b

        return rows.select("file_path", F.lit("own").alias("html")).mapInArrow(run, "file_path string, html string")

    rows = spark.createDataFrame([(f"{i}.{e}", "Ann", "ann") for i in range(10) for e in ("c", "txt")], "file_path string, personname string, personid string")
    files = rows.select("file_path", F.lit(5).alias("size"))
    status = render.write_site(rows, rows.select("file_path"), files, MASK, str(tmp_path / "site"), make=look)
    assert render.site_summary(status) == {"written": 10, "done": 0, "skipped": 10} and made.value == 10


# ---- grammar ----


def test_grammar_names_elements():
    text = "/* c */\n#include <a.h>\n#define M(x) x \\\n  + 1\nstruct S { int a; };\nstatic int count = 0, *p;\nint main(int argc, char *argv[]) {\n  for (i=0; i<3; i++) if (argc > 1) { f(argv[1]); } else return -1;\n}\nint proto(void);\n"
    got = [(t, v) for _, _, t, v in grammar.elements(text, "C")]
    marks = [t for t, v in got if t.startswith("begin_")]
    assert marks == ["begin_comment", "begin_include", "begin_define", "begin_struct", "begin_decl_stmt", "begin_function", "begin_function_decl"]
    for one in (("file", "<a.h>"), ("parameter_list", "("), ("control", "("), ("init", ";"), ("condition", ";"), ("condition", "("), ("argument_list", ")"), ("index", "["), ("expr_stmt", ";"), ("else", "else"), ("return", ";"), ("modifier", "*"), ("specifier", "static"), ("block", "{"), ("decl_stmt", ",")):
        assert one in got, one
    assert grammar.declared(text, "C") == [(3, "macro", "M"), (5, "struct", "S"), (6, "variable", "count"), (7, "function", "main (int argc,char * argv[])"), (10, "prototype", "proto (void)")]
    assert grammar.symbols(text, "C")[1] == "function;main;;(int argc,char * argv[])"
    java = "package a.b;\nimport c.*;\nclass Foo {\n  int x = 1;\n  void m(String s) { x++; }\n}\n"
    assert [t for _, _, t, _ in grammar.elements(java, "Java") if t.startswith("begin_")] == ["begin_package", "begin_import", "begin_class"]
    assert grammar.declared(java, "Java") == [(3, "class", "Foo"), (4, "field", "x"), (5, "method", "m (String s)")]


def test_functions_of_lexed_sources(spark):
    """The grammar's markers make function reports of real sources."""
    lines = lexers.token_lines("int a;\nint f(void) { return 1; }\nint g(void) { return 2; }\n", "C")
    blame_rows = spark.createDataFrame([("a.c", i, f"k;;\t{t}") for i, t in enumerate(lines)], "file_path string, line_no int, line string")
    from tokentrail.operators import dataset

    tokens = dataset.token_rows(blame_rows).withColumns({"personname": F.lit("Ann"), "personid": F.lit("ann")})
    report = contributors.function_report(tokens).orderBy("func_no").collect()
    assert [(r.func_no, r.tokens) for r in report] == [(1, 10), (2, 10)]
    sources = spark.createDataFrame([("a.c", "int a;\nint f(void) { return 1; }\nint g(void) { return 2; }\n", True)], "file_path string, text string, repairable boolean")
    placed = walk.aligned(dataset.token_rows(blame_rows), sources).filter("is_structural = 0").orderBy("token_index").collect()
    assert "".join(r.source_text for r in placed) == sources.first().text
    want = [(a, b) for a, b, _, v in lexers.LEXERS["C"](sources.first().text) if a]
    assert [(r.source_line, r.source_col) for r in placed] == want


def test_repair_counters(spark):
    tokens = spark.createDataFrame([("a.c", 0, "name", "Ã¶x", 0, True), ("a.c", 1, "name", "ok", 0, False)], "file_path string, token_index int, token_type string, token_value string, is_structural int, position_prefix boolean")
    sources = spark.createDataFrame([("a.c", "öx ok", True, False), ("b.c", "", False, True)], "file_path string, text string, repairable boolean, had_bom boolean")
    assert tuple(walk.repair_counters(walk.repaired(tokens, sources), sources).first()) == (1, 1, 1)
    paths = spark.createDataFrame([('"a\\303\\266"',), ("b",), (None,)], "p string")
    assert [r.p for r in paths.select(fn.unquoted_path("p").alias("p")).collect()] == ["aö", "b", None]


def test_spans_do_not_move(spark):
    """Tokens of a page move by file, not their spans, and not once more by person; pages of odd ids and unknown colours."""
    rows = [("a.c", i, "name", f"t{i}", 0, f"t{i}", o, "p", "d", None, "Ann" if i % 2 else None, None, "k") for i, o in enumerate(["ab" * 20, "x", None])]
    rows = spark.createDataFrame(rows, "file_path string, token_index int, token_type string, token_value string, is_structural int, source_text string, original string, repo string, autdate string, summary string, personname string, personid string, commit_sha string")
    colours = spark.createDataFrame([("a.c", "Ann", 7), ("b.c", "Unknown", 9)], "file_path string, person string, colour int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = render.pages(rows, colours)
        plan = made._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line.split("hashpartitioning(", 1)[1].split(", ")[0].split("#")[0] for line in plan.split("\n") if "Exchange hashpartitioning(" in line]
    assert moved == ["file_path", "file_path"] and "person#" not in "".join(line for line in plan.split("\n") if "Exchange hashpartitioning(" in line)
    span = lambda c, title, o, t: f'<span class="c{c}" title="{title}" onclick="windowPre(\'{o}\')">{t}</span>'
    assert made.first().html == "<html><title>a.c</title><pre>" + span(0, "ab" * 20 + ";Unknown;d", "ab" * 20, "t0") + span(7, "x;Ann;d", "x", "t1") + "</pre></html>"
