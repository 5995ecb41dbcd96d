"""The log of maps, runs that go on from it, and history tables from objects."""

import os
import random
import subprocess
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.test_objects import listed
from tests.test_rewrite import ENV, MASK, git
from tokentrail import maplog
from tokentrail.operators import lexers, rewrite
from tokentrail.sources import commits as from_objects
from tokentrail.sources import git as source
from tokentrail.sources import packs, readers
from tokentrail.store import stored

MAP = "orig_tree string, new_tree string, processed_at long"


def trees(spark, numbers, at=0):
    return spark.createDataFrame([(f"t{i}", f"n{i}-{at}", at) for i in numbers], MAP)


def test_appends_write_what_is_new(spark, tmp_path):
    base = str(tmp_path / "log")
    assert maplog.read(spark, base, "tree_map") is None
    total = 0
    for run in range(12):
        found = maplog.append(spark, base, {"tree_map": trees(spark, range(20 * run, 20 * run + 25), run)})  # five are known next time
        total += found["tree_map"]
    rows = {r.orig_tree: r for r in maplog.read(spark, base, "tree_map").collect()}
    assert len(rows) == 245 and rows["t20"].new_tree == "n20-0" and maplog.read(spark, base, "tree_map").count() == 245
    assert total < 245 * 4 and len(maplog.manifest(base)["segments"]["tree_map"]) <= 4  # all maps anew each time would be 1,620
    assert maplog.read(spark, base, "tree_map", 2).count() == 45
    # nothing new: nothing is added
    assert maplog.append(spark, base, {"tree_map": trees(spark, range(30), 99)}) == {"tree_map": 0}
    segments = os.listdir(tmp_path / "log/segments")
    assert maplog.vacuum(spark, base) > 0 and len(os.listdir(tmp_path / "log/segments")) < len(segments) and maplog.read(spark, base, "tree_map").count() == 245


def test_a_version_is_whole_or_not_there(spark, tmp_path):
    base = str(tmp_path / "log")
    both = {"tree_map": trees(spark, range(5)), "blob_map": spark.createDataFrame([("b", "p", "n", 0)], "orig_blob string, path string, new_blob string, processed_at long")}
    maplog.append(spark, base, both)
    with pytest.raises(Exception, match="killed"):
        maplog.append(spark, base, {"tree_map": trees(spark, range(9)), "blob_map": both["blob_map"].withColumn("new_blob", F.raise_error(F.lit("killed"))).withColumn("path", F.lit("other"))})
    assert maplog.manifest(base)["version"] == 1 and maplog.read(spark, base, "tree_map").count() == 5
    # another writer was first
    create = maplog._create

    def late(spark, path, text):
        create(spark, path, text)
        create(spark, path, "{}")

    maplog._create = late
    try:
        with pytest.raises(maplog.Conflict):
            maplog.append(spark, base, {"tree_map": trees(spark, range(9))})
    finally:
        maplog._create = create
    assert maplog.read(spark, base, "tree_map").count() == 9 and not [f for f in os.listdir(tmp_path / "log/manifests") if not f.endswith(".json")]


def parts_of(spark, path):
    found = stored(packs.objects(spark, f"{path}/.git"))
    refs = source.refs(spark, path).withColumn("repo", F.lit(f"{path}/.git"))
    return source.commit_objects(found), stored(source.tree_entries(found).drop("repo").distinct()), found.filter("kind = 'blob'").select("object_id", "size", "content"), refs, source.tag_objects(found), lexers.lexed, MASK


def test_runs_go_on_from_the_log(spark, tmp_path):
    """A run that dies after its objects is repeated; later runs add what is new; in the end all is as in one run."""
    repo, base, target = (str(tmp_path / x) for x in ("repo", "log", "target"))
    os.mkdir(repo)
    git(repo, "init", "-q", "-b", "main")

    def commit(n):
        Path(repo, "a.c").write_text(f"int a{n};\n")
        Path(repo, f"d{n}").mkdir()
        Path(repo, f"d{n}/b.rs").write_text("fn b() {}\n")
        git(repo, "add", ".")
        git(repo, "commit", "-qm", f"commit {n}")

    commit(0)
    commit(1)
    append, maplog.append = maplog.append, lambda *_: (_ for _ in ()).throw(RuntimeError("killed"))
    try:
        with pytest.raises(RuntimeError):
            rewrite.rewrite_into(base, target, *parts_of(spark, repo))
    finally:
        maplog.append = append
    assert maplog.manifest(base)["version"] == 0 and not git(target, "for-each-ref")
    objects = listed(target)
    rewrite.rewrite_into(base, target, *parts_of(spark, repo))
    assert listed(target) == objects and maplog.read(spark, base, "commit_map").count() == 2
    commit(2)
    out = rewrite.rewrite_into(base, target, *parts_of(spark, repo))
    assert out["statistics"].first().commits_processed == 1 and out["objects"].count() < len(listed(target))
    subprocess.run(["git", "-C", target, "fsck", "--full", "--strict"], check=True, env=ENV, capture_output=True)
    known = {r.orig_commit: r.new_commit for r in maplog.read(spark, base, "commit_map").collect()}
    assert git(target, "rev-parse", "main") == known[git(repo, "rev-parse", "main")]
    whole = str(tmp_path / "whole")
    rewrite.rewrite_into(str(tmp_path / "other"), whole, *parts_of(spark, repo))
    assert git(whole, "rev-parse", "main") == git(target, "rev-parse", "main") and set(listed(whole)) <= set(listed(target))
    before = maplog.manifest(base)["version"]
    rewrite.rewrite_into(base, target, *parts_of(spark, repo))
    assert maplog.manifest(base)["version"] == before


def test_history_from_objects(spark, tmp_path):
    """The tables are those that the log command gives."""
    repo = str(tmp_path)
    git(repo, "init", "-q", "-b", "main")
    messages = ["One\n\nbody\n\nSigned-off-by: A <a@x>\nReviewed-by: B\n  C <b@x>\n", "Subject\nof two lines\n\nNot: a trailer\n\nlast words", "Only: subject", "Dr\xe4i\n\nAcked-by: \xe4 <c@x>"]
    for i, m in enumerate(messages):
        more = ["-c", "i18n.commitEncoding=ISO-8859-1"] if i == 3 else []
        git(repo, *more, "commit", "--allow-empty", "-qF", "-", input=m.encode("latin-1"))
    git(repo, "checkout", "-qb", "side", "HEAD~2")
    git(repo, "commit", "--allow-empty", "-qm", "side")
    git(repo, "checkout", "-q", "main")
    git(repo, "merge", "-q", "side", "-m", "Merge")
    git(repo, "tag", "-a", "v1", "-m", "x", "side")
    git(repo, "branch", "-qD", "side")
    git(repo, "commit", "--allow-empty", "-qm", "lost")
    git(repo, "reset", "-q", "--hard", "HEAD~1")
    got, want = from_objects.history(spark, f"{repo}/.git"), readers.git_history(spark, repo)
    for name in want:
        rows = sorted(map(tuple, got[name].select(*want[name].columns).collect()))
        assert rows == sorted(map(tuple, want[name].collect())), name
    assert got["commits"].count() == 6


def test_reached(spark):
    rng = random.Random(3)
    edges = [(f"c{i}", k, f"c{rng.randrange(max(0, i - 4), i)}") for i in range(1, 80) for k in range(rng.choice([1, 1, 2]))]
    of = {}
    for c, _, p in edges:
        of.setdefault(c, set()).add(p)
    tips, seen = ["c79", "c40", "c7"], set()
    todo = list(tips)
    while todo:
        c = todo.pop()
        if c not in seen:
            seen.add(c)
            todo += of.get(c, ())
    got = from_objects.reached(spark.createDataFrame([(t,) for t in tips], "cid string"), spark.createDataFrame(edges, "cid string, idx int, parent string"))
    assert sorted(r.cid for r in got.collect()) == sorted(seen)
