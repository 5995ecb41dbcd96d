"""Tree assembly, order of commits, moved blocks, and objects in packs."""

import hashlib
import os
import random
import subprocess
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.test_rewrite import ENV, MASK, empty, git
from tokentrail.operators import blame, history, lexers, ownership, rewrite
from tokentrail.plans import history_queries
from tokentrail.sources import git as source
from tokentrail.sources import packs
from tokentrail.store import stored

ENTRY = "tree string, name binary, mode string, object_id string"


# ---- trees ----


def random_trees(seed):
    """A directed graph of trees: any may hold any of a smaller number, so trees stand on many levels."""
    rng = random.Random(seed)
    blobs = [hashlib.sha1(f"b{i}".encode()).hexdigest() for i in range(9)]
    ids, rows = [], []
    for i in range(25):
        entries = {f"f{k}.c".encode(): ("100644", rng.choice(blobs)) for k in range(rng.randint(0 if i else 1, 3))}
        if ids:
            entries |= {f"d{k}".encode(): ("40000", rng.choice(ids)) for k in range(rng.randint(1, 3))}
        body = b"".join(m.encode() + b" " + n + b"\0" + bytes.fromhex(o) for n, (m, o) in sorted(entries.items(), key=lambda e: e[0] + (b"/" if e[1][0] == "40000" else b"")))
        oid = history.git_object_id("tree", body)
        if oid not in ids:
            ids.append(oid)
            rows += [(oid, n, m, o) for n, (m, o) in entries.items()]
    return ids, rows, blobs


@pytest.mark.parametrize("seed", [1, 2])
def test_trees_that_stand_on_several_levels(spark, seed):
    ids, rows, blobs = random_trees(seed)
    entries = spark.createDataFrame(rows, ENTRY)
    maps = empty(spark)
    roots = spark.createDataFrame([(i,) for i in ids[-6:]], "root string")
    plan = stored(rewrite.plan_trees(entries, roots, r"\.c$", maps["tree_map"], maps["blob_map"]))
    same = plan.filter("plan = 'miss'").select(F.col("object_id").alias("orig_blob"), "path", F.col("object_id").alias("new_blob")).distinct()
    made = {r.orig_tree: r.new_tree for r in rewrite.assemble(plan, same, maps["tree_map"]).collect()}
    assert made and made == {t: t for t in made}  # every tree is made again as it was
    # with other blobs, as a plain recursion has it
    new = {b: hashlib.sha1(b.encode()).hexdigest() for b in blobs if b != blobs[0]}
    of = {}
    for t, n, m, o in rows:
        of.setdefault(t, []).append((n, m, o))

    def plain(t):
        named = [(n, m, plain(o) if m == "40000" else new.get(o)) for n, m, o in of[t]]
        body = b"".join(m.encode() + b" " + n + b"\0" + bytes.fromhex(o) for n, m, o in sorted(named, key=lambda e: e[0] + (b"/" if e[1] == "40000" else b"")) if o)
        return history.git_object_id("tree", body)

    other = same.filter(F.col("orig_blob") != blobs[0]).withColumn("new_blob", F.sha1(F.col("orig_blob").cast("binary")))
    assert {r.orig_tree: r.new_tree for r in rewrite.assemble(plan, other, maps["tree_map"]).collect()} == {t: plain(t) for t in made}


def test_one_folder_in_two_places(spark):
    leaf, child = "a" * 40, "c" * 40
    rows = [("r" * 40, b"t", "40000", leaf), ("r" * 40, b"x", "40000", child), (child, b"t", "40000", leaf), (leaf, b"f.txt", "100644", "b" * 40), ("e" * 40, b"none", "40000", rewrite.EMPTY_TREE)]
    maps = empty(spark)
    run = lambda rows, root: rewrite.assemble(rewrite.plan_trees(spark.createDataFrame(rows, ENTRY), spark.createDataFrame([(root,)], "root string"), MASK, maps["tree_map"], maps["blob_map"]), maps["blob_map"], maps["tree_map"], bodies=True)
    made = {r.orig_tree: r for r in run(rows, "r" * 40).collect()}
    assert bytes.fromhex(made[leaf].new_tree) in bytes(made[child].body) and bytes(made["r" * 40].body).count(bytes.fromhex(made[leaf].new_tree)) == 1
    assert run(rows, "e" * 40).first().body == b"40000 none\0" + bytes.fromhex(rewrite.EMPTY_TREE)
    with pytest.raises(ValueError, match="not among the entries"):
        run([r for r in rows if r[0] != child], "r" * 40)
    with pytest.raises(ValueError, match="hold each other"):
        run([("r" * 40, b"x", "40000", child), (child, b"y", "40000", "r" * 40)], "r" * 40)


# ---- the order of commits ----


def corrected(commits, edges):
    at, parents = dict(commits), {}
    for c, _, p in edges:
        parents.setdefault(c, []).append(p)
    done = {}
    for c in sorted(at, key=lambda c: int(c[1:])):  # numbers follow the graph
        done[c] = max([at[c], *(done[p] + 1 for p in parents.get(c, []) if p in done)])
    return done


@pytest.mark.parametrize("seed", [0, 1])
def test_parents_come_first(spark, seed):
    rng = random.Random(seed)
    commits = [(f"c{i}", rng.randint(0, 40)) for i in range(60)]
    edges = [(f"c{i}", k, f"c{rng.randrange(i)}") for i in range(1, 60) for k in range(rng.choice([1, 1, 2]))] + [("c3", 5, "elsewhere")]
    frames = spark.createDataFrame(commits, "cid string, at long"), spark.createDataFrame(edges, "cid string, idx int, parent string")
    got = {r.cid: r.at for r in history.corrected_dates(*frames).collect()}
    assert got == corrected(commits, edges)
    place = {r.cid: r.ordinal for r in history.ordinals(frames[0].select("cid", F.lit("2020-01-01").alias("autdate")), frames[1]).collect()}
    assert sorted(place.values()) == list(range(60)) and all(place[p] < place[c] for c, _, p in edges if p in place)


def test_a_long_row_of_equal_dates(spark):
    """A chain is settled by doubling, not a round a commit; a circle is found."""
    n = 400
    commits, edges = [(f"c{i}", 5) for i in range(n)], [(f"c{i}", 0, f"c{i - 1}") for i in range(1, n)]
    frames = spark.createDataFrame(commits, "cid string, at long"), spark.createDataFrame(edges, "cid string, idx int, parent string")
    assert {r.cid: r.at for r in history.corrected_dates(*frames, every=2).collect()} == {f"c{i}": 5 + i for i in range(n)}
    circle = spark.createDataFrame([("a", 0, "b"), ("b", 0, "a")], "cid string, idx int, parent string")
    with pytest.raises(ValueError, match="parents of each other"):
        history.corrected_dates(spark.createDataFrame([("a", 1), ("b", 2)], "cid string, at long"), circle, every=100)


def test_rounds_take_moved_commits_only(spark, monkeypatch):
    """A few commits that are moved round after round do not have all others written again."""
    n, rows = 500, []
    keep = history.stored

    def counted(df, name="table"):
        out = keep(df, name)
        rows.append(out.count())
        return out

    monkeypatch.setattr(history, "stored", counted)
    commits = [(f"c{i}", 5 if i < 20 else 1000 + i) for i in range(n)]
    edges = [(f"c{i}", 0, f"c{i - 1}") for i in range(1, n)]
    frames = spark.createDataFrame(commits, "cid string, at long"), spark.createDataFrame(edges, "cid string, idx int, parent string")
    got = {r.cid: r.at for r in history.corrected_dates(*frames, every=100).collect()}
    assert got == corrected(commits, edges) and sum(rows) < 4 * n


# ---- moved blocks ----


def plain_blocks(rows, least):
    count = lambda t: sum(c.isascii() and c.isalnum() for c in t)
    files = {}
    for f, i, t, parent in rows:
        files.setdefault((f, parent), {})[i] = t.strip(" ")
    out = set()
    for (f, fp), new in files.items():
        for (g, gp), old in files.items():
            if fp or not gp or f == g:
                continue
            for i in new:
                for j in old:
                    if new[i] != old[j] or (i - 1 in new and j - 1 in old and new[i - 1] == old[j - 1]):
                        continue
                    k = 0
                    while i + k in new and j + k in old and new[i + k] == old[j + k]:
                        k += 1
                    solid = [x for x in range(k) if count(new[i + x])]
                    if sum(count(new[i + x]) for x in range(k)) >= least:
                        out.add((f, i + solid[0], i + solid[-1], g, j + solid[0]))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_moved_blocks_are_those_of_all_pairs(spark, seed):
    rng = random.Random(seed)
    texts = ["", "}", " } ", "x = 1;", "return value;", "int f(int a)", "{", "/**/"]
    rows = []
    for f in range(5):
        at = 0
        for _ in range(60):
            at += rng.choice([1, 1, 1, 1, 1, 1, 1, 1, 1, 3])  # added lines may leave gaps
            rows.append((f"f{f}", at, rng.choice(texts), f < 3))
    rows += [("f0", 1000 + i, t, True) for i, t in enumerate(texts * 3)] + [("f4", 2000 + i, t, False) for i, t in enumerate(texts[2:] + texts)]
    got = blame.moved_blocks(spark.createDataFrame(rows, "file_path string, line_no int, text string, parent boolean"), 18)
    want = plain_blocks(rows, 18)
    assert len(want) > 20 and sorted(map(tuple, got.collect())) == sorted(want)


def test_brackets_do_not_cut_blocks(spark):
    body = ["int add(int a, int b)", "{", "", "    return a + b;", "", "}", "int minus(int a, int b)", "{", "    return a - b;", "}"]
    rows = [("old.c", i, t, True) for i, t in enumerate(["", *body])] + [("new.c", i, t, False) for i, t in enumerate([*body, "", "x"])]
    got = blame.moved_blocks(spark.createDataFrame(rows, "file_path string, line_no int, text string, parent boolean"), 46)
    assert [tuple(r) for r in got.collect()] == [("new.c", 0, 8, "old.c", 1)]


def test_windows_of_a_long_file_hold_few_lines():
    """Windows are the same however lines are dealt to batches, and a long file is not held whole for each."""
    rng = random.Random(1)
    n = 20_000
    columns = [pa.array(["f"] * n), pa.array([True] * n), pa.array([i + i // 900 for i in range(n)], pa.int32()), pa.array([rng.choice(["", "}", "a = 1", "return b"]) for _ in range(n)])]
    whole = pa.RecordBatch.from_arrays(columns, names=["file_path", "parent", "line_no", "text"])
    tracemalloc.start()
    found = [pa.Table.from_batches(blame._windows((whole.slice(i, size) for i in range(0, n, size)), 9)).to_pylist() for size in (n, 1000, 7)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found[0]) > n // 3 and found[0] == found[1] == found[2]
    assert peak < 200 << 20


# ---- packs ----


@pytest.fixture(scope="module")
def repo(tmp_path_factory):
    """A packed repository whose files change little by little, so that the pack has chains of differences."""
    path = tmp_path_factory.mktemp("packed")
    git(path, "init", "-q", "-b", "main")
    rng = random.Random(0)
    lines = [f"int value_{i} = {rng.random()};" for i in range(300)]
    (path / "sub/deep").mkdir(parents=True)
    for n in range(12):
        lines[rng.randrange(300)] = f"int changed_{n};"
        (path / "a.c").write_text("\n".join(lines))
        (path / "sub/b.rs").write_text(f"fn f() {{ {n} }}\n")
        (path / "sub/deep/big.bin").write_bytes(rng.randbytes(40_000 if n % 4 == 0 else 5))
        git(path, "add", ".")
        git(path, "commit", "-qm", f"commit {n}")
    git(path, "tag", "-a", "v1", "-m", "First")
    git(path, "gc", "-q", "--aggressive")
    (path / "loose.c").write_text("int loose;\n")
    git(path, "add", ".")
    git(path, "commit", "-qm", "loose")
    return str(path)


def listed(path):
    rows = [line.split() for line in git(path, "cat-file", "--batch-all-objects", "--batch-check").split("\n")]
    return {o: (k, int(n)) for o, k, n in rows}


def test_pack_reader(spark, repo, tmp_path):
    assert any("chain length = 2" in line for line in git(repo, "verify-pack", "-v", next(p for p, _ in packs._listed(f"{repo}/.git", ".idx"))).split("\n"))
    rows = {r.object_id: r for r in packs.objects(spark, f"{repo}/.git").collect()}
    assert {o: (r.kind, r.size) for o, r in rows.items()} == listed(repo)
    for o, r in list(rows.items())[:40]:
        assert bytes(r.content) == subprocess.run(["git", "-C", repo, "cat-file", r.kind, o], capture_output=True, check=True).stdout
    assert {r.object_id for r in packs.object_ids(spark, f"{repo}/.git").collect()} == set(rows)
    # differences to ids, as older packs have them
    old = tmp_path / "old"
    subprocess.run(["git", "clone", "-q", "--bare", "--no-hardlinks", repo, str(old)], check=True)
    ids = "\n".join(listed(old)).encode()
    subprocess.run(["git", "-C", str(old), "pack-objects", "-q", "--no-reuse-delta", "objects/pack/pack"], input=ids, check=True, capture_output=True)
    assert packs.objects(spark, str(old)).count() == len(listed(old))
    empty_repo = str(tmp_path / "empty")
    packs.create(empty_repo)
    assert packs.objects(spark, empty_repo).count() == 0


def test_differences():
    base = bytes(range(256)) * 300
    step = lambda at, n: bytes([128 | 1 | 2 | 4 | 16 | 32, *at.to_bytes(3, "little"), *n.to_bytes(2, "little")])
    number = lambda n: bytes([n & 127 | 128, n >> 7 & 127 | 128, n >> 14])
    made = base[5:900] + b"new" + base[70_000:70_010]
    assert packs.apply_difference(base, number(len(base)) + number(len(made)) + step(5, 895) + b"\3new" + step(70_000, 10)) == made
    assert packs.apply_difference(base, number(len(base)) + number(1 << 16) + b"\x80") == base[: 1 << 16]
    for bad in (number(3) + number(0), number(len(base)) + number(5) + b"\0", number(len(base)) + number(5) + b"\3new"):
        with pytest.raises(ValueError):
            packs.apply_difference(base, bad)


def test_a_rewritten_repository_is_whole(spark, repo, tmp_path):
    """The repository that a rewrite publishes passes git's own check; a run that died leaves nothing that is seen."""
    found = stored(packs.objects(spark, f"{repo}/.git"))
    blobs = found.filter("kind = 'blob'").select("object_id", "size", "content")
    refs = source.refs(spark, repo).withColumn("repo", F.lit(f"{repo}/.git"))
    out = rewrite.rewrite(source.commit_objects(found), stored(source.tree_entries(found).drop("repo").distinct()), blobs, refs, source.tag_objects(found), lexers.lexed, MASK, empty(spark))
    out["objects"] = stored(out["objects"])
    target = str(tmp_path / "target")
    broken = out["objects"].withColumn("content", F.when(F.col("kind") == "tag", F.raise_error(F.lit("killed"))).otherwise(F.col("content")))
    with pytest.raises(Exception):
        packs.write_objects(broken.repartition(4), target)
    assert not [p for p in os.listdir(f"{target}/objects/pack")] and not [p for p in os.listdir(target) if p.startswith("staged")]
    rewrite.published(out, target)
    checked = subprocess.run(["git", "-C", target, "fsck", "--full", "--strict"], capture_output=True, check=True, env=ENV)
    assert b"missing" not in checked.stdout + checked.stderr
    commits = {r.orig_commit: r.new_commit for r in out["commit_map"].collect()}
    assert set(git(target, "rev-list", "--all").split()) == set(commits.values()) and git(target, "rev-parse", "main") == commits[git(repo, "rev-parse", "main")]
    assert git(target, "show", "main:loose.c") == "\n".join(lexers.token_lines("int loose;\n", "C")).strip() and git(target, "cat-file", "-t", "v1") == "tag"
    assert git(target, "rev-parse", "main:sub/deep/big.bin") == git(repo, "rev-parse", "main:sub/deep/big.bin")
    # written again in other parts: nothing is added; and the store reads itself
    before = sorted(os.listdir(f"{target}/objects/pack"))
    packs.write_objects(out["objects"].repartition(7), target, 1000)
    assert sorted(os.listdir(f"{target}/objects/pack")) == before
    assert {r.object_id for r in packs.objects(spark, target).collect()} == {r.object_id for r in out["objects"].collect()}
    other = str(tmp_path / "other")
    packs.write_objects(out["objects"], other, 1000)
    assert len(os.listdir(f"{other}/objects/pack")) > 4 and listed(other) == listed(target)


# ---- blame as tables ----


def is_alignment(old, new, places):
    used = [p for p in places if p >= 0]
    return used == sorted(set(used)) and all(p < 0 or old[p] == new[i] for i, p in enumerate(places))


def test_alignment():
    rng = random.Random(0)
    for n in range(200):
        old = [rng.choice("abcdefgh}"[: rng.randint(2, 9)]) for _ in range(rng.randint(0, 30))]
        new = [c for c in old if rng.random() < 0.8]
        for _ in range(rng.randint(0, 4)):
            new.insert(rng.randint(0, len(new)), rng.choice("abcxyz}"))
        assert is_alignment(old, new, ownership.aligned_lines(old, new)), n
        assert ownership.aligned_lines(old, old) == list(range(len(old)))
    unique = [f"l{i}" for i in range(40)]
    new = [x for x in unique if rng.random() < 0.7]
    assert [unique[p] for p in ownership.aligned_lines(unique, new)] == new  # nothing that stays is lost
    assert ownership.aligned_lines(list("}}}}a}}"), list("x}}}}a}}")) == [-1, 0, 1, 2, 3, 4, 5, 6]


@pytest.fixture(scope="module")
def history_repo(tmp_path_factory):
    """Branches that change a file in different places, a merge, a rename with changes, a copy of a file, a revert."""
    path = tmp_path_factory.mktemp("history")
    git(path, "init", "-q", "-b", "main")
    lines = [f"line number {i} of the file" for i in range(30)]

    def commit(message, **files):
        for name, text in files.items():
            (path / name.replace("_", "/")).parent.mkdir(exist_ok=True)
            (path / name.replace("_", "/")).write_text("".join(f"{x}\n" for x in text))
        git(path, "add", "-A")
        git(path, "commit", "-qm", message)

    commit("one", a=lines, d_b=["other", "file"])
    git(path, "checkout", "-qb", "side")
    side = [*lines[:3], "from the side", *lines[4:]]
    commit("side one", a=side)
    side = [*side, "end of side"]
    commit("side two", a=side)
    git(path, "checkout", "-q", "main")
    main = [*lines[:20], "from main", "and more", *lines[20:]]
    commit("main one", a=main)
    git(path, "merge", "-q", "side", "-m", "merge")
    commit("other", d_b=["other", "changed", "file"])
    merged = (path / "a").read_text().split("\n")[:-1]
    git(path, "mv", "a", "renamed")
    commit("rename", renamed=[*merged[:10], "at the rename", *merged[11:]])
    commit("later", renamed=["first of all", *merged[:10], "at the rename", *merged[12:]])
    git(path, "mv", "d/b", "c")
    git(path, "commit", "-qm", "exact rename")
    return str(path)


def test_blame_of_merges_and_renames(spark, history_repo):
    found = stored(packs.objects(spark, f"{history_repo}/.git"))
    commits = stored(source.commit_objects(found))
    roots = commits.select("repo", F.col("tree").alias("root")).distinct()
    below = source.recursive_entries(source.tree_entries(found), roots, stored).filter(F.col("mode").isin(*source.REGULAR))
    files = stored(commits.select("cid", F.col("tree").alias("root")).join(below, "root").select("cid", "path", F.col("object_id").alias("blob")))
    parents = commits.select("cid", F.posexplode("parents").alias("idx", "parent"))
    lines = found.filter("kind = 'blob'").select(F.col("object_id").alias("blob"), F.split(F.regexp_replace(F.col("content").cast("string"), r"\n\z", ""), "\n").alias("lines"))
    tips = spark.createDataFrame([(git(history_repo, "rev-parse", r),) for r in ("main", "side", "main~3")], "cid string")
    got = {}
    for r in ownership.blame_of(tips, files, parents, lines).collect():
        got.setdefault((r.cid, r.path), {})[r.line_no] = (r.commit_sha, r.old_path or r.path, r.old_line, r.line)
    want = {}
    for tip in [r.cid for r in tips.collect()]:
        for path in git(history_repo, "ls-tree", "-r", "--name-only", tip).split("\n"):
            out, name = subprocess.run(["git", "-C", history_repo, "blame", "--line-porcelain", tip, "--", path], capture_output=True, check=True).stdout.decode(), ""
            for x in out.split("\n"):
                if x[:40].isalnum() and len(x.split()) >= 3 and len(x.split()[0]) == 40:
                    sha, old, new = x.split()[:3]
                elif x.startswith("filename "):
                    name = x[9:]
                elif x.startswith("\t"):
                    want.setdefault((tip, path), {})[int(new) - 1] = (sha, name, int(old) - 1, x[1:])
    assert len(want) >= 5 and got == want


def _history(seed: int):
    """Commits of three files and of one that is renamed with a change, with merges; lines that repeat and odd ones."""
    rnd = random.Random(seed)
    odd = ["", "}", "a\\nb", "a\nb", "\\", "\\0", " tab\t"]
    texts, files, parents, lines = {}, [], [], {}
    for c in range(24):
        of = [] if c == 0 else [c - 1] if c % 5 else [c - 2, c - 1][: 1 + (c > 1)]
        parents += [(f"c{c}", i, f"c{p}") for i, p in enumerate(of)]
        for name in ("x", "y", "z"):
            text = list(rnd.choice([texts[p, name] for p in of])) if of else [f"{name}{i}" for i in range(12)]
            for _ in range(rnd.randrange(3)):
                at = rnd.randrange(len(text) + 1)
                text[at : at + rnd.randrange(2)] = [rnd.choice([*odd, f"new {c}"]) for _ in range(rnd.randrange(3))]
            texts[c, name] = text
        path = "moved" if c >= 10 else "z"
        for name, at in (("x", "x"), ("y", "y"), ("z", path)):
            body = texts[c, name]
            blob = "b" + repr(body)
            files.append((f"c{c}", at, blob))
            lines[blob] = body
    return files, parents, list(lines.items())


def _owners_in_order(files, parents, lines):
    """The owners of lines of files that keep their names, commit by commit."""
    text, blobs, found, version = dict(lines), {(c, p): b for c, p, b in files}, {}, {}
    for cid, path, blob in files:
        of = [p for c, _, p in sorted(parents) if c == cid and (p, path) in blobs]
        same = [p for p in of if blobs[p, path] == blob]
        version[cid, path] = version[same[0], path] if same else cid
        if same:
            continue
        own = [(cid, path, i) for i in range(len(text[blob]))]
        for p in reversed(of):
            for i, j in enumerate(ownership.aligned_lines(text[blobs[p, path]], text[blob])):
                if j >= 0:
                    own[i] = found[version[p, path], path][j]
        found[cid, path] = own
    return {(c, p, i, *o) for (c, p), own in found.items() for i, o in enumerate(own)}


@pytest.mark.parametrize("held", [None, 1, 40])
def test_owners_however_many_versions_a_task_holds(spark, monkeypatch, held):
    """Pointers lead to the same ends within a task as from task to task, and lines are rows in the result only."""
    files, parents, lines = _history(7)
    if held:
        monkeypatch.setattr(ownership, "HELD", held)
        monkeypatch.setattr(ownership, "SMALL", held)
    tables = spark.createDataFrame(files, "cid string, path string, blob string"), spark.createDataFrame(parents, "cid string, idx int, parent string"), spark.createDataFrame(lines, "blob string, lines array<string>")
    got = ownership.owners(*tables)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    of = lambda x: {r for r in x if r[1] in ("x", "y")}
    assert of(rows) == of(_owners_in_order(files, parents, lines))
    moved = [r for r in rows if r[1] == "moved"]
    assert any(r[4] == "z" and int(r[3][1:]) < 10 for r in moved)
    assert {r[3:] for r in moved} <= {(r[0], r[1], r[2]) for r in rows}  # ends are lines of versions


def test_pointers_of_any_length(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 50)], "k int, to_k int")
    assert {(r.k, r.to_k) for r in ownership.followed(links, ["k"]).collect()} == {(i, 100) for i in [*range(100), 200]}
    assert ownership.followed(links.limit(0), ["k"]).count() == 0


def test_entries_are_made_once_from_numbers(spark):
    """Entries are those of the SQL, and no plan that reads them makes them again or moves them."""
    d = "/root/testdata/sf0.001"
    names = ("entries", "known_trees", "known_blobs")
    for name, table in zip(names, history_queries._tables(spark, d, *names), strict=True):
        sql = f"WITH {history_queries.TREES}, {history_queries.KNOWN} SELECT * FROM {name}".replace("FROM lineitem", "FROM {lineitem}")
        want = spark.sql(sql, lineitem=spark.read.parquet(f"{d}/lineitem.parquet"))
        assert sorted(map(tuple, table.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
        assert name != "entries" or "Exchange" not in table._jdf.queryExecution().executedPlan().toString()


def test_ids_of_trees_without_their_bodies(spark, monkeypatch):
    """Entries of a tree go through its task one by one: none are collected, in however many batches they come."""
    rng = random.Random(5)
    rows = [(f"t{rng.randrange(9)}", f"{rng.choice('aAé.')}{i}".encode(), rng.choice(["100644", "40000"]), f"{rng.getrandbits(160):040x}") for i in range(400)]
    rows += [("t0", b"d", "40000", "0" * 40), ("t0", b"d.c", "100644", "1" * 40), ("t0", b"d0", "100644", "2" * 40), ("none", b"x", "100644", None)]
    entries = spark.createDataFrame(rows, "tree string, name binary, mode string, object_id string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = history.tree_ids(entries)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, history.tree_bodies(entries).select("tree", "new_tree").collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(history, "tree_bodies", None)
    assert not history_queries.tree_assembly(spark, "/root/testdata/sf0.001").isEmpty()
