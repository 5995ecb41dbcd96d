"""The provenance operators on small cases, and every registered query against its SQL on the smallest tables."""

import os
import random
import sqlite3
import subprocess

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tokentrail.functions import text as fn
from tokentrail.operators import dataset, history, identity, lexers, mapping, render, walk
from tokentrail.operators.components import connected_components
from tokentrail.plans.adapter import BASE, load
from tokentrail.plans.queries import ORACLES, QUERIES
from tokentrail.schema import DATASET, LOGS, TOKEN_COLUMNS
from tokentrail.sources import readers
from tokentrail.streaming.incremental import stream_commit_map

SF = "/root/testdata/sf0.001"


def plain(value):
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, list):
        return tuple(value)
    if value is None or value != value:
        return None
    return round(value, 6) if isinstance(value, float) else value


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for t in BASE:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    rows = [sorted((tuple(map(plain, r)) for r in d[columns].itertuples(index=False, name=None)), key=repr) for d in (ours, theirs)]
    assert rows[0] == rows[1]


def test_entry(spark):
    assert entry.entry(spark).columns == ["file_path", "person", "tokens"] and set(QUERIES) <= set(entry.queries())


def test_dataset_has_67_columns(spark):
    assert len(DATASET) == 67 and DATASET[0] == "repo_name" and QUERIES["dataset67"](spark, SF).columns == DATASET


def value(spark, column, **cells):
    return spark.createDataFrame([cells], ", ".join(f"{k} string" for k in cells)).select(column.alias("x")).first().x


@pytest.mark.parametrize(("line", "want"), [("name|a|b", ("name", "a|b", 0, None)), ("operator||", ("operator", "|", 0, None)), ("|", ("", "", 1, None)), ("", ("blank", "", 1, None)), ("DECL|function|f", ("DECL", "function|f", 1, "f")), ("DECL|x", ("DECL", "x", 1, None)), ("end_block", ("end_block", "", 1, None)), ("begin_unit|x", ("begin_unit", "begin_unit|x", 1, None)), ("odd", ("unknown", "odd", 1, None))])
def test_classified(spark, line, want):
    assert tuple(value(spark, fn.classified(F.col("t")), t=line)) == want


def test_blame_line(spark):
    assert tuple(value(spark, fn.blame_parts(F.col("t")), t="ab;old;\tname|a;b")) == ("ab", "old", "name|a;b")
    assert value(spark, fn.blame_parts(F.col("t")), t="none") is None


@pytest.mark.parametrize(("text", "want"), [("Bob <b@x.org>", "b@x.org"), ("b@x.org", "b@x.org"), ("a@x.org for B <b@x.org>", "b@x.org"), ("Name <>", None), ("0" * 40, None)])
def test_trailer_address(spark, text, want):
    assert value(spark, fn.trailer_address(F.col("t")), t=text) == want


@pytest.mark.parametrize(("text", "want"), [("Ã¶", "ö"), ("ö", "ö"), ("日", "日"), ("abc", "abc")])
def test_undo_mojibake(spark, text, want):
    assert value(spark, fn.undo_mojibake(F.col("t")), t=text) == want


def test_names(spark):
    assert value(spark, fn.name_key(F.col("n"), F.col("e")), n="Jörg Ærø", e="j@x") == "jorg Ærø".lower().replace("æ", "æ").replace("ø", "o")
    assert value(spark, fn.name_key(F.col("n"), F.col("e")), n="Joe", e="J@x") == "joe at j@x"
    assert tuple(value(spark, fn.email_parts(F.col("e")), e="A@B@c")) == ("a@b@c", "a", "b@c") and tuple(value(spark, fn.email_parts(F.col("e")), e="A")) == ("a", "a", "")
    assert fn.unquote_path('"a\\303\\266\\tb\\""') == 'aö\tb"' and fn.unquote_path("plain") == "plain"
    with pytest.raises(ValueError):
        fn.memory_size("80%")


def test_trailers_of_one_commit(spark):
    emails = spark.createDataFrame([("a@x.org", "p1"), ("b@x.org", "p1"), ("c@x.org", "zed"), ("c@x.org", "abe")], "emailaddr string, personid string")
    rows = [(0, "Reviewed-by", "A <a@x.org>"), (1, "reviewed-by", "B <b@x.org>"), (2, "Acked-by", "A <a@x.org>"), (3, "Reviewed-by", "nobody"), (4, "Reviewed-by", "nobody"), (5, "Reviewed-by", "D@Y.org"), (6, "Reviewed-by", "d@y.org"), (7, "Tested-by", "c@x.org")]
    footers = spark.createDataFrame([("k", *r) for r in rows], "cid string, idx int, key string, value string")
    r = dataset.trailer_lists(footers, emails).first()
    assert r.footer_reviewed_by == ["A <a@x.org>", "nobody", "nobody", "D@Y.org"] and r.footer_acked_by == ["A <a@x.org>"] and r.footer_signed_off_by == []
    persons = spark.createDataFrame([("p1", "One")], "personid string, personname string")
    p = dataset.trailer_persons(footers, emails, persons).first()
    assert p.footer_personids == ["abe", "p1", "zed"] and p.footer_person_names == ["One", "abe", "zed"]
    with pytest.raises(ValueError, match="lacks idx"):
        dataset.trailer_lists(footers.drop("idx"), emails)


@pytest.mark.parametrize("small", [0, 10**6])
def test_components(spark, small):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)] + [(500, 500)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = connected_components(spark.createDataFrame(edges, "u long, v long"), small=small)
    assert {r.node: r.component for r in got.collect()} == {x: root(x) for x in parent}


def test_walk_gives_back_the_source(spark):
    rng = random.Random(2)
    rows = [(f"f{i}", "".join(rng.choice(["ab", "(", ")", " ", "\n", "\t", "é"]) for _ in range(30)) + "x") for i in range(30)]
    files = spark.createDataFrame(rows, "file_path string, text string")
    t = files.select("file_path", F.posexplode(walk.text_tokens(F.col("text"))).alias("token_index", "token_value")).withColumns({"token_type": F.lit("name"), "is_structural": F.lit(0)})
    out: dict = {}
    for r in walk.aligned(t, files).orderBy("file_path", "token_index").collect():
        out[r.file_path] = out.get(r.file_path, "") + r.source_text
        assert r.token_index > 0 or (r.source_line, r.source_col) == (1, 1)
    assert out == dict(rows)


def test_walk_of_whole_documents(spark):
    """No document is left out, however long; and places are those of a plain walk."""
    texts = {r.file_path: r.text for r in load(spark, SF, "files").collect()}
    documents = spark.read.parquet(f"{SF}/documents.parquet").filter("text IS NOT NULL")
    assert len(texts) == documents.count() and max(map(len, texts.values())) == documents.selectExpr("max(char_length(text))").first()[0] > 10_000
    got: dict = {}
    files = load(spark, SF, "files")
    tokens = files.select("file_path", F.posexplode(walk.text_tokens(F.col("text"))).alias("token_index", "token_value")).withColumns({"token_type": F.lit("name"), "is_structural": F.lit(0)})
    for r in walk.aligned(tokens, files).orderBy("file_path", "token_index").collect():
        assert r.source_line == got.get(r.file_path, "").count("\n") + 1
        got[r.file_path] = got.get(r.file_path, "") + r.source_text
    assert got == {f: t for f, t in texts.items() if t.strip()}


def test_walk_places(spark):
    rows = [("a", " \n\tab  cd\n\n é😀x\n", "ab cd é😀x"), ("b", "  ", "q r"), ("c", "one", "one two"), ("d", "", "z"), ("e", None, "y")]
    files = spark.createDataFrame([r[:2] for r in rows], "file_path string, text string")
    tokens = [(f, i, "name", v, int(v == "")) for f, _, t in rows for i, v in enumerate(["", *t.split(), ""])]
    t = spark.createDataFrame(tokens, "file_path string, token_index int, token_type string, token_value string, is_structural int")
    want = {}
    for f, text, _ in rows:
        solid, at, started = [i for i, c in enumerate(text or "") if c not in " \t\n\r"], 0, 0
        for _, i, _, v, _ in (x for x in tokens if x[0] == f):
            end = at if not v else solid[started + len(v)] if started + len(v) < len(solid) else len(text or "")
            before = (text or "")[:at]
            want[f, i] = (text[at:end], before.count("\n") + 1, at - before.rfind("\n")) if text is not None else (None, None, None)
            at, started = end, started + len(v)
    assert {(r.file_path, r.token_index): (r.source_text, r.source_line, r.source_col) for r in walk.aligned(t, files).collect()} == want


def test_repair(spark):
    tokens = spark.createDataFrame([("a.c", 0, "name", "Ã¶x", 0), ("a.c", 1, "name", "Ã¶", 0)], "file_path string, token_index int, token_type string, token_value string, is_structural int")
    sources = spark.createDataFrame([("a.c", "öx Ã¶", True)], "file_path string, text string, repairable boolean")
    got = walk.repaired(tokens, sources).orderBy("token_index").collect()
    assert [(r.token_value, r.was_repaired) for r in got] == [("öx", True), ("Ã¶", False)]


def test_identities_join_over_several_steps(spark):
    rows = [("Ann Lee", "a@x"), ("Ann Lee", "b@x"), ("Bob", "b@x"), ("Eve Fox", "e@x")]
    commits = spark.createDataFrame([(*r, *r) for r in rows], "autname string, autemail string, comname string, comemail string")
    u = identity.unified(identity.identities(commits))
    assert {(r.name, r.personid) for r in u.collect()} == {("Ann Lee", "ann lee"), ("Bob", "ann lee"), ("Eve Fox", "eve fox")}
    assert [r.recordid for r in identity.emails_table(u).orderBy("recordid").collect()] == [0, 1, 2, 3]
    assert identity.persons_table(u).filter("personname IS NOT NULL").count() == 0


def test_map_guards(spark):
    m = spark.createDataFrame([("1", "a.c", "2", 0), ("3", "b.rs", "4", 0), ("5", "c.txt", "5", 0)], "orig_blob string, path string, new_blob string, processed_at long")
    with pytest.raises(ValueError):
        mapping.widened(m, fn.file_mask(), fn.file_mask(("Rust",)))
    with pytest.raises(ValueError):
        mapping.retokenized(m, ["rs"], ["rs", "c"])
    with pytest.raises(ValueError):
        mapping.retokenized(m, ["go"], [])
    with pytest.raises(ValueError):
        fn.has_extension(F.col("path"), [".c"])
    with pytest.raises(ValueError):
        mapping.meta_guard({"mask": "a"}, "mask", "b")
    assert mapping.render_identity(mapping.parse_identity("rs=aaaaaaaa,c=bbbbbbbb")) == "c=bbbbbbbb,rs=aaaaaaaa"
    with pytest.raises(ValueError):
        mapping.parse_identity("rs=aaaaaaaa,rs=aaaaaaaa")
    assert mapping.tokenized_for(spark.createDataFrame([("1", "a.cc", "2")], "orig_blob string, path string, new_blob string"), ["c"]).isEmpty()


def git(path, *args):
    env = os.environ | {f"GIT_{w}_{k}": v for w in ("AUTHOR", "COMMITTER") for k, v in (("NAME", "Ann Lee"), ("EMAIL", "a@x.org"), ("DATE", "2020-01-02T03:04:05Z"))}
    return subprocess.run(["git", "-C", str(path), *args], check=True, capture_output=True, text=True, env=env).stdout.strip()


def test_git_history_and_rewrite(spark, tmp_path):
    git(tmp_path, "init", "-q")
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.c").write_text("int a;\n")
    (tmp_path / "b.txt").write_text("b\n")
    git(tmp_path, "add", ".")
    git(tmp_path, "commit", "-qm", "One\n\nReviewed-by: Bob <b@x.org>")
    h = readers.git_history(spark, str(tmp_path))
    c = h["commits"].first()
    assert (c.autname, c.autdate, c.summary, c.ismerge) == ("Ann Lee", "2020-01-02 03:04:05", "One", False)
    assert tuple(h["footers"].first())[1:] == (0, "Reviewed-by", "Bob <b@x.org>") and h["parents"].isEmpty()
    # identical blobs give the identical tree
    root = git(tmp_path, "rev-parse", "HEAD^{tree}")
    entries = [(root, "b.txt", "100644", git(tmp_path, "rev-parse", "HEAD:b.txt")), (root, "d", "40000", git(tmp_path, "rev-parse", "HEAD:d")), (git(tmp_path, "rev-parse", "HEAD:d"), "a.c", "100644", git(tmp_path, "rev-parse", "HEAD:d/a.c"))]
    e = spark.createDataFrame(entries, "tree string, name string, mode string, object_id string")
    same = e.filter("mode <> '40000'").select("object_id", F.col("object_id").alias("new_id"))
    assert {r.tree: r.new_tree for r in history.assembled_trees(e, same).collect()} == {t: t for t, *_ in entries}
    who = "Ann Lee <a@x.org> 1577934245 +0000"
    new = history.rewritten_commits([{"cid": c.cid, "tree": root, "parents": [], "author": who, "committer": who, "message": "One"}, {"cid": "f" * 40, "tree": root, "parents": [c.cid], "author": who, "committer": who, "message": "Two"}])
    body = f"tree {root}\nauthor {who}\ncommitter {who}\n\nOne\n\nFormer-commit-id: {c.cid}"
    assert new[c.cid] == subprocess.run(["git", "hash-object", "-t", "commit", "--stdin"], input=body, capture_output=True, text=True, cwd=tmp_path).stdout.strip()
    with pytest.raises(ValueError):
        history.rewritten_commits([{"cid": "a", "parents": ["b"]}])


def test_sqlite_and_files(spark, tmp_path):
    with sqlite3.connect(tmp_path / "x.db") as db:
        db.execute("CREATE TABLE footers (cid TEXT, idx INTEGER, key TEXT, value TEXT)")
        db.executemany("INSERT INTO footers VALUES (?, ?, ?, ?)", [("a", 0, "k", "v"), ("b", 1, "k", None)])
    assert sorted(map(tuple, readers.sqlite_table(spark, str(tmp_path / "x.db"), "footers", 2).collect())) == [("a", 0, "k", "v"), ("b", 1, "k", None)]
    (tmp_path / "no.db").write_text("not a database file")
    with pytest.raises(ValueError):
        readers.sqlite_table(spark, str(tmp_path / "no.db"), "footers")
    (tmp_path / "s/d").mkdir(parents=True)
    (tmp_path / "s/d/a.c").write_bytes(b"\xef\xbb\xbfa\r\nb\r")
    (tmp_path / "s/d/a.c.blame").write_text("k;;\tname|a\nk;;\tname|b\n")
    files = {r.file_path: r for r in readers.source_files(spark, str(tmp_path / "s")).collect()}
    assert files["d/a.c"].text == "a\nb\n" and files["d/a.c"].had_bom and not files["d/a.c"].repairable
    rows = dataset.token_rows(readers.blame_files(spark, str(tmp_path / "s"))).orderBy("token_index").collect()
    assert [(r.file_path, r.token_index, r.token_value) for r in rows] == [("d/a.c", 0, "a"), ("d/a.c", 1, "b")]
    assert set(readers.provenance(None, "x").values()) == {""}


def kinds(language, text):
    return [(k, v) for _, _, k, v in lexers.LEXERS[language](text)]


def test_lexers():
    assert kinds("Rust", "fn f<'a>() { r#\"x\"y\"#; /* a /* b */ c */ 'q' } r#fn")[:4] == [("keyword", "fn"), ("identifier", "f"), ("op", "<"), ("lifetime", "'a")]
    assert ("literal", 'r#"x"y"#') in kinds("Rust", 'r#"x"y"#') and kinds("Rust", "/* a /* b */ c */") == [("comment", "/* a /* b */ c */")]
    assert kinds("Rust", "r#fn") == [("identifier", "r#fn")]
    assert kinds("C", '#include "a.h"\nint x=1; // c')[:8] == [("begin_include", ""), ("include", "#"), ("directive", "include"), ("file", '"a.h"'), ("end_include", ""), ("begin_decl_stmt", ""), ("name", "int"), ("name", "x")]
    assert kinds("M4", "AC_INIT([a [b]], `c') # d") == [("identifier", "AC_INIT"), ("token", "("), ("string", "a [b]"), ("token", ","), ("string", "c"), ("token", ")"), ("comment", "# d")]
    with pytest.raises(lexers.LexError):
        kinds("M4", "[a")
    assert kinds("Go", "x := `a`")[1:] == [(":=", ":="), ("STRING", "`a`"), (";", "\n")]
    assert [k for k, _ in kinds("Go", "f(\n1) // c\nx++\n/* a\nb */ y")] == ["IDENT", "(", "INT", ")", "COMMENT", ";", "IDENT", "++", ";", "COMMENT", "IDENT", ";"]
    assert [(a, b) for a, b, _, _ in lexers.rust("a\n  é b")] == [(1, 1), (2, 3), (2, 5)]
    assert lexers.token_lines("int f(void) {\n}", "C") == ["begin_unit|language:C", "begin_function", "DECL|function|f (void)", "name|int", "name|f", "parameter_list|(", "name|void", "parameter_list|)", "block|{", "block|}", "end_function", "", "end_unit", ""]
    assert lexers.token_lines("a; b;", "C", True)[1:6] == ["-:-|begin_decl_stmt", "1:1|name|a", "1:2|decl_stmt|;", "-:-|end_decl_stmt", ""]
    assert lexers.token_lines("", "C") == ["begin_unit|language:C", "end_unit", ""]


def test_tokenized_once_and_blame(spark):
    files = spark.createDataFrame([("a.c", bytearray(b"int x;")), ("b.c", bytearray(b"int x;")), ("c.ac", bytearray(b"[")), ("d.txt", bytearray(b"x"))], "path string, content binary")
    rows = lexers.tokenized(files).collect()
    assert sorted((r.ext, r.status) for r in rows) == [("ac", "tokenizer-error"), ("c", "ok")]
    memo = spark.createDataFrame([(r.content_sha, r.ext) for r in rows if r.status == "ok"], "content_sha string, ext string")
    assert [r.ext for r in lexers.tokenized(files, memo).collect()] == ["ac"]
    revisions = spark.createDataFrame([("f", 1, "A", ["x", "y"]), ("f", 2, "B", ["x", "z", "y"]), ("f", 3, "C", ["z", "y", "w"])], "file_path string, seq int, commit_sha string, tokens array<string>")
    assert [(r.commit_sha, r.token) for r in lexers.native_blame(revisions).orderBy("line_no").collect()] == [("B", "z"), ("A", "y"), ("C", "w")]


def test_html(spark):
    rows = spark.createDataFrame([("d/a.c", 0, "DECL", "function|f", 1, "", "o", "p", "x", "s", "Ann", "ann"), ("d/a.c", 1, "name", "a<b", 0, "a<b", "o", "p", "x", 's"', "Ann", "ann")], "file_path string, token_index int, token_type string, token_value string, is_structural int, source_text string, original string, repo string, autdate string, summary string, personname string, personid string")
    colours = spark.createDataFrame([("d/a.c", "Ann", 3)], "file_path string, person string, colour int")
    html = render.pages(rows, colours).first().html
    assert html.startswith("<html><title>a.c</title>") and '<a name="f"></a>' in html and "a&lt;b" in html and "windowPre('o')" in html


def test_stream_of_commits(spark, tmp_path):
    logs = [spark.createDataFrame(r, LOGS) for r in ([("a", "x\nFormer-commit-id: " + "1" * 40), ("b", "y")], [("b", "z"), ("c", "z")])]
    for df in logs:
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream_commit_map(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = {r.cid: r.originalcid for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"a": "1" * 40, "b": "b", "c": "c"}


def test_parquet_sink(spark, tmp_path):
    wide = QUERIES["dataset67"](spark, SF)
    dataset.write_dataset(wide, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == wide.count()


def test_trailers_of_both_kinds_move_together(spark):
    """Lists and persons of trailers come from one pass, which is what the two give apart, and trailers move twice."""
    footers = spark.createDataFrame([("c", 0, "Reviewed-by", "A <a@x.com>"), ("c", 1, "reviewed-by", "a@x.com"), ("c", 2, "Acked-by", "nobody"), ("d", 0, "Acked-by", "b@x.com")], "cid string, idx int, key string, value string")
    emails = spark.createDataFrame([("A", "a@x.com", "p1"), ("B", "a@x.com", "p2"), ("B", "a@x.com", "p2")], "emailname string, emailaddr string, personid string")
    persons = spark.createDataFrame([("p1", "One"), ("p2", None)], "personid string, personname string")
    both = dataset.trailers(footers, emails, persons)
    apart = dataset.trailer_lists(footers, emails).join(dataset.trailer_persons(footers, emails, persons), "cid").select(both.columns)
    rows = sorted(map(tuple, both.collect()))
    assert rows == sorted(map(tuple, apart.collect()))
    got = {r.cid: (r.footer_reviewed_by, r.footer_acked_by, r.footer_personids, r.footer_person_names) for r in both.collect()}
    assert got == {"c": (["A <a@x.com>"], ["nobody"], ["p1", "p2"], ["One", "p2"]), "d": ([], ["b@x.com"], [], [])}
    merged = dataset.trailers(footers.hint("merge"), emails, persons)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(cid") == 1


def test_results_of_lexers_stream(spark):
    """Token lines leave a task in small batches: those of a whole Arrow batch of files would be held together."""
    text, made = "int a;\n" * 5000, []

    class Rows:
        def select(self, *columns):
            return self

        filter = select

        def mapInArrow(self, run, schema):
            import pyarrow as pa

            columns = [[str(i) for i in range(40)], ["c"] * 40, [text.encode()] * 38 + [None, b"int z;"], ["C"] * 40]
            made.extend(run(iter([pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["content_sha", "ext", "content", "language"])])))

    lexers.lexed(Rows())
    assert [s for b in made for s in b.column(0).to_pylist()] == [str(i) for i in range(40)] and len(made) > 4
    assert {tuple(x) for b in made for x in b.column(3).to_pylist()[:1]} == {tuple(lexers.token_lines(text, "C"))}


def test_many_small_files_are_few_tasks(spark, tmp_path):
    """Small files are read many in a task, and found by tasks on any level; hidden ones are left out."""
    for i in range(600):
        p = tmp_path / f"d{i % 3}" / ("x" * (i % 2)) / f"f{i}.c.blame"
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(f"a;;\t{i}\nb;;\tz\n")
    (tmp_path / "d0/_f.c.blame").write_text("hidden\n")
    (tmp_path / "d0/f.c").write_text("other\n")
    rows = readers.blame_files(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert {tuple(r) for r in rows.filter("line_no = 0").collect()} == {("/".join(["d%d" % (i % 3), *(["x"] if i % 2 else []), f"f{i}.c"]), 0, f"a;;\t{i}") for i in range(600)} and rows.count() == 1200
    (tmp_path / "none").mkdir()
    assert readers.source_files(spark, str(tmp_path / "none")).isEmpty()


@pytest.mark.parametrize("name", ["blame", "footers"])
def test_numbers_move_before_texts_are_made(spark, name):
    """Rows are numbered by key: what moves for it are the columns read, not the ids and texts made of them."""
    plan = load(spark, "/root/testdata/sf0.001", name)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.rindex("sha1(") < plan.index("Exchange")


def test_packed_ids(spark):
    ids = ["ab" * 20, "AB" * 20, "x", "", "q" * 19, "é" * 20, "0" * 20, "ab" * 20 + "\n", None]
    rows = spark.createDataFrame([(i,) for i in ids], "i string").select("i", fn.packed_id(F.col("i")).alias("p"))
    got = [(r.i, r.w, r.n) for r in rows.select("i", fn.whole_id(F.col("p")).alias("w"), F.octet_length("p").alias("n")).collect()]
    assert all(i == w for i, w, _ in got) and got[0][2] == 20 and [n == 20 for *_, n in got].count(True) == 1


def test_rows_of_the_dataset_move_once(spark):
    """Tokens move by commit only, where blame is there by file; trailers do not move by address, nor ids as text."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["dataset67"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line.split("hashpartitioning(", 1)[1].split("#")[0] for line in plan.split("\n") if "Exchange hashpartitioning(" in line]
    assert not {"file_path", "addr", "cid", "commit_sha"} & set(moved) and moved.count("t_packed") == 1, moved


@pytest.mark.parametrize("sent", [0, 1 << 18])
def test_dataset_of_odd_commits(spark, monkeypatch, sent):
    """Commits that share an original, have two, have none or an odd id; trailers without value, address or known key."""
    monkeypatch.setattr(dataset, "SENT", sent)
    sha = "ab" * 20
    commits = spark.createDataFrame([(c, "A", "a@x", "d", "B", "b@x", "e", "s") for c in ("k", sha, "two", "own")], "cid string, autname string, autemail string, autdate string, comname string, comemail string, comdate string, summary string")
    commitmap = spark.createDataFrame([("k", "o", "p"), (sha, "o", None), ("two", "o", "l"), ("two", "own", None)], "cid string, originalcid string, repo string")
    emails = spark.createDataFrame([("A", "a@x", "p1", "x"), ("A", "a@x.com", "p1", "x"), ("B", "b@x.com", "p2", "x")], "emailname string, emailaddr string, personid string, domain string")
    persons = spark.createDataFrame([("p1", "One"), ("p2", None)], "personid string, personname string")
    footers = [("o", 0, "Reviewed-by", "<a@x.com>"), ("o", 1, "reviewed-by", "a@x.com"), ("o", 2, "Acked-by", None), ("o", 3, "Unknown-by", "<b@x.com>"), ("own", 0, "Tested-by", "no one"), ("own", 1, "Tested-by", "no one"), ("own", 2, "Acked-by", "A\n")]
    footers = spark.createDataFrame(footers, "cid string, idx int, key string, value string")
    tokens = [(f"f{c}", 0, 1, 1, "x ", "name", "x", 0, c) for c in ("k", sha, "two", "own", "lost")]
    tokens = spark.createDataFrame(tokens, "file_path string, token_index int, source_line int, source_col int, source_text string, token_type string, token_value string, is_structural int, commit_sha string")
    out = dataset.dataset(tokens, commits, commitmap, emails, persons, footers, "demo")
    assert out.columns == DATASET
    of_o, of_own = (["<a@x.com>"], [None], [], ["p1", "p2"], ["One", "p2"]), ([], ["A\n"], ["no one", "no one"], [], [])
    got = sorted((r.rewritten_commit_sha, r.original_commit_sha, r.repo_tag, (r.footer_reviewed_by, r.footer_acked_by, r.footer_tested_by, r.footer_personids, r.footer_person_names)) for r in out.collect())
    assert got == sorted([("k", "o", "p", of_o), (sha, "o", "", of_o), ("two", "o", "l", of_o), ("two", "own", "", of_own), ("own", "own", "", of_own)])
    assert {(r.author_name, r.personid, r.person_name, r.person_email) for r in out.collect()} == {("A", "p1", "One", "a@x")}


def test_packed_rows_are_short(spark):
    """What is sorted for the sink are ids as bytes and two texts of each commit, whatever stands in these."""
    odd = ["a\0b", "\\", "\\e\\b\\n", "\1", "", None, "é\n"]
    rows = spark.createDataFrame([(odd, [x for x in odd if x is not None], [])], "v array<string>, a array<string>, b array<string>")
    rows = rows.select(dataset._joined([F.col("v")[i] for i in range(len(odd))], [F.col("a"), F.col("b")]).alias("t")).select(dataset._parts(F.col("t")).alias("p"))
    values, lists = dataset._parted(F.col("p"), len(odd), 2)
    assert rows.select(F.array(*values).alias("v"), *(x.alias(n) for n, x in zip("ab", lists, strict=True))).first() == (odd, [x for x in odd if x is not None], [])
    from tokentrail.plans.queries import _packed

    assert _packed(spark, SF).columns == [*TOKEN_COLUMNS, "packed", "facts", "packed_original", "repo", "lists"]
