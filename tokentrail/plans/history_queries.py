"""Queries of the history rewrite: trees, refs, maps and their upkeep."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import maplog
from ..functions import text as fn
from ..operators import blame, history, mapping, ownership, rewrite
from ..sources import commits, git, packs
from ..store import shared_folder, stored
from .adapter import ctes, load
from .registry import query

# 40 roots hold files and 15 sub-trees. The last five of these hold other trees (deep), and those hold some of the first
# sub-trees again, which so stand on the first and on the third level
TREES = """root_entries AS (SELECT DISTINCT sha1('root' || l_orderkey % 40) AS tree, 'd' || l_suppkey % 15 AS name, '40000' AS mode, sha1('sub' || l_suppkey % 15) AS object_id FROM lineitem
  UNION SELECT DISTINCT sha1('root' || l_orderkey % 40), 'f' || l_partkey || CASE l_partkey % 3 WHEN 0 THEN '.c' WHEN 1 THEN '.RS' ELSE '.txt' END, CASE l_partkey % 4 WHEN 0 THEN '100755' ELSE '100644' END, sha1('b' || l_partkey) FROM lineitem
  UNION SELECT DISTINCT sha1('root' || l_orderkey % 40), 'module', '160000', sha1('module') FROM lineitem WHERE l_orderkey % 40 < 9),
sub_entries AS (SELECT DISTINCT sha1('sub' || l_suppkey % 15) AS tree, 'g' || l_partkey || CASE l_partkey % 3 WHEN 0 THEN '.java' WHEN 1 THEN '.cc' ELSE '.md' END AS name, '100644' AS mode, sha1('b' || l_partkey) AS object_id FROM lineitem
  UNION SELECT DISTINCT sha1('sub' || l_suppkey % 15), 'e' || l_linenumber % 3, '40000', sha1('deep' || l_linenumber % 3) FROM lineitem WHERE l_suppkey % 15 > 9
  UNION SELECT DISTINCT sha1('deep' || l_linenumber % 3), 'h' || l_partkey % 50 || '.c', '100644', sha1('b' || l_partkey % 50) FROM lineitem
  UNION SELECT DISTINCT sha1('deep' || l_linenumber % 3), 's' || l_linenumber, '40000', sha1('sub' || (2 + l_linenumber)) FROM lineitem),
entries AS (SELECT * FROM root_entries UNION ALL SELECT * FROM sub_entries)"""
# trees that are known already, and blobs
KNOWN = """known_trees AS (SELECT DISTINCT sha1('sub' || l_suppkey % 15) AS orig_tree, sha1('new' || l_suppkey % 15) AS new_tree FROM lineitem WHERE l_suppkey % 15 < 3
  UNION SELECT DISTINCT sha1('root' || l_orderkey % 40), sha1('newroot' || l_orderkey % 40) FROM lineitem WHERE l_orderkey % 40 = 7),
known_blobs AS (SELECT DISTINCT sha1('b' || l_partkey) AS orig_blob, 'f' || l_partkey || '.c' AS path, sha1('t' || l_partkey) AS new_blob FROM lineitem WHERE l_partkey % 12 = 0)"""
MASK = fn.file_mask()
_MASKED = "regexp_matches(lower(name), '[.](c|cc|java|rs)$')"
PLAN = f"""met AS (SELECT DISTINCT tree, '' AS prefix, 0 AS depth FROM root_entries WHERE tree NOT IN (SELECT orig_tree FROM known_trees)
  UNION SELECT object_id, prefix || name || '/', depth + 1 FROM met JOIN entries USING (tree) WHERE mode = '40000' AND object_id NOT IN (SELECT orig_tree FROM known_trees)),
plan AS (SELECT depth, tree, prefix || name AS path, name, mode, object_id FROM (SELECT tree, min(depth) AS depth, arg_min(prefix, (depth, prefix)) AS prefix FROM met GROUP BY tree) JOIN entries USING (tree)),
told AS (SELECT plan.*, CASE WHEN mode = '40000' THEN 'subtree' WHEN mode = '160000' THEN 'gitlink' WHEN NOT {_MASKED} THEN 'unchanged' WHEN new_blob IS NULL THEN 'miss' ELSE 'hit' END AS plan,
  CASE WHEN mode NOT IN ('40000', '160000') AND {_MASKED} THEN new_blob END AS new_id FROM plan LEFT JOIN known_blobs k ON k.orig_blob = object_id AND k.path = plan.path)"""


def _entries(spark, d):
    """The entries of TREES, which number their rows: distinct numbers are found and stored before names and ids are made of
    them, as these are many times as long."""
    n = load(spark, d, "lineitem").select((F.col("l_orderkey") % 40).alias("root"), (F.col("l_suppkey") % 15).alias("sub"), F.col("l_partkey").alias("part"), F.col("l_linenumber").alias("line"))
    none = F.lit(None).cast("long")
    row = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.cast("long").alias("a"), b.cast("long").alias("b"))
    root, sub, part, line = (F.col(c) for c in n.columns)
    kinds = [row("f", root, part), row("g", sub, part), row("d", root, sub), row("module", F.when(root < 9, root), none), row("e", F.when(sub > 9, sub), line % 3), row("h", line % 3, part % 50), row("s", line % 3, line)]
    rows = stored(n.select(F.inline(F.array(*kinds))).filter("a IS NOT NULL").distinct(), "numbers")
    kind, a, b = F.col("kind"), F.col("a"), F.col("b")
    text = lambda *c: F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in c))
    end = lambda x, y, z: F.when(b % 3 == 0, x).when(b % 3 == 1, y).otherwise(z)
    tree = F.when(kind.isin("f", "d", "module"), text("root", a)).when(kind.isin("g", "e"), text("sub", a)).otherwise(text("deep", a))
    name = F.when(kind == "f", text("f", b, end(".c", ".RS", ".txt"))).when(kind == "g", text("g", b, end(".java", ".cc", ".md"))).when(kind == "h", text("h", b, ".c")).when(kind == "module", "module").otherwise(text(kind, b))
    mode = F.when(kind.isin("d", "e", "s"), "40000").when(kind == "module", "160000").when((kind == "f") & (b % 4 == 0), "100755").otherwise("100644")
    of = F.when(kind == "d", text("sub", b)).when(kind == "e", text("deep", b)).when(kind == "s", text("sub", b + 2)).when(kind == "module", "module").otherwise(text("b", b))
    return rows.select(F.sha1(tree.cast("binary")).alias("tree"), name.alias("name"), mode.alias("mode"), F.sha1(of.cast("binary")).alias("object_id"))


def _tables(spark, d, *names):
    """Named tables of the SQL above."""
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    orders, parts, subs = (lines.select(c.cast("long").alias("i")).distinct() for c in (F.col("l_orderkey") % 40, F.col("l_partkey"), F.col("l_suppkey") % 15))
    sha = lambda c: F.sha1(F.concat(F.lit(c), "i").cast("binary"))

    def table(name):
        if name == "entries":
            return _entries(spark, d)
        if name == "known_blobs":
            return parts.filter("i % 12 = 0").select(sha("b").alias("orig_blob"), F.concat(F.lit("f"), "i", F.lit(".c")).alias("path"), sha("t").alias("new_blob"))
        return subs.filter("i < 3").select(sha("sub").alias("orig_tree"), sha("new").alias("new_tree")).unionByName(orders.filter("i = 7").select(sha("root").alias("orig_tree"), sha("newroot").alias("new_tree")))

    return [table(n) for n in names]


def _plan(spark, d):
    entries, trees, blobs = _tables(spark, d, "entries", "known_trees", "known_blobs")
    entries = entries.withColumn("name", F.col("name").cast("binary"))
    roots = load(spark, d, "lineitem").select(F.sha1(F.concat(F.lit("root"), F.col("l_orderkey") % 40).cast("binary")).alias("root")).distinct()
    return rewrite.plan_trees(entries, roots, MASK, trees, blobs)


@query(f"WITH RECURSIVE {TREES}, {KNOWN}, {PLAN} SELECT * FROM told")
def tree_plan(spark, d):
    return _plan(spark, d).withColumn("name", F.col("name").cast("string"))


@query(f"""WITH RECURSIVE {TREES}, walked AS (SELECT sha1('root' || r_regionkey) AS root, sha1('root' || r_regionkey) AS tree, '' AS prefix FROM region
  UNION ALL SELECT root, object_id, prefix || name || '/' FROM walked JOIN entries USING (tree) WHERE mode = '40000')
SELECT root, prefix || name AS path, object_id FROM walked JOIN entries USING (tree) WHERE mode LIKE '100%' AND {_MASKED}""")
def tracked_files(spark, d):
    entries = _tables(spark, d, "entries")[0].withColumns({"name": F.col("name").cast("binary"), "repo": F.lit("r")})
    roots = load(spark, d, "region").select(F.lit("r").alias("repo"), F.sha1(F.concat(F.lit("root"), "r_regionkey").cast("binary")).alias("root"))
    return git.tracked_files(entries, roots, MASK, stored).drop("repo")


# a tree's bytes by its entries in git's order; the new ids of planned trees, sub-trees first
_BYTES = """SELECT tree, sha1(encode('tree ' || (length(h) // 2)::VARCHAR) || '\\x00'::BLOB || unhex(h)) AS new_tree
  FROM (SELECT tree, string_agg(hex(encode(mode || ' ' || name)) || '00' || upper(new_id), '' ORDER BY hex(encode(name || CASE WHEN mode = '40000' THEN '/' ELSE '' END))) AS h FROM {rows} GROUP BY tree)"""


def _heights(which: str, done: str) -> str:
    """The entries with new ids of the planned trees of one height."""
    return f"(FROM (SELECT tree, name, mode, new_id FROM leaves WHERE new_id IS NOT NULL UNION ALL SELECT told.tree, name, mode, new_tree FROM told JOIN {done} AS d ON d.tree = object_id WHERE plan = 'subtree') WHERE {which})"


_NEW = f"""blobs_ AS (SELECT DISTINCT object_id, path, sha1('t' || object_id) AS new_id FROM told WHERE plan = 'miss' AND NOT starts_with(object_id, '0')),
leaves AS (SELECT depth, tree, name, mode, CASE WHEN plan = 'hit' THEN told.new_id WHEN plan = 'miss' THEN b.new_id ELSE object_id END AS new_id FROM told LEFT JOIN blobs_ b USING (object_id, path) WHERE plan <> 'subtree'),
of_known AS (SELECT orig_tree AS tree, new_tree FROM known_trees),
new0 AS ({_BYTES.format(rows=_heights("tree NOT IN (SELECT tree FROM told WHERE plan = 'subtree' AND object_id NOT IN (SELECT tree FROM of_known))", "of_known"))}), done0 AS (SELECT * FROM of_known UNION ALL SELECT * FROM new0),
new1 AS ({_BYTES.format(rows=_heights("tree IN (SELECT sha1('deep' || i) FROM range(3) x(i)) AND tree NOT IN (SELECT tree FROM done0)", "done0"))}), done1 AS (SELECT * FROM done0 UNION ALL SELECT * FROM new1),
new2 AS ({_BYTES.format(rows=_heights("tree IN (SELECT sha1('sub' || i) FROM range(15) x(i)) AND tree NOT IN (SELECT tree FROM done1)", "done1"))}), done2 AS (SELECT * FROM done1 UNION ALL SELECT * FROM new2),
new3 AS ({_BYTES.format(rows=_heights("tree NOT IN (SELECT tree FROM done2)", "done2"))})"""


@query(f"WITH RECURSIVE {TREES}, {KNOWN}, {PLAN}, {_NEW} SELECT tree AS orig_tree, new_tree FROM new0 UNION ALL FROM new1 UNION ALL FROM new2 UNION ALL FROM new3")
def tree_assembly(spark, d):
    plan = _plan(spark, d)
    # misses whose id begins with 0 were excluded
    new = plan.filter("plan = 'miss' AND NOT startswith(object_id, '0')").select(F.col("object_id").alias("orig_blob"), "path", F.sha1(F.concat(F.lit("t"), "object_id").cast("binary")).alias("new_blob")).distinct()
    return rewrite.assemble(plan, new, _tables(spark, d, "known_trees")[0]).select("orig_tree", "new_tree")


@query(f"WITH RECURSIVE {TREES}, {KNOWN}, {PLAN} SELECT DISTINCT object_id AS orig_blob, path, object_id AS new_blob FROM told WHERE plan = 'unchanged'")
def identity_rows(spark, d):
    return rewrite.identity_rows(_plan(spark, d)).drop("processed_at")


@query(f"WITH RECURSIVE {TREES}, {KNOWN}, {PLAN} SELECT DISTINCT object_id FROM told WHERE plan = 'unchanged' AND object_id < 'c'")
def originals_to_copy(spark, d):
    rows = rewrite.identity_rows(_plan(spark, d))
    return rewrite.originals(rows, rows.filter("orig_blob >= 'c'").select(F.col("orig_blob").alias("object_id")))


@query(f"WITH RECURSIVE {TREES} SELECT DISTINCT object_id, mode FROM entries WHERE mode LIKE '100%' QUALIFY row_number() OVER (PARTITION BY object_id ORDER BY mode) = 1")
def merged_objects(spark, d):
    entries = _tables(spark, d, "entries")[0].filter("mode LIKE '100%'").groupBy("object_id").agg(F.min("mode").alias("mode"))
    return rewrite.merged_objects([entries.filter("object_id < 'a'"), entries.filter("object_id > '5'")])


# refs: a branch a nation, of an order's commit; a tag a region, every second one annotated; a symbolic one and notes
_REFS = """pointed AS (SELECT 'refs/heads/' || n_name AS ref_name, sha1('c' || n_nationkey) AS object_id, NULL AS symref FROM nation UNION ALL SELECT 'refs/tags/' || r_name, CASE WHEN r_regionkey % 2 = 0 THEN sha1('tag' || r_regionkey) ELSE sha1('c' || r_regionkey) END, NULL FROM region
  UNION ALL SELECT 'refs/notes/' || r_name, sha1('c' || r_regionkey), NULL FROM region UNION ALL SELECT 'HEAD', NULL, 'refs/heads/' || min(n_name) FROM nation),
tag_rows AS (SELECT sha1('tag' || r_regionkey) AS tag_id, sha1(CASE WHEN r_regionkey = 2 THEN 'tag0' ELSE 'c' || r_regionkey END) AS target, CASE WHEN r_regionkey = 2 THEN 'tag' ELSE 'commit' END AS target_kind, 'v' || r_name AS tag,
  CASE WHEN r_regionkey = 4 THEN NULL ELSE 'T <t@x> 1 +0000' END AS tagger, 'About ' || r_name || chr(10) AS message, r_regionkey FROM region WHERE r_regionkey % 2 = 0),
mapped AS (SELECT sha1('c' || o_orderkey) AS orig_commit, sha1('o' || o_orderkey) AS new_commit FROM orders WHERE o_orderkey % 11 <> 5)"""


@query(f"""WITH {_REFS}, peeled AS (SELECT p.*, CASE WHEN t.r_regionkey = 2 THEN sha1('c0') ELSE coalesce(t.target, p.object_id) END AS peeled, tag, tagger, message, t.tag_id IS NOT NULL AS annotated FROM pointed p LEFT JOIN tag_rows t ON t.tag_id = object_id WHERE symref IS NULL),
found AS (SELECT * FROM peeled JOIN mapped ON orig_commit = peeled)
SELECT ref_name, CASE WHEN annotated THEN 'annotated_tag' WHEN starts_with(ref_name, 'refs/tags/') THEN 'lightweight_tag' ELSE 'head' END AS kind, object_id AS orig_target,
  CASE WHEN annotated THEN sha1(encode('tag ' || length(body)::VARCHAR) || '\\x00'::BLOB || encode(body)) ELSE new_commit END AS new_target, orig_commit, new_commit, NULL AS symref, regexp_matches(ref_name, '^refs/(heads|tags|remotes)/') AS recorded
FROM (SELECT *, 'object ' || new_commit || chr(10) || 'type commit' || chr(10) || 'tag ' || tag || chr(10) || 'tagger ' || coalesce(tagger, 'unknown <unknown> 0 +0000') || chr(10) || chr(10) || message AS body FROM found)
UNION ALL SELECT ref_name, 'symbolic', NULL, NULL, NULL, NULL, symref, false FROM pointed WHERE symref IS NOT NULL""")
def ref_projection(spark, d):
    sql = f"WITH {_REFS} SELECT 'r' AS repo, * FROM "
    frames = {t: load(spark, d, t) for t in ("nation", "region", "orders")}
    for t in frames:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}")
    used = lambda q: {t: f for t, f in frames.items() if f"{{{t}}}" in q}
    refs, tags, mapped = (spark.sql(sql + n, **used(sql)) for n in ("pointed", "tag_rows", "mapped"))
    for c in ("tag", "tagger", "message"):
        tags = tags.withColumn(c, F.col(c).cast("binary"))
    return rewrite.project_refs(refs, tags.drop("r_regionkey"), mapped).drop("repo", "processed_at")


# ---- maps ----

_B = "WITH " + ctes("blob_map")


@query(_B + " SELECT count_if(orig_blob <> new_blob)::BIGINT AS tokenized, count_if(orig_blob = new_blob)::BIGINT AS identity, (SELECT count(*) FROM orders) AS trees, (SELECT count(*) FROM customer) AS commits, (SELECT count(*) FROM nation) AS refs FROM blob_map")
def map_counts_of_all(spark, d):
    return mapping.row_counts(load(spark, d, "blob_map"), *(load(spark, d, t) for t in ("orders", "customer", "nation")))


@query(_B + r", m AS (SELECT DISTINCT sha1(path) AS content_sha, lower(regexp_extract(path, '\.([^./]+)$', 1)) AS ext, processed_at < 3 AS known FROM blob_map WHERE size > 0) SELECT content_sha, ext, 'ok' AS status, [CASE WHEN known THEN 'memo' ELSE 'new' END] AS tokens FROM m")
def memo_reuse(spark, d):
    rows = load(spark, d, "blob_map").filter("size > 0").select(F.sha1(F.col("path").cast("binary")).alias("content_sha"), fn.extension(F.col("path")).alias("ext"), F.col("path").cast("binary").alias("content"), "processed_at")
    memo = rows.filter("processed_at < 3").select("content_sha", "ext", F.array(F.lit("memo")).alias("tokens"))
    return mapping.memoised(rows, memo, lambda new: new.select("content_sha", "ext", F.lit("ok").alias("status"), F.array(F.lit("new")).alias("tokens")))


@query(r"WITH c AS (SELECT 'e' || p_partkey % 7 AS ext, p_partkey AS seq, p_name AS content FROM part) SELECT ext, sha256(string_agg(sha256(content), chr(10) ORDER BY seq)) AS digest FROM c GROUP BY ext")
def tokenizer_digests(spark, d):
    p = load(spark, d, "part").select(F.concat(F.lit("e"), F.col("p_partkey") % 7).alias("ext"), F.col("p_partkey").alias("seq"), F.col("p_name").cast("binary").alias("content"))
    return mapping.identity_digests(p)


@query("SELECT doc_id::VARCHAR AS file_path, n_chars AS size, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS place FROM documents WHERE n_chars IS NOT NULL")
def largest_first(spark, d):
    files = load(spark, d, "documents").filter("n_chars IS NOT NULL").select(F.col("doc_id").cast("string").alias("file_path"), F.col("n_chars").alias("size"), F.col("doc_id").alias("ordinal"))
    return mapping.largest_first(files)


@query("SELECT 'blob ' || doc_id AS label, 100 - doc_id % 97 AS seconds FROM documents ORDER BY seconds DESC, label LIMIT 16")
def in_flight(spark, d):
    return mapping.in_flight(load(spark, d, "documents").select(F.concat(F.lit("blob "), "doc_id").alias("label"), (F.col("doc_id") % 97).alias("started")), 100)


@query("SELECT source || '/' || doc_id AS path, n_chars AS size FROM documents WHERE n_chars > 0 AND doc_id % 3 <> 1")
def not_done_yet(spark, d):
    docs = load(spark, d, "documents").select(F.concat("source", F.lit("/"), "doc_id").alias("path"), F.col("n_chars").alias("size"), "doc_id")
    return blame.without_done(docs, docs.filter("doc_id % 3 = 1").select(F.col("path").alias("file_path"))).select("path", "size")


# parents by number, dates as they are: half of all commits are dated before a parent
_GRAPH = """edges AS (SELECT 'k' || o_orderkey AS cid, 0 AS idx, 'k' || p AS parent FROM (SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders) x WHERE p IS NOT NULL
  UNION ALL SELECT 'k' || o_orderkey, 1, 'k' || p FROM (SELECT o_orderkey, o_orderkey - 1 AS p FROM orders WHERE o_orderstatus = 'P') x),
dated AS (SELECT 'k' || o_orderkey AS cid, CAST(o_orderdate AS STRING) AS autdate FROM orders)"""
_ORDINALS = f"""RECURSIVE {_GRAPH}, at_ AS (SELECT cid, epoch(autdate::TIMESTAMP)::BIGINT AS own FROM dated),
late AS (SELECT cid, own AS put FROM at_ UNION SELECT e.cid, late.put + 1 FROM late JOIN edges e ON e.parent = late.cid JOIN at_ ON at_.cid = e.cid WHERE late.put >= own),
ordered AS (SELECT cid, row_number() OVER (ORDER BY max(put), cid) - 1 AS i, (SELECT count(*) FROM orders) AS m FROM late GROUP BY cid)"""


def _graph(spark, d):
    sql = f"WITH {_GRAPH} SELECT * FROM ".replace("FROM orders", "FROM {orders}")
    return [spark.sql(sql + t, orders=load(spark, d, "orders")) for t in ("dated", "edges")]


@query(f"WITH {_ORDINALS} SELECT cid, i AS ordinal, ((i + 1) * 7 - 1) // m AS shard FROM ordered")
def shard_ranges(spark, d):
    return history.shards(*_graph(spark, d), 7)


@query(f"WITH {_ORDINALS} SELECT cid FROM ordered WHERE ((i + 1) * 5 - 1) // m = 2")
def shard_commits(spark, d):
    commits, parents = _graph(spark, d)
    return rewrite.shard_of(commits, 2, 5, parents).select("cid")


# ---- blame ----

# 30 files of like blocks of unlike length, 20 of them of the parent; brackets and blank lines between, lines that repeat
_MOVED = """line_rows AS (SELECT 'm' || l_orderkey % 30 AS file_path, CAST(row_number() OVER (PARTITION BY l_orderkey % 30 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS INT) AS line_no,
  CASE l_linenumber WHEN 3 THEN '  ' || chr(125) WHEN 5 THEN '' ELSE 'part ' || l_linenumber || ' of ' || CAST(floor(l_orderkey / 30) AS BIGINT) % 17 || ' from ' || CAST(floor(l_orderkey / 210) AS BIGINT) % 4 END AS text, l_orderkey % 30 < 20 AS parent FROM lineitem)"""


@query(f"""WITH {_MOVED}, s AS (SELECT * REPLACE (trim(text) AS text), length(regexp_replace(text, '[^a-zA-Z0-9]', '', 'g')) AS n FROM line_rows),
met AS (SELECT a.file_path, a.line_no, a.n, b.file_path AS from_file, b.line_no AS from_no, a.line_no - b.line_no AS apart FROM s a JOIN s b USING (text) WHERE NOT a.parent AND b.parent AND a.file_path <> b.file_path),
runs AS (SELECT *, line_no - row_number() OVER (PARTITION BY file_path, from_file, apart ORDER BY line_no) AS run FROM met)
SELECT file_path, min(line_no) FILTER (n > 0) AS first, max(line_no) FILTER (n > 0) AS last, from_file, min(from_no) FILTER (n > 0) AS from_first FROM runs GROUP BY file_path, from_file, apart, run HAVING sum(n) >= 60""")
def moved_blocks(spark, d):
    sql = f"WITH {_MOVED} SELECT * FROM line_rows".replace("FROM lineitem", "FROM {lineitem}")
    return blame.moved_blocks(spark.sql(sql, lineitem=load(spark, d, "lineitem")), 60)


# a file a customer, a version an order: the parts of this order and the two before it, a line each
_HELD = """o AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders),
parts AS (SELECT DISTINCT o_custkey, k, l_partkey FROM o JOIN lineitem ON l_orderkey = o_orderkey),
held AS (SELECT DISTINCT a.o_custkey, a.k, p.l_partkey FROM o a JOIN parts p ON p.o_custkey = a.o_custkey AND p.k BETWEEN a.k - 2 AND a.k)"""
_VERSIONS = f"""{_HELD}, whole AS (SELECT o_custkey, k, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_partkey) AS body FROM held GROUP BY ALL)"""


@query(f"""WITH {_VERSIONS}, islands AS (SELECT *, k - row_number() OVER (PARTITION BY o_custkey, l_partkey ORDER BY k) AS island, row_number() OVER (PARTITION BY o_custkey, k ORDER BY l_partkey) - 1 AS line_no FROM held),
born AS (SELECT *, min(k) OVER (PARTITION BY o_custkey, l_partkey, island) AS first FROM islands)
SELECT 'c' || a.o_custkey || '-' || a.k AS cid, 'f' || a.o_custkey AS path, a.line_no::INT AS line_no, 'c' || a.o_custkey || '-' || a.first AS commit_sha, 'f' || a.o_custkey AS old_path, b.line_no::INT AS old_line
FROM born a JOIN born b ON b.o_custkey = a.o_custkey AND b.l_partkey = a.l_partkey AND b.k = a.first
WHERE NOT EXISTS (SELECT 1 FROM whole x JOIN whole y ON y.o_custkey = x.o_custkey AND y.k = x.k - 1 AND y.body = x.body WHERE x.o_custkey = a.o_custkey AND x.k = a.k)""")
def line_owners(spark, d):
    parts = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_partkey").alias("parts"))
    orders = load(spark, d, "orders").select("o_custkey", "o_orderkey").filter("o_custkey IS NOT NULL")
    of = Window.partitionBy("o_custkey").orderBy(F.asc_nulls_last("o_orderkey"))
    held = orders.join(parts, "o_orderkey", "left").select("o_custkey", F.row_number().over(of).alias("k"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("parts").over(of.rowsBetween(-2, 0))))).alias("held")).filter("size(held) > 0")
    cid = lambda k: F.concat(F.lit("c"), "o_custkey", F.lit("-"), k)
    whole = held.select(cid(F.col("k")).alias("cid"), F.concat(F.lit("f"), "o_custkey").alias("path"), F.when(F.col("k") > 1, cid(F.col("k") - 1)).alias("parent"), F.transform("held", lambda x: x.cast("string")).alias("lines"))
    whole = stored(whole.withColumn("blob", F.unhex(F.md5(F.array_join("lines", "\n").cast("binary")))), "versions")
    parents = whole.filter("parent IS NOT NULL").select("cid", F.lit(0).alias("idx"), "parent")
    return ownership.owners(whole.select("cid", "path", "blob"), parents, whole.select("blob", "lines"))


@query("WITH e AS (SELECT DISTINCT 't' || n_regionkey AS tree, 'n' || n_nationkey AS name, '100644' AS mode, sha1(n_name) AS object_id FROM nation), h AS (SELECT tree, string_agg(hex(encode(mode || ' ' || name)) || '00' || upper(object_id), '' ORDER BY hex(encode(name))) AS h FROM e GROUP BY tree) SELECT tree, sha1(encode('tree ' || (length(h) // 2)::VARCHAR) || '\\x00'::BLOB || unhex(h)) AS new_tree FROM h")
def tree_ids(spark, d):
    n = load(spark, d, "nation").select(F.concat(F.lit("t"), "n_regionkey").alias("tree"), F.concat(F.lit("n"), "n_nationkey").alias("name"), F.lit("100644").alias("mode"), F.sha1(F.col("n_name").cast("binary")).alias("object_id"))
    return history.tree_bodies(n).select("tree", "new_tree")


# ---- objects, commits and maps that are written and read again ----


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(r"SELECT DISTINCT sha1(encode('blob ' || octet_length(encode(text))::VARCHAR) || '\x00'::BLOB || encode(text)) AS object_id, 'blob' AS kind, octet_length(encode(text)) AS size, sha256(text) AS content_sha256 FROM documents WHERE text IS NOT NULL")
def packed_objects(spark, d):
    text = F.col("text").cast("binary")
    docs = load(spark, d, "documents").filter("text IS NOT NULL").select(rewrite.git_id("blob", text).alias("object_id"), F.lit("blob").alias("kind"), text.alias("content"))
    path = _folder(spark, "packs")
    packs.write_objects(docs, path)
    return packs.objects(spark, path).select("object_id", "kind", "size", F.sha2("content", 256).alias("content_sha256"))


# a chain of commits a customer; every seventh message ends in a trailer
_CHAIN = """chain AS (SELECT o_custkey, o_orderkey, 'k' || o_orderkey AS cid, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, sha1('t' || o_orderkey) AS tree, 'Dev <d@x> ' || o_orderkey || ' +0000' AS who,
  'Order ' || o_orderkey || chr(10) || chr(10) || CASE o_orderkey % 7 WHEN 0 THEN 'Signed-off-by: Dev <d@x>' ELSE 'text' END AS message FROM orders),
linked AS (SELECT a.*, b.cid AS parent FROM chain a LEFT JOIN chain b ON b.o_custkey = a.o_custkey AND b.k = a.k - 1)"""
_COMMIT = """sha1(encode('commit ' || octet_length(encode({body}))::VARCHAR) || '\\x00'::BLOB || encode({body}))"""
_COMMIT_BODY = """'tree ' || sha1('n' || {t}.tree) || chr(10) || {parent} || 'author ' || {t}.who || chr(10) || 'committer ' || {t}.who || chr(10) || chr(10) || {t}.message || CASE WHEN {t}.o_orderkey % 7 = 0 THEN chr(10) ELSE chr(10) || chr(10) END || 'Former-commit-id: ' || {t}.cid"""


@query(f"""WITH RECURSIVE {_CHAIN}, made AS (SELECT o_custkey, k, cid, {_COMMIT.format(body=_COMMIT_BODY.format(t="c", parent="''"))} AS new_commit FROM chain c WHERE k = 1
  UNION ALL SELECT c.o_custkey, c.k, c.cid, {_COMMIT.format(body=_COMMIT_BODY.format(t="c", parent="'parent ' || made.new_commit || chr(10)"))} FROM made JOIN chain c ON c.o_custkey = made.o_custkey AND c.k = made.k + 1)
SELECT 'r' || o_custkey % 16 AS repo, cid AS orig_commit, new_commit FROM made""")
def commit_fold(spark, d):
    rows = spark.sql(f"WITH {_CHAIN} SELECT * FROM linked".replace("FROM orders", "FROM {orders}"), orders=load(spark, d, "orders"))
    binary = lambda c: F.col(c).cast("binary")
    commits = rows.select(F.concat(F.lit("r"), F.col("o_custkey") % 16).alias("repo"), "cid", "tree", F.when(F.col("parent").isNull(), F.array().cast("array<string>")).otherwise(F.array("parent")).alias("parents"), binary("who").alias("author"), binary("who").alias("committer"), F.lit(None).cast("binary").alias("encoding"), binary("message").alias("message"))
    trees = rows.select(F.col("tree").alias("orig_tree"), F.sha1(F.concat(F.lit("n"), "tree").cast("binary")).alias("new_tree")).distinct()
    none = spark.createDataFrame([], "repo string, orig_commit string, new_commit string")
    return rewrite.fold_commits(stored(commits, "commits"), trees, none).drop("processed_at")


_OBJECTS = """SELECT sha1('c' || o_orderkey) AS cid, 'Dev ' || o_custkey || ' <d' || o_custkey % 9 || '@x.example> ' || (1000000000 + o_orderkey * 7919) || ' +0130' AS author, 'Com  <c@x> ' || (1000000100 + o_orderkey * 7919) || ' -0800' AS committer,
  'Order ' || o_orderkey || CASE o_orderkey % 3 WHEN 0 THEN chr(10) || 'goes on' ELSE '' END || CASE o_orderkey % 4 WHEN 0 THEN '' ELSE chr(10) || chr(10) || 'Reviewed-by: R' || o_custkey || ' <r@x>' || chr(10) || 'Cc: two' || chr(10) || '  lines' END AS message, o_custkey FROM orders"""


@query(f"""WITH o AS ({_OBJECTS}), n AS (SELECT *, split_part(message, ' ', 2) AS rest, CAST(regexp_extract(author, '> ([0-9]+)', 1) AS BIGINT) AS at_ FROM o)
SELECT cid, 'Dev ' || o_custkey AS autname, 'd' || o_custkey % 9 || '@x.example' AS autemail, strftime(to_timestamp(at_) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS autdate, 'Com' AS comname, 'c@x' AS comemail, strftime(to_timestamp(at_ + 100) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS comdate,
  replace(split_part(message, chr(10) || chr(10), 1), chr(10), ' ') AS summary, false AS ismerge, CASE WHEN contains(message, 'Cc') THEN ['Reviewed-by=R' || o_custkey || ' <r@x>', 'Cc=two lines'] ELSE [] END AS trailers FROM n""")
def history_tables(spark, d):
    rows = spark.sql(_OBJECTS.replace("FROM orders", "FROM {orders}"), orders=load(spark, d, "orders"))
    for c in ("author", "committer", "message"):
        rows = rows.withColumn(c, F.col(c).cast("binary"))
    t = commits.tables(rows.withColumns({"parents": F.array().cast("array<string>"), "encoding": F.lit(None).cast("binary")}))
    trailers = t["footers"].groupBy("cid").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", F.concat_ws("=", "key", "value").alias("t")))), lambda x: x["t"]).alias("trailers"))
    return t["commits"].join(trailers, "cid", "left").withColumn("trailers", F.coalesce("trailers", F.array().cast("array<string>")))


@query("WITH m AS (SELECT sha1('t' || o_orderkey % 5000) AS orig_tree, sha1('n' || o_orderkey) AS new_tree, floor(o_orderkey / 5000)::BIGINT AS processed_at FROM orders) SELECT orig_tree, arg_min(new_tree, processed_at) AS new_tree, min(processed_at) AS processed_at FROM m GROUP BY orig_tree")
def map_log(spark, d):
    """Three runs append to a log; keys that are known stay as they are."""
    key = F.col("o_orderkey")
    rows = load(spark, d, "orders").select(F.sha1(F.concat(F.lit("t"), key % 5000).cast("binary")).alias("orig_tree"), F.sha1(F.concat(F.lit("n"), key).cast("binary")).alias("new_tree"), F.floor(key / 5000).alias("processed_at"))
    base = _folder(spark, "log")
    for part in ("processed_at = 0", "processed_at = 1", "processed_at > 1"):
        maplog.append(spark, base, {"tree_map": rows.filter(part).orderBy("processed_at")})
    return maplog.read(spark, base, "tree_map")
