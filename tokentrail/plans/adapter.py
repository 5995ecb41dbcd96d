"""The provenance tables, derived from the supplied test tables by SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

_ADDR = "'u' || CAST(floor({k} / 2) AS BIGINT) || '@d' || CAST(floor({k} / 2) AS BIGINT) % 5 || '.example.com'"
_MAIL = "CASE WHEN {k} % 7 = 0 THEN upper(" + _ADDR + ") ELSE " + _ADDR + " END"
_NAME = "'Dev N' || CAST(floor({k} / 3) AS BIGINT)"


def _k(template: str, k: str) -> str:
    return template.replace("{k}", k)


_PATH = "'src/d' || l_partkey % 13 || '/f' || l_partkey || CASE l_partkey % 5 WHEN 0 THEN '.c' WHEN 1 THEN '.CC' WHEN 2 THEN '.java' WHEN 3 THEN '.rs' ELSE '.txt' END"
_COMMIT = "CASE WHEN l_orderkey % 11 = 0 THEN sha1('c' || l_orderkey) ELSE sha1('o' || l_orderkey) END"

TABLES = {
    "commits": f"""SELECT sha1('c' || o_orderkey) AS cid, {_k(_NAME, 'o_custkey')} AS autname, {_k(_MAIL, 'o_custkey')} AS autemail,
        CAST(o_orderdate AS STRING) AS autdate, {_k(_NAME, '(o_custkey + o_orderkey % 4)')} AS comname, {_k(_MAIL, '(o_custkey + o_orderkey % 4)')} AS comemail,
        CAST(o_orderdate AS STRING) AS comdate, o_orderpriority AS summary, o_orderstatus = 'P' AS ismerge FROM orders""",
    "commitmap": """SELECT sha1('c' || o_orderkey) AS cid, sha1('o' || o_orderkey) AS originalcid,
        CASE o_orderkey % 4 WHEN 0 THEN 'p' WHEN 1 THEN 'b' WHEN 2 THEN 'l' ELSE NULL END AS repo FROM orders WHERE o_orderkey % 11 <> 0""",
    "emails": f"""SELECT DISTINCT {_k(_NAME, 'c_custkey')} AS emailname, {_k(_MAIL, 'c_custkey')} AS emailaddr, lower({_k(_ADDR, 'c_custkey')}) AS lcemail,
        'person ' || CAST(floor(c_custkey / 6) AS BIGINT) AS personid, 'd' || CAST(floor(c_custkey / 2) AS BIGINT) % 5 || '.example.com' AS domain FROM customer""",
    "persons": """SELECT DISTINCT 'person ' || CAST(floor(c_custkey / 6) AS BIGINT) AS personid,
        CASE WHEN CAST(floor(c_custkey / 6) AS BIGINT) % 2 = 0 THEN 'Person Number ' || CAST(floor(c_custkey / 6) AS BIGINT) ELSE NULL END AS personname FROM customer""",
    "footers": f"""SELECT {_COMMIT} AS cid,
        CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INT) AS idx,
        CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'Signed-off-by' WHEN 'NF' THEN 'reviewed-by' WHEN 'NO' THEN 'Reviewed-by' WHEN 'RF' THEN 'Acked-By' WHEN 'AO' THEN 'Tested-by' ELSE 'Co-authored-by' END AS key,
        CASE l_suppkey % 4 WHEN 0 THEN 'Some Name <' || {_k(_ADDR, 'l_suppkey')} || '>' WHEN 1 THEN {_k(_ADDR, 'l_suppkey')}
          WHEN 2 THEN 'noreply@forge.example.org writing for Name <' || {_k(_MAIL, 'l_suppkey')} || '>' ELSE 'nobody in particular' END AS value FROM lineitem""",
    "blame": f"""SELECT {_PATH} AS file_path,
        CAST(row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) - 1 AS INT) AS line_no,
        CASE WHEN l_orderkey % 97 = 0 THEN '' WHEN l_orderkey % 89 = 0 THEN 'no fields' ELSE sha1('c' || l_orderkey) || ';' || CASE WHEN l_suppkey % 6 = 0 THEN 'old/name.c' ELSE '' END || ';' || chr(9) ||
          CASE WHEN l_linenumber = 2 THEN l_suppkey || ':' || l_linenumber || chr(9) ELSE '' END ||
          CASE (l_suppkey + l_linenumber) % 12 WHEN 0 THEN 'begin_unit|revision:1;language:C' WHEN 1 THEN 'begin_function' WHEN 2 THEN 'end_function' WHEN 3 THEN 'DECL|function|f' || l_suppkey
            WHEN 4 THEN '|' WHEN 5 THEN '' WHEN 6 THEN 'begin_block' WHEN 7 THEN 'noseparator' WHEN 8 THEN 'operator||' WHEN 9 THEN 'literal|a|b' ELSE 'name|v' || l_partkey END END AS line FROM lineitem""",
    "logs": """SELECT sha1('c' || o_orderkey) AS cid, 'Subject ' || o_orderkey || CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN chr(10) || chr(10) || 'Signed-off-by: A <a@b.example>' ELSE chr(10) || chr(10) || 'body text' END ||
        CASE WHEN o_orderkey % 3 = 0 THEN chr(10) || 'Former-commit-id: ' || sha1('o' || o_orderkey) WHEN o_orderkey % 3 = 1 THEN chr(10) || 'Former-commit-id: ' || upper(sha1('o' || o_orderkey)) ELSE '' END ||
        CASE WHEN o_orderkey % 7 = 0 THEN chr(10) || chr(10) WHEN o_orderkey % 7 = 1 THEN chr(10) || 'after' ELSE '' END AS log FROM orders""",
    "parents": """SELECT sha1('c' || o_orderkey) AS cid, 0 AS idx, sha1('c' || p) AS parent FROM (SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p FROM orders) x WHERE p IS NOT NULL
        UNION ALL SELECT sha1('c' || o_orderkey) AS cid, 1 AS idx, sha1('c' || (o_orderkey - 1)) AS parent FROM orders WHERE o_orderstatus = 'P' AND o_orderkey > 0""",
    "blob_map": """SELECT orig_blob, path, CASE WHEN masked THEN sha1('t' || orig_blob) ELSE orig_blob END AS new_blob, CAST(doc_id % 7 AS BIGINT) AS processed_at, n_chars AS size FROM (
        SELECT doc_id, n_chars, sha1(coalesce(text, '')) AS orig_blob, source || '/' || doc_id || CASE doc_id % 6 WHEN 0 THEN '.c' WHEN 1 THEN '.CC' WHEN 2 THEN '.java' WHEN 3 THEN '.rs' WHEN 4 THEN '.txt' ELSE '.ac' END AS path, doc_id % 6 < 4 AS masked FROM documents) x""",
    "porcelain": """SELECT 'p' || conv_id || '.c' AS file_path, turn AS line_no, sha1(role || conv_id % 3) AS cid,
        CASE WHEN row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) = 1 THEN CASE WHEN role = 'user' THEN 'p' || conv_id || '.c' ELSE 'old' || conv_id || '.c' END ELSE NULL END AS filename, text AS content FROM conversations""",
    "refs": """SELECT 'refs/heads/' || n_name AS ref_name, sha1('c' || n_nationkey) AS orig_commit FROM nation UNION ALL SELECT 'refs/notes/' || r_name AS ref_name, sha1('c' || r_regionkey) AS orig_commit FROM region""",
    "source_refs": """SELECT 'refs/heads/' || n_name AS ref_name FROM nation WHERE n_regionkey < 3""",
    "grafts": """SELECT CASE WHEN o_orderkey % 4 = 0 THEN sha1('c' || o_orderkey) WHEN o_orderkey % 4 = 1 THEN '  ' || sha1('c' || o_orderkey) || '  x' || o_orderkey || ' y ' ELSE sha1('c' || o_orderkey) || ' z' || o_orderkey END AS value FROM orders WHERE o_orderkey % 10 = 0""",
    "files": """SELECT source || '/' || doc_id || '.txt' AS file_path, text FROM documents WHERE text IS NOT NULL""",
}


#: Tables numbered in groups of a key: their rows move by it as they are read. Spark would move them with all columns made,
#: commit ids and texts among these, which are many times as long.
MOVED = {"blame": ("lineitem", "l_partkey"), "footers": ("lineitem", "l_orderkey")}
#: Rows of a clustered table in a task.
TASK_ROWS = 1 << 17
#: What is made of that key, one to one. Rows that move by it move no more for what goes by file or by commit.
CLUSTERED = {"blame": _PATH, "footers": _COMMIT}


def needs(name: str) -> list[str]:
    """The base tables of an adapter table."""
    return [b for b in BASE if re.search(rf"\b{b}\b", TABLES[name])]


def load(spark: SparkSession, sf_dir: str, name: str, clustered: bool | None = False) -> DataFrame:
    """A base table or an adapter table. Only the tables and columns it needs are read. Numbered tables are clustered by
    their file or commit if asked for; with None they are not moved unless their numbers are used."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = TABLES[name]
    frames = {b: spark.read.parquet(f"{sf_dir}/{b}.parquet") for b in needs(name)}
    if name in MOVED:
        base, key = MOVED[name]
        if clustered:
            sql = sql.replace(f"PARTITION BY {key} ", f"PARTITION BY {CLUSTERED[name]} ")
            # a task makes far more of a row than moves, so rows bound it, not their bytes
            tasks, least = -(-frames[base].count() // TASK_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions"))
            many = [max(tasks, least)] if tasks > spark.sparkContext.defaultParallelism else []
            frames[base] = frames[base].repartition(*many, F.expr(CLUSTERED[name]))
        elif clustered is not None:
            frames[base] = frames[base].repartition(key)
    for b in frames:
        sql = re.sub(rf"\b(FROM) {b}\b", rf"\1 {{{b}}} AS {b}", sql)
    return spark.sql(sql, **frames)


def ctes(*names: str) -> str:
    """WITH clauses of adapter tables, for DuckDB."""
    return ", ".join(f"{n} AS ({TABLES[n]})" for n in names)
