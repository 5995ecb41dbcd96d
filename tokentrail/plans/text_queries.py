"""Queries of column functions, lexers, repair, rendering, and of files that go out and come back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as fn
from ..operators import contributors, dataset, lexers, render, walk
from ..sources import readers, sinks
from ..store import shared_folder, write_files
from .adapter import ctes, load
from .registry import query

# names with accents, some of one word, some with a blank behind
NAMES = """people AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Jörg Ærø' WHEN 1 THEN 'Éßen' WHEN 2 THEN 'Núñez ða ' ELSE 'Plain Name' END || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' ' || c_custkey END || CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE '' END AS name,
  CASE WHEN c_custkey % 6 = 0 THEN 'noat' || c_custkey ELSE 'U' || c_custkey || '@Ex' || c_custkey % 3 || '@y' END AS email FROM customer)"""
_PLAIN = "replace(replace(replace(replace(strip_accents(name), 'ø', 'o'), 'ß', 'ss'), 'æ', 'ae'), 'ð', 'o')"


def _people(spark, d):
    return spark.sql(f"WITH {NAMES} SELECT * FROM people".replace("FROM customer", "FROM {customer}"), customer=load(spark, d, "customer"))


@query(f"""WITH {NAMES}, p AS (SELECT *, {_PLAIN} AS plain FROM people) SELECT c_custkey, plain, CASE WHEN contains(plain, ' ') THEN lower(plain) ELSE lower(plain || ' at ' || email) END AS key, CASE WHEN contains(name, ' ') THEN name ELSE email END AS preferred, name || ' <' || email || '>' AS whole,
  regexp_replace(name, ' $', '') AS trimmed, split_part(lower(email), '@', 1) AS userid, CASE WHEN contains(email, '@') THEN lower(email)[strpos(email, '@') + 1:] ELSE '' END AS domain FROM p""")
def name_functions(spark, d):
    n, e = F.col("name"), F.col("email")
    parts = fn.email_parts(e)
    return _people(spark, d).select("c_custkey", fn.strip_accents(n).alias("plain"), fn.name_key(n, e).alias("key"), fn.preferred_name(n, e).alias("preferred"), fn.full_email(n, e).alias("whole"), fn.without_last_space(n).alias("trimmed"), parts["userid"].alias("userid"), parts["domain"].alias("domain"))


@query(f"WITH {NAMES} SELECT c_custkey, name AS undone, name AS kept FROM people")
def mojibake_undone(spark, d):
    twice = F.decode(F.encode("name", "UTF-8"), "ISO-8859-1")
    once = F.when(F.col("name").rlike("[^\\x00-\\x7f]"), fn.undo_mojibake(twice)).otherwise(F.col("name"))
    return _people(spark, d).select("c_custkey", once.alias("undone"), fn.undo_mojibake(F.col("name")).alias("kept"))


@query("SELECT l_orderkey, l_linenumber, least(greatest(l_orderkey * 100000 + l_suppkey * 30000000, 0), 2147483647)::INT AS total, least(greatest(l_orderkey::HUGEINT * l_partkey * CASE WHEN l_linenumber = 3 THEN -1 ELSE 900 END, 0), 2147483647)::INT AS product FROM lineitem")
def saturating(spark, d):
    a, b, c = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", fn.saturating_sum(a * 100000, c * 30000000).alias("total"), fn.saturating_product(a, b * F.when(F.col("l_linenumber") == 3, -1).otherwise(900)).alias("product"))


@query(r"SELECT doc_id, sha1(replace(replace(text, chr(10), ' '), chr(13), ' ')) AS folded, text <> '' AND starts_with(regexp_replace(text, '[ \t\n\r]', '', 'g')[4:], regexp_replace(text[1:9], '[ \t\n\r]', '', 'g')[4:]) AND regexp_replace(text[1:9], '[ \t\n\r]', '', 'g')[4:] <> '' AS holds FROM documents WHERE text IS NOT NULL")
def text_functions(spark, d):
    t = load(spark, d, "documents").filter("text IS NOT NULL")
    solid = F.regexp_replace("text", walk.WS, "")
    ahead = F.substring(F.regexp_replace(F.substring("text", 1, 9), walk.WS, ""), 4, 99)
    return t.select("doc_id", F.sha1(fn.folded(F.col("text")).cast("binary")).alias("folded"), walk.holds_next(solid, F.lit(3), ahead).alias("holds"))


# words of sources; every third of those with accents stands encoded twice in the tokens
@query(f"""WITH {NAMES}, w AS (SELECT 'f' || c_custkey // 10 || CASE WHEN c_custkey // 10 % 4 = 0 THEN '.rs' ELSE '.c' END AS file_path, (c_custkey % 10)::INT AS token_index, replace(name, ' ', '') AS word, c_custkey % 3 = 0 AS twice FROM people)
SELECT file_path, token_index, CASE WHEN twice AND ends_with(file_path, '.rs') THEN 'twice ' || sha1(word) ELSE word END AS token_value, twice AND regexp_matches(word, '[^\\x00-\\x7f]') AND NOT ends_with(file_path, '.rs') AS was_repaired FROM w WHERE NOT (twice AND ends_with(file_path, '.rs'))""")
def repaired_tokens(spark, d):
    word = F.replace("name", F.lit(" "), F.lit(""))
    path = F.concat(F.lit("f"), F.floor(F.col("c_custkey") / 10), F.when(F.floor(F.col("c_custkey") / 10) % 4 == 0, ".rs").otherwise(".c"))
    p = _people(spark, d).select(path.alias("file_path"), (F.col("c_custkey") % 10).cast("int").alias("token_index"), word.alias("word"), (F.col("c_custkey") % 3 == 0).alias("twice"))
    tokens = p.select("file_path", "token_index", F.lit("name").alias("token_type"), F.when(F.col("twice"), F.decode(F.encode("word", "UTF-8"), "ISO-8859-1")).otherwise(F.col("word")).alias("token_value"), F.lit(0).alias("is_structural"), "twice")
    sources = p.groupBy("file_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("token_index", "word"))), lambda x: x["word"]), "\n ").alias("text")).withColumn("repairable", ~F.col("file_path").endswith(".rs"))
    out = walk.repaired(tokens, sources).filter(~(F.col("twice") & F.col("file_path").endswith(".rs")))
    return out.select("file_path", "token_index", "token_value", "was_repaired")


@query("WITH " + ctes("blame") + " SELECT DISTINCT file_path FROM blame WHERE contains(line, ';') AND NOT file_path LIKE '%7.%'")
def missing_sources(spark, d):
    tokens = dataset.token_rows(load(spark, d, "blame"))
    return walk.missing_sources(tokens, tokens.filter("file_path LIKE '%7.%'").select("file_path").distinct())


# ---- lexers ----

_SOLID = r"regexp_replace(regexp_replace(text, '\\\r?\n', '', 'g'), '[\s\p{Z}\x{85}\x{0b}\x{0c}\x{1c}-\x{1f}]', '', 'g')"


@query(f"WITH x AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'C' WHEN 1 THEN 'C++' ELSE 'Java' END AS language, {_SOLID} AS solid FROM documents WHERE text IS NOT NULL) SELECT doc_id, language, sha1(solid) AS solid FROM x")
def lexed_solids(spark, d):
    """Every solid character of a text is in one token, in order, whatever the text."""
    import pyarrow as pa

    docs = load(spark, d, "documents").filter("text IS NOT NULL")
    language = F.when(F.col("doc_id") % 3 == 0, "C").when(F.col("doc_id") % 3 == 1, "C++").otherwise("Java")

    def run(batches):
        for b in batches:
            out = []
            for lang, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                values = "".join(v for line, _, _, v in lexers.LEXERS[lang](text) if line)
                out.append(fn.sha1_hex(fn.re.sub(r"\\\r?\n|\s", "", values).encode()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=["doc_id", "language", "solid"])

    return docs.select("doc_id", language.alias("language"), "text").mapInArrow(run, "doc_id long, language string, solid string")


@query()
def token_lines(spark, d):
    """Token lines of all documents as files of seven languages."""
    docs = load(spark, d, "documents").filter("text IS NOT NULL")
    ext = F.element_at(F.array(*map(F.lit, ("c", "cpp", "java", "rs", "am"))), (F.col("doc_id") % 5 + 1).cast("int"))
    found = lexers.tokenized(docs.select(F.concat(F.lit("f."), ext).alias("path"), F.col("text").cast("binary").alias("content")))
    return found.select("content_sha", "ext", "status", F.size("tokens").alias("n_lines"))


# ---- reports ----


@query("""WITH r AS (SELECT o_orderpriority AS file_path, 'P' || o_custkey % 50 AS person, sum(o_orderkey % 7)::BIGINT AS tokens, count(*) AS commits FROM orders GROUP BY ALL),
s AS (SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY tokens DESC, person) AS place, round(100 * tokens / sum(tokens) OVER (PARTITION BY file_path), 2) AS token_pct, round(100 * commits / sum(commits) OVER (PARTITION BY file_path), 2) AS commit_pct FROM r)
SELECT file_path, person, tokens, commits, token_pct, commit_pct, place::INT AS place FROM s UNION ALL SELECT file_path, 'Total', sum(tokens)::BIGINT, sum(commits)::BIGINT, max(CASE WHEN token_pct IS NOT NULL THEN 100.0 END), 100.0, (max(place) + 1)::INT FROM s GROUP BY file_path""")
def report_with_totals(spark, d):
    o = load(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("file_path"), F.concat(F.lit("P"), F.col("o_custkey") % 50).alias("person")).agg(F.sum(F.col("o_orderkey") % 7).alias("tokens"), F.count(F.lit(1)).alias("commits"))
    return contributors.with_totals(contributors._shares(o, ["file_path"]), ["file_path"])


@query("""WITH x AS (SELECT doc_id, text AS t, CASE doc_id % 4 WHEN 0 THEN 'p' WHEN 1 THEN 'b' WHEN 2 THEN 'l' END AS repo FROM documents WHERE text IS NOT NULL), e AS (SELECT *, replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS h FROM x)
SELECT doc_id, '<span class="c' || doc_id % 67 || '" title="' || h || '" onclick="' || CASE repo WHEN 'p' THEN 'windowPre' WHEN 'b' THEN 'windowBit' WHEN 'l' THEN 'windowLin' ELSE 'window' END || '(''' || sha1(t) || ''')">' || h || '</span>' AS span, 'src/' || source_ || '.c in src v1 http://x' AS header
FROM e JOIN (SELECT doc_id, source AS source_ FROM documents) USING (doc_id)""")
def html_spans(spark, d):
    docs = load(spark, d, "documents").filter("text IS NOT NULL").withColumnRenamed("text", "t")
    repo = F.when(F.col("doc_id") % 4 == 0, "p").when(F.col("doc_id") % 4 == 1, "b").when(F.col("doc_id") % 4 == 2, "l")
    name = F.concat(F.lit("src/"), "source", F.lit(".c"))
    return docs.select("doc_id", render.token_span(F.col("t"), F.sha1(F.col("t").cast("binary")), repo, (F.col("doc_id") % 67).cast("string"), F.col("t")).alias("span"), render.expanded(F.lit("_FILENAME_ in _DIRNAME_ v_VERSION_ _REPO_URL_"), name, F.lit("src"), F.lit("1"), F.lit("http://x")).alias("header"))


# ---- files that go out and come back ----


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("WITH " + ctes("blame") + " SELECT file_path, line_no, line FROM blame")
def blame_file_scan(spark, d):
    rows = load(spark, d, "blame").groupBy("file_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("content"))
    root = _folder(spark, "blame")
    write_files(rows.select("file_path", F.concat("content", F.lit("\n")).alias("content")), root, ".blame")
    return readers.blame_files(spark, root)


@query(r"""SELECT 'd' || doc_id % 7 || '/' || doc_id || CASE WHEN doc_id % 3 = 0 THEN '.rs' ELSE '.c' END AS file_path, sha1(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))) AS text_sha, doc_id % 5 = 0 AS had_bom, doc_id % 5 <> 0 AND doc_id % 3 <> 0 AS repairable FROM documents WHERE text <> ''""")
def source_file_scan(spark, d):
    docs = load(spark, d, "documents").filter("text <> ''")
    content = F.concat(F.when(F.col("doc_id") % 5 == 0, F.lit(b"\xef\xbb\xbf")).otherwise(F.lit(b"")), F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit("\r\n"))).otherwise(F.col("text")).cast("binary"))
    root = _folder(spark, "sources")
    write_files(docs.select(F.concat(F.lit("d"), F.col("doc_id") % 7, F.lit("/"), "doc_id", F.when(F.col("doc_id") % 3 == 0, ".rs").otherwise(".c")).alias("file_path"), content.alias("content")), root)
    return readers.source_files(spark, root).select("file_path", F.sha1(F.col("text").cast("binary")).alias("text_sha"), "had_bom", "repairable")


@query("SELECT c_custkey::BIGINT AS c_custkey, c_name FROM customer")
def sqlite_scan(spark, d):
    path = f"{_folder(spark, 'rows').removeprefix('file://').removeprefix('file:')}.db"
    sinks.write_sqlite(load(spark, d, "customer").select(F.col("c_custkey").cast("long"), "c_name"), path, "customer", window=700)
    return readers.sqlite_table(spark, path, "customer", 3)
