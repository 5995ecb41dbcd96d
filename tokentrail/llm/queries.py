"""The queries of the training-text operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, fingerprints, gif, jaccard_join, lang_id, line_dedup, mixing, pieces, quality, search, spelling, substring_dedup, token_store
from .common import table, work_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, WORD_BPE)
    return token_store.with_crc32(token_store.read_tokens(spark, path))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_classes(table(spark, sf_dir, "documents"))


def op5_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = gif.stored_media(table(spark, sf_dir, "documents"))
    return found.withColumns({"n_frames": F.size("frames"), "feature": gif.feature_of("frames")}).drop("frames")


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.report(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(table(spark, sf_dir, "documents"), PIECES).drop("ids", "n_best_ids")


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(search.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.write_formatted(table(spark, sf_dir, "conversations").select(more.columns).union(more)))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_store, op2_quality, op3_fingerprints, op4_jaccard, op5_gif, op6_lines, op7_substrings, op8_language, op9_mix, op10_pieces, op11_search, op12_chat, op13_spelling, pipeline)}


_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP4 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS s FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM both_ JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

OP6 = r"""
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents
), kept AS (
  SELECT doc_id, l, list_filter(range(1, len(l) + 1), lambda i: regexp_replace(l[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') <> '') AS at_ FROM lines
), runs AS (
  SELECT doc_id, k, at_[k] AS a, at_[k + 2] AS b, list_transform(at_[k:k+2], lambda i: regexp_replace(l[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) AS r
  FROM (SELECT doc_id, l, at_, unnest(range(1, len(at_) - 1)) AS k FROM kept)
), late AS (
  SELECT doc_id, k, a, b FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY doc_id, k) AS nth FROM runs) WHERE nth > 1
), gone AS (SELECT doc_id, list_distinct(flatten(list(range(a, b + 1)))) AS g,
    (SELECT count(*) FROM late x WHERE x.doc_id = late.doc_id AND NOT EXISTS (SELECT 1 FROM late y WHERE y.doc_id = x.doc_id AND y.k < x.k AND y.k >= x.k - 3)) AS n_runs FROM late GROUP BY doc_id)
SELECT k.doc_id, len(l)::BIGINT AS n_lines, coalesce(len(g), 0)::BIGINT AS n_removed, coalesce(n_runs, 0)::BIGINT AS n_runs,
  sha256(array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda i: g IS NULL OR NOT list_contains(g, i)), lambda i: l[i]), chr(10))) AS kept_sha256
FROM kept k LEFT JOIN gone USING (doc_id)
"""

OP7 = rf"""
WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (SELECT doc_id, k, array_to_string(w[k:k+19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS k FROM words)),
late AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY s ORDER BY doc_id, k) AS nth FROM windows) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS i FROM late),
each_ AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words),
left_ AS (SELECT e.doc_id, count(*) AS n, array_to_string(list(e.w[e.i] ORDER BY e.i), ' ') AS kept FROM each_ e ANTI JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id)
SELECT words.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN left_ USING (doc_id)
"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH terms AS (SELECT rid, doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM (SELECT *, row_number() OVER () AS rid FROM documents)),
held AS (SELECT rid, doc_id, t, count(*) AS tf FROM terms GROUP BY ALL), sizes AS (SELECT rid, count(*) AS n FROM terms GROUP BY rid),
all_ AS (SELECT count(*) AS N_, sum(n)::BIGINT AS L FROM sizes), df AS (SELECT t, count(*) AS df FROM held GROUP BY t),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
weighed AS (SELECT item_id, t, floor(1000 * ln((2 * N_ + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM asked JOIN df USING (t), all_),
scored AS (SELECT item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * N_) // L))))::BIGINT AS score FROM weighed JOIN held USING (t) JOIN sizes USING (rid), all_ GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0
QUALIFY rank <= 10
"""


def _op12() -> str:
    """The formatted length is summed up from roles, escaped texts and marks; attachments are told by their notation."""
    shown, sums = "text", []
    for i, (kind, names) in enumerate(chat.KINDS.items()):
        link = rf"!\[[^\[\]\n]*\]\([^()\x00-\x20]+\.(?i:{names.replace(' ', '|')})\)"
        shown = f"regexp_replace({shown}, '{link}', chr({0xE001 + i}), 'g')"
        sums.append(f"(length(shown) - length(replace(shown, chr({0xE001 + i}), '')))")
    marks = " + ".join(f"{len(kind) + 3} * {s}" for kind, s in zip(chat.KINDS, sums, strict=True))
    tokens = " + ".join(f"{n} * {s}" for n, s in zip(((chat.SIDE // chat.PATCH) ** 2, chat.AUDIO_RATE, chat.PAGE_TOKENS), sums, strict=True))
    escaped = r"length(replace(replace({}, '\', '\\'), '<|', '<\|'))"
    return rf"""
WITH rows_ AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) x(i)),
each_ AS (SELECT *, {shown} AS shown FROM rows_)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len("<|turn|><|text|><|end|>") + 1} + {escaped.format("role")} + {escaped.format("shown")} + {marks})::BIGINT AS formatted_chars, sum({" + ".join(sums)})::BIGINT AS n_attachments, sum({tokens})::BIGINT AS expanded_tokens
FROM each_ GROUP BY conv_id
"""


OP13 = rf"""
WITH RECURSIVE steps AS (SELECT i, i AS c, 0 AS k FROM range(256) x(i) UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM steps WHERE k = 8),
runs AS (SELECT rid, doc_id, run, count(*) AS n FROM (SELECT rid, doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM (SELECT *, row_number() OVER () AS rid FROM documents)) GROUP BY ALL),
checked AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(encode(key)) + 1), lambda p: ('0x' || hex(encode(key))[2 * p - 1:2 * p])::BIGINT)), lambda c, b: xor(c // 256, crcs[xor(c % 256, b) + 1]))) AS h
  FROM (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || run AS key FROM runs WHERE length(run) >= 5), crc_table),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM checked) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words),
holes AS (SELECT word, n, left(word, (p - 1)::INT) || '*' || substr(word, p + 1) AS hole, left(word, (p - 1)::INT) || substr(word, p + 1) AS less FROM places),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.less UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.less),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, encode(other))) AS other, max(other_n) AS other_n FROM near GROUP BY word),
formed AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS at_ FROM formed UNION ALL SELECT chain.word, form FROM chain JOIN formed ON formed.word = at_ WHERE form IS NOT NULL)
SELECT f.word, n, n_near, form, form_n, at_ AS root FROM formed f JOIN chain ON chain.word = f.word JOIN (SELECT word AS last_ FROM formed WHERE form IS NULL) ON at_ = last_
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_jaccard": OP4, "op6_lines": OP6, "op7_substrings": OP7, "op11_search": OP11, "op12_chat": _op12(), "op13_spelling": OP13}
