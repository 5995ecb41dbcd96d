"""Document fingerprints: bottom-k sketches of word-shingle hashes, in DataFrame functions only.

A sketch is the ascending array of the k smallest distinct 48-bit hashes of a text's shingles of five words (a
shorter text is one shingle). Sketches of parts merge into the sketch of the whole by their k smallest values.
With fewer than k values a sketch is the whole set and all estimates are exact.

Nulls: a null text is the empty text, whose sketch is empty; two empty sketches are alike (1), an empty and
another are not (0). A null doc_id sorts first. Rows with one doc_id are rows of their own. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ranges

K, SHINGLE = 128, 5
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """Hashes of the words, in order."""
    return F.transform(F.filter(F.split(text, SPACE), lambda w: w != ""), lambda w: F.xxhash64(w))


def sketch_of(words: Column, k: int = K, n: int = SHINGLE) -> Column:
    """The sketch of a text from its words' hashes, which must be a column and not an expression: it is read for
    every element."""
    runs = F.zip_with(
        F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        F.zip_with(F.slice(words, 3, F.size(words)), F.slice(words, 4, F.size(words)), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        lambda x, y: F.struct(x["a"].alias("a"), x["b"].alias("b"), y["a"].alias("c"), y["b"].alias("d")),
    ) if n == 5 else None
    if runs is not None:
        hashes = F.zip_with(runs, F.slice(words, 5, F.size(words)), lambda x, e: F.when(e.isNotNull(), F.shiftrightunsigned(F.xxhash64(x["a"], x["b"], x["c"], x["d"], e), 16)))
    else:
        hashes = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.when(i + n - 1 <= F.size(words), F.shiftrightunsigned(F.xxhash64(F.slice(words, i, F.lit(n))), 16)))
    whole = F.array(F.shiftrightunsigned(F.xxhash64(words), 16))
    found = F.when(F.size(words) >= n, F.filter(hashes, lambda h: h.isNotNull())).when(F.size(words) > 0, whole).otherwise(F.array().cast("array<bigint>"))
    return F.slice(F.sort_array(F.array_distinct(found)), 1, k)


def merged(df: DataFrame, keys: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """The sketch of each group's union. Of a group's values only k leave each task and reach the last sort."""
    values = df.select(*keys, F.explode(sketch).alias("_h")).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))
    least = values.withColumn("_r", rank).filter(F.col("_r") <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the part of the union's k smallest values that both have."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / F.size(union).cast("double"))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k values."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * float(1 << 48) / F.element_at(a, -1))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated part of a's shingles that b has too."""
    j = resemblance(a, b, k)
    both = j / (1 + j) * (distinct_count(a, k) + distinct_count(b, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_count(a, k)))


def as_text(a: Column) -> Column:
    """A sketch as a string: 12 hexadecimal digits a value."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 12, "0")), "")


def from_text(s: Column) -> Column:
    return F.transform(F.filter(F.sequence(F.lit(0), F.length(s), F.lit(12)), lambda i: i < F.length(s)), lambda i: F.conv(F.substring(s, i + 1, F.lit(12)), 16, 10).cast("long"))


def with_next(docs: DataFrame, column: str) -> DataFrame:
    """Adds next: column's value in the row before by doc_id, and the last row's for the first (a ring).

    doc_id is cut in ranges that are sorted apart. Each range also gets the last row of the range with rows
    before it: the driver sees one doc_id a range, and the text moves once, but for these.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = ranges(docs, "doc_id", n)
    place = F.lit(0)
    if cuts:
        edges = F.array(*[F.lit(c) for c in cuts])
        below = F.array_position(F.transform(edges, lambda c: F.coalesce(F.col("doc_id"), F.lit(-(2**63))) <= c), True)
        place = F.when(below == 0, len(cuts)).otherwise(below - 1).cast("int")
    ranged = docs.withColumn("_range", place)
    order = [F.col("doc_id").asc_nulls_first(), F.col(column)]
    last = {r[0]: r[1] for r in ranged.groupBy("_range").agg(F.max(F.coalesce("doc_id", F.lit(-(2**63))))).collect()}
    filled = sorted(last)
    after = {r: filled[(i + 1) % len(filled)] for i, r in enumerate(filled)}
    if not filled:
        return docs.withColumn("next", F.lit(None).cast(dict(docs.dtypes)[column]))
    pick = F.array(*[F.array(F.lit(last[r]), F.lit(r).cast("long"), F.lit(after[r]).cast("long")) for r in filled])
    to = F.filter(pick, lambda x: (x[0] == F.coalesce(F.col("doc_id"), F.lit(-(2**63)))) & (x[1] == F.col("_range")))
    copies = F.concat(F.array(F.struct(F.col("_range"), F.lit(1).alias("own"))), F.transform(to, lambda x: F.struct(x[2].cast("int").alias("_range"), F.lit(0).alias("own"))))
    rows = ranged.withColumn("_c", F.explode(copies)).withColumn("_range", F.col("_c._range")).withColumn("_own", F.col("_c.own")).drop("_c")
    w = Window.partitionBy("_range").orderBy("_own", *order)
    return rows.repartitionById(n, "_range").withColumn("next", F.lag(column).over(w)).filter("_own = 1").drop("_range", "_own")


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Sketches of each text and of its edited text: the last third is the beginning of the next document's."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(base, "text").withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next", F.lit(1), cut))
    rows = rows.withColumn("edited", edited)
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), words_of(F.col("text")).alias("w"), words_of(F.col("edited")).alias("w_edited"), words_of(F.col("next")).alias("w_next"))
    rows = rows.select("doc_id", "n_chars", "edited_sha256", *[sketch_of(F.col(c), k).alias(s) for c, s in (("w", "a"), ("w_edited", "b"), ("w_next", "c"))])
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("a")).alias("fingerprint"),
        as_text(F.col("b")).alias("edited_fingerprint"),
        resemblance(F.col("a"), F.col("b"), k).alias("near_edited"),
        resemblance(F.col("a"), F.col("c"), k).alias("near_next"),
        distinct_count(F.col("a"), k).alias("n_shingles"),
    )
