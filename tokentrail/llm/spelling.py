"""Spelling variants by pairless wildcard groups.

Words are counted over all whole texts. Two words are near if one inserted, deleted or replaced code point makes one of
the other.

- Replacements: a word of L code points is in L groups (position, prefix, suffix), each by its text with that place open. A
  group keeps its size and its two most frequent words; each member learns from these how many others there are and
  which of them is most frequent. Two words share one group at most, so sizes add up, and no pair is made.
- Insertions and deletions: the distinct deletions of a word are joined with the words themselves, and both ends learn
  of each other. Only deletions that are words come out of the join, L of a word at most.
- Forms are followed by doubling: each round, a word's pointer becomes the pointer of the word it points to. A form has
  twice the count at least, so the number of rounds is bounded by the logarithm of a logarithm.

Sizes: the letters of a word are 90 at most (a-z and U+00C0-U+00FF), so a group has 90 words at most and a word has
90 * (L + 1) that become it by a deletion. A word gives L rows, a word of more than LONG letters gives its open forms
as hashes of 128 bits. Counts are summed in each task first, so very common words move a row a task.

Nulls: null texts have no words; a null doc_id reads as an empty string before the colon. Rows with one doc_id are documents
of their own, equal rows as well. Empty texts have no words, very long ones are read whole. Ties are broken by code-point
order, which UTF-8's byte order is. An empty table gives no rows. Other columns, of any names, are left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, utf8, written

LEAST_CHARS, LEAST_N = 5, 3
EDIT = 97
#: Letters beyond which open forms are hashed.
LONG = 64
_RUN = re.compile("[a-zÀ-ÿ]+")
_HELD = 200_000


def count_words(text: bytes, doc_id: int | None, held: Counter, edit: int = EDIT) -> None:
    """Adds the words of one text to held; runs whose checksum edit divides lose a letter."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(_RUN.findall(text.lower().decode())).items():  # only A-Z are lowered in bytes
        if len(run) < LEAST_CHARS:
            continue
        h = zlib.crc32(run.encode(), start)
        if h % edit == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        held[run] += n


def counted(docs: DataFrame, edit: int = EDIT) -> DataFrame:
    """(word, n) over all texts, of words with LEAST_CHARS letters and LEAST_N occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            kept = [(w, n) for w, n in held.items() if len(w) >= LEAST_CHARS]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

        for b in slices(batches):
            for d, text in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                count_words(text, d, held, edit)
            if len(held) > _HELD:
                yield out()
                held.clear()
        yield out()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_N)


def _form(word: Column, size: Column, i: Column, mark: str) -> Column:
    """word with mark in place of its letter i, from 1; of long words its hash."""
    form = F.concat(F.substring(word, F.lit(1), i - 1), F.lit(mark), F.substring(word, i + 1, size))
    return F.when(size <= LONG, form).otherwise(F.md5(form))


def _merged(df: DataFrame) -> DataFrame:
    """df for a join by sorting: words in a file are a small part of their size in memory, so that Spark would send tables of
    many words through the driver."""
    return df.hint("merge")


def _best(n: Column, word: Column) -> Column:
    """The least of these is the most frequent word, the first in code-point order among equals."""
    return F.struct((-n).alias("minus"), word.alias("word"))


def replacements(words: DataFrame) -> DataFrame:
    """(word, n_near, best): near words by one replaced letter, summed up by group."""
    size = F.length("word")
    holes = words.select("word", "n", F.explode(F.transform(F.sequence(F.lit(1), size), lambda i: _form(F.col("word"), size, i, "*"))).alias("hole"))
    top = F.slice(F.sort_array(F.collect_list(_best(F.col("n"), F.col("word")))), 1, 2)  # of 90 words at most
    groups = holes.groupBy("hole").agg(F.count(F.lit(1)).alias("size"), top.alias("top")).filter("size > 1")
    met = holes.join(_merged(groups), "hole")
    other = F.when(F.col("top")[0]["word"] == F.col("word"), F.col("top")[1]).otherwise(F.col("top")[0])
    return met.groupBy("word").agg(F.sum(F.col("size") - 1).alias("n_near"), F.min(other).alias("best"))


def deletions(words: DataFrame) -> DataFrame:
    """(word, n_near, best): near words by one inserted or deleted letter. Both ends of each are told."""
    size = F.length("word")
    shorter = F.array_distinct(F.transform(F.sequence(F.lit(1), size), lambda i: _form(F.col("word"), size, i, "")))
    gone = words.filter(size > LEAST_CHARS).select("word", "n", F.explode(shorter).alias("key"))
    known = words.select(F.when(size < LONG, F.col("word")).otherwise(F.md5("word")).alias("key"), F.col("word").alias("less"), F.col("n").alias("less_n"))
    met = gone.join(_merged(known), "key")
    up = met.groupBy(F.col("less").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(_best(F.col("n"), F.col("word"))).alias("best"))
    down = met.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(_best(F.col("less_n"), F.col("less"))).alias("best"))
    return up.union(down)


def forms(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) for each word of (word, n)."""
    near = replacements(words).union(deletions(words)).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    form_n = -F.col("best.minus")
    taken = form_n >= 2 * F.col("n")
    out = words.join(_merged(near), "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("best.word")).alias("form"), F.when(taken, form_n).alias("form_n"))


def with_roots(found: DataFrame) -> DataFrame:
    """found with root, the last of the forms that follow each other from a word on. found should be a stored table."""
    links = found.filter("form IS NOT NULL").select("word", F.col("form").alias("to"))
    while True:
        onward = links.select(F.col("word").alias("to"), F.col("to").alias("next"))
        links = written(links.join(_merged(onward), "to", "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "forms")
        if links.filter("moved").isEmpty():
            break
        links = links.drop("moved")
    return found.join(_merged(links.select("word", F.col("to").alias("root"))), "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of all words of the documents."""
    words = written(counted(docs), "words")
    found = written(forms(words), "near")
    return with_roots(found).select("word", "n", "n_near", "form", "form_n", "root")
