"""A training corpus from documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents.

1. quality: documents that the classifier scores below its threshold go; labels are those of the labels table.
2. lines: later repeated runs of lines are cut out of the texts; documents of which nothing is left go.
3. near_duplicates: of each group that links on five-word shingles at a similarity of 0.8, the least doc_id stays.
4. mix: sources are brought to their target weights by blocks of words; a document may come twice.
5. pieces: texts become piece ids, with the scores of their best segmentations and a check of decoding.

Nulls and empty texts pass quality by their score; they are empty sets in stage 3 and take nothing in stage 4. Rows with
a null doc_id are no copies of others in stage 3, and of rows with one doc_id all stay or all go; equal rows there count
as one document and all stay if it does. Very long texts are worked on whole. Empty tables give no rows. Other columns
of documents, of any names, come through to stage 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokentrail.llm import jaccard_join, line_dedup, mixing, pieces, quality
from tokentrail.llm.common import small_batches, table, written
from tokentrail.llm.queries import PIECES

WORDS, PERCENT = 5, 80


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return line_dedup.without_repeats(docs)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    classes = jaccard_join.similarity_classes(docs, WORDS, PERCENT)
    others = classes.filter(F.col("component_id") < F.col("doc_id")).select(F.col("doc_id").alias("other")).distinct()
    return docs.join(others, docs["doc_id"].cast("long") == others["other"], "left_anti")


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mixing.mixed_documents(docs, spark)


def stage_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pieces.encode_pieces(docs, PIECES)


STAGES = [("quality", stage_quality), ("lines", stage_lines), ("near_duplicates", stage_near_duplicates), ("mix", stage_mix), ("pieces", stage_pieces)]

#: The classifier, the seeded blocks and the piece lattice are beyond SQL; tests hold stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
