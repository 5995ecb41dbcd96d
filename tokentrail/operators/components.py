"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..store import shared_folder


def _store(df: DataFrame) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/components-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _remove(spark: SparkSession, path: str, later: bool = False) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.deleteOnExit(p) if later else fs.delete(p, True)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links neighbours to the least of them. Least neighbours are found with partial sums, then joined back, so no
    node's neighbours meet in one task: Spark may split a hub's side of the join."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


#: Edges of which one task can hold all, 16 bytes each.
SMALL = 500_000


def _in_one_task(edges: DataFrame) -> DataFrame:
    """(u, v) with v the least node of u's component, by union-find over few edges."""
    import pyarrow as pa

    def run(batches):
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for b in batches:
            for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                u, v = root(u), root(v)
                if u != v:
                    parent[max(u, v)] = min(u, v)
        nodes = sorted(parent)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["u", "v"])

    return edges.coalesce(1).mapInArrow(run, "u long, v long")


def connected_components(edges: DataFrame, left: str = "u", right: str = "v", small: int = SMALL) -> DataFrame:
    """(node, component) of every node of an edge; component is the least node reachable.

    At most `small` edges of long nodes are counted first and then solved in one task. Null ends are left out; loops are nodes of their own. Each round is written in the folder of
    spark.checkpoint.dir; the driver sees a count and a checksum a round.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
    nodes, nodes_path = _store(pairs)
    _remove(spark, nodes_path, later=True)
    if dict(nodes.dtypes) == {"u": "bigint", "v": "bigint"} and nodes.count() <= small:
        now, path = _store(_in_one_task(nodes))
        _remove(spark, path, later=True)
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    now, path = nodes.filter("u <> v").distinct(), None
    before = None
    while True:
        now, new = _store(_star(_star(now, True), False))
        if path:
            _remove(spark, path)
        path = new
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first()
        if state == before or not state[0]:
            break
        before = state
    _remove(spark, path, later=True)
    loops = nodes.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return loops.join(now.withColumnRenamed("u", "node"), "node", "left").select("node", F.coalesce("v", "node").alias("component"))
