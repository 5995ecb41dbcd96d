"""Streams that keep state: any order of arrival gives what one run over all rows gives."""

import random

import pytest

from tests.test_rewrite import empty
from tokentrail.operators import rewrite
from tokentrail.streaming import incremental


def commits(seed):
    rng = random.Random(seed)
    rows = []
    for repo in ("r", "s"):
        for i in range(25):
            parents = sorted({f"{repo}{rng.randrange(i)}" for _ in range(rng.choice([1, 1, 2]))}) if i and rng.random() < 0.95 else []
            rows.append((repo, f"{repo}{i}", "t" * 40, parents, b"A <a> %d +0000" % rng.randint(0, 99), b"A <a> %d +0000" % rng.randint(0, 99), None, b"message %d" % i))
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_commits_in_any_order(spark, tmp_path, seed):
    rows = commits(seed)
    frame = spark.createDataFrame(rows, incremental.COMMITS)
    trees = spark.createDataFrame([("t" * 40, "t" * 40, 0)], "orig_tree string, new_tree string, processed_at long")
    want = {(r.repo, r.orig_commit): r.new_commit for r in rewrite.fold_commits(frame, trees, empty(spark)["commit_map"]).collect()}
    rng = random.Random(seed)
    late = [*rows, *rng.sample(rows, 15)]  # some come twice
    rng.shuffle(late)
    paths = [str(tmp_path / x) for x in ("in", "out", "state")]
    cut = sorted(rng.sample(range(1, len(late)), 3))
    for i, part in enumerate([late[: cut[0]], late[cut[0] : cut[1]], late[cut[1] : cut[2]], late[cut[2] :]]):
        spark.createDataFrame(part, incremental.COMMITS).coalesce(1).write.mode("append").parquet(paths[0])
        if i % 2:  # the stream is stopped and goes on from its state
            incremental.stream_rewritten_commits(spark, *paths, files=1).awaitTermination()
    got = [((r.repo, r.orig_commit), r.new_commit) for r in spark.read.parquet(paths[1]).collect()]
    assert len(got) == len(want) and dict(got) == want
