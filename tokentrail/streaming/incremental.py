"""New commits as they arrive: file streams that keep what they know in state and write only what is new."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.history import commit_map, git_object_id
from ..operators.rewrite import commit_body, with_footer
from ..schema import LOGS

#: A commit as it comes in; tree is the new id of its root tree.
COMMITS = "repo string, cid string, tree string, parents array<string>, author binary, committer binary, encoding binary, message binary"
_WAITING = "missing int, tree string, parents array<string>, author binary, committer binary, encoding binary, message binary"
_STORE = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _written(rows: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    """Writes each batch to a folder of its own number, so a batch that is done again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    return rows.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _stateful(spark: SparkSession) -> None:
    """State goes to RocksDB, so it may be larger than memory and each batch stores its changes only."""
    spark.conf.set(*_STORE)


def stream_commit_map(spark: SparkSession, logs_path: str, out_path: str, checkpoint: str) -> StreamingQuery:
    """Maps the commits of log files (Parquet) that come in under logs_path. The first row of a commit counts: ids that
    were seen are keyed state, and no output is read."""
    _stateful(spark)
    return _written(commit_map(spark.readStream.schema(LOGS).parquet(logs_path).dropDuplicates(["cid"])), out_path, checkpoint)


class _Fold(StatefulProcessor):
    """One repository's commits in any order: a commit gets its new id as soon as all its parents have theirs, and waits in
    the state until then; repeats are dropped."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.new = handle.getMapState("new", "cid string", "new_id string")
        self.waiting = handle.getMapState("waiting", "cid string", _WAITING)
        self.children = handle.getMapState("children", "cid string", "cids array<string>")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timers) -> Iterator[Row]:
        for r in rows:
            if self.new.containsKey((r.cid,)) or self.waiting.containsKey((r.cid,)):
                continue
            row = (r.tree, list(r.parents), *(None if x is None else bytes(x) for x in (r.author, r.committer, r.encoding, r.message)))
            missing = {p for p in r.parents if not self.new.containsKey((p,))}
            if not missing:
                yield from self._settle(key[0], r.cid, row)
                continue
            self.waiting.updateValue((r.cid,), (len(missing), *row))
            for p in missing:
                known = list(self.children.getValue((p,))[0]) if self.children.containsKey((p,)) else []
                self.children.updateValue((p,), ([*known, r.cid],))

    def _settle(self, repo: str, cid: str, row: tuple) -> Iterator[Row]:
        ready = [(cid, row)]
        while ready:
            cid, (tree, parents, author, committer, encoding, message) = ready.pop()
            body = commit_body(tree, [self.new.getValue((p,))[0] for p in parents], author, committer, encoding, with_footer(message, cid))
            new = git_object_id("commit", body)
            self.new.updateValue((cid,), (new,))
            yield Row(repo=repo, orig_commit=cid, new_commit=new)
            if not self.children.containsKey((cid,)):
                continue
            for child in self.children.getValue((cid,))[0]:
                missing, *held = self.waiting.getValue((child,))
                if missing > 1:
                    self.waiting.updateValue((child,), (missing - 1, *held))
                else:
                    self.waiting.removeKey((child,))
                    ready.append((child, (held[0], list(held[1]), *(None if x is None else bytes(x) for x in held[2:]))))
            self.children.removeKey((cid,))

    def close(self) -> None:
        pass


def stream_rewritten_commits(spark: SparkSession, commits_path: str, out_path: str, checkpoint: str, files: int | None = None) -> StreamingQuery:
    """New ids (repo, orig_commit, new_commit) of the commits (Parquet, COMMITS) that come in under commits_path, in whatever
    order; files: how many make a batch at most. Each batch writes the commits that it has settled. A repository is one
    key, as its ids hang together; its state is keyed by commit, and only what a batch touches is read."""
    _stateful(spark)
    source = spark.readStream.schema(COMMITS)
    if files:
        source = source.option("maxFilesPerTrigger", files)
    rows = source.parquet(commits_path).groupBy("repo").transformWithState(_Fold(), "repo string, orig_commit string, new_commit string", "append", "none")
    return _written(rows, out_path, checkpoint)
