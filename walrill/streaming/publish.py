"""The source side of the stream: replication messages to committed events and on to the transport, batch by batch.

What a batch leaves behind for the next is small or append-only: the latest description of each relation, and the messages of a
transaction that is still open, as a list of folders to which each batch adds its own. A batch without a commit is only noted;
one with a commit decodes all up to its last commit. Every batch writes folders named by its number and last its state file, so a
batch that comes again after a crash starts from the same state and writes the same."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from walrill.functions.retry import Backoff, PermanentError, fence_key
from walrill.operators.decode import MESSAGE, decode
from walrill.operators.envelope import to_records
from walrill.operators.ordered import numbered
from walrill.storage import names, read_text, remove, write_text
from walrill.streaming.observe import Metrics

#: A message's JSON form in the feed: all but its position, which the source gives.
BODY = MESSAGE.split(", ", 1)[1]
FAULT = "pos bigint, reason string"
RECORD = "offset bigint, key string, value string, headers array<struct<key:string,value:binary>>"


def parsed(rows: DataFrame) -> DataFrame:
    """Messages from (lsn, body); a body that can't be read has kind ``unreadable``."""
    m = rows.select(F.col("lsn").alias("pos"), F.from_json("body", BODY).alias("m")).select("pos", "m.*")
    return m.withColumn("kind", F.coalesce("kind", F.lit("unreadable")))


class Publisher:
    """Decodes micro-batches of (lsn, body) and writes records to ``path``/records, faults to ``path``/faults.

    Messages come in order of position, one transaction after the other. What is delivered again from an earlier position on
    replaces what was kept of the open transaction from there; :meth:`reset` forgets it wholly, as after a new connection. A
    position that falls behind the durable one is refused, since what lies between was published."""

    def __init__(self, spark: SparkSession, path: str, identity: DataFrame | None = None, sink: Callable[[DataFrame, int], None] | None = None, on_commit: Callable[[dict], None] | None = None):
        self.spark, self.path, self.identity, self.on_commit = spark, path.rstrip("/"), identity, on_commit
        self.sink = sink or (lambda records, batch: records.write.mode("overwrite").parquet(f"{self.path}/records/batch={batch}"))

    def state(self, before: int | None = None) -> dict:
        """The state after the newest batch, or the newest before ``before``."""
        found = [int(n[6:-5]) for n in names(self.spark, self.path) if n.startswith("state-")]
        found = [b for b in found if before is None or b < before]
        none = {"batch": -1, "open": [], "open_from": None, "relations": None, "durable": 0, "next": 0}
        return json.loads(read_text(self.spark, self._file(max(found)))) if found else none

    def _file(self, batch: int) -> str:
        return f"{self.path}/state-{batch:012d}.json"

    def _messages(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], MESSAGE)
        return self.spark.read.schema(MESSAGE).parquet(*folders)

    def reset(self) -> None:
        """Forgets the open transaction; the source sends it again from its beginning."""
        now = self.state()
        if now["open"]:
            write_text(self.spark, self._file(now["batch"]), json.dumps(now | {"open": [], "open_from": None}), replace=True)

    def __call__(self, rows: DataFrame, batch: int) -> None:
        old, home = self.state(batch), f"{self.path}/messages/batch={batch}"
        parsed(rows).write.mode("overwrite").parquet(home)
        new = self._messages([home])
        seen = new.agg(F.min("pos").alias("first"), F.max(F.when(F.col("kind") == "commit", F.col("pos"))).alias("commit"), F.max(F.when(F.col("kind") == "begin", F.col("pos"))).alias("begin"), F.count(F.when(F.col("kind") == "commit", 1)).alias("commits")).first()
        if seen["first"] is None:
            return
        if seen["first"] <= old["durable"]:
            raise RuntimeError(f"position {seen['first']} was published before: {old['durable']} is durable")
        kept = self._messages(old["open"]).where(F.col("pos") < seen["first"])
        relations = self._messages([old["relations"]] if old["relations"] else []).where(F.col("pos") < seen["first"])
        is_open = seen["begin"] is not None and (seen["commit"] is None or seen["begin"] > seen["commit"])
        state = {"batch": batch, "open": old["open"], "open_from": old["open_from"], "relations": old["relations"], "durable": old["durable"], "next": old["next"]}
        if seen["commit"] is None:
            # Nothing to publish yet; of the open transaction only a folder's name is added.
            state |= {"open": [*old["open"], home], "open_from": seen["begin"] if old["open_from"] is None else old["open_from"]}
        else:
            whole = relations.unionByName(kept).unionByName(new.where(F.col("pos") <= seen["commit"]))
            events, faults = decode(whole.where("kind <> 'unreadable'"), self.identity)
            placed = numbered(events, ["commit_pos", "source.sequence"], "offset").withColumn("offset", F.col("offset") + (old["next"] - 1))
            self.sink(to_records(placed, ("offset",)), batch)
            broken = whole.where("kind = 'unreadable'").select("pos", F.lit("unreadable message").alias("reason"))
            faults.unionByName(broken).write.mode("overwrite").parquet(f"{self.path}/faults/batch={batch}")
            every = whole.where("kind = 'relation'")
            latest = every.groupBy("relation_id").agg(F.max("pos").alias("pos"))
            every.join(latest, ["relation_id", "pos"], "left_semi").write.mode("overwrite").parquet(f"{self.path}/relations/batch={batch}")
            tail = f"{self.path}/open/batch={batch}"
            new.where(F.col("pos") > seen["commit"]).write.mode("overwrite").parquet(tail)
            state |= {"open": [tail], "open_from": seen["begin"] if is_open else None, "relations": f"{self.path}/relations/batch={batch}", "durable": seen["commit"], "next": old["next"] + int(events.count())}
        write_text(self.spark, self._file(batch), json.dumps(state), replace=True)
        if self.on_commit is not None:
            self.on_commit({"batch": batch, "durable": state["durable"], "open_from": state["open_from"], "published": state["next"] - old["next"], "transactions": seen["commits"] if seen["commit"] is not None else 0})

    def records(self) -> DataFrame:
        """All that was published, in the folder form of the sink."""
        if not names(self.spark, f"{self.path}/records"):
            return self.spark.createDataFrame([], f"{RECORD}, batch int")
        return self.spark.read.schema(f"{RECORD}, batch int").parquet(f"{self.path}/records")

    def faults(self) -> DataFrame:
        if not names(self.spark, f"{self.path}/faults"):
            return self.spark.createDataFrame([], FAULT)
        return self.spark.read.schema(f"{FAULT}, batch int").parquet(f"{self.path}/faults").drop("batch")

    def vacuum(self) -> list[str]:
        """Removes messages, tails and descriptions that the newest state doesn't name, and older state files; what went.

        To be called between batches, as the state before the newest goes too."""
        now, gone = self.state(), []
        used = {*now["open"], now["relations"]}
        for kind in ("messages", "open", "relations"):
            gone += [f"{self.path}/{kind}/{n}" for n in names(self.spark, f"{self.path}/{kind}") if f"{self.path}/{kind}/{n}" not in used]
        gone += [f"{self.path}/{n}" for n in names(self.spark, self.path) if n.startswith("state-") and int(n[6:-5]) < now["batch"]]
        for path in gone:
            remove(self.spark, path)
        return gone


def start(messages: DataFrame, publisher: Publisher, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Runs ``publisher`` over a stream of (lsn, body). Offsets are noted, and the feed acknowledged, after the batch is written."""
    sink = messages.writeStream.foreachBatch(publisher).option("checkpointLocation", checkpoint)
    return (sink.trigger(availableNow=True) if available_now else sink).start()


@contextmanager
def fenced(spark: SparkSession, folder: str, name: str) -> Iterator[None]:
    """Keeps a second stream of one name out while the first runs: a file named by the stream's number, made once and removed at the end.

    A file that a dead process left has to be removed by hand, which is the safe side: two publishers would both write."""
    path = f"{folder.rstrip('/')}/fence-{fence_key(name) & (2**64 - 1):016x}"
    names(spark, folder)
    if not write_text(spark, path, name):
        raise PermanentError(f"another stream {name} is at work: {path}")
    try:
        yield
    finally:
        remove(spark, path)


def supervised(begin: Callable[[], StreamingQuery], backoff: Backoff, publisher: Publisher | None = None, metrics: Metrics | None = None, checks: Sequence[Callable[[], None]] = ()) -> None:
    """Runs a query to its end, and again after a failure, with growing waits; the open transaction is forgotten in between.

    ``checks`` come before each start, such as :func:`walrill.streaming.observe.require_durable` of the topic's settings. What is
    known to fail for good (:class:`walrill.functions.retry.PermanentError`) is raised at once."""

    def go() -> None:
        try:
            for check in checks:
                check()
            query = begin()
            if metrics is not None:
                metrics.set_ready(True)
            query.awaitTermination()
        except Exception:
            if metrics is not None:
                metrics.failed("stream")
                metrics.set_ready(False)
            if publisher is not None:
                publisher.reset()
            raise

    backoff.run("stream", go)
