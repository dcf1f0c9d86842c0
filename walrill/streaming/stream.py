"""The live stream: transport records to keyed state, one micro-batch after the other."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from walrill.functions.lsn import lsn_order
from walrill.functions.rows import event_key
from walrill.operators import evolve
from walrill.operators.apply import applied
from walrill.operators.assemble import split_complete
from walrill.operators.envelope import EVENT, read_records
from walrill.storage import read_text
from walrill.streaming.store import Store

PENDING = f"{EVENT}, pos bigint"


class Writer:
    """Applies micro-batches exactly once: a batch is known by its number and an event by its id.

    Events of transactions that are not complete yet wait in the store's ``pending`` folder, which the pointer's batch names, so a
    batch that is run again reads what its first run read."""

    def __init__(self, spark: SparkSession, store: Store, source_registry: DataFrame | None = None, on_commit: Callable[[dict], None] | None = None, check_types: bool = True):
        self.spark, self.store, self.source_registry, self.on_commit, self.check_types = spark, store, source_registry, on_commit, check_types

    def _pending_folder(self, batch: int | None) -> str:
        return f"{self.store.path}/pending-{-1 if batch is None else batch:012d}"

    def pending(self, batch: int | None) -> DataFrame:
        folder = self._pending_folder(batch)
        if read_text(self.spark, f"{folder}/_SUCCESS") is None:
            return self.spark.createDataFrame([], PENDING)
        return self.spark.read.schema(PENDING).parquet(folder)

    def __call__(self, records: DataFrame, batch: int) -> None:
        pointer = self.store.pointer()
        if pointer["batch"] is not None and batch <= pointer["batch"]:
            return
        # Several results come from these rows; they are read and parsed once.
        read = read_records(records.withColumnRenamed("offset", "pos"), ("pos",)).persist()
        events, unreadable = read.where("reason is null"), read.where("reason is not null").select("pos", "value", "reason")
        events = self.pending(pointer["batch"]).unionByName(events.select(*self.spark.createDataFrame([], PENDING).columns))
        events = events.persist()
        try:
            ready, waiting = split_complete(events)
            state = self.store.load(pointer)
            repaired = False
            if self.source_registry is not None:
                state, report = evolve.repair(state, self.source_registry, ready)
                repaired = not report.where("action like 'added%'").isEmpty()
            place, lsn = F.pmod(F.xxhash64("schema", "table", event_key(F.col("schema"), F.col("table"), F.col("key"))), F.lit(pointer["n_buckets"])), lsn_order(F.col("source.commit_lsn"))
            seen = ready.agg(F.min(lsn).alias("low"), F.max(lsn).alias("high"), F.collect_set(F.when(F.col("operation") != "truncate", place)).alias("touched"), F.max(F.col("operation") == "truncate").alias("cut")).first()
            # Rows outside the touched buckets, and markers of other positions, have no part in this batch and aren't read.
            touched = None if seen["cut"] or repaired else sorted(seen["touched"])
            if touched is not None:
                state = replace(state, rows=self.store.load(pointer, touched).rows)
            markers = state.markers.where(F.col("lsn").isNull() | F.col("lsn").between(F.lit(seen["low"]), F.lit(seen["high"])))
            after, outcome, new = applied(ready, replace(state, markers=markers), check_types=self.check_types)
            lost = unreadable.select(F.concat(F.lit("offset:"), F.col("pos")).alias("event_id"), F.lit(None).cast("string").alias("schema"), F.lit(None).cast("string").alias("table"), F.lit(None).cast("string").alias("operation"), F.create_map(F.lit("value"), F.col("value")).alias("after"), "reason", F.current_timestamp().alias("occurred_at"))
            after = replace(after, dead_letters=after.dead_letters.unionByName(lost, allowMissingColumns=True))
            waiting.write.mode("overwrite").parquet(self._pending_folder(batch))
            version = self.store.commit(after, batch, touched, pointer["version"], new.select("id", F.col("lsn").cast("decimal(20,0)").alias("lsn")))
            if self.on_commit is not None:
                counts = {r["outcome"]: r["n"] for r in outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).collect()}
                held = waiting.agg(F.count(F.lit(1)).alias("n"), F.min("source.commit_time").alias("oldest"), F.current_timestamp().alias("now")).first()
                age = (held["now"] - held["oldest"]).total_seconds() if held["oldest"] else 0.0
                self.on_commit({"batch": batch, "version": version, "unreadable": unreadable.count(), "pending": held["n"], "group_age": age, **counts})
        finally:
            events.unpersist()
            read.unpersist()


def start(records: DataFrame, writer: Writer, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Runs ``writer`` over a stream of records (offset, value). The batch is committed to the store before Spark notes its
    offsets, so a crash in between delivers it again and the writer passes over it."""
    sink = records.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    return (sink.trigger(availableNow=True) if available_now else sink).start()


def progress_row(progress: dict) -> dict:
    """The figures of a streaming progress report that the lag rules use."""
    return {"batch": progress.get("batchId"), "rows": progress.get("numInputRows"), "rows_per_second": progress.get("processedRowsPerSecond"), "end_offset": json.dumps([s.get("endOffset") for s in progress.get("sources", [])])}
