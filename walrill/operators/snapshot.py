"""The first copy of the source's tables, handed over to the live stream."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walrill.functions.lsn import lsn_order, lsn_passes
from walrill.functions.rows import RESERVED, empty_row, event_key, overlay
from walrill.operators import fold
from walrill.operators.apply import State

DONE = "snapshot_done"


class SnapshotError(RuntimeError):
    pass


def shared_columns(registry_columns: list[str], source_columns: list[str]) -> list[str]:
    """Destination columns that the source has too, in destination order, without the engine's own."""
    there = set(source_columns)
    return [c for c in registry_columns if c in there and c not in RESERVED]


def as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as nullable text, as they would come over the wire; booleans as t and f."""
    kinds = dict(df.dtypes)
    return df.select(*(F.when(F.col(c), "t").when(~F.col(c), "f").alias(c) if kinds[c] == "boolean" else F.concat(F.lit("\\x"), F.lower(F.hex(c))).alias(c) if kinds[c] == "binary" else F.col(c).cast("string").alias(c) for c in columns))


def rows_of(df: DataFrame, schema: str, table: str, columns: list[str], key: list[str], lsn: str, commit_time) -> DataFrame:
    """State rows of a table's copy at position ``lsn``. The key must be among the columns and nowhere null."""
    if lost := [k for k in key if k not in columns]:
        raise SnapshotError(f"{schema}.{table}: key column {lost[0]} is not at the source")
    text = as_text(df, columns)
    for k in key:
        checked = F.when(F.col(k).isNull(), F.raise_error(F.lit(f"{schema}.{table}: key column {k} is null"))).otherwise(F.col(k))
        text = text.withColumn(k, checked)
    pairs = lambda names: F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*map(F.col, names)))
    return text.select(F.lit(schema).alias("schema"), F.lit(table).alias("table"), event_key(F.lit(schema), F.lit(table), pairs(key)).alias("key"), lsn_order(F.lit(lsn)).alias("lsn"), commit_time.alias("commit_time"), pairs(columns).alias("cols"))


def merge_rows(base: DataFrame, copied: DataFrame, at: Column | None = None) -> DataFrame:
    """Snapshot rows (one for each key) upserted like inserts at their position: guarded, without markers, columns that they lack kept."""
    at = F.current_timestamp() if at is None else at
    names = ["lsn", "commit_time", "cols", "replicated_at"]
    pack = lambda df, name: df.select(*fold.KEY, F.struct(*names).alias(name))
    both = pack(base, "old").join(pack(copied.withColumn("replicated_at", at), "new"), fold.KEY, "full")
    stays = F.col("new").isNull() | F.coalesce(~lsn_passes(F.col("old.lsn"), F.col("new.lsn")), F.lit(False))
    merged = F.struct(F.col("new.lsn").alias("lsn"), F.col("new.commit_time").alias("commit_time"), overlay(F.coalesce(F.col("old.cols"), empty_row()), F.col("new.cols")).alias("cols"), F.col("new.replicated_at").alias("replicated_at"))
    return both.select(*fold.KEY, F.when(stays & F.col("old").isNotNull(), F.col("old")).otherwise(merged).alias("row")).select(*fold.KEY, "row.*")


def completed(state: State) -> bool:
    return not state.settings.where((F.col("name") == DONE) & (F.lower("value") == "done")).isEmpty()


def mark_completed(state: State) -> State:
    done = state.settings.sparkSession.createDataFrame([(DONE, "done")], "name string, value string")
    return replace(state, settings=state.settings.where(F.col("name") != DONE).unionByName(done))


def verify_not_corrupt(state: State, stream_position_exists: bool) -> None:
    if completed(state) and not stream_position_exists:
        raise SnapshotError("the snapshot is done but the stream's position is gone: changes in between are lost")


def wait_for_position(position: Callable[[], str | None], timeout: float = 120.0, every: float = 2.0) -> str:
    """The stream's starting position, once there is one."""
    end = time.monotonic() + timeout
    while True:
        if lsn := position():
            return lsn
        if time.monotonic() >= end:
            raise SnapshotError("no stream position appeared")
        time.sleep(every)


def run(state: State, tables: dict[tuple[str, str], DataFrame], lsn: str, commit_time) -> State:
    """All of ``tables`` copied at one position and merged at once. The caller pins the inputs and commits the result as one version."""
    from walrill.operators import registry as reg

    copied = None
    for (schema, table), df in sorted(tables.items()):
        known = reg.columns(state.registry, schema, table)
        columns = shared_columns([c["column"] for c in known], df.columns)
        rows = rows_of(df, schema, table, columns, [c["column"] for c in known if c["is_key"]], lsn, commit_time)
        copied = rows if copied is None else copied.unionByName(rows)
    return state if copied is None else replace(state, rows=merge_rows(state.rows, copied))


def boot(state: State, position: Callable[[], str | None], tables: dict[tuple[str, str], DataFrame], commit_time, timeout: float = 120.0) -> State:
    """Nothing if the snapshot is done and the stream can go on; else waits for the position, copies, and marks it done."""
    if completed(state):
        verify_not_corrupt(state, position() is not None)
        return state
    return mark_completed(run(state, tables, wait_for_position(position, timeout), commit_time))
