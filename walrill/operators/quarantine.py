"""Dead letters: listed, looked up, replayed, dropped."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walrill.functions.lsn import lsn_order
from walrill.operators.apply import State, apply_batch
from walrill.operators.envelope import FIELDS, SOURCE, VERSION
from walrill.operators.ordered import numbered
from walrill.storage import materialise


def listed(letters: DataFrame, schema: str = "", table: str = "") -> DataFrame:
    """Dead letters of a schema and table (either may be left out), oldest first."""
    if schema:
        letters = letters.where(F.col("schema") == schema)
    if table:
        letters = letters.where(F.col("table") == table)
    return letters.orderBy("occurred_at", "event_id")


def one(letters: DataFrame, event_id: str) -> DataFrame:
    return letters.where(F.col("event_id") == event_id)


def as_events(letters: DataFrame) -> DataFrame:
    """The events again; of their source only position and time are left. ``pos`` numbers them by the time of quarantine, then by
    position at the source and place in the transaction."""
    none = F.lit(None)
    source = F.struct(none.cast("bigint"), F.col("source_lsn"), F.col("source_lsn"), F.col("source_commit_time"), none.cast("int"), none.cast("int")).cast(SOURCE)
    events = letters.select(F.lit(VERSION).alias("version"), F.col("event_id").alias("id"), "schema", "table", "operation", "key", "before", "after", source.alias("source"), "unchanged_columns", F.unix_micros("occurred_at").alias("_at"))
    # Ids end in the place of their event, so the shorter of two at one position is the earlier.
    placed = events.withColumn("_lsn", lsn_order(F.col("source.commit_lsn"))).withColumn("_length", F.length("id"))
    return numbered(placed, ["_at", "_lsn", "_length", "id"], "pos").select(*FIELDS, "pos")


def _without(state: State, ids: DataFrame) -> State:
    gone = ids.select(F.col("event_id").alias("id"))
    return replace(state, markers=state.markers.join(gone, "id", "left_anti"), dead_letters=state.dead_letters.join(ids.select("event_id"), "event_id", "left_anti"))


def replay(state: State, letters: DataFrame, at=None) -> tuple[State, DataFrame]:
    """Applies dead letters anew. What applies loses its record; what is still refused keeps record and marker, and of the record
    all but the reason, which is the new one. The second result says which (event_id, replayed)."""
    unmarked = replace(state, markers=_without(state, letters).markers)
    after, outcome = apply_batch(as_events(letters), unmarked, at)
    result = materialise(outcome.select(F.col("id").alias("event_id"), (F.col("outcome") != "dead letter").alias("replayed")))
    healed = result.where("replayed").select("event_id")
    return replace(after, dead_letters=after.dead_letters.join(healed, "event_id", "left_anti")), result


def drop(state: State, letters: DataFrame) -> State:
    """Forgets dead letters and their markers, so a later delivery would be tried again."""
    return _without(state, letters)
