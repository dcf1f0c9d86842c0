"""A batch of events applied to the whole state: refused ones set aside, the rest folded, markers and watermarks moved on."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walrill.functions.lsn import lsn_order
from walrill.functions.rows import has
from walrill.operators import fold, registry as reg
from walrill.operators.envelope import with_reason
from walrill.operators.ordered import running
from walrill.storage import materialise

DEAD_LETTERS = "event_id string, `schema` string, `table` string, operation string, key map<string,string>, before map<string,string>, after map<string,string>, unchanged_columns array<string>, source_lsn string, source_commit_time timestamp, reason string, occurred_at timestamp"
SETTINGS = "name string, value string"


@dataclass(frozen=True)
class State:
    """All tables of the destination. ``rows`` are those of every replicated table."""

    rows: DataFrame
    markers: DataFrame
    watermarks: DataFrame
    dead_letters: DataFrame
    registry: DataFrame
    settings: DataFrame

    @staticmethod
    def empty(spark: SparkSession) -> State:
        make = lambda schema: spark.createDataFrame([], schema)
        return State(make(fold.STATE), make(fold.MARKERS), make(fold.WATERMARKS), make(DEAD_LETTERS), make(reg.REGISTRY), make(SETTINGS))


def dead_letters_of(refused: DataFrame, at) -> DataFrame:
    """Events with ``reason`` as dead letters; ``at`` is when."""
    return refused.select(
        F.col("id").alias("event_id"), "schema", "table", "operation", "key", "before", "after", F.coalesce("unchanged_columns", F.array().cast("array<string>")).alias("unchanged_columns"),
        F.col("source.commit_lsn").alias("source_lsn"), F.col("source.commit_time").alias("source_commit_time"), "reason", at.alias("occurred_at"),
    )


def _absent_rows(events: DataFrame, base: DataFrame, registry: DataFrame) -> DataFrame:
    """(id, reason) of preserving updates of rows that are not there, where a kept column is required and has no default."""
    keeping = events.where("operation = 'update' and size(unchanged_columns) > 0")
    if keeping.isEmpty():
        return events.sparkSession.createDataFrame([], "id string, reason string")
    keyed = events.join(keeping.select(*fold.KEY).distinct(), fold.KEY, "left_semi").withColumn("_op", F.col("operation"))
    seen = running(keyed, ["pos"], {"_before": ("last", F.col("_op"))}, tuple(fold.KEY), exclusive=True)
    known = base.select(*fold.KEY, F.lit(True).alias("_held"))
    first = seen.where("operation = 'update' and size(unchanged_columns) > 0").join(known, fold.KEY, "left")
    absent = first.where((F.col("_before") == "delete") | F.col("_before").isNull() & F.col("_held").isNull())
    needed = registry.where("not nullable and default_value is null").select(F.col("schema").alias("n_schema"), F.col("table").alias("n_table"), F.col("column").alias("n_column"))
    lost = absent.join(needed, (F.col("schema") == F.col("n_schema")) & (F.col("table") == F.col("n_table"))).where(~has(F.col("after"), F.col("n_column")))
    return lost.groupBy("id").agg(F.concat(F.lit("row absent, required column unchanged "), F.min("n_column")).alias("reason"))


def apply_batch(events: DataFrame, state: State, at=None, check_types: bool = True) -> tuple[State, DataFrame]:
    """(state after ``events``, outcome of each id). Events are envelope events with ``pos``.

    Outcomes: ``applied`` (stale ones too: they leave a marker), ``duplicate``, ``stale truncate``, ``dead letter``. A refused
    event is set aside with its marker, so a later delivery does nothing; the others of its transaction apply."""
    after, outcome, new = applied(events, state, at, check_types)
    return replace(after, markers=state.markers.unionByName(new)), outcome


def applied(events: DataFrame, state: State, at=None, check_types: bool = True) -> tuple[State, DataFrame, DataFrame]:
    """As :func:`apply_batch`, with the new markers apart and the state's as they were."""
    at = F.current_timestamp() if at is None else at
    judged = with_reason(events)
    # An id that is missing can't be marked or looked up; such events are told apart by position.
    judged = judged.withColumn("id", F.when(F.coalesce("id", F.lit("")) == "", F.concat(F.lit("unnamed:"), F.col("pos"))).otherwise(F.col("id")))
    # Checks, letters, markers and the fold all start from the fresh events, so these are written once.
    new = materialise(fold.fresh(judged, state.markers))
    flat = fold.flat(new.where("reason is null"))
    if check_types:
        refusals = materialise(reg.poison(flat, state.registry))
        flat_ok = flat.join(refusals.select("id"), "id", "left_anti")
        refusals = materialise(refusals.unionByName(_absent_rows(flat_ok, state.rows, state.registry)))
    else:
        refusals = events.sparkSession.createDataFrame([], "id string, reason string")
    refused = new.where("reason is not null").unionByName(new.where("reason is null").drop("reason").join(refusals, "id").select(*new.columns))
    good = flat.join(refusals.select("id"), "id", "left_anti")
    marks = materialise(fold.truncate_marks(good, state.watermarks))
    rows, watermarks = fold.fold(good, state.rows, state.watermarks, marks, at)
    new_markers = fold.markers_of(good).unionByName(refused.select("id", lsn_order(F.col("source.commit_lsn")).alias("lsn")))
    # A record that is there already keeps everything but its reason.
    letters = dead_letters_of(refused, at)
    told = letters.select("event_id", F.col("reason").alias("_reason"))
    kept = state.dead_letters.join(told, "event_id", "left").withColumn("reason", F.coalesce("_reason", "reason")).select(*state.dead_letters.columns)
    letters = letters.join(state.dead_letters.select("event_id"), "event_id", "left_anti").select(*state.dead_letters.columns)
    stale = marks.where("not effective").select("id")
    outcome = good.select("id", F.lit("applied").alias("outcome")).join(stale, "id", "left_anti")
    outcome = outcome.unionByName(stale.select("id", F.lit("stale truncate").alias("outcome")))
    outcome = outcome.unionByName(refused.select("id", F.lit("dead letter").alias("outcome")))
    repeated = judged.select("id", "pos").join(new.select("id", "pos"), ["id", "pos"], "left_anti").select("id", F.lit("duplicate").alias("outcome"))
    after = replace(state, rows=rows, watermarks=watermarks, dead_letters=kept.unionByName(letters))
    return after, outcome.unionByName(repeated), new_markers
