"""Events applied to keyed state, as sets.

Order of arrival (``pos``) is the order of application. Duplicates go by event id; an effective truncate cuts off all that comes
before it; behind the last one each key is independent. One summary row for each key, combined before the exchange, says
whether its positions ever fall and whether its changes all have the same columns. Where they do and never fall, the last
change is the row. Other keys whose positions only rise take columns by their latest writer, and so do keys that were never
deleted, once events below the running maximum of their positions are left out. Only keys with a stale event and a delete are
folded event by event. All kinds but the first are looked up again among the events only if there are any.

Events here have pos, id, schema, table, operation, key (text, see ``event_key``), lsn (decimal), commit_time, key_row, after.
State rows have schema, table, key, lsn, commit_time, cols, replicated_at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walrill.functions.lsn import lsn_order, truncate_is_stale
from walrill.functions.rows import ROW, empty_row, event_key, overlay
from walrill.operators.ordered import BLOCK, running
from walrill.storage import materialise

STATE = f"`schema` string, `table` string, key string, lsn decimal(20,0), commit_time timestamp, cols {ROW}, replicated_at timestamp"
WATERMARKS = "`schema` string, `table` string, watermark decimal(20,0)"
MARKERS = "id string, lsn decimal(20,0)"
TABLE = ["schema", "table"]
KEY = [*TABLE, "key"]
ROWS = [*KEY, "lsn", "commit_time", "cols", "replicated_at"]


def flat(events: DataFrame) -> DataFrame:
    """Envelope events (with ``pos``) in the flat form of this module."""
    return events.select(
        "pos", "id", "schema", "table", "operation", event_key(F.col("schema"), F.col("table"), F.col("key")).alias("key"), lsn_order(F.col("source.commit_lsn")).alias("lsn"), F.col("source.commit_time").alias("commit_time"), F.col("key").alias("key_row"), "after", "unchanged_columns"
    )


def fresh(events: DataFrame, markers: DataFrame | None = None) -> DataFrame:
    """The first arrival of each event id that has no marker yet."""
    first = Window.partitionBy("id").orderBy("pos")
    once = events.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return once if markers is None else once.join(markers.select("id"), "id", "left_anti")


def truncate_marks(events: DataFrame, watermarks: DataFrame | None = None) -> DataFrame:
    """(pos, id, schema, table, lsn, effective) of each truncate; one at or before its table's watermark has no effect."""
    cuts = events.where("operation = 'truncate'").select("pos", "id", *TABLE, "lsn")
    seen = running(cuts, ["pos"], {"_seen": ("max", F.col("lsn"))}, tuple(TABLE), exclusive=True)
    if watermarks is not None:
        seen = seen.join(watermarks, TABLE, "left")
    else:
        seen = seen.withColumn("watermark", F.lit(0).cast("decimal(20,0)"))
    known = F.greatest(F.coalesce("_seen", F.lit(0)), F.coalesce("watermark", F.lit(0)))
    return seen.select("pos", "id", *TABLE, "lsn", (~truncate_is_stale(F.col("lsn"), known)).alias("effective"))


def truncate_epochs(events: DataFrame, watermarks: DataFrame | None = None) -> DataFrame:
    """Events with ``effective`` (a truncate beyond the table's watermark) and ``epoch`` (effective truncates up to here)."""
    marks = truncate_marks(events, watermarks).select(F.col("pos").alias("_pos"), F.col("effective").alias("_effective"))
    d = events.join(marks, F.col("pos") == F.col("_pos"), "left").withColumn("effective", F.coalesce("_effective", F.lit(False))).drop("_pos", "_effective")
    return running(d, ["pos"], {"epoch": ("sum", F.col("effective").cast("long"))}, tuple(TABLE))


def new_watermarks(marks: DataFrame, watermarks: DataFrame | None = None) -> DataFrame:
    raised = marks.where("effective").groupBy(*TABLE).agg(F.max("lsn").alias("watermark"))
    both = raised if watermarks is None else raised.unionByName(watermarks.select(*TABLE, "watermark"))
    return both.groupBy(*TABLE).agg(F.max("watermark").alias("watermark"))


def _step(state: Column, e: Column) -> Column:
    """One event on one row: a stale event changes nothing; a delete leaves nothing behind, not even its position."""
    stale = state["present"] & state["lsn"].isNotNull() & (state["lsn"] > e["lsn"])
    deleted = F.struct(F.lit(False).alias("present"), F.lit(None).cast("decimal(20,0)").alias("lsn"), F.lit(None).cast("timestamp").alias("commit_time"), empty_row().alias("cols"), F.lit(False).alias("written"))
    written = F.struct(F.lit(True).alias("present"), e["lsn"].alias("lsn"), e["commit_time"].alias("commit_time"), overlay(state["cols"], F.from_json(e["after"], ROW)).alias("cols"), F.lit(True).alias("written"))
    return F.when(stale, state).when(e["operation"] == "delete", deleted).otherwise(written)


def fold_exact(events: DataFrame, base: DataFrame, at: Column) -> DataFrame:
    """State after all events of each key, one after the other. For keys that need it: their events are gathered."""
    # Maps have no order, so rows ride as JSON inside the sorted array; null values stay.
    packed = F.struct("pos", "operation", "lsn", "commit_time", F.to_json(F.coalesce("after", empty_row()), {"ignoreNullFields": "false"}).alias("after"))
    logs = events.groupBy(*KEY).agg(F.array_sort(F.collect_list(packed)).alias("log"))
    held = base.select(*KEY, F.col("lsn").alias("b_lsn"), F.col("commit_time").alias("b_time"), F.col("cols").alias("b_cols"), F.col("replicated_at").alias("b_at"))
    joined = logs.join(held, KEY, "left")
    start = F.struct(F.col("b_cols").isNotNull().alias("present"), F.col("b_lsn").cast("decimal(20,0)").alias("lsn"), F.col("b_time").alias("commit_time"), F.coalesce("b_cols", empty_row()).alias("cols"), F.lit(False).alias("written"))
    end = joined.select(*KEY, F.aggregate("log", start, _step).alias("s"), "b_at").where("s.present")
    return end.select(*KEY, "s.lsn", "s.commit_time", "s.cols", F.when(F.col("s.written"), at).otherwise(F.col("b_at")).alias("replicated_at"))


def fold_columns(events: DataFrame, base: DataFrame, left: DataFrame, at: Column) -> DataFrame:
    """State of keys whose positions never fall: each column's latest writer after the key's last delete.

    ``left`` (key, gone, last) are their summaries. Columns are few for each row; a key's events are never gathered, only the
    latest of each column."""
    kept = events.where("operation <> 'delete'").join(left.select(*KEY, "gone"), KEY).where(F.col("gone").isNull() | (F.col("pos") > F.col("gone")))
    cells = kept.select(*KEY, "pos", F.explode("after").alias("name", "value"))
    below = base.join(left.where("gone is null").select(*KEY), KEY, "left_semi").select(*KEY, F.lit(-1).cast("long").alias("pos"), F.explode("cols").alias("name", "value"))
    # max_by passes over null values, which are values here; in a struct they stay.
    cols = cells.unionByName(below).groupBy(*KEY, "name").agg(F.max_by(F.struct("value"), "pos").alias("v"))
    rows = cols.groupBy(*KEY).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", F.col("v.value").alias("value"))))).cast(ROW).alias("cols"))
    return rows.join(left, KEY).select(*KEY, F.col("last.lsn").alias("lsn"), F.col("last.commit_time").alias("commit_time"), "cols", at.alias("replicated_at"))


def fold_guarded(events: DataFrame, base: DataFrame, at: Column) -> DataFrame:
    """State of keys that are never deleted, whose positions may fall: what is below an earlier position changes nothing.

    The running maximum goes by blocks of the log, so no key is gathered here either."""
    held = base.select(*KEY, F.col("lsn").alias("_held"))
    high = F.greatest(F.coalesce("_high", F.lit(-1)), F.coalesce("_held", F.lit(-1)))
    passed = running(events, ["pos"], {"_high": ("max", F.col("lsn"))}, tuple(KEY), exclusive=True).join(held, KEY, "left").where(F.col("lsn") >= high).drop("_high", "_held")
    left = passed.groupBy(*KEY).agg(F.lit(None).cast("long").alias("gone"), F.max_by(F.struct("lsn", "commit_time"), "pos").alias("last"))
    return fold_columns(passed, base, left, at).select(*ROWS).unionByName(base.join(left.select(*KEY), KEY, "left_anti").select(*ROWS))


def _names(row: Column) -> Column:
    """The columns of a row as one number."""
    return F.xxhash64(F.array_sort(F.map_keys(row)))


def summaries(changes: DataFrame, base: DataFrame) -> DataFrame:
    """One row for each key of ``changes``: gone (position of its last delete), last (its last change) and ``how`` it is folded.

    Rows combine before the exchange; only positions go by blocks, so a key with a third of all events is no task of its own."""
    upsert = F.col("operation") != "delete"
    latest = changes.groupBy(*KEY).agg(
        F.max(F.when(~upsert, F.col("pos"))).alias("gone"), F.max_by(F.struct("lsn", "commit_time", "operation", "after"), "pos").alias("last"),
        F.min(F.when(upsert, _names(F.col("after")))).alias("least"), F.max(F.when(upsert, _names(F.col("after")))).alias("most"),
    )
    inside = Window.partitionBy(*KEY, "block").orderBy("pos")
    places = changes.select(*KEY, "pos", "lsn", F.floor(F.col("pos") / BLOCK).alias("block"))
    places = places.withColumn("down", F.coalesce(F.lag("lsn").over(inside) > F.col("lsn"), F.lit(False)))
    blocks = places.groupBy(*KEY, "block").agg(F.max("down").alias("down"), F.min_by("lsn", "pos").alias("first"), F.max("lsn").alias("high"))
    before = Window.partitionBy(*KEY).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("down", F.col("down") | F.coalesce(F.max("high").over(before) > F.col("first"), F.lit(False)))
    order = blocks.groupBy(*KEY).agg(F.max("down").alias("falls"), F.min_by("first", "block").alias("first"))
    held = base.select(*KEY, F.col("lsn").alias("b_lsn"), _names(F.col("cols")).alias("b_names"))
    d = latest.join(order, KEY).join(held, KEY, "left")
    same = F.coalesce(F.col("least") == F.col("most"), F.lit(True)) & (F.col("gone").isNotNull() | F.col("b_names").isNull() | (F.col("b_names") == F.col("least")))
    late = F.col("falls") | F.coalesce(F.col("b_lsn") > F.col("first"), F.lit(False))
    how = F.when(late & F.col("gone").isNotNull(), "exact").when(late, "guarded").when((F.col("last.operation") == "delete") | same, "last").otherwise("columns")
    return d.select(*KEY, "gone", "last", how.alias("how"))


def fold(events: DataFrame, base: DataFrame | None = None, watermarks: DataFrame | None = None, marks: DataFrame | None = None, at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(state, watermarks) after ``events`` (fresh, appliable, flat) on ``base``. Rows of untouched keys stay as they are.

    ``events`` are read several times. A caller that has them written already gives their ``marks`` too; else they are written here.
    ``at`` is what changed rows note as ``replicated_at``."""
    spark, at = events.sparkSession, F.current_timestamp() if at is None else at
    base = spark.createDataFrame([], STATE) if base is None else base
    if marks is None:
        events = materialise(events)
        marks = materialise(truncate_marks(events, watermarks))
    changes, kept = events.where("operation <> 'truncate'"), base
    if not marks.isEmpty():
        # A table with an effective truncate starts from nothing, whatever its rows' positions.
        cut = marks.where("effective").groupBy(*TABLE).agg(F.max("pos").alias("_cut"))
        changes = changes.join(cut, TABLE, "left").where("_cut is null or pos > _cut").drop("_cut")
        kept = base.join(cut.select(*TABLE), TABLE, "left_anti")
    keys = materialise(summaries(changes, kept))
    kinds = {r["how"] for r in keys.select("how").distinct().collect()}
    own = lambda how: keys.where(F.col("how") == how)
    of = lambda df, how: df.join(own(how).select(*KEY), KEY, "left_semi")
    out = kept.join(keys.select(*KEY), KEY, "left_anti").select(*ROWS)
    if "last" in kinds:
        out = out.unionByName(own("last").where("last.operation <> 'delete'").select(*KEY, "last.lsn", "last.commit_time", F.col("last.after").alias("cols"), at.alias("replicated_at")))
    if "columns" in kinds:
        out = out.unionByName(fold_columns(of(changes, "columns"), of(kept, "columns"), own("columns"), at).select(*ROWS))
    if "guarded" in kinds:
        out = out.unionByName(fold_guarded(of(changes, "guarded"), of(kept, "guarded"), at))
    if "exact" in kinds:
        out = out.unionByName(fold_exact(of(changes, "exact"), of(kept, "exact"), at).select(*ROWS))
    return out, new_watermarks(marks, watermarks)


def markers_of(events: DataFrame) -> DataFrame:
    """Markers that fresh events leave, stale ones too."""
    return events.select("id", "lsn")
