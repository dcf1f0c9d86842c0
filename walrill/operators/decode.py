"""Row-change messages to committed, sequenced, keyed change events.

A message row has pos, kind, xid, relation_id, namespace, relation, columns (name, flags), old_kind, old_tuple and new_tuple
(kind, value), relation_ids, commit_lsn, end_lsn, commit_time. ``pos`` is its place in the stream. What the protocol forbids becomes
an error row with the position and a reason instead of an end of the stream; a transaction with an error is not committed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walrill.functions.rows import ROW, empty_row, has, overlay, rows_equal
from walrill.operators.envelope import VERSION
from walrill.operators.ordered import numbered, running
from walrill.storage import materialise

TUPLE = "array<struct<kind:string,value:string>>"
MESSAGE = f"pos bigint, kind string, xid bigint, relation_id bigint, namespace string, relation string, columns array<struct<name:string,flags:int>>, old_kind string, old_tuple {TUPLE}, new_tuple {TUPLE}, relation_ids array<bigint>, commit_lsn string, end_lsn string, commit_time timestamp"
CHANGES = ("insert", "update", "delete")
_CHANGE = "struct<operation:string,key:map<string,string>,before:map<string,string>,after:map<string,string>,unchanged_columns:array<string>>"


def framed(messages: DataFrame) -> DataFrame:
    """Messages with ``begin`` (position and id of the open transaction, null outside) and ``frame_fault``."""
    frame = F.when(F.col("kind").isin("begin", "commit"), F.struct("pos", "kind", "xid"))
    d = running(messages, ["pos"], {"_frame": ("last", frame)}, exclusive=True)
    is_open = F.coalesce(F.col("_frame.kind") == "begin", F.lit(False))
    fault = (
        F.when((F.col("kind") == "begin") & is_open, "begin inside a transaction")
        .when((F.col("kind") == "commit") & ~is_open, "commit without a transaction")
        .when(F.col("kind").isin(*CHANGES, "truncate") & ~is_open, "change outside a transaction")
    )
    return d.withColumn("begin", F.when(is_open & (F.col("kind") != "begin"), F.struct(F.col("_frame.pos").alias("pos"), F.col("_frame.xid").alias("xid")))).withColumn("frame_fault", fault).drop("_frame")


def with_relation(changes: DataFrame, relations: DataFrame) -> DataFrame:
    """Each change with the latest description of its relation before it (``rel``), null if there was none."""
    described = F.struct("namespace", "relation", "columns")
    log = changes.select(*changes.columns).withColumn("_is", F.lit(False)).unionByName(relations.withColumn("_is", F.lit(True)), allowMissingColumns=True)
    filled = running(log, ["pos"], {"rel": ("last", F.when(F.col("_is"), described))}, ("relation_id",), exclusive=True)
    return filled.where("not _is").drop("_is")


def _row(cells: Column) -> Column:
    """Null and text cells as a map; unchanged ones are absent."""
    kept = F.filter(cells, lambda z: z["kind"].isin("n", "t"))
    return F.map_from_entries(F.transform(kept, lambda z: F.struct(z["name"], F.when(z["kind"] == "t", z["value"])))).cast(ROW)


def _cells(columns: Column, tuple_: Column) -> Column:
    return F.transform(F.arrays_zip(columns.alias("c"), tuple_.alias("v")), lambda z: F.struct(z["c"]["name"].alias("name"), z["c"]["flags"].alias("flags"), z["v"]["kind"].alias("kind"), z["v"]["value"].alias("value")))


def _key(row: Column, key_columns: Column) -> Column:
    return F.map_filter(row, lambda k, _: F.array_contains(key_columns, k))


def _key_fault(row: Column, key_columns: Column, what: str) -> Column:
    return (
        F.when(F.size(key_columns) == 0, "relation has no key")
        .when(F.exists(key_columns, lambda k: ~has(row, k)), f"{what}: key column missing")
        .when(F.exists(key_columns, lambda k: F.element_at(row, k).isNull()), f"{what}: key column is null")
    )


def decoded(changes: DataFrame) -> DataFrame:
    """Row changes (with rel and key_columns) with ``changes``, one or two of them, or ``fault``."""
    no_hints = F.array().cast("array<string>")
    d = changes.withColumn("_columns", F.col("rel.columns"))
    flagged = F.transform(F.filter("_columns", lambda c: c["flags"].bitwiseAND(1) == 1), lambda c: c["name"])
    d = d.withColumn("_key_columns", F.when(F.coalesce(F.size("key_columns"), F.lit(0)) > 0, F.col("key_columns")).otherwise(flagged))
    key_only = F.coalesce(F.col("old_kind") == "K", F.lit(False))
    old_cells = _cells(F.col("_columns"), F.col("old_tuple"))
    d = d.withColumn("_old", F.when(key_only, F.filter(old_cells, lambda z: z["flags"].bitwiseAND(1) == 1)).otherwise(old_cells)).withColumn("_new", _cells(F.col("_columns"), F.col("new_tuple")))
    d = d.withColumn("_before", F.when(F.col("old_tuple").isNotNull(), _row(F.col("_old")))).withColumn("_after0", F.when(F.col("new_tuple").isNotNull(), _row(F.col("_new"))))
    # Unchanged values come from the old image if it has them; otherwise they are hints. A null in the old image tells nothing.
    open_names = F.transform(F.filter("_new", lambda z: z["kind"] == "u"), lambda z: z["name"])
    from_old = F.map_filter(F.coalesce("_before", empty_row()), lambda k, v: F.array_contains(open_names, k) & v.isNotNull())
    d = d.withColumn("_after", F.when(F.col("_after0").isNotNull(), overlay(from_old, F.col("_after0"))))
    d = d.withColumn("_unchanged", F.filter(open_names, lambda n: ~has(from_old, n)))
    d = d.withColumn("_old_key", _key(F.col("_before"), F.col("_key_columns"))).withColumn("_new_key", _key(F.col("_after"), F.col("_key_columns")))
    wrong = lambda cells: F.exists(cells, lambda z: z["kind"] == "b")
    unknown = lambda cells: F.exists(cells, lambda z: ~F.coalesce(z["kind"].isin("n", "t", "u", "b"), F.lit(False)))
    is_new, is_old = F.col("kind").isin("insert", "update"), F.col("old_tuple").isNotNull() & F.col("kind").isin("update", "delete")
    moved = (F.col("kind") == "update") & is_old & ~rows_equal(F.col("_old_key"), F.col("_new_key"))
    fault = (
        F.when(F.col("rel").isNull(), "relation not described")
        .when(is_new & F.col("new_tuple").isNull() | (F.col("kind") == "delete") & F.col("old_tuple").isNull(), "tuple is missing")
        .when(is_new & (F.size("new_tuple") != F.size("_columns")) | is_old & (F.size("old_tuple") != F.size("_columns")), "tuple and relation differ in columns")
        .when(is_new & wrong(F.col("_new")) | is_old & wrong(F.col("_old")), "binary value")
        .when(is_new & unknown(F.col("_new")) | is_old & unknown(F.col("_old")), "unknown value kind")
        .when(is_old & key_only & F.exists("_old", lambda z: z["kind"] == "u"), "key column cannot be unchanged")
        .when((F.col("kind") == "insert") & (F.size("_unchanged") > 0), "insert with unchanged values")
        .when(is_old, _key_fault(F.col("_before"), F.col("_key_columns"), "old row"))
    )
    fault = F.coalesce(fault, F.when(is_new, _key_fault(F.col("_after"), F.col("_key_columns"), "new row")), F.when(moved & (F.size("_unchanged") > 0), "unchanged value without an old image while the key changes"))
    null_row = F.lit(None).cast(ROW)
    one = lambda op, key, before, after, hints: F.struct(F.lit(op).alias("operation"), key.alias("key"), before.alias("before"), after.alias("after"), hints.alias("unchanged_columns")).cast(_CHANGE)
    made = (
        F.when(F.col("kind") == "insert", F.array(one("insert", F.col("_new_key"), null_row, F.col("_after"), no_hints)))
        .when(moved, F.array(one("delete", F.col("_old_key"), F.col("_before"), null_row, no_hints), one("insert", F.col("_new_key"), null_row, F.col("_after"), no_hints)))
        .when(F.col("kind") == "update", F.array(one("update", F.when(is_old, F.col("_old_key")).otherwise(F.col("_new_key")), F.col("_before"), F.col("_after"), F.col("_unchanged"))))
        .otherwise(F.array(one("delete", F.col("_old_key"), F.col("_before"), null_row, no_hints)))
    )
    return d.withColumn("fault", fault).withColumn("changes", F.when(F.col("fault").isNull(), made)).drop(*(c for c in d.columns if c.startswith("_")))


def decode(messages: DataFrame, identity: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(events, faults) of a stretch of the stream. Events come only from transactions whose commit is in it.

    ``identity`` (schema, table, key_columns) overrides the relations' own key flags. Kinds besides begin, commit, relation,
    insert, update, delete and truncate are passed over. Events have ``pos`` of their message and of their commit (``commit_pos``)."""
    # Frames and decoded rows are written once each: several results come from them, and their expressions are long.
    d = materialise(framed(messages))
    relations = d.where("kind = 'relation'").select("pos", "relation_id", "namespace", "relation", "columns")
    frame_faults = d.where("frame_fault is not null").select("pos", F.col("frame_fault").alias("reason"), "begin")
    inside = d.where("frame_fault is null and begin is not null")
    rows = inside.where(F.col("kind").isin(*CHANGES)).select("pos", "kind", "relation_id", "old_kind", "old_tuple", "new_tuple", "begin", F.lit(0).alias("part"))
    cleared = inside.where("kind = 'truncate'").select("pos", "kind", F.posexplode("relation_ids").alias("part", "relation_id"), "old_kind", "old_tuple", "new_tuple", "begin")
    all_changes = with_relation(rows.unionByName(cleared), relations)
    if identity is not None:
        # Tables of a catalog: a few rows, but never assumed so; the planner broadcasts by size.
        keys = identity.select(F.col("schema").alias("_s"), F.col("table").alias("_t"), "key_columns")
        all_changes = all_changes.join(keys, (F.col("rel.namespace") == F.col("_s")) & (F.col("rel.relation") == F.col("_t")), "left").drop("_s", "_t")
    else:
        all_changes = all_changes.withColumn("key_columns", F.lit(None).cast("array<string>"))
    done = decoded(all_changes.where("kind <> 'truncate'")).select("pos", "part", "begin", "rel", "fault", "changes")
    none = F.lit(None)
    truncate = F.array(F.struct(F.lit("truncate").alias("operation"), none.cast(ROW).alias("key"), none.cast(ROW).alias("before"), none.cast(ROW).alias("after"), F.array().cast("array<string>").alias("unchanged_columns")).cast(_CHANGE))
    wiped = all_changes.where("kind = 'truncate'").select("pos", "part", "begin", "rel", F.when(F.col("rel").isNull(), "relation not described").alias("fault"), F.when(F.col("rel").isNotNull(), truncate).alias("changes"))
    every = materialise(done.unionByName(wiped))
    faults = frame_faults.unionByName(every.where("fault is not null").select("pos", F.col("fault").alias("reason"), "begin"))
    commits = inside.where("kind = 'commit'").select(F.col("begin.pos").alias("begin_pos"), F.col("begin.xid").alias("transaction_id"), F.col("pos").alias("commit_pos"), "commit_lsn", "end_lsn", "commit_time")
    broken = faults.where("begin is not null").select(F.col("begin.pos").alias("begin_pos")).distinct()
    good = commits.join(broken, "begin_pos", "left_anti")
    single = every.where("fault is null").select(F.col("begin.pos").alias("begin_pos"), "pos", "part", "rel", F.posexplode("changes").alias("step", "c"))
    placed = numbered(single, ["pos", "part", "step"], "sequence", ("begin_pos",))
    counts = single.groupBy("begin_pos").agg(F.count(F.lit(1)).alias("n"))
    joined = placed.join(good, "begin_pos").join(counts, "begin_pos")
    seq = F.col("sequence").cast("int")
    source = F.struct(F.col("transaction_id"), F.col("commit_lsn"), F.col("end_lsn").alias("transaction_end_lsn"), F.col("commit_time"), seq.alias("sequence"), F.col("n").cast("int").alias("transaction_event_count"))
    events = joined.select(
        F.lit(VERSION).alias("version"), F.concat_ws(":", "commit_lsn", seq.cast("string")).alias("id"), F.col("rel.namespace").alias("schema"), F.col("rel.relation").alias("table"),
        F.col("c.operation").alias("operation"), F.col("c.key").alias("key"), F.col("c.before").alias("before"), F.col("c.after").alias("after"), source.alias("source"), F.col("c.unchanged_columns").alias("unchanged_columns"), "pos", "commit_pos",
    )
    return events, faults.select("pos", "reason")
