"""A change log made from the ``events`` table, for queries and benchmarks: one change of a user's row for each event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from walrill.functions.lsn import lsn_text
from walrill.operators.decode import TUPLE
from walrill.operators.envelope import SOURCE
from walrill.operators.registry import REGISTRY

#: Size of a source transaction in the log.
GROUP = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pos, uid, kind (event type), cents (text), lsn (decimal) of each event."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("pos"), F.col("user_id").cast("string").alias("uid"), F.col("event_type").alias("kind"), F.floor(F.col("value") * 100).cast("bigint").cast("string").alias("cents"), (F.col("event_id") + 1).cast("decimal(20,0)").alias("lsn"), F.col("ts").cast("timestamp").alias("ts"))


def row(**cells: Column) -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, cells)), F.array(*cells.values()))


def changes(rows: DataFrame, deletes: bool = True, preserve: bool = False, name: Column | None = None) -> DataFrame:
    """Envelope events: errors delete, clicks update (and keep cents, if ``preserve``), all else inserts."""
    click, error = F.col("kind") == "click", (F.col("kind") == "error") & F.lit(deletes)
    full, part = row(uid=F.col("uid"), kind=F.col("kind"), cents=F.col("cents")), row(uid=F.col("uid"), kind=F.col("kind"))
    none = F.lit(None).cast("map<string,string>")
    keeps = click & F.lit(preserve)
    text = lsn_text(F.col("lsn"))
    source = F.struct(F.floor(F.col("pos") / GROUP).alias("a"), text.alias("b"), text.alias("c"), F.col("ts").alias("d"), (F.col("pos") % GROUP + 1).cast("int").alias("e"), F.lit(GROUP).alias("f")).cast(SOURCE)
    return rows.select(
        F.lit(1).alias("version"), F.concat_ws(":", text, F.lit("1")).alias("id"), F.lit("public").alias("schema"), (F.lit("users") if name is None else name).alias("table"),
        F.when(error, "delete").when(click, "update").otherwise("insert").alias("operation"), row(uid=F.col("uid")).alias("key"), none.alias("before"),
        F.when(~error, F.when(keeps, part).otherwise(full)).alias("after"), source.alias("source"), F.when(keeps & ~error, F.array(F.lit("cents"))).otherwise(F.array().cast("array<string>")).alias("unchanged_columns"), "pos",
    )


def registry(spark: SparkSession, tables: tuple[str, ...] = ("users",), cents: str = "bigint", columns: tuple[str, ...] = ("uid", "kind", "cents")) -> DataFrame:
    kinds = {"uid": ("bigint", False, True), "kind": ("text", False, False), "cents": (cents, True, False), "note": ("text", True, False)}
    return spark.createDataFrame([("public", t, c, i + 1, kinds[c][0], kinds[c][1], None, kinds[c][2], None) for t in tables for i, c in enumerate(columns)], REGISTRY)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as replication messages, ten changes a transaction: begin at tx * 100, changes behind it, commit at tx * 100 + 99.

    A fifth of the clicks moves the row to another key; the relation is described anew, under another name, every 100 transactions."""
    b = base(spark, sf_dir).withColumn("tx", F.floor(F.col("pos") / GROUP))
    cell = lambda v: F.struct(F.lit("t").alias("kind"), v.alias("value"))
    cells = lambda *v: F.array(*map(cell, v)).cast(TUPLE)
    none = F.lit(None).cast(TUPLE)
    moved = (F.col("kind") == "click") & (F.col("pos") % 5 == 0)
    new_uid = F.when(moved, F.concat(F.lit("9"), F.col("uid"))).otherwise(F.col("uid"))
    op = F.when(F.col("kind") == "error", "delete").when(F.col("kind") == "click", "update").otherwise("insert")
    rows = b.select((F.col("tx") * 100 + F.col("pos") % GROUP + 1).alias("pos"), op.alias("kind"), F.lit(1).cast("bigint").alias("relation_id"), F.when(op != "insert", "O").alias("old_kind"), F.when(op != "insert", cells(F.col("uid"), F.col("kind"), F.col("cents"))).otherwise(none).alias("old_tuple"), F.when(op != "delete", cells(new_uid, F.col("kind"), F.col("cents"))).otherwise(none).alias("new_tuple"))
    txs = b.groupBy("tx").agg(F.max("lsn").alias("lsn"), F.max("ts").alias("ts"))
    begins = txs.select((F.col("tx") * 100).alias("pos"), F.lit("begin").alias("kind"), F.col("tx").alias("xid"))
    commits = txs.select((F.col("tx") * 100 + 99).alias("pos"), F.lit("commit").alias("kind"), lsn_text(F.col("lsn")).alias("commit_lsn"), lsn_text(F.col("lsn")).alias("end_lsn"), F.col("ts").alias("commit_time"))
    described = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(f).alias("flags")) for n, f in (("uid", 1), ("kind", 0), ("cents", 0))))
    relations = txs.where("tx % 100 = 0").select((F.col("tx") * 100 - 1).alias("pos"), F.lit("relation").alias("kind"), F.lit(1).cast("bigint").alias("relation_id"), F.lit("public").alias("namespace"), F.concat(F.lit("users_v"), F.floor(F.col("tx") / 100)).alias("relation"), described.alias("columns"))
    out = rows
    for part in (begins, commits, relations):
        out = out.unionByName(part, allowMissingColumns=True)
    return out.withColumn("relation_ids", F.lit(None).cast("array<bigint>"))
