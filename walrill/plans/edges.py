"""More registered queries: edge cases of decoding, apply, quarantine, repair, snapshot and registry, each with its twin in SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walrill.functions.rows import columns_of
from walrill.operators import assemble, decode, envelope, evolve, fold, quarantine, registry, snapshot
from walrill.operators.apply import State, apply_batch
from walrill.operators.registry import REGISTRY
from walrill.plans import log
from walrill.plans.cdc import _DECODED, _cell, _in_groups, _poisoned, _query, _two_tables

_ID = "printf('%X/%X:1', lsn // 4294967296, lsn % 4294967296)"
_AT = "2024-01-01"


def _at(text: str = _AT):
    return F.lit(text).cast("timestamp")


def _cell_of(kind: str, value=None):
    return F.struct(F.lit(kind).alias("kind"), (F.lit(None).cast("string") if value is None else value).alias("value"))


# --- decoding ---------------------------------------------------------------------------------------------------


@_query(f"""WITH {{b}}, {_DECODED} SELECT printf('%X/%X:%d', lsn // 4294967296, lsn % 4294967296, sequence) AS id, operation FROM q WHERE tx < (SELECT max(tx) FROM q)""")
def cdc_decode_open_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transaction whose commit hasn't come gives no events yet."""
    m = log.messages(spark, sf_dir)
    last = m.agg(F.max(F.when(F.col("kind") == "commit", F.col("pos"))).alias("last"))
    return decode.decode(m.join(last, (F.col("pos") == F.col("last")), "left_anti"))[0].select("id", "operation")


@_query("""WITH {b} SELECT (pos // 10) * 100 + pos % 10 + 1 AS pos, uid, 'uid' AS before FROM b WHERE kind = 'error'""")
def cdc_decode_key_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes of which the log holds the key alone: their old image has that one column, however many cells came."""
    m, gone = log.messages(spark, sf_dir), F.col("kind") == "delete"
    short = F.transform("old_tuple", lambda c: c)
    cells = F.array(short[0], _cell_of("n"), _cell_of("n")).cast(decode.TUPLE)
    m = m.withColumn("old_kind", F.when(gone, "K").otherwise(F.col("old_kind"))).withColumn("old_tuple", F.when(gone, cells).otherwise(F.col("old_tuple")))
    events = decode.decode(m)[0].where("operation = 'delete' and size(before) = 1")
    return events.select("pos", F.element_at("key", F.lit("uid")).alias("uid"), F.array_join(F.map_keys("before"), ",").alias("before"))


@_query("""WITH {b}, c AS (SELECT (pos // 10) * 100 + pos % 10 + 1 AS pos, pos AS p, uid, cents FROM b WHERE kind = 'click')
SELECT pos, 'update' AS operation, uid, cents, '' AS unchanged FROM c WHERE p % 2 = 0 AND p % 5 > 0
UNION ALL SELECT pos, 'delete', uid, NULL, '' FROM c WHERE p % 10 = 0
UNION ALL SELECT pos, 'insert', '9' || uid, cents, '' FROM c WHERE p % 10 = 0
UNION ALL SELECT pos, 'update', CASE WHEN p % 5 = 0 THEN '9' || uid ELSE uid END, NULL, 'cents' FROM c WHERE p % 2 = 1""")
def cdc_decode_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that an update doesn't repeat come from the old image; without one they are named as unchanged."""
    m, update, odd = log.messages(spark, sf_dir), F.col("kind") == "update", (F.col("pos") - 1) % 2 == 1
    cells = F.array(F.col("new_tuple")[0], F.col("new_tuple")[1], _cell_of("u")).cast(decode.TUPLE)
    m = m.withColumn("new_tuple", F.when(update, cells).otherwise(F.col("new_tuple")))
    m = m.withColumn("old_tuple", F.when(~(update & odd), F.col("old_tuple"))).withColumn("old_kind", F.when(~(update & odd), F.col("old_kind")))
    clicks = m.where(update).select(F.col("pos").alias("p"))
    events = decode.decode(m)[0].join(clicks, F.col("pos") == F.col("p"))
    return events.select("pos", "operation", F.element_at("key", F.lit("uid")).alias("uid"), F.element_at("after", F.lit("cents")).alias("cents"), F.array_join("unchanged_columns", ",").alias("unchanged"))


@_query("""WITH {b}, t AS (SELECT DISTINCT pos // 10 AS tx FROM b WHERE (pos // 10) % 3 > 0)
SELECT tx AS transaction_id, 1 AS sequence, 'truncate' AS operation, 'users' AS "table" FROM t UNION ALL SELECT tx, 2, 'truncate', 'orders' FROM t""")
def cdc_decode_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A truncate of two tables is an event for each; one that names an undescribed table spoils its transaction."""
    txs = log.base(spark, sf_dir).select(F.floor(F.col("pos") / log.GROUP).alias("tx")).distinct()
    ids = F.when(F.col("tx") % 3 == 0, F.array(F.lit(1), F.lit(9))).otherwise(F.array(F.lit(1), F.lit(2))).cast("array<bigint>")
    at = lambda n: (F.col("tx") * 100 + n).alias("pos")
    parts = [
        txs.select(at(0), F.lit("begin").alias("kind"), F.col("tx").alias("xid")), txs.select(at(1), F.lit("truncate").alias("kind"), ids.alias("relation_ids")),
        txs.select(at(2), F.lit("commit").alias("kind"), F.lit("0/1").alias("commit_lsn"), F.lit("0/1").alias("end_lsn")),
    ]
    columns = F.array(F.struct(F.lit("id").alias("name"), F.lit(1).alias("flags")))
    for i, name in ((1, "users"), (2, "orders")):
        parts.append(spark.range(1).select(F.lit(i - 9).cast("bigint").alias("pos"), F.lit("relation").alias("kind"), F.lit(i).cast("bigint").alias("relation_id"), F.lit("public").alias("namespace"), F.lit(name).alias("relation"), columns.alias("columns")))
    m = spark.createDataFrame([], decode.MESSAGE)
    for part in parts:
        m = m.unionByName(part, allowMissingColumns=True)
    return decode.decode(m)[0].select("source.transaction_id", "source.sequence", "operation", "table")


# --- apply ------------------------------------------------------------------------------------------------------


@_query("""WITH {b} SELECT pos, CASE WHEN kind = 'error' THEN NULL WHEN pos % 5 = 0 THEN 'key column absent from row' WHEN pos % 7 = 0 THEN 'key column marked unchanged' END AS reason FROM b""")
def cdc_key_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key column that the row lacks, or that is said to be unchanged."""
    e, full = log.changes(log.base(spark, sf_dir)), F.col("operation") != "delete"
    e = e.withColumn("key", F.when(full & (F.col("pos") % 5 == 0), F.map_concat("key", F.create_map(F.lit("region"), F.lit("1")))).otherwise(F.col("key")))
    e = e.withColumn("unchanged_columns", F.when(full & (F.col("pos") % 7 == 0), F.array(F.lit("uid"))).otherwise(F.col("unchanged_columns")))
    return envelope.with_reason(e).select("pos", "reason")


@_query("""WITH {b} SELECT pos, 'cents,kind,uid' AS columns, CASE WHEN pos % 3 = 0 THEN 'NULL' ELSE cents END || ',' || kind || ',' || uid AS "values" FROM b WHERE kind <> 'error'""")
def cdc_row_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row as its sorted columns and their values in that order."""
    rows = log.base(spark, sf_dir).withColumn("cents", F.when(F.col("pos") % 3 > 0, F.col("cents")))
    e = log.changes(rows).where("after is not null").select("pos", "after", columns_of(F.col("after")).alias("c"))
    return e.select("pos", F.array_join("c", ",").alias("columns"), F.array_join(F.transform("c", lambda x: F.element_at("after", x)), ",", "NULL").alias("values"))


@_query("""WITH {b} SELECT uid, kind, cents, lsn FROM b WHERE kind <> 'error' ORDER BY pos LIMIT 1""")
def cdc_single_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event alone, applied to nothing."""
    e = log.changes(log.base(spark, sf_dir)).where("operation <> 'delete'")
    first = e.agg(F.min("pos").alias("first"))
    after, _ = apply_batch(e.join(first, F.col("pos") == F.col("first")).drop("first"), replace(State.empty(spark), registry=log.registry(spark)), _at())
    return after.rows.select(_cell("uid"), _cell("kind"), _cell("cents"), F.col("lsn").cast("bigint").alias("lsn"))


@_query("""WITH {b}, r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY pos DESC) AS n FROM b)
SELECT r.uid::BIGINT AS uid, printf('%X/%X', r.lsn // 4294967296, r.lsn % 4294967296) AS source_lsn, epoch_us(e.ts::TIMESTAMP) AS committed, '2024-01-01' AS replicated FROM r JOIN events e ON e.event_id = r.pos WHERE n = 1""")
def cdc_row_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the engine notes beside each row: where and when it was committed at the source, and when it was written."""
    after, _ = apply_batch(log.changes(log.base(spark, sf_dir), deletes=False), replace(State.empty(spark), registry=log.registry(spark)), _at())
    t = registry.typed_table(after.rows, after.registry, "public", "users")
    return t.select("uid", "source_lsn", F.unix_micros("source_commit_time").alias("committed"), F.date_format("replicated_at", "yyyy-MM-dd").alias("replicated"))


@_query(f"""WITH {{b}} SELECT {_ID} AS id, CASE WHEN pos % 17 = 0 THEN 'undefined table' ELSE 'undefined column extra' END AS reason FROM b WHERE pos % 17 = 0 OR (pos % 11 = 0 AND kind <> 'error')""")
def cdc_undefined_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of tables and with columns that the destination doesn't have."""
    e = log.changes(log.base(spark, sf_dir), name=F.when(F.col("pos") % 17 == 0, "nowhere").otherwise("users"))
    e = e.withColumn("after", F.when(F.col("pos") % 11 == 0, F.map_concat("after", F.create_map(F.lit("extra"), F.lit("1")))).otherwise(F.col("after")))
    return registry.poison(fold.flat(e), log.registry(spark))


# --- transactions and transport ---------------------------------------------------------------------------------


@_query("""WITH {b}, x AS (SELECT pos, pos // 10 AS tx FROM b WHERE pos % 97 <> 0) SELECT pos FROM x WHERE tx IN (SELECT tx FROM x GROUP BY tx HAVING count(*) < 10)""")
def cdc_txn_waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that wait because their transaction isn't whole."""
    return assemble.split_complete(_in_groups(spark, sf_dir))[1].select("pos")


@_query(f"""WITH {{b}} SELECT pos, 'public.users|uid=' || uid AS key, {_ID} AS event_id, CASE kind WHEN 'error' THEN 'delete' WHEN 'click' THEN 'update' ELSE 'insert' END AS operation FROM b""")
def cdc_record_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and headers of the transport records."""
    records = envelope.to_records(log.changes(log.base(spark, sf_dir)), ("pos",))
    header = lambda name: F.filter("headers", lambda h: h["key"] == name)[0]["value"].cast("string")
    return records.select("pos", "key", header("event_id").alias("event_id"), header("operation").alias("operation"))


# --- quarantine -------------------------------------------------------------------------------------------------


@_query(f"""WITH {{b}} SELECT {_ID} AS event_id, 'value refused by type cents' AS reason, uid FROM b WHERE pos = 13""")
def cdc_dead_letter_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dead letter by its event's id."""
    after, _ = apply_batch(_poisoned(spark, sf_dir), _two_tables(spark), _at())
    return quarantine.one(after.dead_letters, "0/E:1").select("event_id", "reason", F.element_at("key", F.lit("uid")).alias("uid"))


@_query("""WITH {b}, x AS (SELECT pos % 13 = 0 AS bad, uid::BIGINT % 2 = 1 AS dropped FROM b)
SELECT 'dead letters' AS what, count(*) FILTER (bad AND NOT dropped) AS n FROM x UNION ALL SELECT 'markers', count(*) FILTER (NOT (bad AND dropped)) FROM x""")
def cdc_dead_letter_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left after the dead letters of one table are dropped, with their markers."""
    after, _ = apply_batch(_poisoned(spark, sf_dir), _two_tables(spark), _at())
    left = quarantine.drop(after, quarantine.listed(after.dead_letters, "public", "users_1"))
    count = lambda df, what: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")
    return count(left.dead_letters, "dead letters").unionByName(count(left.markers, "markers"))


@_query(f"""WITH {{b}} SELECT {_ID} AS event_id, uid::BIGINT % 2 = 1 AS replayed, CASE WHEN uid::BIGINT % 2 = 0 THEN '2024-01-01' END AS since, CASE WHEN uid::BIGINT % 2 = 0 THEN 'value refused by type cents' END AS reason FROM b WHERE pos % 13 = 0""")
def cdc_dead_letter_failed_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later replay of all dead letters after one of two tables was mended: the others keep their record and its time."""
    after, _ = apply_batch(_poisoned(spark, sf_dir), _two_tables(spark), _at())
    mended = F.when((F.col("table") == "users_1") & (F.col("column") == "cents"), "text").otherwise(F.col("pg_type"))
    fixed = replace(after, registry=after.registry.withColumn("pg_type", mended))
    again, result = quarantine.replay(fixed, after.dead_letters, _at("2024-02-02"))
    kept = again.dead_letters.select("event_id", F.date_format("occurred_at", "yyyy-MM-dd").alias("since"), "reason")
    return result.join(kept, "event_id", "left").select("event_id", "replayed", "since", "reason")


# --- repair and snapshot ----------------------------------------------------------------------------------------


@_query("""WITH {b} SELECT 'added with enum' AS what, 1::BIGINT AS n UNION ALL SELECT CASE WHEN pos % 10 = 0 AND kind = 'view' THEN 'dead letter' ELSE 'applied' END, count(*) FROM b GROUP BY 1""")
def cdc_enum_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of an enum type comes with its labels; a value that is none of them is refused."""
    e = log.changes(log.base(spark, sf_dir), deletes=False)
    mood = F.create_map(F.lit("note"), F.when(F.element_at("after", F.lit("kind")) == "view", "wild").otherwise("calm"))
    e = e.withColumn("after", F.when(F.col("pos") % 10 == 0, F.map_concat("after", mood)).otherwise(F.col("after")))
    state = replace(State.empty(spark), registry=log.registry(spark))
    is_note = F.col("column") == "note"
    source = log.registry(spark, columns=("uid", "kind", "cents", "note")).withColumn("pg_type", F.when(is_note, "mood").otherwise(F.col("pg_type"))).withColumn("enum_labels", F.when(is_note, F.array(F.lit("calm"), F.lit("glad"))))
    state, report = evolve.repair(state, source, e)
    _, outcome = apply_batch(e, state, _at())
    return report.select(F.col("action").alias("what")).unionByName(outcome.select(F.col("outcome").alias("what"))).groupBy("what").agg(F.count(F.lit(1)).alias("n"))


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry with a table for each nation: id and region are its key, note only in every third."""
    n = log.table(spark, sf_dir, "nation")
    spec = F.array(*(F.struct(F.lit(c).alias("column"), F.lit(i + 1).alias("ordinal"), F.lit(t).alias("pg_type"), F.lit(k).alias("is_key")) for i, (c, t, k) in enumerate((("region", "bigint", True), ("id", "bigint", True), ("name", "text", False), ("note", "text", False)))))
    rows = n.select(F.lit("public").alias("schema"), F.col("n_name").alias("table"), "n_nationkey", F.explode(spec).alias("c")).where("c.column <> 'note' or n_nationkey % 3 = 0")
    names = [f.split()[0].strip("`") for f in REGISTRY.split(", ")]
    return rows.select("schema", "table", "c.*", (~F.col("c.is_key")).alias("nullable"), F.lit(None).cast("string").alias("default_value"), F.lit(None).cast("array<string>").alias("enum_labels")).select(*names)


@_query("""SELECT 'public' AS "schema", n_name AS "table" FROM nation""")
def cdc_published_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.tables(_catalog(spark, sf_dir))


@_query("""SELECT n_name AS "table", CASE WHEN n_nationkey % 3 = 0 THEN 'region,id,name,note' ELSE 'region,id,name' END AS columns FROM nation WHERE n_nationkey < 5""")
def cdc_column_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of some tables in their order."""
    catalog = _catalog(spark, sf_dir)
    few = [r["n_name"] for r in log.table(spark, sf_dir, "nation").where("n_nationkey < 5").collect()]
    return spark.createDataFrame([(t, ",".join(c["column"] for c in registry.columns(catalog, "public", t))) for t in few], "`table` string, columns string")


@_query("""SELECT n_name AS "table", 'note' AS "column" FROM nation WHERE n_nationkey % 3 = 0""")
def cdc_column_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the columns asked for are there."""
    catalog = _catalog(spark, sf_dir)
    return registry.present(catalog, registry.tables(catalog).withColumn("column", F.lit("note"))).select("table", "column")


@_query("""SELECT n_name AS "table", 'region,id' AS key_columns FROM nation""")
def cdc_primary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.key_columns(_catalog(spark, sf_dir)).select("table", F.array_join("key_columns", ",").alias("key_columns"))


@_query("""SELECT 'nation' AS "table", 'public.nation|n_nationkey=' || n_nationkey AS key, n_name AS name, 2::BIGINT AS columns, '0/64' AS source_lsn, TRUE AS done FROM nation
UNION ALL SELECT 'region', 'public.region|r_regionkey=' || r_regionkey, r_name, 2, '0/64', TRUE FROM region""")
def cdc_snapshot_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first copy of two tables: the columns that both sides have, at the stream's position; then it is marked as done."""
    spec = [("nation", "n_nationkey", "integer", True), ("nation", "n_name", "text", False), ("nation", "extra", "text", False), ("region", "r_regionkey", "integer", True), ("region", "r_name", "text", False)]
    rows = [("public", t, c, i + 1, k, not key, None, key, None) for i, (t, c, k, key) in enumerate(spec)]
    state = replace(State.empty(spark), registry=spark.createDataFrame(rows, REGISTRY))
    after = snapshot.boot(state, lambda: "0/64", {("public", t): log.table(spark, sf_dir, t) for t in ("nation", "region")}, _at())
    done = snapshot.completed(after)
    return after.rows.select("table", "key", F.coalesce(F.element_at("cols", F.lit("n_name")), F.element_at("cols", F.lit("r_name"))).alias("name"), F.size("cols").cast("bigint").alias("columns"), F.concat(F.lit("0/"), F.hex(F.col("lsn").cast("bigint"))).alias("source_lsn"), F.lit(done).alias("done"))
