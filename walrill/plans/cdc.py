"""Registered queries of the change-data operators over the log of ``plans.log``, each with its twin in SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walrill.functions.lsn import lsn_order, lsn_text
from walrill.functions.pgtypes import interval_of, typed
from walrill.functions.rows import cast_suffix, enum_literal, event_key, quoted
from walrill.operators import assemble, decode, envelope, evolve, fold, identity, quarantine, registry, snapshot
from walrill.operators.apply import State, apply_batch
from walrill.plans import log
from walrill.streaming import observe

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

#: The log in SQL, before what each query does to it.
_BASE = "b AS (SELECT event_id AS pos, user_id::VARCHAR AS uid, event_type AS kind, floor(value * 100)::BIGINT::VARCHAR AS cents, event_id + 1 AS lsn FROM events)"


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql.replace("{b}", _BASE)
        return f

    return add


def _cell(name: str, cols: str = "cols"):
    return F.element_at(cols, F.lit(name)).alias(name)


def _users(state: DataFrame) -> DataFrame:
    return state.select(_cell("uid"), _cell("kind"), _cell("cents"), F.col("lsn").cast("bigint").alias("lsn"))


# --- apply ------------------------------------------------------------------------------------------------------


@_query("""WITH {b}, r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY pos DESC) AS n FROM b)
SELECT uid, kind, cents, lsn FROM r WHERE n = 1 AND kind <> 'error'""")
def cdc_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed table after the whole log: the row of each user's last change, unless that deleted it."""
    events = fold.flat(log.changes(log.base(spark, sf_dir)))
    return _users(fold.fold(fold.fresh(events))[0])


@_query("""WITH {b}, d AS (SELECT uid, max(pos) FILTER (kind = 'error') AS gone, max(pos) AS last, arg_max(kind, pos) AS last_kind FROM b GROUP BY uid)
SELECT b.uid, arg_max(b.kind, b.pos) AS kind, arg_max(b.cents, b.pos) FILTER (b.kind <> 'click') AS cents, max(b.lsn) AS lsn
FROM b JOIN d ON d.uid = b.uid WHERE b.pos > coalesce(d.gone, -1) AND d.last_kind <> 'error' GROUP BY b.uid""")
def cdc_preserve_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As before, but clicks leave cents as they are: the value is that of the last change that has one."""
    events = fold.flat(log.changes(log.base(spark, sf_dir), preserve=True))
    return _users(fold.fold(fold.fresh(events))[0])


_STALE = "b0 AS (SELECT event_id AS pos, user_id::VARCHAR AS uid, event_type AS kind, floor(value * 100)::BIGINT::VARCHAR AS cents, event_id + 1 - CASE WHEN event_id % 11 = 0 AND event_id > 60 THEN 50 ELSE 0 END AS lsn FROM events)"


def _stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = (F.col("pos") % 11 == 0) & (F.col("pos") > 60)
    return log.base(spark, sf_dir).withColumn("lsn", (F.col("lsn") - F.when(late, 50).otherwise(0)).cast("decimal(20,0)"))


def _by_pos(events: DataFrame) -> DataFrame:
    """Ids by position, for logs in which positions of the source repeat."""
    return events.withColumn("id", F.col("pos").cast("string"))


@_query(f"""WITH {_STALE}, g AS (SELECT *, max(lsn) OVER (PARTITION BY uid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM b0)
SELECT uid, arg_max(kind, pos) AS kind, arg_max(cents, pos) AS cents, max(lsn) AS lsn FROM g WHERE high IS NULL OR lsn >= high GROUP BY uid""")
def cdc_stale_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that come late, behind the position of their row, change nothing (no deletes in this log)."""
    events = fold.flat(_by_pos(log.changes(_stale(spark, sf_dir), deletes=False)))
    return _users(fold.fold(fold.fresh(events))[0])


@_query(f"""WITH RECURSIVE {_STALE}, o AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY pos) AS n FROM b0),
s AS (SELECT uid, n, kind <> 'error' AS p, CASE WHEN kind <> 'error' THEN lsn END AS l, CASE WHEN kind <> 'error' THEN kind END AS k, CASE WHEN kind NOT IN ('error', 'click') THEN cents END AS c FROM o WHERE n = 1
UNION ALL SELECT o.uid, o.n,
 CASE WHEN s.p AND s.l > o.lsn THEN s.p ELSE o.kind <> 'error' END, CASE WHEN s.p AND s.l > o.lsn THEN s.l WHEN o.kind <> 'error' THEN o.lsn END,
 CASE WHEN s.p AND s.l > o.lsn THEN s.k WHEN o.kind <> 'error' THEN o.kind END,
 CASE WHEN s.p AND s.l > o.lsn THEN s.c WHEN o.kind = 'error' THEN NULL WHEN o.kind = 'click' THEN s.c ELSE o.cents END
 FROM s JOIN o ON o.uid = s.uid AND o.n = s.n + 1)
SELECT s.uid, k AS kind, c AS cents, l AS lsn FROM s JOIN (SELECT uid, max(n) AS n FROM o GROUP BY uid) m ON m.uid = s.uid AND m.n = s.n WHERE p""")
def cdc_exact_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late changes, deletes and kept columns together: each row is what its changes make of it one by one."""
    events = fold.flat(_by_pos(log.changes(_stale(spark, sf_dir), preserve=True)))
    return _users(fold.fold(fold.fresh(events))[0])


@_query("""WITH {b}, u AS (SELECT pos, lsn FROM b UNION ALL SELECT pos + 10000000, lsn FROM b WHERE pos % 7 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY lsn ORDER BY pos) AS n FROM u)
SELECT printf('%X/%X:1', lsn // 4294967296, lsn % 4294967296) AS id, pos, lsn FROM r WHERE n = 1 AND lsn % 17 <> 0""")
def cdc_dedupe_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First arrivals of ids that have no marker; a seventh is delivered twice, a seventeenth is marked before."""
    events = log.changes(log.base(spark, sf_dir))
    again = events.where("pos % 7 = 0").withColumn("pos", F.col("pos") + 10_000_000)
    flat = fold.flat(events.unionByName(again))
    markers = log.base(spark, sf_dir).where("lsn % 17 = 0").select(F.concat(lsn_text(F.col("lsn")), F.lit(":1")).alias("id"), "lsn")
    return fold.fresh(flat, markers).select("id", "pos", F.col("lsn").cast("bigint").alias("lsn"))


_CUTS = "t AS (SELECT pos, pos % 2000 IN (0, 1) AS cut, lsn - CASE WHEN pos % 2000 = 1 THEN 5 ELSE 0 END AS lsn FROM b)"


def _with_truncates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = F.col("pos") % 2000
    rows = log.base(spark, sf_dir).withColumn("lsn", (F.col("lsn") - F.when(cut == 1, 5).otherwise(0)).cast("decimal(20,0)"))
    return fold.flat(_by_pos(log.changes(rows, deletes=False))).withColumn("operation", F.when(cut.isin(0, 1), "truncate").otherwise(F.col("operation")))


@_query(f"""WITH {{b}}, {_CUTS}, w AS (SELECT *, max(CASE WHEN cut THEN lsn END) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM t),
e AS (SELECT *, cut AND lsn > greatest(coalesce(seen, 0), 3000) AS effective FROM w)
SELECT pos, effective, sum(effective::INT) OVER (ORDER BY pos)::BIGINT AS epoch FROM e""")
def cdc_truncate_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncates beyond the watermark open a new epoch; those at or before it are replays."""
    marks = spark.createDataFrame([("public", "users")], "`schema` string, `table` string").withColumn("watermark", F.lit(3000).cast("decimal(20,0)"))
    return fold.truncate_epochs(_with_truncates(spark, sf_dir), marks).select("pos", "effective", "epoch")


@_query(f"""WITH {{b}}, {_CUTS}, w AS (SELECT *, max(CASE WHEN cut THEN lsn END) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM t),
l AS (SELECT max(pos) AS p, max(lsn) AS wm FROM w WHERE cut AND lsn > coalesce(seen, 0)),
r AS (SELECT b.uid, b.kind, b.cents, t.lsn, row_number() OVER (PARTITION BY uid ORDER BY b.pos DESC) AS n FROM b JOIN t USING (pos) WHERE NOT t.cut AND b.pos > (SELECT p FROM l))
SELECT uid, kind, cents, lsn, (SELECT wm FROM l) AS watermark FROM r WHERE n = 1""")
def cdc_truncate_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table behind its last effective truncate, with the new watermark."""
    state, marks = fold.fold(fold.fresh(_with_truncates(spark, sf_dir)))
    return state.join(marks, fold.TABLE).select(_cell("uid"), _cell("kind"), _cell("cents"), F.col("lsn").cast("bigint").alias("lsn"), F.col("watermark").cast("bigint").alias("watermark"))


@_query("""WITH {b}, x AS (SELECT pos, lsn, uid, pos % 13 = 0 AND kind <> 'error' AS bad, pos % 19 = 0 AS invalid FROM b)
SELECT CASE WHEN invalid OR bad THEN 'dead letter' ELSE 'applied' END AS outcome, count(*) AS n FROM x GROUP BY 1
UNION ALL SELECT 'duplicate', count(*) FROM x WHERE pos % 7 = 0""")
def cdc_apply_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of every delivery of a batch: applied, set aside or known already."""
    rows = log.base(spark, sf_dir).withColumn("cents", F.when(F.col("pos") % 13 == 0, "oops").otherwise(F.col("cents")))
    events = log.changes(rows).withColumn("version", F.when(F.col("pos") % 19 == 0, 2).otherwise(F.col("version")))
    events = events.unionByName(events.where("pos % 7 = 0").withColumn("pos", F.col("pos") + 10_000_000))
    state = replace(State.empty(spark), registry=log.registry(spark))
    _, outcome = apply_batch(events, state, F.lit("2024-01-01").cast("timestamp"))
    return outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


# --- transactions -----------------------------------------------------------------------------------------------


@_query("""WITH {b} SELECT pos // 10 AS transaction_id, count(*) AS events, count(*) = 10 AS complete FROM b WHERE pos % 97 <> 0 GROUP BY 1""")
def cdc_txn_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which source transactions have arrived whole; every 97th change is lost and the first three of each tenth come twice."""
    events = _in_groups(spark, sf_dir)
    partly = events.where("transaction_id % 10 = 0 and sequence <= 3").withColumn("pos", F.col("pos") - 5)
    return assemble.transactions(events.unionByName(partly)).select("transaction_id", "events", "complete")


def _in_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = log.changes(log.base(spark, sf_dir)).where("pos % 97 <> 0")
    return events.select("pos", F.col("source.transaction_id").alias("transaction_id"), F.floor(F.col("pos") / 10).cast("string").alias("commit_lsn"), F.col("source.sequence").alias("sequence"), F.col("source.transaction_event_count").alias("transaction_event_count"))


@_query("""WITH {b}, x AS (SELECT pos, pos // 10 AS transaction_id, (pos % 10 + 1)::INT AS sequence FROM b WHERE pos % 97 <> 0),
l AS (SELECT *, lag(sequence) OVER (PARTITION BY transaction_id ORDER BY pos) AS previous FROM x)
SELECT pos, transaction_id, sequence, CASE WHEN previous IS NULL THEN 'opens after 1' ELSE 'gap' END AS fault FROM l
WHERE (previous IS NULL AND sequence <> 1) OR sequence <> previous + 1""")
def cdc_txn_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a transaction skips a sequence number."""
    return assemble.sequence_faults(_in_groups(spark, sf_dir)).select("pos", "transaction_id", "sequence", "fault")


# --- contract and transport -------------------------------------------------------------------------------------


@_query("""WITH {b} SELECT pos, CASE WHEN pos % 23 = 0 THEN 'unsupported version' WHEN pos % 29 = 0 THEN 'missing schema or table' WHEN pos % 31 = 0 THEN 'unsupported operation'
 WHEN pos % 37 = 0 THEN 'missing key' WHEN pos % 41 = 0 AND kind <> 'error' THEN 'missing after' WHEN pos % 43 = 0 THEN 'bad identifier'
 WHEN (pos % 47 = 0 AND kind <> 'error') OR pos % 53 = 0 THEN 'reserved column' END AS reason FROM b""")
def cdc_validate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why an event breaks the contract, or null; rules in their order."""
    every = lambda n: F.col("pos") % n == 0
    e = log.changes(log.base(spark, sf_dir))
    e = e.withColumn("version", F.when(every(23), 9).otherwise(F.col("version"))).withColumn("schema", F.when(every(29), "").otherwise(F.col("schema"))).withColumn("operation", F.when(every(31), "merge").otherwise(F.col("operation")))
    e = e.withColumn("key", F.when(~every(37), F.col("key"))).withColumn("after", F.when(~every(41), F.col("after"))).withColumn("table", F.when(every(43), "us ers").otherwise(F.col("table")))
    e = e.withColumn("after", F.when(every(47), F.map_concat("after", F.create_map(F.lit("source_lsn"), F.lit("0/1")))).otherwise(F.col("after")))
    e = e.withColumn("key", F.when(every(53), F.map_concat("key", F.create_map(F.lit("replicated_at"), F.lit("1")))).otherwise(F.col("key")))
    return envelope.with_reason(e).select("pos", "reason")


@_query("""WITH {b} SELECT pos, 'public.users|kind=' || coalesce(CASE WHEN pos % 3 > 0 THEN kind END, 'NULL') || '|uid=' || uid AS event_key FROM b""")
def cdc_event_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transport's grouping key, columns sorted, NULL for null."""
    key = log.row(uid=F.col("uid"), kind=F.when(F.col("pos") % 3 > 0, F.col("kind")))
    return log.base(spark, sf_dir).select("pos", event_key(F.lit("public"), F.lit("users"), key).alias("event_key"))


@_query("""WITH {b} SELECT pos, printf('%X/%X:1', lsn // 4294967296, lsn % 4294967296) AS id, CASE kind WHEN 'error' THEN 'delete' WHEN 'click' THEN 'update' ELSE 'insert' END AS operation, uid,
 CASE WHEN kind <> 'error' THEN cents END AS cents, kind <> 'error' AS has_note, (pos % 10 + 1)::INT AS sequence, pos % 50 <> 0 AS readable FROM b WHERE pos % 50 <> 0
UNION ALL SELECT pos, '', '', '', '', FALSE, 0, FALSE FROM b WHERE pos % 50 = 0""")
def cdc_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events to JSON records and back; a null value stays a present column; a broken document goes apart."""
    e = log.changes(log.base(spark, sf_dir))
    e = e.withColumn("after", F.map_concat("after", F.create_map(F.lit("note"), F.lit(None).cast("string"))))
    records = envelope.to_records(e, ("pos",)).withColumn("value", F.when(F.col("pos") % 50 == 0, F.substring("value", F.lit(1), F.lit(20))).otherwise(F.col("value")))
    back, read = envelope.read_records(records, ("pos",)), F.col("reason").isNull()
    text = lambda value, name: F.when(read, value).otherwise("").alias(name)
    noted = F.coalesce(F.array_contains(F.map_keys("after"), "note"), F.lit(False))
    return back.select(
        "pos", text(F.col("id"), "id"), text(F.col("operation"), "operation"), text(F.element_at("key", F.lit("uid")), "uid"), text(F.element_at("after", F.lit("cents")), "cents"),
        (read & noted).alias("has_note"), F.when(read, F.col("source.sequence")).otherwise(0).alias("sequence"), read.alias("readable"),
    )


# --- decoding ---------------------------------------------------------------------------------------------------

_DECODED = """x AS (SELECT *, pos // 10 AS tx, kind = 'click' AND pos % 5 = 0 AS moved FROM b),
e AS (SELECT pos, tx, 0 AS step, CASE WHEN kind = 'error' OR moved THEN 'delete' WHEN kind = 'click' THEN 'update' ELSE 'insert' END AS operation, uid AS key_uid FROM x
 UNION ALL SELECT pos, tx, 1, 'insert', '9' || uid FROM x WHERE moved),
q AS (SELECT *, row_number() OVER (PARTITION BY tx ORDER BY pos, step)::INT AS sequence, count(*) OVER (PARTITION BY tx)::INT AS n, max(pos + 1) OVER (PARTITION BY tx) AS lsn FROM e)"""


@_query(f"""WITH {{b}}, {_DECODED} SELECT printf('%X/%X:%d', lsn // 4294967296, lsn % 4294967296, sequence) AS id, tx AS transaction_id, sequence, n AS transaction_event_count FROM q""")
def cdc_decode_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to events: numbered in their transaction, named by its commit, counted."""
    events, _ = decode.decode(log.messages(spark, sf_dir))
    return events.select("id", "source.transaction_id", "source.sequence", "source.transaction_event_count")


@_query(f"""WITH {{b}}, {_DECODED} SELECT tx AS transaction_id, sequence, operation, key_uid FROM q""")
def cdc_key_change_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update that moves a row is a delete and an insert."""
    events, _ = decode.decode(log.messages(spark, sf_dir))
    return events.select("source.transaction_id", "source.sequence", "operation", F.element_at("key", F.lit("uid")).alias("key_uid"))


@_query("""WITH {b} SELECT (pos // 10) * 100 + pos % 10 + 1 AS pos, 'users_v' || (pos // 1000) AS relation FROM b""")
def cdc_relation_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The description of its relation that each change goes by: the latest before it."""
    m = log.messages(spark, sf_dir)
    changes = m.where(F.col("kind").isin(*decode.CHANGES)).select("pos", "relation_id")
    relations = m.where("kind = 'relation'").select("pos", "relation_id", "namespace", "relation", "columns")
    return decode.with_relation(changes, relations).select("pos", F.col("rel.relation").alias("relation"))


@_query("""WITH {b}, t AS (SELECT pos // 10 AS tx, count(*) AS n FROM b GROUP BY 1)
SELECT CASE tx % 5 WHEN 0 THEN 'binary value' WHEN 1 THEN 'tuple and relation differ in columns' WHEN 2 THEN 'new row: key column is null' WHEN 3 THEN 'insert with unchanged values' ELSE 'relation not described' END AS reason, count(*) AS n FROM t GROUP BY 1""")
def cdc_decode_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the protocol forbids, found and named: one broken insert in each transaction."""
    b = log.base(spark, sf_dir).select(F.floor(F.col("pos") / 10).alias("tx")).distinct()
    kind = F.col("tx") % 5
    t = lambda k, v="x": F.struct(F.lit(k).alias("kind"), F.lit(v).alias("value"))
    tuple_ = F.when(kind == 0, F.array(t("t"), t("b"))).when(kind == 1, F.array(t("t"))).when(kind == 2, F.array(t("n"), t("t"))).when(kind == 3, F.array(t("t"), t("u"))).otherwise(F.array(t("t"), t("t"))).cast(decode.TUPLE)
    rows = b.select((F.col("tx") * 10 + 2).alias("pos"), F.lit("insert").alias("kind"), F.when(kind == 4, 9).otherwise(1).cast("bigint").alias("relation_id"), tuple_.alias("new_tuple"), F.lit(None).cast(decode.TUPLE).alias("old_tuple"), F.lit(None).cast("string").alias("old_kind"), F.lit(None).cast("array<bigint>").alias("relation_ids"))
    begins = b.select((F.col("tx") * 10 + 1).alias("pos"), F.lit("begin").alias("kind"), F.col("tx").alias("xid"))
    commits = b.select((F.col("tx") * 10 + 3).alias("pos"), F.lit("commit").alias("kind"), F.lit("0/1").alias("commit_lsn"), F.lit("0/1").alias("end_lsn"), F.lit(None).cast("timestamp").alias("commit_time"))
    described = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(f).alias("flags")) for n, f in (("id", 1), ("v", 0))))
    relation = spark.range(1).select(F.lit(0).cast("bigint").alias("pos"), F.lit("relation").alias("kind"), F.lit(1).cast("bigint").alias("relation_id"), F.lit("public").alias("namespace"), F.lit("t").alias("relation"), described.alias("columns"))
    m = rows
    for part in (begins, commits, relation):
        m = m.unionByName(part, allowMissingColumns=True)
    return decode.decode(m)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# --- quarantine, repair, snapshot -------------------------------------------------------------------------------


def _poisoned(spark: SparkSession, sf_dir: str, deletes: bool = False) -> DataFrame:
    rows = log.base(spark, sf_dir).withColumn("cents", F.when(F.col("pos") % 13 == 0, "oops").otherwise(F.col("cents")))
    return log.changes(rows, deletes=deletes, name=F.concat(F.lit("users_"), F.col("uid").cast("long") % 2))


def _two_tables(spark: SparkSession, cents: str = "bigint") -> State:
    return replace(State.empty(spark), registry=log.registry(spark, ("users_0", "users_1"), cents))


@_query("""WITH {b} SELECT printf('%X/%X:1', lsn // 4294967296, lsn % 4294967296) AS id, 'value refused by type cents' AS reason FROM b WHERE pos % 13 = 0""")
def cdc_poison_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose values their columns refuse."""
    return registry.poison(fold.flat(_poisoned(spark, sf_dir)), _two_tables(spark).registry)


@_query("""WITH {b} SELECT printf('%X/%X:1', lsn // 4294967296, lsn % 4294967296) AS event_id, 'users_1' AS "table", CASE kind WHEN 'click' THEN 'update' ELSE 'insert' END AS operation, uid, printf('%X/%X', lsn // 4294967296, lsn % 4294967296) AS source_lsn
FROM b WHERE pos % 13 = 0 AND uid::BIGINT % 2 = 1""")
def cdc_dead_letter_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of one of two tables."""
    after, _ = apply_batch(_poisoned(spark, sf_dir), _two_tables(spark), F.lit("2024-01-01").cast("timestamp"))
    found = quarantine.listed(after.dead_letters, "public", "users_1")
    return found.select("event_id", "table", "operation", F.element_at("key", F.lit("uid")).alias("uid"), "source_lsn")


@_query("""WITH {b}, r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY lsn DESC) AS n FROM b) SELECT uid, kind, CASE WHEN pos % 13 = 0 THEN 'oops' ELSE cents END AS cents, lsn FROM r WHERE n = 1""")
def cdc_dead_letter_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables after the column has become text and all dead letters are replayed: late ones change nothing."""
    at = F.lit("2024-01-01").cast("timestamp")
    after, _ = apply_batch(_poisoned(spark, sf_dir), _two_tables(spark), at)
    # Quarantine keeps the order of arrival in its times.
    letters = after.dead_letters.withColumn("occurred_at", F.timestamp_micros(lsn_order(F.col("source_lsn")).cast("bigint")))
    fixed = replace(after, registry=_two_tables(spark, "text").registry, dead_letters=letters)
    return _users(quarantine.replay(fixed, letters, at)[0].rows)


@_query("""WITH {b}, r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY pos DESC) AS n, bool_or(pos % 10 = 0) OVER (PARTITION BY uid) AS noted FROM b), l AS (SELECT uid, arg_max(pos, pos) AS p FROM b WHERE pos % 10 = 0 GROUP BY uid)
SELECT r.uid::BIGINT AS uid, r.kind, CASE WHEN l.p IS NULL THEN 'none' ELSE 'n' || l.p END AS note FROM r LEFT JOIN l USING (uid) WHERE r.n = 1""")
def cdc_schema_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that first appears in the log is added with its default, and the rows that lack it show that."""
    rows = log.base(spark, sf_dir)
    e = log.changes(rows, deletes=False).withColumn("after", F.when(F.col("pos") % 10 == 0, F.map_concat("after", F.create_map(F.lit("note"), F.concat(F.lit("n"), F.col("pos"))))).otherwise(F.col("after")))
    state = replace(State.empty(spark), registry=log.registry(spark, columns=("uid", "kind", "cents")))
    source = log.registry(spark, columns=("uid", "kind", "cents", "note")).withColumn("default_value", F.when(F.col("column") == "note", "none"))
    state, _ = evolve.repair(state, source, e)
    after, _ = apply_batch(e, state, F.lit("2024-01-01").cast("timestamp"))
    return registry.typed_table(after.rows, after.registry, "public", "users").select("uid", "kind", "note")


@_query("""WITH {b}, s AS (SELECT c_custkey::VARCHAR AS uid, c_mktsegment AS segment FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY pos DESC) AS n FROM b)
SELECT coalesce(s.uid, r.uid) AS uid, s.segment, CASE WHEN s.uid IS NULL OR r.lsn >= 5000 THEN r.cents END AS cents, CASE WHEN r.lsn IS NULL OR (s.uid IS NOT NULL AND r.lsn < 5000) THEN 5000 ELSE r.lsn END AS lsn
FROM s FULL JOIN (SELECT * FROM r WHERE n = 1) r ON r.uid = s.uid""")
def cdc_snapshot_handoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers copied at one position, then the log on top: what the copy has seen changes nothing."""
    source = log.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("uid"), F.col("c_mktsegment").alias("segment"))
    when = F.lit("2024-01-01").cast("timestamp")
    copied = snapshot.rows_of(source, "public", "users", ["uid", "segment"], ["uid"], "0/1388", when)
    empty = State.empty(spark)
    state = fold.fold(fold.flat(log.changes(log.base(spark, sf_dir), deletes=False)), snapshot.merge_rows(empty.rows, copied))[0]
    return state.select(_cell("uid"), _cell("segment"), _cell("cents"), F.col("lsn").cast("bigint").alias("lsn"))


@_query("""WITH t AS (SELECT n_name AS "table", CASE n_nationkey % 5 WHEN 0 THEN 'd' WHEN 1 THEN 'i' WHEN 2 THEN 'f' WHEN 3 THEN 'n' ELSE 'x' END AS mode, n_nationkey % 7 > 0 AS pk, n_nationkey % 3 > 0 AS ix FROM nation)
SELECT "table", CASE WHEN mode IN ('d', 'f') AND pk THEN 'id,region' WHEN mode = 'i' AND ix THEN 'email' END AS key_columns,
 CASE WHEN mode = 'n' THEN 'identity nothing' WHEN mode = 'x' THEN 'unknown identity' WHEN (mode IN ('d', 'f') AND NOT pk) OR (mode = 'i' AND NOT ix) THEN 'no usable key' END AS refusal FROM t""")
def cdc_identity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key of each table by its replica identity, from catalog tables, or why it has none."""
    n = log.table(spark, sf_dir, "nation").select(F.col("n_name").alias("table"), F.col("n_nationkey").alias("k"), F.lit("public").alias("schema"))
    mode = F.element_at(F.array(*map(F.lit, "difnx")), (F.col("k") % 5 + 1).cast("int"))
    identities = n.select("schema", "table", mode.alias("mode"), F.when(F.col("k") % 3 > 0, "by_email").alias("identity_index"))
    index = lambda name, primary, cols, when: n.where(when).select("schema", "table", F.lit(name).alias("index"), F.lit(primary).alias("is_primary"), F.posexplode(F.array(*map(F.lit, cols))).alias("ordinality", "column"))
    indexes = index("pk", True, ("id", "region"), "k % 7 > 0").unionByName(index("by_email", False, ("email",), "k % 3 > 0"))
    found = identity.discover(n.select(F.lit("pub").alias("publication"), "schema", "table"), identities, indexes)
    return found.select("table", F.array_join("key_columns", ",").alias("key_columns"), "refusal")


# --- types, positions, figures ----------------------------------------------------------------------------------


@_query("""SELECT event_id, (event_id * 2654435761) % 9007199254740992 AS n, printf('%X/%X', ((event_id * 2654435761) % 9007199254740992) // 4294967296, ((event_id * 2654435761) % 9007199254740992) % 4294967296) AS lsn FROM events""")
def cdc_lsn_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions to text and back."""
    e = log.table(spark, sf_dir, "events").select("event_id", ((F.col("event_id") * 2654435761) % 9007199254740992).alias("n"))
    return e.select("event_id", lsn_order(lsn_text(F.col("n"))).cast("bigint").alias("n"), lsn_text(F.col("n")).alias("lsn"))


@_query("""SELECT p_partkey, p_size % 2 = 0 AS flag, CASE WHEN p_partkey % 5 > 0 THEN p_size::VARCHAR END AS size, p_size || '+' || (p_size + 1) AS sizes, p_brand || ',"x"' AS quoted_item, p_size AS range_from, p_partkey % 3 > 0 AS upper_open, 90000 * p_size AS seconds,
 CASE WHEN p_partkey % 4 > 0 THEN 'deadbeef' END AS bytes, CASE WHEN p_size < 25 THEN 'small' END AS mood FROM part""")
def cdc_typed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire text typed by destination types; what a type refuses is null."""
    p, size = log.table(spark, sf_dir, "part"), F.col("p_size").cast("string")
    number = F.when(F.col("p_partkey") % 5 > 0, size).otherwise("1x")
    array = F.concat(F.lit("{"), size, F.lit(","), (F.col("p_size") + 1).cast("string"), F.lit("}"))
    texts = F.concat(F.lit('{"'), F.col("p_brand"), F.lit(',\\"x\\""}'))
    spread = typed(F.concat(F.lit("["), size, F.lit(",99"), F.when(F.col("p_partkey") % 3 > 0, ")").otherwise("]")), "int4range")
    hours = interval_of(F.concat(size, F.lit(" days "), size, F.lit(":00:00")))
    raw = typed(F.when(F.col("p_partkey") % 4 > 0, F.lit("\\xdeadbeef")).otherwise("deadbeef"), "bytea")
    mood = typed(F.when(F.col("p_size") < 25, "small").otherwise("huge"), "mood", ["small", "large"])
    return p.select("p_partkey", typed(F.when(F.col("p_size") % 2 == 0, "t").otherwise("f"), "boolean").alias("flag"), typed(number, "integer").cast("string").alias("size"), F.array_join(typed(array, "integer[]").cast("array<string>"), "+").alias("sizes"), typed(texts, "text[]")[0].alias("quoted_item"), spread["lower"].cast("int").alias("range_from"), (~spread["upper_inc"]).alias("upper_open"), _seconds(hours).alias("seconds"), F.lower(F.hex(raw)).alias("bytes"), mood.alias("mood"))


def _seconds(interval):
    day, hour, minute = (F.extract(F.lit(x), interval).cast("int") for x in ("DAY", "HOUR", "MINUTE"))
    return day * 86400 + hour * 3600 + minute * 60


@_query("""SELECT n_nationkey, '"' || replace(n_name || '"x', '"', '""') || '"' AS quoted, '''' || n_name || ''', ''it''''s''' AS labels, CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE '::text[]' END AS suffix FROM nation""")
def cdc_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, labels and type suffixes as the destination spells them."""
    n = log.table(spark, sf_dir, "nation")
    kind = F.when(F.col("n_nationkey") % 2 == 1, "text[]").otherwise("")
    return n.select("n_nationkey", quoted(F.concat("n_name", F.lit('"x'))).alias("quoted"), enum_literal(F.array("n_name", F.lit("it's"))).alias("labels"), cast_suffix(kind).alias("suffix"))


@_query("""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN -1 ELSE o_orderkey % 100 END AS start, o_orderkey % 100 + o_custkey % 60 - 10 AS "end", CASE WHEN o_orderkey % 13 > 0 THEN o_custkey % 120 - 5 END AS committed FROM orders),
k AS (SELECT *, start >= 0 AND "end" >= 0 AND "end" >= start AS ends, coalesce(committed, -1) >= 0 AS has_commit FROM o)
SELECT o_orderkey, CASE WHEN ends THEN "end" - start ELSE -1 END AS produced, CASE WHEN ends AND has_commit THEN committed - start ELSE -1 END AS consumed, CASE WHEN ends AND has_commit AND "end" >= committed THEN "end" - committed ELSE -1 END AS lag,
 coalesce(start >= 0 AND committed >= 0 AND committed < start, FALSE) AS outran, 604800 - (o_orderkey % 100) * 9000 AS headroom, coalesce((o_orderkey % 100) >= 60 AND committed * 1000000 > 67108864, FALSE) AS stalled FROM k""")
def cdc_lag_headroom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets, some unknown or reversed, to lag, and lag to what is left of retention."""
    o, k, c = log.table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    first = F.when(k % 7 == 0, None).when(k % 11 == 0, -1).otherwise(k % 100)
    offsets = o.select("o_orderkey", first.cast("bigint").alias("start"), (k % 100 + c % 60 - 10).alias("end"), F.when(k % 13 > 0, c % 120 - 5).alias("committed"))
    figures = observe.consumer_figures(offsets)
    spent = k % 100
    return figures.select("o_orderkey", "produced", "consumed", "lag", "outran", observe.headroom(spent * 9000, F.lit(observe.RETENTION_SECONDS)).alias("headroom"), observe.stalled(spent, F.col("committed") * 1_000_000).alias("stalled"))


@_query("""SELECT CASE """ + " ".join(f"WHEN x <= {b} THEN {b}::DOUBLE" for b in observe.SIZE_BUCKETS) + """ ELSE 'inf'::DOUBLE END AS le, count(*) AS n FROM (SELECT count(*) AS x FROM lineitem GROUP BY l_orderkey) GROUP BY 1""")
def cdc_batch_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of groups in the buckets of the size histogram."""
    sizes = log.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("size"))
    return observe.histogram(sizes, "size", observe.SIZE_BUCKETS)


@_query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 < 3 THEN 'fewer than 3 brokers' WHEN o_orderkey % 3 <> 1 THEN 'not exactly 1 partition' WHEN o_orderkey % 5 < 3 THEN 'replication below 3' WHEN o_orderkey % 4 < 2 THEN 'fewer than 2 replicas in sync' WHEN o_orderkey % 11 < 2 THEN 'min.insync.replicas below 2' END AS fault FROM orders""")
def cdc_durability_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with a topic's settings, first rule first."""
    k = F.col("o_orderkey")
    topic = log.table(spark, sf_dir, "orders").select("o_orderkey", (k % 7).alias("brokers"), (k % 3).alias("partitions"), (k % 5).alias("replication"), (k % 4).alias("in_sync"), (k % 11).alias("min_in_sync"))
    return observe.durability_faults(topic).select("o_orderkey", "fault")
