"""Registered queries of the running engine: settings, retries, figures, the command line, and the two streams end to end."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walrill import admin
from walrill.functions import retry
from walrill.operators.apply import State
from walrill.plans import log
from walrill.plans.cdc import _DECODED, _cell, _query
from walrill.sources import connect, files, replication
from walrill.storage import shared_dir
from walrill.streaming import observe, publish
from walrill.streaming.store import Store
from walrill.streaming.stream import Writer, start


@_query("""WITH o AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '604800000' WHEN 1 THEN 'week' END AS value FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 604800000 ELSE 0 END AS retention_ms FROM o""")
def cdc_topic_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic's retention from its settings; 0 where it isn't set or isn't a number."""
    k = F.col("o_orderkey")
    configs = log.table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 == 0, "604800000").when(k % 3 == 1, "week").alias("value"))
    return configs.select("o_orderkey", observe.retention_ms(F.col("value")).alias("retention_ms"))


@_query("""WITH {b}, x AS (SELECT pos, lsn - CASE WHEN pos % 11 = 0 AND pos > 60 THEN 50 ELSE 0 END AS lsn FROM b),
m AS (SELECT *, max(lsn) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS durable FROM x) SELECT pos, lsn, durable FROM m WHERE lsn < durable""")
def cdc_position_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of a position that lies before one reported earlier."""
    late = (F.col("pos") % 11 == 0) & (F.col("pos") > 60)
    reports = log.base(spark, sf_dir).select("pos", (F.col("lsn") - F.when(late, 50).otherwise(0)).cast("bigint").alias("lsn"))
    return observe.position_faults(reports)


@_query("""SELECT n AS attempt, least(2.0::DOUBLE, 0.1::DOUBLE * pow(2, n - 1)) AS wait FROM range(1, 21) t(n)""")
def cdc_retry_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waits between attempts before they are shortened at random."""
    plan = retry.Backoff()
    return spark.createDataFrame([(n, plan.plain(n)) for n in range(1, plan.attempts + 1)], "attempt bigint, wait double")


@_query("""WITH h AS (SELECT n_name, list_reduce(list_prepend(14695981039346656037::UHUGEINT, list_transform(range(1, length(n_name) + 1), lambda i: ascii(n_name[i])::UHUGEINT)), lambda h, b: (xor(h, b) * 1099511628211) % 18446744073709551616) AS h FROM nation)
SELECT n_name, CASE WHEN h >= 9223372036854775808 THEN (h::HUGEINT - 18446744073709551616)::BIGINT ELSE h::BIGINT END AS fence FROM h""")
def cdc_fence_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number under which a stream of a name locks out a second one."""
    names = [r["n_name"] for r in log.table(spark, sf_dir, "nation").select("n_name").collect()]
    return spark.createDataFrame([(n, retry.fence_key(n)) for n in names], "n_name string, fence bigint")


@_query("""SELECT * FROM (VALUES ('slot', 'cdc_slot'), ('topic', 'events'), ('brokers', 'a:1,b:2'), ('retention', '60.0'), ('kafka.security.protocol', 'SASL_SSL'), ('kafka.sasl.mechanism', 'SCRAM-SHA-256'), ('kafka.acks', 'all'),
 ('startingOffsets', 'earliest'), ('failOnDataLoss', 'true'), ('kafka.max.partition.fetch.bytes', '4194304'), ('url', 'jdbc:postgresql://h:5433/d'), ('user', 'u'), ('sslmode', 'verify-full'), ('sslrootcert', '/ca')) t(name, value)""")
def cdc_connection_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings from the environment as options of readers and writers."""
    env = {"KAFKA_BROKERS": "a:1, b:2,", "KAFKA_TOPIC": " events ", "RETENTION_SECONDS": "60", "KAFKA_TLS_ENABLED": "true", "KAFKA_SASL_USERNAME": "u", "KAFKA_SASL_PASSWORD": "p", "PGSSLROOTCERT": "/ca"}
    s = connect.Settings.load(env)
    jdbc, options = connect.jdbc_options("postgres://u@h:5433/d", env), connect.kafka_read_options(s, env) | connect.kafka_write_options(s, env)
    found = {"slot": s.slot, "topic": s.topic, "brokers": ",".join(s.brokers), "retention": str(s.retention_seconds)} | {k: options[k] for k in ("kafka.security.protocol", "kafka.sasl.mechanism", "kafka.acks", "startingOffsets", "failOnDataLoss", "kafka.max.partition.fetch.bytes")}
    return spark.createDataFrame(list((found | {k: jdbc[k] for k in ("url", "user", "sslmode", "sslrootcert")}).items()), "name string, value string")


@_query("""SELECT * FROM (VALUES ('list', 'list', '', '', FALSE), ('list -table s.t', 'list', 's', 't', FALSE), ('list -schema a -table s.t', 'list', 'a', 's.t', FALSE), ('drop -all', 'drop', '', '', FALSE), ('', NULL, NULL, NULL, TRUE), ('purge', NULL, NULL, NULL, TRUE),
 ('replay', NULL, NULL, NULL, TRUE), ('drop -event x -all', NULL, NULL, NULL, TRUE)) t(args, action, "schema", "table", refused)""")
def cdc_admin_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Command lines and what becomes of them."""
    out = []
    for args in ("list", "list -table s.t", "list -schema a -table s.t", "drop -all", "", "purge", "replay", "drop -event x -all"):
        try:
            c = admin.parse(args.split())
            out.append((args, c.action, c.schema, c.table, False))
        except admin.UsageError:
            out.append((args, None, None, None, True))
    return spark.createDataFrame(out, "args string, action string, `schema` string, `table` string, refused boolean")


@_query("""SELECT * FROM (VALUES ('/healthz', 200, 'ok'), ('/readyz', 503, 'not ready'), ('/nowhere', 404, 'not found'), ('cdc_messages_processed_total{{outcome="applied"}}', 200, '3'), ('cdc_dead_letters_total', 200, '1'), ('cdc_messages_published_total', 200, '7'),
 ('cdc_transactions_acked_total', 200, '2'), ('cdc_pending_events', 200, '4'), ('cdc_errors_total{{component="stream"}}', 200, '1'), ('cdc_lag_seconds', 200, '10'), ('cdc_retention_headroom_seconds', 200, '90'), ('cdc_group_age_seconds', 200, '5'), ('cdc_ready', 200, '0'), ('cdc_batch_size_count', 200, '1')) t(page, status, body)""".replace("{{", "{").replace("}}", "}"))
def cdc_health_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of a process and the figures that its batches fed."""
    m = observe.Metrics()
    m.batch_done({"batch": 0, "version": 1, "applied": 3, "dead letter": 1, "unreadable": 0, "pending": 4, "group_age": 5.0}, 0.2)
    m.publish_done({"batch": 0, "published": 7, "transactions": 2})
    m.failed("stream")
    m.set_lag(10, 100)
    m.set_ready(False)
    pages = [(p, *observe.answer(m, p)) for p in ("/healthz", "/readyz", "/nowhere")]
    wanted = ('cdc_messages_processed_total{outcome="applied"}', "cdc_dead_letters_total", "cdc_messages_published_total", "cdc_transactions_acked_total", "cdc_pending_events", 'cdc_errors_total{component="stream"}', "cdc_lag_seconds", "cdc_retention_headroom_seconds", "cdc_group_age_seconds", "cdc_ready", "cdc_batch_size_count")
    status, text = observe.answer(m, "/metrics")
    found = dict(line.rsplit(" ", 1) for line in text.splitlines() if not line.startswith("#"))
    return spark.createDataFrame([(p, s, b.strip()) for p, s, b in pages] + [(w, status, found[w]) for w in wanted], "page string, status int, body string")


@_query(f"""WITH {{b}}, {_DECODED} SELECT printf('%X/%X:%d', lsn // 4294967296, lsn % 4294967296, sequence) AS id, row_number() OVER (ORDER BY tx, sequence) - 1 AS "offset", operation, 'public.users_v' || (tx // 100) || '|uid=' || key_uid AS key FROM q""")
def cdc_stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a feed of segments, decoded and published in three micro-batches that cut transactions and fall between descriptions."""
    home = shared_dir(spark)
    replication.register(spark)
    m = log.messages(spark, sf_dir).withColumn("pos", F.col("pos") + 100)
    last = m.agg(F.max("pos")).first()[0] or 0
    publisher, low = publish.Publisher(spark, f"{home}/out"), 0
    for high in (last // 3 // 100 * 100 + 5, 2 * last // 3 // 100 * 100 + 8, last):
        replication.write_segments(m.where((F.col("pos") > low) & (F.col("pos") <= high)), f"{home}/feed")
        feed = spark.readStream.format("replication").option("path", f"{home}/feed").option("startLsn", "0/0").load()
        publish.start(feed, publisher, f"{home}/checkpoint", available_now=True).awaitTermination()
        low = high
    header = lambda name: F.filter("headers", lambda h: h["key"] == name)[0]["value"].cast("string")
    return publisher.records().select(header("event_id").alias("id"), "offset", header("operation").alias("operation"), "key")


@_query("""WITH {b}, d AS (SELECT uid, max(pos) FILTER (kind = 'error') AS gone, max(pos) AS last, arg_max(kind, pos) AS last_kind FROM b GROUP BY uid)
SELECT b.uid, arg_max(b.kind, b.pos) AS kind, arg_max(b.cents, b.pos) FILTER (b.kind <> 'click') AS cents, max(b.lsn) AS lsn
FROM b JOIN d ON d.uid = b.uid WHERE b.pos > coalesce(d.gone, -1) AND d.last_kind <> 'error' GROUP BY b.uid""")
def cdc_stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as transport records, applied to the store in two micro-batches, the second with a repetition of the first's end."""
    home = shared_dir(spark)
    store = Store(spark, f"{home}/store", buckets=8)
    store.commit(replace(State.empty(spark), registry=log.registry(spark)))
    e = log.changes(log.base(spark, sf_dir), preserve=True)
    # Sequences of a transaction are dense; each event has a commit position of its own in this log, so each is one transaction.
    one = F.struct(F.col("pos").alias("transaction_id"), "source.commit_lsn", "source.transaction_end_lsn", "source.commit_time", F.lit(1).alias("sequence"), F.lit(1).alias("transaction_event_count"))
    e = e.withColumn("source", one)
    middle = (e.agg(F.max("pos")).first()[0] or 0) // 2
    for part in (e.where(F.col("pos") <= middle), e.where(F.col("pos") > middle - 20)):
        files.write_records(part, f"{home}/records")
        start(files.stream_records(spark, f"{home}/records"), Writer(spark, store), f"{home}/checkpoint", available_now=True).awaitTermination()
    return store.load().rows.select(_cell("uid"), _cell("kind"), _cell("cents"), F.col("lsn").cast("bigint").alias("lsn"))
