from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from walrill.functions import lsn, pgtypes, retry, rows
from walrill.sources import connect
from walrill.streaming import observe


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_positions_compare_as_numbers(spark):
    order = lambda t: lsn.lsn_order(F.lit(t))
    assert one(spark, order("0/9") < order("0/10"), order("FFFFFFFF/FFFFFFFF"), order("x"), lsn.lsn_text(order("a/0f"))) == (True, Decimal(2**64 - 1), None, "A/F")


@pytest.mark.parametrize(("event", "mark", "stale"), [("0/1000", "0/0", False), ("0/2000", "0/2000", True), ("0/2999", "0/3000", True), ("0/4000", "0/3000", False)])
def test_truncate_guard(spark, event, mark, stale):
    assert one(spark, lsn.truncate_is_stale(lsn.lsn_order(F.lit(event)), lsn.lsn_order(F.lit(mark)))) == (stale,)


def test_event_key_is_sorted(spark):
    key = F.create_map(*map(F.lit, ("z", "2", "a", "1")))
    assert one(spark, rows.event_key(F.lit("public"), F.lit("users"), key)) == ("public.users|a=1|z=2",)
    assert one(spark, rows.event_key(F.lit("p"), F.lit("t"), F.lit(None).cast(rows.ROW))) == ("p.t",)


def test_rows_equal_with_nulls(spark):
    row = lambda *v: F.create_map(*map(F.lit, v)).cast(rows.ROW)
    assert one(spark, rows.rows_equal(row("a", None, "b", "1"), row("b", "1", "a", None)), rows.rows_equal(row("a", None), row("a", "1"))) == (True, False)


TYPES = [
    ("t", "boolean", True), ("maybe", "boolean", None), ("12", "bigint", 12), ("12x", "integer", None), ("12345.6789", "numeric(12,4)", Decimal("12345.6789")),
    ("\\xdeadbeef", "bytea", bytearray(b"\xde\xad\xbe\xef")), ("deadbeef", "bytea", None), ("{1,2,3}", "integer[]", [1, 2, 3]), ("{1,x}", "integer[]", None),
    ('{a,"b,\\"c",NULL}', "text[]", ["a", 'b,"c', None]), ("{}", "text[]", []), ("a,b", "text[]", None), ('{"a": [1, 2]}', "jsonb", '{"a": [1, 2]}'), ("{", "jsonb", None),
    ("A0EEBC99-9C0B-4EF8-BB6D-6BB9BD380A11", "uuid", "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"), ("0/1F", "pg_lsn", "0/1F"), ("1 day", "interval", "1 day"), ("abc", "varchar(2)", None),
]


@pytest.mark.parametrize(("text", "kind", "value"), TYPES)
def test_typed(spark, text, kind, value):
    got, refused = one(spark, pgtypes.typed(F.lit(text), kind).alias("v"), pgtypes.refuses(F.lit(text), kind))
    assert got == value and refused == (value is None)


def test_ranges_intervals_enums(spark):
    r = one(spark, pgtypes.typed(F.lit("[1,5)"), "int4range"))[0]
    assert (r["lower"], r["upper"], r["lower_inc"], r["upper_inc"]) == ("1", "5", True, False)
    assert one(spark, pgtypes.interval_of(F.lit("1 day 02:03:04.5")), pgtypes.interval_of(F.lit("1 year"))) == (timedelta(days=1, hours=2, minutes=3, seconds=4.5), None)
    assert one(spark, pgtypes.typed(F.lit("ok"), "mood", ["ok"]), pgtypes.typed(F.lit("no"), "mood", ["ok"])) == ("ok", None)
    assert one(spark, rows.enum_literal(F.array(F.lit("it's"))), rows.quoted(F.lit('a"b'))) == ("'it''s'", '"a""b"')


@pytest.mark.parametrize(("produced", "consumed", "lag"), [(10, 4, 6), (10, 10, 0), (10, 11, -1), (-1, 4, -1), (10, -1, -1)])
def test_lag(spark, produced, consumed, lag):
    assert one(spark, observe.lag(F.lit(produced), F.lit(consumed))) == (lag,)


@pytest.mark.parametrize(("committed", "start", "outran"), [(3, 5, True), (5, 5, False), (6, 5, False), (-1, 5, False), (0, 0, False)])
def test_retention(spark, committed, start, outran):
    assert one(spark, observe.retention_outran(F.lit(committed), F.lit(start))) == (outran,)


OFFSETS = [((5, 15, 8), (10, 3, 7, False)), ((5, 15, -1), (10, -1, -1, False)), ((5, 15, None), (10, -1, -1, False)), ((None, 15, 8), (-1, -1, -1, False)), ((5, None, 8), (-1, -1, -1, False)), ((9, 5, 3), (-1, -1, -1, True)), ((5, 15, 3), (10, -2, 12, True)), ((5, 15, 20), (10, 15, -1, False))]


def test_consumer_figures(spark):
    df = spark.createDataFrame([(i, *o) for i, (o, _) in enumerate(OFFSETS)], "i int, start long, end long, committed long")
    got = {r["i"]: (r["produced"], r["consumed"], r["lag"], r["outran"]) for r in observe.consumer_figures(df).collect()}
    assert got == {i: want for i, (_, want) in enumerate(OFFSETS)}
    assert one(spark, *(observe.stalled(F.lit(s), F.lit(b)) for s, b in ((60, 2**26 + 1), (59, 2**40), (60, 2**26)))) == (True, False, False)


def test_metrics_pages():
    m = observe.Metrics()
    m.add("cdc_messages_processed_total", operation="insert")
    m.set_lag(10, 100)
    m.batch_done({"batch": 1, "version": 1, "applied": 3, "dead letter": 1}, 0.02)
    text = observe.answer(m, "/metrics")[1]
    assert 'cdc_messages_processed_total{operation="insert"} 1' in text and "cdc_retention_headroom_seconds 90" in text
    assert 'cdc_batch_size_bucket{le="5"} 1' in text and "cdc_dead_letters_total 1" in text
    assert observe.answer(m, "/readyz")[0] == 503
    m.set_ready(True)
    assert observe.answer(m, "/readyz") == (200, "ready\n") and observe.answer(m, "/healthz")[0] == 200 and len(observe.FAMILIES) == 12


def test_retry():
    b, waits, tries = retry.Backoff(), [], []

    def flaky():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("down")
        return "up"

    assert b.run("connect", flaky, waits.append) == "up" and len(waits) == 2 and 0.08 <= waits[0] <= 0.1
    assert sum(b.plain(k) for k in range(1, 20)) == pytest.approx(31.1)
    with pytest.raises(retry.PermanentError):
        b.run("apply", lambda: (_ for _ in ()).throw(retry.PermanentError("bad")), waits.append)
    with pytest.raises(RuntimeError, match="apply: no"):
        retry.Backoff(attempts=2).run("apply", lambda: (_ for _ in ()).throw(OSError("no")), waits.append)
    wrapped = RuntimeError("x")
    wrapped.__cause__ = retry.PermanentError("y")
    assert retry.is_permanent(wrapped) and not retry.is_permanent(OSError())
    assert retry.fence_key("") == 0xCBF29CE484222325 - 2**64 and retry.fence_key("a") != retry.fence_key("b")


def test_settings_and_options():
    s = connect.Settings.load({"KAFKA_BROKERS": " a:1, ,b:2 ", "PG_REPLICATION_SLOT": "  ", "RETENTION_SECONDS": "nonsense"})
    assert s.brokers == ("a:1", "b:2") and s.slot == "cdc_slot" and s.retention_seconds == 604_800
    o = connect.kafka_read_options(s, {"KAFKA_TLS_ENABLED": "true", "KAFKA_SASL_USERNAME": "u", "KAFKA_SASL_PASSWORD": 'p"', "KAFKA_SASL_MECHANISM": "SCRAM-SHA-512"})
    assert o["kafka.security.protocol"] == "SASL_SSL" and o["kafka.sasl.mechanism"] == "SCRAM-SHA-512" and o["startingOffsets"] == "earliest" and '\\"' in o["kafka.sasl.jaas.config"]
    assert connect.kafka_write_options(s, {})["kafka.acks"] == "all" and connect.kafka_options(s, {})["kafka.security.protocol"] == "PLAINTEXT"
    j = connect.jdbc_options("postgres://u:p%40@h:5433/d?sslmode=disable", {})
    assert j["url"] == "jdbc:postgresql://h:5433/d" and j["password"] == "p@" and j["sslmode"] == "disable"
    assert connect.jdbc_options("postgres://h/d", {"PGSSLROOTCERT": "/c"})["sslmode"] == "verify-full"
