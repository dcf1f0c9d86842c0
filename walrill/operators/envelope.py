"""The change event: its type, its JSON form on the transport, its rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walrill.functions.rows import RESERVED, event_key, has, is_identifier

#: The document's version, operations and fields (fixed values).
VERSION = 1
OPERATIONS = ("insert", "update", "delete", "truncate")
SOURCE = "struct<transaction_id:bigint,commit_lsn:string,transaction_end_lsn:string,commit_time:timestamp,sequence:int,transaction_event_count:int>"
EVENT = f"version int, id string, `schema` string, `table` string, operation string, key map<string,string>, before map<string,string>, after map<string,string>, source {SOURCE}, unchanged_columns array<string>"
FIELDS = ("version", "id", "schema", "table", "operation", "key", "before", "after", "source", "unchanged_columns")


def _size(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0))


def invalid_reason() -> Column:
    """Why an event breaks the contract, null if it doesn't; the first rule broken names the reason."""
    op, row_op = F.col("operation"), F.col("operation").isin("insert", "update")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return (
        F.when(F.coalesce(F.col("version"), F.lit(0)) != VERSION, "unsupported version")
        .when(blank("id"), "missing id")
        .when(blank("schema") | blank("table"), "missing schema or table")
        .when(~F.coalesce(op.isin(*OPERATIONS), F.lit(False)), "unsupported operation")
        .when((row_op | (op == "delete")) & (_size(F.col("key")) <= 0), "missing key")
        .when(row_op & (_size(F.col("after")) <= 0), "missing after")
    )


def unappliable_reason() -> Column:
    """Why a valid event can never be applied to a keyed table, whatever the table; null if it can."""
    row_op = F.col("operation").isin("insert", "update")
    key_names, reserved = F.map_keys("key"), F.array(*map(F.lit, RESERVED))
    return (
        F.when(~is_identifier(F.col("schema")) | ~is_identifier(F.col("table")), "bad identifier")
        .when(F.exists(F.concat(F.coalesce(F.map_keys("after"), F.array().cast("array<string>")), F.coalesce(key_names, F.array().cast("array<string>"))), lambda c: ~c.rlike("^[A-Za-z_][A-Za-z0-9_]*$")), "bad column name")
        .when(F.coalesce(F.arrays_overlap(F.map_keys("after"), reserved), F.lit(False)) | F.coalesce(F.arrays_overlap(key_names, reserved), F.lit(False)), "reserved column")
        .when(row_op & F.exists(key_names, lambda k: ~has(F.col("after"), k)), "key column absent from row")
        .when(row_op & F.coalesce(F.arrays_overlap(key_names, F.col("unchanged_columns")), F.lit(False)), "key column marked unchanged")
    )


def with_reason(events: DataFrame, name: str = "reason") -> DataFrame:
    return events.withColumn(name, F.coalesce(invalid_reason(), unappliable_reason()))


def to_records(events: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Transport records beside ``carry``: key, JSON value, headers. Empty before, after and hints are left out, the key never is."""
    skip = lambda c: F.when(_size(F.col(c)) > 0, F.col(c)).alias(c)
    body = F.struct("version", "id", "schema", "table", "operation", "key", skip("before"), skip("after"), "source", skip("unchanged_columns"))
    text = F.to_json(body, {"ignoreNullFields": "true", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    # A null key is part of the document; null values inside rows are kept by the map writer.
    text = F.when(F.col("key").isNull(), F.regexp_replace(text, r"^\{(.*)\}$", r'{$1,"key":null}')).otherwise(text)
    headers = F.array(F.struct(F.lit("event_id").alias("key"), F.col("id").cast("binary").alias("value")), F.struct(F.lit("operation").alias("key"), F.col("operation").cast("binary").alias("value")))
    return events.select(*carry, event_key(F.col("schema"), F.col("table"), F.col("key")).alias("key"), text.alias("value"), headers.alias("headers"))


def read_records(records: DataFrame, carry: tuple[str, ...] = ("offset",)) -> DataFrame:
    """JSON values as events beside ``carry``, parsed once; where one is no JSON object or has no version, ``value`` and ``reason``
    say so and the event's fields are null."""
    parsed = records.select(*carry, F.col("value").cast("string").alias("value"), F.from_json(F.col("value").cast("string"), EVENT).alias("e"))
    bad = F.col("e").isNull() | F.col("e.version").isNull() & F.col("e.id").isNull() & F.col("e.operation").isNull()
    return parsed.select(*carry, *(F.col(f"e.{f}").alias(f) for f in FIELDS), F.when(bad, F.col("value")).alias("value"), F.when(bad, "unreadable JSON").alias("reason"))


def from_records(records: DataFrame, carry: tuple[str, ...] = ("offset",)) -> tuple[DataFrame, DataFrame]:
    """(events, unreadable) of :func:`read_records`."""
    parsed = read_records(records, carry)
    return parsed.where("reason is null").select(*carry, *FIELDS), parsed.where("reason is not null").select(*carry, "value", "reason")
