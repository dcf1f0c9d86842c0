"""Columns that appear at the source, added at the destination."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walrill.functions.rows import has, overlay
from walrill.operators.apply import State
from walrill.operators.registry import REGISTRY

#: Types that are built in or made of them; any other type must be an enum to be created (fixed values).
BUILT_IN = "^(bigint|bigserial|integer|serial|smallint|real|double precision|numeric|text|citext|name|boolean|bytea|date|time|timestamp|timestamptz|interval|uuid|json|jsonb|pg_lsn|inet|cidr|character varying|varchar|character|char|int4range|int8range|numrange|daterange|tsrange|tstzrange)( with(out)? time zone)?(\\([0-9, ]+\\))?(\\[\\])?$"


def missing_columns(events: DataFrame, registry: DataFrame) -> DataFrame:
    """(schema, table, column) that rows of ``events`` carry and known tables lack."""
    used = events.where(F.col("operation").isin("insert", "update")).select("schema", "table", F.explode(F.map_keys("after")).alias("column")).distinct()
    used = used.join(registry.select("schema", "table").distinct(), ["schema", "table"], "left_semi")
    return used.join(registry.select("schema", "table", "column"), ["schema", "table", "column"], "left_anti")


def repair(state: State, source: DataFrame, events: DataFrame) -> tuple[State, DataFrame]:
    """(state with the missing columns, what was done: schema, table, column, action).

    A column takes the source's type, nullability and default; enums come with their labels. Columns that the source lacks and
    types that are neither built in nor enums are refused. Present rows get the default. Nothing that is there is changed, so a
    second repair does nothing."""
    wanted = missing_columns(events, state.registry)
    found = wanted.join(source, ["schema", "table", "column"], "left")
    ok = F.col("enum_labels").isNotNull() | F.col("pg_type").rlike(BUILT_IN)
    action = F.when(F.col("pg_type").isNull(), "refused: not at the source").when(~ok, "refused: type cannot be created").when(F.col("enum_labels").isNotNull(), "added with enum").otherwise("added")
    report = found.select("schema", "table", "column", action.alias("action"))
    last = state.registry.groupBy("schema", "table").agg(F.max("ordinal").alias("last"))
    new = found.where(F.col("pg_type").isNotNull() & ok).join(last, ["schema", "table"]).withColumn("ordinal", F.col("last") + F.col("ordinal")).withColumn("is_key", F.lit(False))
    names = [f.split()[0].strip("`") for f in REGISTRY.split(", ")]
    registry = state.registry.unionByName(new.select(*names))
    defaults = new.where("default_value is not null").groupBy("schema", "table").agg(F.map_from_entries(F.collect_list(F.struct("column", "default_value"))).alias("_defaults"))
    rows = state.rows.join(defaults, ["schema", "table"], "left").withColumn("cols", F.when(F.col("_defaults").isNotNull(), overlay(F.col("_defaults"), F.col("cols"))).otherwise(F.col("cols"))).drop("_defaults")
    return replace(state, registry=registry, rows=rows.select(*state.rows.columns)), report


def enum_labels(labels: DataFrame) -> DataFrame:
    """(type_name, labels) in their sort order, from a row for each label."""
    return labels.groupBy("type_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("sort_order", "label"))), lambda x: x["label"]).alias("labels"))


def enum_refuses(event_row, column: str, labels: list[str]):
    """Whether a row map has a value in ``column`` that is no label."""
    value = F.element_at(event_row, F.lit(column))
    return has(event_row, F.lit(column)) & value.isNotNull() & ~value.isin(labels)
