"""The registry of tables: a row for each column with its destination type, and what a table's types refuse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walrill.functions.pgtypes import refuses, typed
from walrill.functions.rows import has

REGISTRY = "`schema` string, `table` string, column string, ordinal int, pg_type string, nullable boolean, default_value string, is_key boolean, enum_labels array<string>"


def tables(registry: DataFrame) -> DataFrame:
    return registry.select("schema", "table").distinct().orderBy("schema", "table")


def columns(registry: DataFrame, schema: str, table: str) -> list:
    """A table's columns in order."""
    return registry.where((F.col("schema") == schema) & (F.col("table") == table)).orderBy("ordinal").collect()


def key_columns(registry: DataFrame) -> DataFrame:
    ordered = F.transform(F.array_sort(F.collect_list(F.when(F.col("is_key"), F.struct("ordinal", "column")))), lambda x: x["column"])
    return registry.groupBy("schema", "table").agg(ordered.alias("key_columns"))


def present(registry: DataFrame, wanted: DataFrame) -> DataFrame:
    """Those of ``wanted`` (schema, table, column) that the registry has."""
    return wanted.join(registry.select("schema", "table", "column"), ["schema", "table", "column"], "left_semi")


def _refused(registry: DataFrame, value: Column, pg_type: Column, labels: Column) -> Column:
    """Whether ``value`` is refused by its type; a branch for each type that occurs, which are few."""
    kinds = [r["pg_type"] for r in registry.where("enum_labels is null").select("pg_type").distinct().collect()]
    out = F.when(labels.isNotNull(), value.isNotNull() & ~F.coalesce(F.array_contains(labels, value), F.lit(False)))
    for kind in sorted(kinds):
        out = out.when(pg_type == kind, refuses(value, kind))
    return out.otherwise(False)


def poison(events: DataFrame, registry: DataFrame) -> DataFrame:
    """(id, reason) of events that the destination's tables refuse, the first reason of each by column.

    Unknown tables and columns, values that a type can't take, null or missing values of required columns. An event that keeps
    unchanged columns is not refused for those here: they matter only if its row is absent, see ``apply``. Each event is judged
    where it is, beside its table's description; a table's columns are one row, and the planner broadcasts these by size."""
    described = F.struct("ordinal", "column", "pg_type", "nullable", F.col("default_value").isNotNull().alias("filled"), "enum_labels")
    known = registry.groupBy(F.col("schema").alias("r_schema"), F.col("table").alias("r_table")).agg(F.collect_list(described).alias("known"))
    upsert = F.col("operation").isin("insert", "update")
    row = F.when(upsert, F.col("after")).when(F.col("operation") == "delete", F.col("key_row"))
    d = events.join(known, (F.col("schema") == F.col("r_schema")) & (F.col("table") == F.col("r_table")), "left").select("id", "known", upsert.alias("upsert"), row.alias("row"), F.coalesce("unchanged_columns", F.array().cast("array<string>")).alias("open"))

    def judged(c: Column) -> Column:
        there, value = has(F.col("row"), c["column"]), F.element_at("row", c["column"])
        what = (
            F.when(there & value.isNull() & ~c["nullable"], "null in a required column ").when(there & _refused(registry, value, c["pg_type"], c["enum_labels"]), "value refused by type ")
            .when(F.col("upsert") & ~there & ~c["nullable"] & ~c["filled"] & ~F.array_contains("open", c["column"]), "required column missing ")
        )
        return F.struct(c["ordinal"].alias("ordinal"), F.concat(what, c["column"]).alias("reason"))

    strange = F.array_except(F.map_keys("row"), F.transform("known", lambda c: c["column"]))
    strange = F.transform(strange, lambda c: F.struct(F.lit(1_000_000).alias("ordinal"), F.concat(F.lit("undefined column "), c).alias("reason")))
    faults = F.filter(F.concat(F.transform("known", judged), strange), lambda f: f["reason"].isNotNull())
    first = F.when(F.col("known").isNull(), "undefined table").when(F.col("row").isNotNull(), F.array_min(faults)["reason"])
    return d.select("id", first.alias("reason")).where("reason is not null")


def typed_table(rows: DataFrame, registry: DataFrame, schema: str, table: str) -> DataFrame:
    """The rows of one table as typed columns, defaults for absent ones, with source_lsn, source_commit_time and replicated_at."""
    from walrill.functions.lsn import lsn_text

    cells = []
    for c in columns(registry, schema, table):
        value = F.when(has(F.col("cols"), F.lit(c["column"])), F.element_at("cols", F.lit(c["column"]))).otherwise(F.lit(c["default_value"]))
        cells.append(typed(value, c["pg_type"], c["enum_labels"]).alias(c["column"]))
    own = rows.where((F.col("schema") == schema) & (F.col("table") == table))
    return own.select(*cells, lsn_text(F.col("lsn")).alias("source_lsn"), F.col("commit_time").alias("source_commit_time"), "replicated_at")
