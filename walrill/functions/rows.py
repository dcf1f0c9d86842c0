"""Rows as maps of nullable text: a column may be absent, null or a value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IDENTIFIER = "^[A-Za-z_][A-Za-z0-9_]*$"
#: Columns that the engine itself writes beside each row (fixed values).
RESERVED = ("source_lsn", "source_commit_time", "replicated_at")
ROW = "map<string,string>"


def is_identifier(name: Column) -> Column:
    return F.coalesce(name.rlike(IDENTIFIER), F.lit(False))


def quoted(name: Column) -> Column:
    """A name in double quotes, those inside doubled."""
    return F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))


def enum_literal(labels: Column) -> Column:
    """Labels as a list of quoted literals, quotes inside doubled."""
    return F.array_join(F.transform(labels, lambda x: F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("''")), F.lit("'"))), ", ")


def cast_suffix(pg_type: Column) -> Column:
    return F.when(F.coalesce(pg_type, F.lit("")) == "", "").otherwise(F.concat(F.lit("::"), pg_type))


def event_key(schema: Column, table: Column, key: Column) -> Column:
    """The grouping key ``schema.table|a=1|z=2``: columns in order, NULL for null, nothing escaped."""
    parts = F.transform(F.array_sort(F.map_keys(key)), lambda k: F.concat(F.lit("|"), k, F.lit("="), F.coalesce(F.element_at(key, k), F.lit("NULL"))))
    return F.concat(schema, F.lit("."), table, F.coalesce(F.array_join(parts, ""), F.lit("")))


def row_entries(row: Column) -> Column:
    """A row as sorted pairs, which compare and order as maps don't."""
    return F.array_sort(F.map_entries(row))


def rows_equal(a: Column, b: Column) -> Column:
    """Same columns, same values; null equals null."""
    return row_entries(a).eqNullSafe(row_entries(b))


def has(row: Column, name: Column) -> Column:
    return F.coalesce(F.array_contains(F.map_keys(row), name), F.lit(False))


def overlay(below: Column, above: Column) -> Column:
    """Columns of ``above``, and those of ``below`` that it lacks."""
    return F.map_concat(F.map_filter(below, lambda k, _: ~F.array_contains(F.map_keys(above), k)), above)


def columns_of(row: Column) -> Column:
    return F.array_sort(F.map_keys(row))


def empty_row() -> Column:
    return F.create_map().cast(ROW)
