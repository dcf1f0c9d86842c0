"""Typing of wire text by the destination's column types. Text that a type refuses gives null, never an error."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
#: Destination type to Spark type, where a cast of the text is all it takes (fixed values).
CASTS = {
    "bigint": "bigint", "bigserial": "bigint", "integer": "int", "serial": "int", "smallint": "smallint", "real": "float", "double precision": "double",
    "numeric": "decimal(38,18)", "date": "date", "timestamp without time zone": "timestamp_ntz", "timestamp with time zone": "timestamp", "timestamptz": "timestamp",
}
_TEXTS = ("text", "character varying", "varchar", "character", "char", "name", "citext")


def spark_type(pg_type: str) -> str:
    """The Spark type of a destination type; types without one stay text."""
    kind = pg_type.strip().lower()
    if kind.endswith("[]"):
        return f"array<{spark_type(kind[:-2])}>"
    if m := re.fullmatch(r"numeric\((\d+),\s*(\d+)\)", kind):
        return f"decimal({min(int(m[1]), 38)},{m[2]})"
    if kind in ("int4range", "int8range", "numrange", "daterange", "tsrange", "tstzrange"):
        return "struct<lower:string,upper:string,lower_inc:boolean,upper_inc:boolean>"
    return {"boolean": "boolean", "bytea": "binary"}.get(kind, CASTS.get(kind, "string"))


def array_elements(text: Column) -> Column:
    """Elements of ``{a,"b,c",NULL}``; null unless it is a list of one dimension."""
    parts = F.regexp_extract_all(F.substring(text, F.lit(2), F.length(text) - 2), F.lit(r'("(?:[^"\\]|\\.)*+"|[^,"{}]+)'), F.lit(1))
    plain = lambda x: F.when(F.upper(x) != "NULL", x)
    quoted = lambda x: F.regexp_replace(F.substring(x, F.lit(2), F.length(x) - 2), r"\\(.)", "$1")
    whole = text.rlike(r'^\{(?:(?:"(?:[^"\\]|\\.)*+"|[^,"{}\s][^,"{}]*+)(?:,(?:"(?:[^"\\]|\\.)*+"|[^,"{}\s][^,"{}]*+))*+)?\}$')
    return F.when(whole, F.transform(parts, lambda x: F.when(x.startswith('"'), quoted(x)).otherwise(plain(x))))


def range_parts(text: Column) -> Column:
    pattern = r"^([\[(])([^,]*),([^,]*)([\])])$"
    part = lambda i: F.regexp_extract(text, pattern, i)
    bound = lambda x: F.when(x != "", F.regexp_replace(x, '^"|"$', ""))
    return F.when(text.rlike(pattern), F.struct(bound(part(2)).alias("lower"), bound(part(3)).alias("upper"), (part(1) == "[").alias("lower_inc"), (part(4) == "]").alias("upper_inc")))


def interval_of(text: Column) -> Column:
    """Day-time interval of canonical text such as ``1 day 02:03:04.5``; null with years or months, which have no fixed length."""
    days = F.regexp_extract(text, r"(-?\d+) days?", 1)
    clock = r"(-?)(\d+):(\d\d):(\d\d(?:\.\d+)?)$"
    sign = F.when(F.regexp_extract(text, clock, 1) == "-", -1).otherwise(1)
    part = lambda i: F.coalesce(F.expr("0") + F.regexp_extract(text, clock, i).try_cast("decimal(18,6)"), F.lit(0))
    ok = text.rlike(r"^(?:-?\d+ days?)?(?:(?:^| )-?\d+:\d\d:\d\d(?:\.\d+)?)?$") & (text != "")
    return F.when(ok, F.make_dt_interval(F.coalesce(days.try_cast("int"), F.lit(0)), (sign * part(2)).cast("int"), (sign * part(3)).cast("int"), sign * part(4)))


def typed(value: Column, pg_type: str, labels: list[str] | None = None) -> Column:
    """``value`` as its destination type; ``labels`` are those of an enum."""
    kind = pg_type.strip().lower()
    if labels is not None:
        return F.when(value.isin(labels), value)
    if kind.endswith("[]"):
        items = array_elements(value)
        made = F.transform(items, lambda x: typed(x, kind[:-2]))
        bad = F.exists(items, lambda x: x.isNotNull() & typed(x, kind[:-2]).isNull())
        return F.when(~bad, made)
    if kind == "boolean":
        return F.when(F.lower(F.trim(value)).isin("t", "true", "y", "yes", "on", "1"), True).when(F.lower(F.trim(value)).isin("f", "false", "n", "no", "off", "0"), False)
    if kind == "bytea":
        return F.when(value.startswith("\\x"), F.try_to_binary(F.substring(value, F.lit(3), F.length(value)), F.lit("hex")))
    if kind in ("json", "jsonb"):
        return F.when(F.try_parse_json(value).isNotNull(), value)
    if kind == "uuid":
        return F.when(value.rlike(_UUID), F.lower(value))
    if spark_type(kind).startswith("struct"):
        return range_parts(value)
    if kind == "pg_lsn":
        return F.when(value.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"), value)
    if m := re.fullmatch(r"(?:character varying|varchar|character|char)\((\d+)\)", kind):
        return F.when(F.length(value) <= int(m[1]), value)
    if spark_type(kind) == "string" or kind in _TEXTS:
        return value
    return value.try_cast(spark_type(kind))


def refuses(value: Column, pg_type: str, labels: list[str] | None = None) -> Column:
    """Whether the type can't take a value that is there."""
    return value.isNotNull() & typed(value, pg_type, labels).isNull()
