"""Events and state for the tests, and the sequential model that the set-based apply is held against."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from walrill.operators import envelope
from walrill.operators.apply import State
from walrill.operators.registry import REGISTRY

AT = datetime(2024, 1, 1)
EVENT = f"{envelope.EVENT}, pos bigint"


def event(pos, id, op, lsn, key=None, after=None, unchanged=(), table="t", schema="public", version=1, txid=1, sequence=1, count=1):
    return (version, id, schema, table, op, key, None, after, (txid, lsn, lsn, AT, sequence, count), list(unchanged), pos)


def events(spark, rows):
    return spark.createDataFrame(rows, EVENT)


def registry(spark, **columns):
    """column=(type, nullable, is_key[, default[, labels]]) of table public.t."""
    rows = [("public", "t", c, i + 1, v[0], v[1], v[3] if len(v) > 3 else None, v[2], v[4] if len(v) > 4 else None) for i, (c, v) in enumerate(columns.items())]
    return spark.createDataFrame(rows, REGISTRY)


def state(spark, **columns):
    return replace(State.empty(spark), registry=registry(spark, **columns))


def rows(df):
    return {r["key"].split("|", 1)[1]: dict(r["cols"]) for r in df.collect()}


class Sequential:
    """One event after the other, as a keyed table with a guard would take them."""

    def __init__(self, base=None, watermark=0):
        self.rows, self.watermark, self.marks = {k: dict(v) for k, v in (base or {}).items()}, watermark, set()

    def apply(self, id, op, key, lsn, after):
        if id in self.marks:
            return
        self.marks.add(id)
        if op == "truncate":
            if self.watermark and lsn <= self.watermark:
                return
            self.rows, self.watermark = {}, lsn
            return
        row = self.rows.get(key)
        if row and row["lsn"] is not None and row["lsn"] > lsn:
            return
        if op == "delete":
            self.rows.pop(key, None)
        else:
            self.rows[key] = {"lsn": lsn, "cols": {**(row["cols"] if row else {}), **after}}
