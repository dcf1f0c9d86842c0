"""Running values over a long ordered log without a task that sees all of it.

A log position is dense, so blocks of positions hold a bounded number of rows. Values run inside blocks in parallel; one row for
each block carries on what came before, and an equi-join on the same keys, which needs no further exchange, brings it back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 500_000


def running(df: DataFrame, order: list[str], values: dict[str, tuple[str, Column]], partition: tuple[str, ...] = (), exclusive: bool = False, block: int = BLOCK) -> DataFrame:
    """``df`` with running values: name -> (``last`` | ``sum`` | ``max``, expression); nulls are passed over.

    ``order`` starts with a long position. ``exclusive`` leaves the row itself out. Sums start at 0, others at null."""
    names = list(values)
    d = df.select("*", F.floor(F.col(order[0]) / block).alias("_block"), *(values[n][1].alias(f"_v_{n}") for n in names))
    keys = [*partition, "_block"]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    place = F.struct(*order)
    local = {"last": lambda n: F.last(f"_v_{n}", ignorenulls=True).over(inside), "sum": lambda n: F.sum(f"_v_{n}").over(inside), "max": lambda n: F.max(f"_v_{n}").over(inside)}
    whole = {"last": lambda n: F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), place)), "sum": lambda n: F.sum(f"_v_{n}"), "max": lambda n: F.max(f"_v_{n}")}
    totals = d.groupBy(*keys).agg(*(whole[values[n][0]](n).alias(f"_t_{n}") for n in names))
    before = Window.partitionBy(*partition).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = {"last": lambda n: F.last(f"_t_{n}", ignorenulls=True).over(before), "sum": lambda n: F.sum(f"_t_{n}").over(before), "max": lambda n: F.max(f"_t_{n}").over(before)}
    carry = totals.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *(carried[values[n][0]](n).alias(f"_c_{n}") for n in names))
    d = d.select("*", *(local[values[n][0]](n).alias(f"_l_{n}") for n in names))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = d.join(carry, on)
    merge = {"last": lambda a, b: F.coalesce(a, b), "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": lambda a, b: F.greatest(a, b)}
    return joined.select(*df.columns, *(merge[values[n][0]](F.col(f"_l_{n}"), F.col(f"_c_{n}")).alias(n) for n in names))


def numbered(df: DataFrame, order: list[str], name: str, partition: tuple[str, ...] = (), block: int = BLOCK) -> DataFrame:
    """``df`` with consecutive numbers from 1 in ``order`` within ``partition``."""
    return running(df, order, {name: ("sum", F.lit(1).cast("long"))}, partition, block=block)
