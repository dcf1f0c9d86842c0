"""Source transactions put back together from their events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walrill.operators.ordered import running

TXN = ("transaction_id", "commit_lsn")


def transactions(events: DataFrame) -> DataFrame:
    """One row for each (transaction_id, commit_lsn): how many different sequences arrived, of how many, and whether that is all.

    A prefix that was delivered twice counts once, so a restarted sender does no harm. Counts combine before the exchange."""
    return (
        events.groupBy(*TXN)
        .agg(F.count_distinct("sequence").alias("events"), F.max("transaction_event_count").alias("expected"), F.min("sequence").alias("first_sequence"), F.max("sequence").alias("last_sequence"))
        .withColumn("complete", (F.col("events") == F.col("expected")) & (F.col("first_sequence") == 1) & (F.col("last_sequence") == F.col("expected")))
    )


def split_complete(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events of complete transactions, events to hold until the rest arrives), for envelope events or flat ones."""
    flat = events if TXN[0] in events.columns else events.withColumns({c: F.col(f"source.{c}") for c in (*TXN, "sequence", "transaction_event_count")})
    whole = transactions(flat).where("complete").select(*TXN)
    return tuple(flat.join(whole, list(TXN), kind).select(*events.columns) for kind in ("left_semi", "left_anti"))


def sequence_faults(events: DataFrame) -> DataFrame:
    """Where, in order of arrival (``pos``), a transaction does not open at 1 or does not go on by one; repeats of a sequence
    that has been seen are deliveries again, not faults."""
    seen = Window.partitionBy(*TXN, "sequence").orderBy("pos")
    first = events.withColumn("_n", F.row_number().over(seen)).where("_n = 1").drop("_n")
    found = running(first, ["pos"], {"previous": ("last", F.col("sequence"))}, TXN, exclusive=True)
    fault = F.when(F.col("previous").isNull() & (F.col("sequence") != 1), "opens after 1").when(F.col("sequence") != F.col("previous") + 1, "gap")
    return found.withColumn("fault", fault).where("fault is not null")
