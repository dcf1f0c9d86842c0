"""Records and messages in folders of JSON lines: the transport without a broker, and the spool of decoded messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walrill.operators.decode import MESSAGE
from walrill.operators.envelope import to_records

RECORD = "offset bigint, key string, value string"


def write_records(events: DataFrame, path: str, first_offset: int = 0) -> None:
    """Appends events (with ``pos``) as records; offsets follow ``pos``."""
    keyed = events.withColumn("offset", F.col("pos") + F.lit(first_offset))
    to_records(keyed, ("offset",)).select("offset", "key", "value").write.mode("append").json(path)


def stream_records(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Records as they arrive; ``files_per_batch`` bounds a micro-batch."""
    reader = spark.readStream.schema(RECORD)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECORD).json(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE).json(path)


def stream_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(MESSAGE).json(path)
