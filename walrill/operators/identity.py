"""Which columns name a row, by the replica identity of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODES = ("d", "i", "f", "n")


def resolve(tables: DataFrame) -> DataFrame:
    """``tables`` (schema, table, mode, primary_key, index_columns) with ``key_columns`` and, where there are none, ``refusal``.

    Default and full identities use the primary key (a full image is not a key), index identities the index's columns; identity
    nothing, unknown modes and tables without such columns are refused."""
    none = F.array().cast("array<string>")
    key = F.when(F.col("mode").isin("d", "f"), F.coalesce("primary_key", none)).when(F.col("mode") == "i", F.coalesce("index_columns", none)).otherwise(none)
    refusal = F.when(F.col("mode") == "n", "identity nothing").when(~F.coalesce(F.col("mode").isin(*MODES), F.lit(False)), "unknown identity").when(F.size(key) == 0, "no usable key")
    return tables.withColumn("key_columns", key).withColumn("refusal", refusal).withColumn("key_columns", F.when(F.col("refusal").isNull(), F.col("key_columns")))


def discover(published: DataFrame, identities: DataFrame, index_columns: DataFrame) -> DataFrame:
    """:func:`resolve` over catalog tables: published (publication, schema, table), identities (schema, table, mode,
    identity_index) and index_columns (schema, table, index, is_primary, ordinality, column). Columns keep index order."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("ordinality", "column"))), lambda x: x["column"])
    primary = index_columns.where("is_primary").groupBy("schema", "table").agg(ordered.alias("primary_key"))
    by_index = index_columns.groupBy("schema", "table", F.col("index").alias("identity_index")).agg(ordered.alias("index_columns"))
    tables = published.select("schema", "table").distinct().join(identities, ["schema", "table"])
    tables = tables.join(primary, ["schema", "table"], "left").join(by_index, ["schema", "table", "identity_index"], "left")
    return resolve(tables).orderBy("schema", "table")
