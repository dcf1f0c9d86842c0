"""A corpus pipeline of five stages; each takes the documents that its predecessor kept and works on all of them.

Any column may hold nulls, rows may repeat and share ids, texts may be empty or very long, and ``documents`` may have further
columns, whatever their names; each stage says what it does with such rows. An empty table stays empty through all stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from walrill.llm import decontam, mixing, neardup, sharding, toxicity
from walrill.llm.common import materialise, table


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go; the columns stay as they are.

    The score is of the text alone, so equal texts go or stay together, whatever their ids. Null and empty texts have the score of
    a text without evidence. Labels are joined by id; rows without an id teach nothing and are scored like any other."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (a similarity of 0.8 or more) stays, the one with the least id.

    A null id comes after all others; of rows with the same id and text one stays. Texts without words (null, empty, blank) are
    in no group, so all of their rows stay. Of rows that share an id, each stands for its own text."""
    return neardup.one_of_each(docs, percent=80)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go, all of their repeated rows too.

    Null and empty texts contain nothing and stay, null and empty items are contained in nothing. A text of fewer than five words
    goes only if it is an item as a whole."""
    return decontam.without_items(docs, table(spark, sf_dir, "benchmark"))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as often as the mix takes it: not at all, once or twice.

    A null source is a source of its own, the last. Documents without words weigh nothing and are taken at their source's rate.
    Rows that repeat, or tie in size and hash, are counted each for itself; the same rows give the same mix."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their size in bytes, shard and slot, under names with underscores in front where these are taken.

    Null and empty texts have a size of 16. Copies of a text stand side by side, in one shard unless they outweigh the tolerance;
    rows that are equal in all keep different slots. Slots are gapless from 0 in each shard."""
    return sharding.with_shards(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_filter),
    ("near_duplicates", near_duplicate_filter),
    ("decontamination", benchmark_filter),
    ("mixing", source_mixture),
    ("sharding", shards),
]

#: Sketches, a trained model and histogram splitters are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each one's rows written to the shared folder for the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
