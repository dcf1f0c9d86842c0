"""Sharding by histogram sort: exact counts below probe keys are refined until splitters fit, then rows move once.

Keys are (hash of the text, hash of the row), so equal texts stand side by side. A boundary falls between two texts unless
copies of one text outweigh the tolerance; only such a group is cut, and then between two of its rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walrill.llm.common import fresh_name, frugal, materialise

HALF = 1 << 63
#: Fixed bytes that count for each row besides its text.
ROW_BYTES = 16


def _below(probes: list[int], hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """For each key how many of the sorted 128-bit probes are at or below it."""
    p_hi = np.array([p >> 64 for p in probes], np.uint64)
    p_lo = np.array([p & (2**64 - 1) for p in probes], np.uint64)
    first, last = np.searchsorted(p_hi, hi, "left"), np.searchsorted(p_hi, hi, "right")
    out = first.copy()
    for at in np.unique(first[last > first]) if len(p_hi) else ():
        rows = np.flatnonzero((first == at) & (last > first))
        out[rows] = at + np.searchsorted(p_lo[at : last[rows[0]]], lo[rows], "right")
    return out


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ np.uint64(HALF)


def _counter(probes: list[int]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(probes) + 1
        size, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        ends: dict[int, tuple[int, int]] = {}
        for b in batches:
            if not b.num_rows:
                continue
            hi, lo = _unsigned(b.column(0)), _unsigned(b.column(1))
            weight = b.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            bins = _below(probes, hi, lo)
            np.add.at(size, bins, weight)
            np.add.at(rows, bins, 1)
            order = np.lexsort((lo, hi, bins))
            s = bins[order]
            for a, z in zip(np.flatnonzero(np.append(True, s[1:] != s[:-1])), np.flatnonzero(np.append(s[1:] != s[:-1], True)), strict=True):
                x, y = ((int(hi[i]) << 64) | int(lo[i]) for i in (order[a], order[z]))
                old = ends.get(int(s[a]))
                ends[int(s[a])] = (min(x, old[0]), max(y, old[1])) if old else (x, y)
        full = sorted(ends)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(size[full], pa.int64()), pa.array(rows[full], pa.int64()), pa.array([f"{ends[i][0]:032x}" for i in full], pa.string()), pa.array([f"{ends[i][1]:032x}" for i in full], pa.string())], names=["bin", "bytes", "rows", "low", "high"])

    return count


def histogram(keys: DataFrame, probes: list[int]) -> list[tuple[int, int, int, int]]:
    """(bytes, rows, least key, greatest key) of each of the ``len(probes) + 1`` ranges; empty ones have keys (1, 0).

    Each task sends a row for each range that it met, so the driver receives a bounded summary, never keys of rows."""
    out = [(0, 0, 1, 0)] * (len(probes) + 1)
    part = keys.mapInArrow(frugal(_counter(probes)), "bin long, bytes long, rows long, low string, high string")
    for r in part.groupBy("bin").agg(F.sum("bytes").alias("b"), F.sum("rows").alias("n"), F.min("low").alias("l"), F.max("high").alias("h")).collect():
        out[r["bin"]] = (r["b"], r["n"], int(r["l"], 16), int(r["h"], 16))
    return out


def splitters(keys: DataFrame, parts: int, tolerance: float = 0.005, probes_each: int = 12) -> tuple[list[int], list[int]]:
    """Keys that cut ``keys`` (hi, lo, weight) into ``parts`` ranges of near-equal weight, and the rows before each range.

    Every round counts exactly, over all rows, what lies below the probes of all unsettled boundaries."""
    total, rows, low, high = histogram(keys, [])[0]
    if not rows:
        return [], [0]
    slack = tolerance * total / parts
    #: Known cuts: key -> (weight, rows) strictly below it.
    known = {low: (0, 0), high + 1: (total, rows)}
    goal = [total * i / parts for i in range(1, parts)]
    settled: dict[int, int] = {}
    #: Of a gap between two known cuts, the keys that its rows really span.
    span = {(low, high + 1): (low, high)}
    while len(settled) < len(goal):
        cuts = sorted(known)
        weights = [known[c][0] for c in cuts]
        probes: set[int] = set()
        for i, g in enumerate(goal):
            if i in settled:
                continue
            at = max(1, min(bisect_right(weights, g), len(cuts) - 1))
            a, z = cuts[at - 1], cuts[at]
            near = a if g - weights[at - 1] <= weights[at] - g else z
            first, last = span[a, z]
            if abs(known[near][0] - g) <= slack or first >= last:
                settled[i] = near
                continue
            whole = (first >> 64) != (last >> 64)
            lo, hi = (first >> 64, last >> 64) if whole else (first, last)
            step = max(1, (hi - lo) // (probes_each + 1))
            tries = {min(hi, lo + 1 + step * k) for k in range(probes_each)} | {hi}
            if whole:
                mid = lo + int((hi - lo) * (g - weights[at - 1]) / max(1, weights[at] - weights[at - 1]))
                tries |= {max(lo + 1, min(hi, mid + d * max(1, (hi - lo) // 512))) for d in (-1, 0, 1)}
            probes |= {t << 64 if whole else t for t in tries}
        if not (new := sorted(probes - known.keys())):
            continue
        every = sorted({*new, *known} - {low, high + 1})
        found = histogram(keys, every)
        below_w = below_n = 0
        edges = [low, *every, high + 1]
        span = {}
        for (w, n, x, y), a, z in zip(found, edges, edges[1:], strict=False):
            below_w, below_n = below_w + w, below_n + n
            known[z] = (below_w, below_n)
            span[a, z] = (x, y) if n else (a, a)
    keys_at = [settled[i] for i in range(len(goal))]
    for i in range(1, len(keys_at)):
        keys_at[i] = max(keys_at[i], keys_at[i - 1])
    return keys_at, [0, *(known[k][1] for k in keys_at)]


def _placer(cuts: list[int], fields: list[str]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = _below(cuts, _unsigned(b.column(0)), _unsigned(b.column(1))) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part.astype(np.int32))], names=fields)

    return place


def with_shards(docs: DataFrame, n_shards: int = 40, text: str = "text", row_id: str = "doc_id", carry: list[str] | None = None, part_bytes: int = 512 << 20, part_rows: int = 1_000_000) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes of the text plus 16; 16 for null), ``shard`` and ``slot`` (gapless from 0 in each shard).

    Law ``bytes``: shards hold near-equal sums of ``size``. Null ids and texts, empty texts and repeated rows are rows like
    any other; without ``carry`` rows with equal ids and texts are not parted by a boundary. An empty table gives an empty result. New names get underscores in front where ``docs`` already has them.
    ``carry`` names the columns to move with each row (all by default). A shard is dealt out as several ranges of at most about ``part_bytes`` and ``part_rows`` each, so no task holds a shard."""
    kept = docs.columns if carry is None else carry
    size, shard, slot = (fresh_name(docs.select(*kept), n) for n in ("size", "shard", "slot"))
    # Everything that comes along is one struct, so no column of the input meets one of the columns below.
    weight = (F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + ROW_BYTES).alias("weight")
    hi = F.xxhash64(F.lit(1), F.col(text)).alias("hi")
    if carry is None:
        # Rows are read again for the exchange, so their keys come from their contents alone; rows with equal ids and texts tie.
        keyed = docs.select(F.struct(*kept).alias("row"), hi, F.xxhash64(F.lit(2), F.col(row_id)).alias("lo"), weight)
        narrow = materialise(keyed.select("hi", "lo", "weight"))
    else:
        # What little comes along is written with its keys, so even rows that are equal in all get keys of their own.
        lo = F.xxhash64(F.lit(2), F.col(row_id), F.monotonically_increasing_id()).alias("lo")
        keyed = narrow = materialise(docs.select(F.struct(*kept).alias("row"), hi, lo, weight))
    total, rows, _, _ = histogram(narrow.select("hi", "lo", "weight"), [])[0]
    each = max(1, -(-total // (n_shards * part_bytes)), -(-rows // (n_shards * part_rows)))
    cuts, before = splitters(narrow.select("hi", "lo", "weight"), n_shards * each)
    names = ["hi", "lo", "row", "weight", "part"]
    schema = T.StructType([*keyed.select(*names[:4]).schema.fields, T.StructField("part", T.IntegerType())])
    placed = keyed.select(*names[:4]).mapInArrow(frugal(_placer(cuts, names)), schema)
    starts = {}
    for k, n in enumerate(before):
        starts.setdefault(k // each, n)
    base = [n - starts[k // each] for k, n in enumerate(before)]
    spark = docs.sparkSession
    # One small row for each range: a bound of total bytes over part_bytes, checked before it is broadcast.
    offsets = spark.createDataFrame([(k, int(b)) for k, b in enumerate(base)], "range_key int, range_base long")
    if len(base) <= 1_000_000:
        offsets = F.broadcast(offsets)
    ranked = placed.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy("hi", "lo")).cast("long") - 1)
    out = ranked.join(offsets, F.col("part") == F.col("range_key"))
    return out.select("row.*", F.col("weight").alias(size), F.floor(F.col("part") / each).cast("int").alias(shard), (F.col("range_base") + F.col("place")).alias(slot))


def shard_documents(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """The digest of :func:`with_shards` for each row of ``docs`` (doc_id, text): where it goes and what it weighs."""
    narrow = docs.select("doc_id", "text", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    placed = with_shards(narrow, n_shards, carry=["doc_id", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
