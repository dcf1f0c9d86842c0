"""Approximate nearest neighbours: a neighbour graph by NN-descent, then greedy search in it.

Nodes are distinct vectors. A first graph comes from the exact neighbours inside the leaves of a few random projection trees.
Their upper levels are fitted on a bounded sample; leaves that hold too many nodes are split on by passes over all nodes, each
of which adds up to four levels with middles from about a thousand nodes of every leaf, until all leaves are small, however
many nodes there are. One more tree deals nodes out by hash, so that every node has neighbours to begin with. Every round of
NN-descent then joins each node with the vectors of its neighbours and of the nodes that have it as neighbour, compares these
with each other, and keeps what is nearer than a node's present neighbours: the neighbours of neighbours are likely
neighbours. A node with very many others pointing at it is dealt out in parts that each hold its own neighbours, so no group
grows with the data and none of its links is left out. Rounds go on until few neighbours are new, and a search until its
candidates hold nothing unexplored; neither is cut off by a count. ``exact_search`` compares all with all queries instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walrill.llm.common import discard, materialise, mix

#: Neighbours of a node in the graph, trees of the first graph, vectors that a tree's upper levels are fitted on at most.
DEGREE, TREES, SAMPLE = 32, 8, 50_000
#: Nodes that a leaf is meant to hold; one with more than twice as many is split.
LEAF = 2_048
#: Levels that one pass adds to a leaf at most, and the nodes of it that middles are taken from, about.
LEVELS, MIDDLES_FROM = 4, 1_000
#: Neighbours that a leaf gives each of its nodes for the first graph.
LEAF_DEGREE = 16
#: Rounds of NN-descent end once at most this share of all neighbours is new.
STILL = 0.02
#: Candidates that a query holds during greedy search.
BEAM = 96
#: Queries and nodes that meet in one group of the exact search, about.
BLOCK_QUERIES, BLOCK_NODES = 2_000, 20_000

_EDGE = "a long, b long, score double"


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, unit vector (doubles) of the rows that take part: no null, no zero, only finite components."""
    for b in batches:
        ids, vectors = b.column(0).to_pylist(), b.column(1).to_pylist()
        out = []
        for i, v in zip(ids, vectors, strict=True):
            if i is None or not v or any(x is None for x in v):
                continue
            x = np.array(v, np.float64)
            if not np.isfinite(x).all():
                continue
            # Scaled first, so that neither very small nor very large components overflow.
            top = np.abs(x).max()
            if top > 0:
                x = x / top
                out.append((i, x / np.sqrt(x @ x)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()), pa.array([x.tobytes() for _, x in out], pa.binary())], names=["vec_id", "unit"])


def _small(column: pa.Array) -> pa.Array:
    """Unit vectors as 8-bit integers: the graph is built and kept on these, answers are scored on the doubles."""
    x = _matrix(column)
    q = np.rint(x * (127 / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300))).astype(np.int8) if len(x) else x.astype(np.int8)
    return pa.array([r.tobytes() for r in q], pa.binary())


def _coarse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), _small(b.column(1))], names=["node", "unit"])


def _rough(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """8-bit vectors as unit vectors of floats."""
    rows = column.to_pylist()
    x = np.frombuffer(b"".join(rows), np.int8).reshape(len(rows), -1).astype(np.float32) if rows else np.zeros((0, 0), np.float32)
    return x / np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x))[:, None], 1e-30)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1) if rows else np.zeros((0, 0))


class Tree:
    """A random projection tree in arrays: a direction and a middle value for each inner node, level by level."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int):
        rng = np.random.default_rng(seed)
        n, dim = sample.shape
        self.depth = depth
        self.directions = np.zeros(((1 << depth) - 1, dim))
        self.middles = np.zeros((1 << depth) - 1)
        leaf = np.zeros(n, np.int64)
        for level in range(depth):
            for k in range(1 << level):
                own = sample[leaf == k]
                d = own[rng.integers(len(own))] - own[rng.integers(len(own))] if len(own) > 1 else rng.normal(size=dim)
                self.directions[(1 << level) - 1 + k] = d
                self.middles[(1 << level) - 1 + k] = np.median(own @ d) if len(own) else 0.0
            leaf = self._down(sample, leaf, level)

    def _down(self, x: np.ndarray, leaf: np.ndarray, level: int) -> np.ndarray:
        at = (1 << level) - 1 + leaf
        return 2 * leaf + (np.einsum("ij,ij->i", x, self.directions[at]) > self.middles[at])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(x), np.int64)
        for level in range(self.depth):
            leaf = self._down(x, leaf, level)
        return leaf


def _leaf_rows(trees: list[Tree], buckets: int):
    names = ["tree", "leaf", "node", "unit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _rough(b.column(1))
            for t, tree in enumerate(trees):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(tree.leaves(x)), b.column(0), b.column(1)], names=names)
            if buckets > 1:
                by_hash = (mix(b.column(0).to_numpy().view(np.uint64)) >> np.uint64(11)) % np.uint64(buckets)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), len(trees), np.int32)), pa.array(by_hash.astype(np.int64)), b.column(0), b.column(1)], names=names)

    return run


def _directions(seed: int, dim: int) -> np.ndarray:
    """A direction for each tree (and the hashed one) and level of a pass; the same in every process."""
    return np.random.default_rng(1_000_003 * (seed + 1)).normal(size=(TREES + 1, LEVELS, dim)).astype(np.float32)


def _along(x: np.ndarray, direction: np.ndarray) -> np.ndarray:
    """Row by row and rounded, so that equal vectors have equal values whatever batch they are in."""
    return np.round(np.einsum("ij,j->i", x.astype(np.float64), direction.astype(np.float64)), 5)


def _bits(x: np.ndarray, node: np.ndarray, directions: np.ndarray, middles: np.ndarray, salt: int) -> np.ndarray:
    """Place of each vector among the leaves below one leaf; what lies on a middle goes to a side by the hash of its node."""
    place = np.zeros(len(x), np.int64)
    for level in range(int(np.log2(middles.shape[1] + 1))):
        value, middle = _along(x, directions[level]), middles[np.arange(len(x)), (1 << level) - 1 + place]
        side = (mix(node.view(np.uint64) + np.uint64(salt + level)) >> np.uint64(40)) & np.uint64(1) == 1
        place = 2 * place + ((value > middle) | (value == middle) & side)
    return place


def _middles(seed: int, leaf: int):
    def run(group: pa.Table) -> pa.Table:
        x, node, tree = _rough(group.column("unit")), group.column("node").to_numpy(), group.column("tree")[0].as_py()
        depth = min(LEVELS, max(1, int(np.ceil(np.log2(group.column("n")[0].as_py() / leaf)))))
        directions = _directions(seed, x.shape[1])[tree]
        middles = np.zeros((1, (1 << depth) - 1))
        for level in range(depth):
            place = _bits(x, node, directions, np.repeat(middles[:, : (1 << level) - 1], len(x), axis=0), 64 * seed)
            value = _along(x, directions[level])
            for k in range(1 << level):
                own = value[place == k]
                middles[0, (1 << level) - 1 + k] = np.median(own) if len(own) else 0.0
        return pa.table({"tree": group.column("tree")[:1], "leaf": group.column("leaf")[:1], "middles": pa.array([middles.tobytes()], pa.binary())})

    return run


def _lower(seed: int):
    """Rows one pass further down: their leaf's number with LEVELS more bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, node, tree = _rough(b.column(3)), b.column(2).to_numpy(), b.column(0).to_numpy()
            middles, place = b.column(4).to_pylist(), np.zeros(b.num_rows, np.int64)
            directions = _directions(seed, x.shape[1])
            sizes = np.array([len(m) // 8 if m else 0 for m in middles])
            for t, n in {(int(t), int(n)) for t, n in zip(tree, sizes, strict=True) if n}:
                own = np.flatnonzero((tree == t) & (sizes == n))
                m = np.frombuffer(b"".join(middles[i] for i in own), np.float64).reshape(len(own), n)
                place[own] = _bits(x[own], node[own], directions[t], m, 64 * seed)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array((b.column(1).to_numpy() << LEVELS) + place), b.column(2), b.column(3)], names=["tree", "leaf", "node", "unit"])

    return run


def _placed(units: DataFrame, trees: list[Tree], buckets: int, leaf: int) -> DataFrame:
    """(tree, leaf, node, unit) of every node in every tree; no leaf has more than twice ``leaf`` nodes.

    Every pass cuts a leaf that is too large in two at least, at a middle that its own nodes give, and what is equal in the
    direction by hash, so the passes grow with the logarithm of the nodes and end for any data."""
    schema = "tree int, leaf long, node long, unit binary"
    rows, seed = materialise(units.mapInArrow(_leaf_rows(trees, buckets), schema)), 0
    while True:
        large = materialise(rows.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * leaf))
        if large.isEmpty():
            return rows
        seed += 1
        some = rows.join(large, ["tree", "leaf"]).where(F.pmod(F.xxhash64("node", F.lit(seed)), F.col("n")) < MIDDLES_FROM)
        middles = materialise(some.groupBy("tree", "leaf").applyInArrow(_middles(seed, leaf), "tree int, leaf long, middles binary"))
        lower = materialise(rows.join(middles, ["tree", "leaf"], "left").select("tree", "leaf", "node", "unit", "middles").mapInArrow(_lower(seed), schema))
        for old in (rows, large, middles):
            discard(old)
        rows = lower


def _best(a: np.ndarray, b: np.ndarray, s: np.ndarray, k: int) -> pa.Table:
    """The k best rows for each a, nearest first, ties to the smaller b."""
    order = np.lexsort((b, -s, a))
    a, b, s = a[order], b[order], s[order]
    first = np.maximum.accumulate(np.where(np.append(True, a[1:] != a[:-1]), np.arange(len(a)), 0)) if len(a) else a
    keep = np.arange(len(a)) - first < k
    return pa.table({"a": a[keep], "b": b[keep], "score": s[keep].astype(np.float64)})


def _exact_inside(k: int, most: int = 2_000):
    def run(group: pa.Table) -> pa.Table:
        node, x = group.column("node").to_numpy(), _rough(group.column("unit"))
        rows = []
        # Groups are near LEAF by construction; a larger one is compared in blocks of bounded size.
        for low in range(0, len(x), most):
            s = x[low : low + most] @ x.T
            s[np.arange(len(s)), low + np.arange(len(s))] = -np.inf
            m = min(k, len(x) - 1)
            if m > 0:
                top = np.argpartition(-s, m - 1, axis=1)[:, :m]
                rows.append(_best(np.repeat(node[low : low + most], m), node[top.ravel()], np.take_along_axis(s, top, axis=1).ravel(), k))
        return pa.concat_tables(rows) if rows else pa.table({"a": node[:0], "b": node[:0], "score": np.zeros(0)})

    return run


def _top(edges: DataFrame, k: int) -> DataFrame:
    """The k best distinct neighbours of each a. A node's rows are a few multiples of k, from groups of bounded size."""
    rank = Window.partitionBy("a").orderBy(F.desc("score"), "b")
    once = edges.groupBy("a", "b").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).drop("rank")


def _compared(k: int):
    """One group: a node's neighbours and some that point at it, with vectors and their present k-th score; what is better."""

    def run(group: pa.Table) -> pa.Table:
        node, at = np.unique(group.column("node").to_numpy(), return_index=True)
        fresh = group.column("fresh").to_numpy(zero_copy_only=False)
        new = np.zeros(len(node), bool)
        new[np.searchsorted(node, group.column("node").to_numpy()[fresh])] = True
        x, worst = _rough(group.column("unit").take(pa.array(at))), group.column("worst").to_numpy()[at]
        s = x @ x.T
        np.fill_diagonal(s, -np.inf)
        # Pairs of which neither end is new here have met before.
        a, b = np.nonzero((s > worst[:, None]) & (new[:, None] | new[None, :]))
        return _best(node[a], node[b], s[a, b], k)

    return run


def _descend(edges: DataFrame, units: DataFrame, k: int) -> DataFrame:
    """Better neighbours by one round over the graph (a, b, score, fresh)."""
    worst = edges.groupBy("a").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(-2.0)).alias("worst"))
    parts = edges.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / (2 * k)).alias("parts")).withColumnRenamed("b", "hub")
    back = edges.join(parts, F.col("b") == F.col("hub")).select(F.col("b").alias("hub"), F.pmod(F.xxhash64("a"), F.col("parts")).alias("part"), F.col("a").alias("node"), "fresh")
    sizes = parts.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    ahead = edges.join(sizes, F.col("a") == F.col("hub")).select("hub", "part", F.col("b").alias("node"), "fresh")
    alone = edges.join(parts, F.col("a") == F.col("hub"), "left_anti").select(F.col("a").alias("hub"), F.lit(0).cast("long").alias("part"), F.col("b").alias("node"), "fresh")
    members = back.unionByName(ahead).unionByName(alone).join(units, "node").join(worst, F.col("node") == F.col("a")).select("hub", "part", "node", "fresh", "unit", "worst")
    return members.groupBy("hub", "part").applyInArrow(_compared(k), _EDGE)


def build_graph(units: DataFrame, k: int = DEGREE, rounds: int | None = None, sample_rows: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """(a, b, score): about the k nearest others of each node of ``units`` (node, unit).

    ``rounds`` stops NN-descent early; without it rounds end by STILL alone. Every round that finds a neighbour raises the sum
    of all scores, so they do end."""
    spark = units.sparkSession
    units = materialise(units.select("node", "unit").mapInArrow(_coarse, "node long, unit binary"))
    n = units.count()
    depth = max(0, int(np.ceil(np.log2(max(1, n) / leaf))))
    sample = _rough(pa.array([bytes(r["unit"]) for r in units.orderBy(F.xxhash64("node"), "node").limit(sample_rows).select("unit").collect()], pa.binary()))
    # The upper levels stop where the sample can't carry them; passes over all nodes add the rest.
    trees = [Tree(sample, min(depth, max(0, int(np.log2(max(1, len(sample)) / 16)))), seed) for seed in range(TREES)] if n else []
    leaves = _placed(units, trees, -(-n // leaf), leaf)
    first = leaves.groupBy("tree", "leaf").applyInArrow(_exact_inside(min(k, LEAF_DEGREE)), _EDGE)
    graph = materialise(_top(first, k).withColumn("fresh", F.lit(True)))
    discard(leaves)
    done = 0
    while rounds is None or done < rounds:
        done += 1
        found = _descend(graph, units, k)
        old = graph.select("a", "b", "score", F.lit(0).alias("is_new"))
        both = old.unionByName(found.select("a", "b", "score", F.lit(1).alias("is_new")))
        rank = Window.partitionBy("a").orderBy(F.desc("score"), "b")
        once = both.groupBy("a", "b").agg(F.max("score").alias("score"), F.min("is_new").alias("is_new"))
        better = once.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("a", "b", "score", (F.col("is_new") == 1).alias("fresh"))
        better = materialise(better)
        discard(graph)
        graph, found, both, once = better, None, None, None
        # Lets the cleaner remove the shuffle files of the round.
        spark.sparkContext._jvm.System.gc()
        if graph.where("fresh").count() <= STILL * k * n:
            break
    discard(units)
    return graph.drop("fresh")


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        s = np.einsum("ij,ij->i", _matrix(b.column(2)), _matrix(b.column(3))) if b.num_rows else np.zeros(0)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s)], names=["query", "node", "score"])


def greedy_search(queries: DataFrame, graph: DataFrame, units: DataFrame, beam: int = BEAM) -> DataFrame:
    """(query, node, score) of the ``beam`` best nodes that each of ``queries`` (query, unit, start) finds from its start.

    Every hop expands all nodes in the beam that were not expanded before and keeps the best of old and new. It ends where no
    beam holds a node that was not expanded: a node that has left a beam is worse than all in it for good, so it does."""
    pairs = lambda df: df.join(units, "node").join(queries.select("query", F.col("unit").alias("q_unit")), "query").select("query", "node", "unit", "q_unit").mapInArrow(_scored, "query long, node long, score double")
    held = materialise(pairs(queries.select("query", F.col("start").alias("node"))).withColumn("open", F.lit(True)))
    while not held.where("open").isEmpty():
        ahead = held.where("open").join(graph, F.col("node") == F.col("a")).select("query", F.col("b").alias("node")).distinct()
        new = ahead.join(held.select("query", "node"), ["query", "node"], "left_anti")
        both = held.select("query", "node", "score", F.lit(False).alias("open")).unionByName(pairs(new).withColumn("open", F.lit(True)))
        rank = Window.partitionBy("query").orderBy(F.desc("score"), "node")
        best = materialise(both.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= beam).drop("rank"))
        discard(held)
        held = best
    return held.drop("open")


def _compare_block(beam: int):
    def run(asked: pa.Table, others: pa.Table) -> pa.Table:
        q, x = _matrix(asked.column("unit")), _matrix(others.column("unit"))
        name, node, rows = asked.column("query").to_numpy(), others.column("node").to_numpy(), []
        for low in range(0, len(q) if len(x) else 0, 256):
            s, m = q[low : low + 256] @ x.T, min(beam, len(x))
            top = np.argpartition(-s, m - 1, axis=1)[:, :m]
            rows.append(_best(np.repeat(name[low : low + 256], m), node[top.ravel()], np.take_along_axis(s, top, axis=1).ravel(), beam))
        out = pa.concat_tables(rows) if rows else pa.table({"a": node[:0], "b": node[:0], "score": np.zeros(0)})
        return out.rename_columns(["query", "node", "score"])

    return run


def exact_search(queries: DataFrame, units: DataFrame, beam: int = BEAM) -> DataFrame:
    """As :func:`greedy_search`, by comparing each of ``queries`` with every node, a block of either at a time."""
    blocks, chunks = (max(1, -(-df.count() // size)) for df, size in ((queries, BLOCK_QUERIES), (units, BLOCK_NODES)))
    spread = lambda df, own, other, n_own, n_other, key: df.select(F.pmod(F.xxhash64(key), F.lit(n_own)).alias(own), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))).alias(other), key, "unit")
    asked = spread(queries, "block", "chunk", blocks, chunks, "query").groupBy("block", "chunk")
    others = spread(units, "chunk", "block", chunks, blocks, "node").groupBy("block", "chunk")
    found = asked.cogroup(others).applyInArrow(_compare_block(beam), "query long, node long, score double")
    rank = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= beam).drop("rank")


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, exact: bool = False) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest other rows found for each row whose vec_id is divisible by ``every``.

    With ``exact`` every query is compared with every row instead of searching the graph.

    Nearness is the cosine in double precision, ties go to the smaller vec_id; with at most k candidates all are returned.
    Rows without an id or vector, with null or non-finite components or of length zero take no part, nor do rows of another
    dimension than most rows have. Equal vectors are one node, named by a 64-bit hash (among 1e9 vectors a
    pair that shares a name, of which one is lost, has a chance of 3 %): of its rows the k + 1 with the least ids can be in an answer,
    since every other is beaten by them in all ties. Rows that share an id are candidates each for itself, never for their own id; as
    queries each of their different vectors has an answer of its own under that id."""
    rows = materialise(vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(_unit, "vec_id long, unit binary"))
    common = rows.groupBy(F.length("unit").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.length("unit") == (common["n"] if common else 0)).withColumn("key", F.xxhash64("unit"))
    # A node is named by its vector, so rows that share an id and differ are nodes of their own.
    units = materialise(rows.groupBy(F.col("key").alias("node")).agg(F.min("unit").alias("unit")))
    graph = None if exact else build_graph(units, DEGREE)
    asked = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "key"])
    queries = materialise(asked.select(F.xxhash64("vec_id", "key").alias("query"), F.col("vec_id").alias("query_id"), "unit", F.col("key").alias("start")))
    found = exact_search(queries, units) if exact else greedy_search(queries.drop("query_id"), graph, units)
    # The members that may answer: the k + 1 least ids of each node, by two levels of ranks.
    spread = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    few = Window.partitionBy("key", "unit", "salt").orderBy("vec_id")
    least = spread.withColumn("r", F.row_number().over(few)).where(F.col("r") <= k + 1)
    least = least.withColumn("r", F.row_number().over(Window.partitionBy("key", "unit").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    members = least.select(F.col("key").alias("node"), "vec_id")
    answers = found.join(members, "node").join(queries.select("query", "query_id"), "query").where(F.col("vec_id") != F.col("query_id"))
    rank = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
