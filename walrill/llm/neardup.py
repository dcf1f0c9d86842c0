"""Near-duplicate detection on five-word shingles: fast similarity sketches, banding, exact verification.

1. Each text becomes its set of shingle hashes; equal sets are one node from here on, so exact copies cost nothing more.
2. A set is sketched by rounds of hashed bin placement: in round i every element goes to one bin with a value in [i, i + 1),
   and a bin keeps its least value. Rounds stop once all bins are filled; after as many rounds as there are bins, round j
   more fills bin j from all elements, so every coordinate is filled. Coordinates of two sets agree with a probability of
   their similarity, and their number of agreements is concentrated.
3. Sets that agree on all rows of a band become candidates, in stars around the band bucket's least node.
4. Candidate clusters are verified exactly in blocks of bounded size, which count all intersections by matrix products over
   the shared shingles and emit a spanning forest of the true links. First every chunk of a cluster meets the cluster's head.
   Sets that are linked by then need no more comparisons with each other; only chunks that still hold different groups meet,
   two in a task. A group of near copies, however large, is one group after the first step, so its work is linear.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walrill.llm.common import discard, frugal, materialise, mix, raw_texts, shingle_sets, slices, windows
from walrill.llm.files import bit_table, maybe_in
from walrill.llm.graph import components

#: The limit of the op3 query, and the one at which a pipeline keeps one document of a group.
SIMILARITY_PERCENT, STAGE_PERCENT = 85, 80
#: A pair at the limit shares no band with this probability at most.
MISSED = 2e-6
#: What one chunk of a candidate cluster holds on average at most; two chunks meet in a task.
CHUNK_SETS, CHUNK_SHINGLES = 256, 250_000

_U = np.uint64
_EMPTY = _U(2**64 - 1)


def sketches(hashes: np.ndarray, at: np.ndarray, bins: int) -> np.ndarray:
    """The sketch of each non-empty set ``hashes[at[i]:at[i + 1]]``, a row each."""
    n = len(at) - 1
    out = np.full(n * bins, _EMPTY)
    doc = np.repeat(np.arange(n), np.diff(at))
    h = hashes
    for i in range(bins):
        if not len(doc):
            break
        g = mix(h + _U(((i + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1)))
        place = doc * bins + ((g >> _U(32)) * _U(bins) >> _U(32)).astype(np.int64)
        free = out[place] == _EMPTY
        np.minimum.at(out, place[free], (_U(i) << _U(32)) | (g[free] & _U(0xFFFFFFFF)))
        if i % 4 == 3 or i == 0:
            open_docs = (out.reshape(n, bins) == _EMPTY).any(axis=1)
            left = open_docs[doc]
            h, doc = h[left], doc[left]
    grid = out.reshape(n, bins)
    if len(doc):
        for j in range(bins):
            need = (grid[:, j] == _EMPTY)[doc]
            if need.any():
                g = mix(h[need] + _U(((bins + j + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1)))
                np.minimum.at(out, doc[need] * bins + j, (_U(bins + j) << _U(32)) | (g & _U(0xFFFFFFFF)))
    return grid


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows of a band for a limit: 28 of 6 at 85, 34 of 5 at 80."""
    rows = 6 if percent >= 85 else 5
    return int(np.ceil(np.log(MISSED) / np.log1p(-(min(percent, 99) / 100) ** rows))), rows


def band_keys(grid: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each sketch; equal keys mean equal rows of the same band."""
    part = mix(grid).reshape(len(grid), bands, rows)
    key = np.zeros((len(grid), bands), _U)
    for r in range(rows):
        key = key * _U(0x9FB21C651E98DF25) + part[:, :, r]
    return mix(key + mix(np.arange(1, bands + 1, dtype=_U)))


def set_keys(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, from all its elements whatever their order."""
    total = np.concatenate([[_U(0)], np.cumsum(mix(hashes + _U(77)), dtype=_U)])
    return mix(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(_U))


def _digest(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = raw_texts(b.column(1))
            for a, z in slices(texts):
                h, at = shingle_sets(texts[a:z])
                n = np.diff(at)
                full = np.flatnonzero(n)
                keys = band_keys(sketches(h, np.append(at[:-1][full], len(h)), bands * rows), bands, rows).view(np.int64)
                offsets = np.concatenate([[0], np.cumsum((n > 0) * bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), pa.array(n, pa.int64()), pa.array(set_keys(h, at).view(np.int64), pa.int64(), mask=n == 0), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())), b.column(2).slice(a, z - a)], names=["doc_id", "n_shingles", "node", "bands", "text_key"])

    return run


def _forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a boolean adjacency matrix."""
    left, out = np.ones(len(adjacent), bool), []
    for root in range(len(adjacent)):
        if not left[root]:
            continue
        left[root] = False
        stack = [root]
        while stack:
            u = stack.pop()
            near = np.flatnonzero(adjacent[u] & left)
            left[near] = False
            out += [(u, int(v)) for v in near]
            stack += near.tolist()
    return out


def true_links(hashes: np.ndarray, at: np.ndarray, percent: int, cells: int = 4_000_000) -> list[tuple[int, int]]:
    """A spanning forest of the links 100 * intersection >= percent * union among the sets, from exact intersections."""
    n, size = len(at) - 1, np.diff(at)
    doc = np.repeat(np.arange(n), size)
    _, column, count = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = count > 1
    column, doc = (np.cumsum(shared) - 1)[column[shared[column]]], doc[shared[column]]
    both = np.zeros((n, n), np.float32)
    width = max(1, cells // n)
    order = np.argsort(column, kind="stable")
    column, doc = column[order], doc[order]
    for low in range(0, int(shared.sum()), width):
        a, z = np.searchsorted(column, [low, low + width])
        part = np.zeros((n, min(width, int(shared.sum()) - low)), np.float32)
        part[doc[a:z], column[a:z] - low] = 1
        both += part @ part.T
    meet = both.astype(np.int64)
    linked = 100 * meet >= percent * (size[:, None] + size[None, :] - meet)
    np.fill_diagonal(linked, False)
    return _forest(linked)


def _verify(percent: int):
    """Of the texts of one block, with the names of their sets (node): a spanning forest of the true links."""

    def run(table: pa.Table) -> pa.Table:
        texts = raw_texts(table.column("text").combine_chunks())
        wanted = table.column("node").to_numpy().astype(np.int64)
        h, at = shingle_sets(texts)
        node = set_keys(h, at).view(np.int64)
        # A row whose id names several texts brings them all; only the text of the wanted set counts, once.
        own = np.flatnonzero(node == wanted)
        own = own[np.unique(node[own], return_index=True)[1]]
        sets = [h[at[i] : at[i + 1]] for i in own]
        links = true_links(np.concatenate(sets) if sets else h[:0], np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64), percent) if len(sets) > 1 else []
        names = node[own]
        return pa.table({"a": pa.array([int(names[i]) for i, _ in links], pa.int64()), "b": pa.array([int(names[j]) for _, j in links], pa.int64())})

    return run


def _clusters(digests: DataFrame) -> DataFrame:
    """(node, component) of the candidate graph: stars around the least node of each bucket that holds two nodes or more."""
    members = digests.where("node is not null").select("node", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most").select("bucket", "least")
    return components(members.join(buckets, "bucket").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")))


def _known(table: tuple[int, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = maybe_in(table, b.column(2).to_numpy(zero_copy_only=False).view(np.uint64))
            yield pa.RecordBatch.from_arrays(b.columns[:2], names=["doc_id", "text"]).filter(pa.array(hit))

    return run


def near_groups(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Digests (doc_id, n_shingles, node, bands, text_key) of all rows of ``docs`` (doc_id, text), and (node, component) of all linked nodes.

    Node is the text's set of shingles (null: no words), component the least node reachable over links."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = narrow.withColumn("text_key", F.xxhash64("text"))
    digests = materialise(keyed.mapInArrow(frugal(_digest(*banding(percent))), "doc_id long, n_shingles long, node long, bands array<long>, text_key long"))
    clusters = materialise(_clusters(digests))
    # Rows of equal texts combine before they move, so a text in a third of all rows is one row of each task.
    nodes = digests.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"))
    nodes = materialise(nodes.join(clusters, "node"))
    # Only texts of candidates move: a bit table of their ids, of bounded size, drops nearly all others before the join.
    table = bit_table(materialise(nodes.select(F.xxhash64("rep"))))
    if table is None:
        return digests, clusters
    near = narrow.select("doc_id", "text", F.xxhash64("doc_id").alias("key")).mapInArrow(frugal(_known(table)), "doc_id long, text string")
    near = materialise(near.join(nodes.select("node", "rep"), F.col("doc_id").eqNullSafe(F.col("rep"))).select("node", "text"))
    sizes = nodes.groupBy("component").agg(_parts("n").alias("chunks"))
    placed = nodes.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")))
    # The head goes to every chunk.
    where = F.when(F.col("node") == F.col("component"), F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).otherwise(F.array("own"))
    schema = "a long, b long"
    first = near.join(placed.select("node", "component", F.explode(where).alias("block")), "node").groupBy("component", "block")
    links = materialise(first.applyInArrow(_verify(percent), schema))
    found = materialise(components(links))
    many = placed.where("chunks > 1").select("node", "component", "n")
    if not many.isEmpty():
        more = _between_groups(many, found, near, percent, schema)
        if more is not None:
            discard(found)
            found = materialise(components(materialise(links.unionByName(more))))
    for done in (clusters, nodes, near):
        discard(done)
    return digests, found


def _parts(n: str):
    """How many chunks of bounded size a group of sets makes."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK_SETS), F.ceil(F.sum(n) / CHUNK_SHINGLES))


def _between_groups(nodes: DataFrame, found: DataFrame, near: DataFrame, percent: int, schema: str) -> DataFrame | None:
    """Links between sets of one candidate cluster that are not linked yet; ``nodes`` are those of clusters of several chunks.

    Groups of a fair size get chunks of their own, small ones share chunks. Two chunks meet unless they are of one group, so
    only clusters that really hold many groups cost more than their size."""
    told = nodes.join(found.select("node", F.col("component").alias("label")), "node", "left").withColumn("label", F.coalesce("label", "node"))
    told = materialise(told)
    split = told.groupBy("component").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("component")
    told = materialise(told.join(split, "component", "left_semi"))
    if told.isEmpty():
        return None
    groups = told.groupBy("component", "label").agg(F.count(F.lit(1)).alias("sets"), _parts("n").alias("own_parts"))
    told = told.join(groups, ["component", "label"]).withColumn("big", (F.col("sets") * 4 >= CHUNK_SETS) | (F.col("own_parts") > 1))
    shared = told.where("not big").groupBy("component").agg(_parts("n").alias("shared_parts"))
    told = told.join(shared, "component", "left")
    part = lambda n: F.pmod(F.xxhash64("node", F.lit(2)), F.col(n))
    chunk = F.when(F.col("big"), F.xxhash64("label", part("own_parts"))).otherwise(F.xxhash64(F.lit("shared"), part("shared_parts")))
    told = materialise(told.select("node", "component", "big", F.when(F.col("big"), F.col("label")).alias("label"), chunk.alias("chunk")))
    chunks = told.select("component", "chunk", "big", "label").distinct()
    side = lambda s: chunks.select("component", *(F.col(c).alias(f"{c}_{s}") for c in ("chunk", "big", "label")))
    of_groups = chunks.where("big").select("component", "label").distinct()
    labels = of_groups.select("component", F.col("label").alias("label_a")).join(of_groups.select("component", F.col("label").alias("label_b")), "component").where("label_a < label_b")
    both = labels.join(side("a").where("big_a"), ["component", "label_a"]).join(side("b").where("big_b"), ["component", "label_b"]).select("component", "chunk_a", "chunk_b")
    mixed = side("a").where("not big_a").join(side("b"), "component").where("big_b or chunk_a <= chunk_b").select("component", "chunk_a", "chunk_b")
    pairs = materialise(both.unionByName(mixed).withColumn("block", F.xxhash64("chunk_a", "chunk_b")))
    ends = pairs.select("component", "block", F.explode(F.array_distinct(F.array("chunk_a", "chunk_b"))).alias("chunk"))
    blocks = near.join(told.select("node", "component", "chunk").join(ends, ["component", "chunk"]).drop("chunk"), "node").groupBy("component", "block")
    return materialise(blocks.applyInArrow(_verify(percent), schema))


def near_duplicates(docs: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable over links) and kept (whether it is its own) of each row.

    Null, empty and blank texts have no shingles, are linked with nothing and kept. Rows with the same shingles are linked.
    A null doc_id never names a component that has another; rows that share an id are rows of their own."""
    digests, found = near_groups(docs, percent)
    rows = digests.join(found, "node", "left").withColumn("group", F.coalesce("component", "node"))
    rows = materialise(rows.select("doc_id", "n_shingles", "group"))
    # Only groups of two rows or more go back to the rows.
    least = rows.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    out = rows.join(materialise(least), "group", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, percent: int = STAGE_PERCENT, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay: of each group of linked rows the one with the least id, and every row without words.

    Repeated rows are one group, so one of them stays; the columns are those of ``docs``. Rows are known by id and
    text, so ids may be null or repeat."""
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(row_id).cast("long").alias("id"), F.col(text).alias("text"))
    digests, found = near_groups(packed.select(F.col("id").alias("doc_id"), "text"), percent)
    grouped = digests.join(found, "node", "left").withColumn("group", F.coalesce("component", "node"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("text_key").alias("t"))).alias("k")
    keepers = materialise(grouped.where("group is not null").groupBy("group").agg(first).select("k.*"))
    discard(digests)
    discard(found)
    keyed = packed.select("row", F.col("id").isNull().alias("z"), F.coalesce("id", F.lit(0)).alias("i"), F.xxhash64("text").alias("t"), (~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")).alias("blank"))
    # Rows that repeat a keeper meet it by the same keys as the join, so no further exchange is needed to leave one of them.
    kept = keyed.where("not blank").join(keepers, ["z", "i", "t"], "left_semi").dropDuplicates(["z", "i", "t"])
    return kept.unionByName(keyed.where("blank")).select("row.*")


NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS s FROM d WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
l AS (SELECT x.r AS a, y.r AS b FROM s x JOIN s y ON x.s = y.s AND x.r <> y.r JOIN n nx ON nx.r = x.r JOIN n ny ON ny.r = y.r
      GROUP BY x.r, y.r, nx.n, ny.n HAVING 100 * count(*) >= 85 * (nx.n + ny.n - count(*))),
g AS (SELECT r AS a, r AS b FROM d UNION SELECT g.a, l.b FROM g JOIN l ON l.a = g.b),
c AS (SELECT g.a AS r, min(d.doc_id) AS component_id FROM g JOIN d ON d.r = g.b GROUP BY g.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id IS NOT DISTINCT FROM c.component_id AS kept
FROM d JOIN c USING (r) LEFT JOIN n USING (r)
"""
