"""Benchmark decontamination: which documents hold at least four fifths of a test item's five-word shingles.

Size-partitioned MinHash containment search. Items fall in classes by the number q of their shingles, [2**k, 2**(k + 1)). For
each class that occurs, documents are cut into overlapping pieces of 2**(k + 2) shingles, so that a passage as long as the
largest item of the class lies in one piece, and piece and item have a similarity of at least t / (5 - t) for a containment of
t, however long the document is. Pieces and items are sketched alike (fast similarity sketching, ``neardup.sketches``), and a
pair becomes a candidate if as many coordinates agree as leaves a miss a probability of ``MISSED``. Candidates are then
verified exactly on the full sets of item and document.

Two bit tables of bounded size, of all items' shingles and of their sketches' coordinates, save work and decide nothing: a
piece is sketched only if it holds as many item shingles as an item of the class needs, and only coordinates that an item may
have leave a task. So any number of items takes one pass over the documents. Shared shingles that are scattered over more of a
long document than a piece may escape the sketches; ``exact`` looks every shingle up instead and misses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walrill.llm.common import discard, frugal, materialise, mix, raw_texts, shingle_sets, slices, windows, word_hashes
from walrill.llm.files import bit_table, maybe_in
from walrill.llm.neardup import sketches

#: Coordinates of a sketch, and the probability at most that a pair at the limit has too few in common.
COORDINATES, MISSED = 128, 1e-6
#: Pieces sketched at once.
PIECES = 2_048
CONTAINMENT_PERCENT = 80
#: Shingles of items that one pass of the exact search takes to the tasks: 32 MB at most, whatever the number of items.
BLOCK_SHINGLES = 4_000_000


def sketch_length(q: int, percent: int = CONTAINMENT_PERCENT) -> int:
    """Length for the size class [2**k, 2**(k + 1)) of ``q``: what its largest items need, so enough for all of it."""
    top = (1 << q.bit_length()) - 1
    return min(q, top - -(-percent * top // 100) + 1)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = raw_texts(b.column(1))
        for a, z in slices(texts):
            h, at = shingle_sets(texts[a:z])
            yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), pa.array([h[at[i] : at[i + 1]].tobytes() for i in range(z - a)], pa.binary())], names=["item_id", "shingles"])


class ItemIndex:
    """Sorted sketch hashes of a block of items with the items that each belongs to, and all items' full sets."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], percent: int):
        self.items, self.percent = items, percent
        sketch = [np.sort(h)[: sketch_length(len(h), percent)] for _, h in items]
        owner = np.repeat(np.arange(len(items)), [len(s) for s in sketch])
        keys = np.concatenate(sketch) if sketch else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], owner[order]

    def search(self, shingles: np.ndarray) -> list[tuple[int, int]]:
        """(item, shared shingles) of the items that the sorted set ``shingles`` contains."""
        first, last = np.searchsorted(self.keys, shingles, "left"), np.searchsorted(self.keys, shingles, "right")
        hits = np.flatnonzero(last > first)
        if not len(hits):
            return []
        found = []
        for k in np.unique(np.concatenate([self.owner[first[i] : last[i]] for i in hits])):
            own = self.items[k][1]
            at = np.minimum(np.searchsorted(shingles, own), len(shingles) - 1)
            if 100 * (shared := int((shingles[at] == own).sum())) >= self.percent * len(own):
                found.append((int(k), shared))
        return found


def _searcher(items: list[tuple[int | None, bytes]], percent: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex([(i, np.frombuffer(b, np.uint64)) for i, b in items], percent)
        kind = pa.int64()
        for b in batches:
            ids, texts = b.column(0), raw_texts(b.column(1))
            rows: list[tuple[int, int, int]] = []
            for a, z in slices(texts):
                h, at = shingle_sets(texts[a:z])
                # One look-up for the whole slice; only documents with a hit are looked at one by one.
                near = np.searchsorted(index.keys, h)
                hit = np.zeros(len(h), bool)
                inside = near < len(index.keys)
                hit[inside] = index.keys[near[inside]] == h[inside]
                for i in np.unique(np.searchsorted(at, np.flatnonzero(hit), "right") - 1):
                    rows += [(a + int(i), k, shared) for k, shared in index.search(h[at[i] : at[i + 1]])]
            if rows:
                where = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays([ids.take(where).cast(kind), pa.array([items[r[1]][0] for r in rows], kind), pa.array([len(index.items[r[1]][1]) for r in rows], kind), pa.array([r[2] for r in rows], kind)], names=["doc_id", "item_id", "n_item", "n_shared"])

    return search


def _blocks(items: DataFrame, block_shingles: int) -> Iterator[list[tuple[int | None, bytes]]]:
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(frugal(_sets), "item_id long, shingles binary").where(F.octet_length("shingles") > 0)
    block, held = [], 0
    for r in rows.toLocalIterator():
        if block and held + len(r["shingles"]) // 8 > block_shingles:
            yield block
            block, held = [], 0
        block.append((r["item_id"], bytes(r["shingles"])))
        held += len(r["shingles"]) // 8
    if block:
        yield block


def agreements(percent: int = CONTAINMENT_PERCENT) -> int:
    """Coordinates that a candidate has in common with an item at least, one at the least."""
    j, below = percent / 100 / (5 - percent / 100), 0.0
    for m in range(COORDINATES):
        below += comb(COORDINATES, m) * j**m * (1 - j) ** (COORDINATES - m)
        if below > MISSED:
            return max(1, m)
    return COORDINATES


def ordered_shingles(texts: list[bytes | None], length: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The shingles' hashes of each text in order, repeated ones too, and where each text's begin."""
    words, begin = word_hashes(texts, fold_case=True)
    sizes, every = np.diff(begin), windows(words, length)
    counts = np.where(sizes >= length, sizes - length + 1, np.minimum(sizes, 1))
    at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    out = np.zeros(int(at[-1]), np.uint64)
    long = sizes >= length
    inside = np.repeat(long, counts)
    out[inside] = every[(np.arange(len(out)) - np.repeat(at[:-1] - begin[:-1], counts))[inside]] if len(every) else 0
    for i in np.flatnonzero((sizes > 0) & ~long):
        out[at[i]] = windows(words[begin[i] : begin[i + 1]], int(sizes[i]))[0]
    return out, at


def _coordinates(grid: np.ndarray, k: int) -> np.ndarray:
    """A key for each coordinate of each sketch of class ``k``."""
    return mix(mix(grid) + mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) + np.uint64(1024 * (k + 1))))


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item (its number), item_id, n_item, class, shingles and coordinates of each item that has a shingle."""
    lists = lambda rows: pa.array([r.view(np.int64).tolist() for r in rows], pa.list_(pa.int64()))
    for b in batches:
        texts = raw_texts(b.column(2))
        for a, z in slices(texts):
            h, at = shingle_sets(texts[a:z])
            sets = [h[at[i] : at[i + 1]] for i in range(z - a)]
            own = [i for i, x in enumerate(sets) if len(x)]
            if own:
                kinds = [len(sets[i]).bit_length() - 1 for i in own]
                keys = [_coordinates(sketches(sets[i], np.array([0, len(sets[i])]), COORDINATES), k)[0] for i, k in zip(own, kinds, strict=True)]
                where = pa.array([a + i for i in own])
                yield pa.RecordBatch.from_arrays([b.column(0).take(where), b.column(1).take(where), pa.array([len(sets[i]) for i in own], pa.int64()), pa.array(kinds, pa.int32()), lists(sets[i] for i in own), lists(keys)], names=["item", "item_id", "n_item", "class", "shingles", "keys"])


def _pieces(doc: np.ndarray, place: np.ndarray, length: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, number) of the pieces of class ``k`` that hold ``least`` of the given distinct places or more.

    Piece j begins at shingle j s, s = 2**(k + 1), and holds 2 s; the last one reaches the end of its document."""
    s = 2 << k
    last = np.maximum(-(-length // s) - 2, 0)
    ahead, behind = np.minimum(place // s, last), np.clip(place // s - 1, 0, last)
    both = ahead != behind
    doc, piece = np.concatenate([doc, doc[both]]), np.concatenate([ahead, behind[both]])
    if not len(doc):
        return doc, piece
    order = np.lexsort((piece, doc))
    doc, piece = doc[order], piece[order]
    first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (piece[1:] != piece[:-1])))
    enough = np.diff(np.append(first, len(doc))) >= least
    return doc[first[enough]], piece[first[enough]]


_FOUND = "kind byte, uid long, doc_id long, text_key long, piece long, h long"


def _searcher_of_pieces(classes: list[int], shingle_table: tuple[int, str], key_table: tuple[int, str], percent: int):
    """Of (uid, doc_id, text_key, text): each item shingle of a document once (kind 1), and coordinates of its pieces (kind 0)."""
    names = [f.split()[0] for f in _FOUND.split(", ")]

    def rows(b: pa.RecordBatch, kind: int, where: np.ndarray, piece: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
        at = pa.array(where)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(where), kind, np.int8)), *(b.column(c).take(at) for c in range(3)), pa.array(piece.astype(np.int64)), pa.array(h.view(np.int64))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = raw_texts(b.column(3))
            for a, z in slices(texts):
                h, at = ordered_shingles(texts[a:z])
                spot = np.flatnonzero(maybe_in(shingle_table, h))
                if not len(spot):
                    continue
                doc = np.searchsorted(at, spot, "right") - 1
                order = np.lexsort((h[spot], doc))
                d, x = doc[order], h[spot][order]
                new = np.append(True, (d[1:] != d[:-1]) | (x[1:] != x[:-1]))
                yield rows(b, 1, a + d[new], np.zeros(int(new.sum())), x[new])
                length = np.diff(at)
                for k in classes:
                    owner, number = _pieces(doc, spot - at[doc], length[doc], k, -(-percent * (1 << k) // 100))
                    for low in range(0, len(owner), PIECES):
                        o, j = owner[low : low + PIECES], number[low : low + PIECES]
                        begin = at[o] + j * (2 << k)
                        size = np.minimum(begin + (4 << k), at[o + 1]) - begin
                        ends = np.cumsum(size)
                        inside = np.arange(int(ends[-1])) + np.repeat(begin - (ends - size), size)
                        keys = _coordinates(sketches(h[inside], np.concatenate([[0], ends]), COORDINATES), k)
                        row, column = np.nonzero(maybe_in(key_table, keys.ravel()).reshape(keys.shape))
                        if len(row):
                            yield rows(b, 0, a + o[row], j[row], keys[row, column])

    return run


def _hits(docs: DataFrame, items: DataFrame, percent: int) -> DataFrame | None:
    """(doc_id, text_key, item_id, n_item, n_shared) of each row of ``docs`` (doc_id, text) and item that it holds; None without items."""
    number = F.monotonically_increasing_id()
    named = items.select(number.alias("item"), F.col("item_id").cast("long").alias("item_id"), "text")
    items = materialise(named.mapInArrow(frugal(_item_rows), "item long, item_id long, n_item long, class int, shingles array<long>, keys array<long>"))
    classes = sorted(r["class"] for r in items.select("class").distinct().collect())
    if not classes:
        return None
    shingles, keys = (materialise(items.select("item", F.explode(c).alias("h"))) for c in ("shingles", "keys"))
    tables = [bit_table(df.select("h")) for df in (shingles, keys)]
    rows = docs.select(number.alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    found = materialise(rows.mapInArrow(frugal(_searcher_of_pieces(classes, *tables, percent)), _FOUND))
    # A coordinate that two pieces share counts for each of them; equal texts among the items are items of their own.
    agree = found.where("kind = 0").join(keys, "h").groupBy("uid", "piece", "item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= agreements(percent))
    pairs = materialise(agree.select("uid", "item").distinct())
    # Exact, on all of the item and all of the document: as many rows as candidates have shingles, never documents times items.
    wanted = pairs.join(shingles, "item")
    shared = found.where("kind = 1").join(wanted, ["uid", "h"]).groupBy("uid", "doc_id", "text_key", "item").agg(F.count(F.lit(1)).alias("n_shared"))
    out = shared.join(items.select("item", "item_id", "n_item"), "item").where(100 * F.col("n_shared") >= percent * F.col("n_item"))
    return out.select("doc_id", "text_key", "item_id", "n_item", "n_shared")


def contained_items(docs: DataFrame, items: DataFrame, percent: int = CONTAINMENT_PERCENT, block_shingles: int = BLOCK_SHINGLES, exact: bool = False) -> DataFrame:
    """A row (doc_id, item_id, n_item, n_shared) for each row of ``docs`` and item with 100 * shared >= percent * item size.

    Sets are the distinct five-word shingles, letters A-Z in lower case; a text of fewer words is one shingle, so a short
    item is found only as a whole document. Null and empty texts are in no pair. Rows with null or repeated ids count each
    for itself, of documents and of items. Without documents or items the result is empty. ``exact`` looks up every shingle of
    every document instead of sketching pieces, in blocks of ``block_shingles`` of the items, each one pass over the documents."""
    schema = "doc_id long, item_id long, n_item long, n_shared long"
    if not exact:
        hits = _hits(docs, items, percent)
        return docs.sparkSession.createDataFrame([], schema) if hits is None else hits.drop("text_key")
    narrow, out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None
    for block in _blocks(items, block_shingles):
        found = materialise(narrow.mapInArrow(frugal(_searcher(block, percent)), schema))
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _split(table: tuple[int, str], known: bool):
    """The rows whose key (second column) the table knows, or the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = maybe_in(table, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
            yield b.filter(pa.array(hit if known else ~hit))

    return run


def without_items(docs: DataFrame, items: DataFrame, percent: int = CONTAINMENT_PERCENT, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that contain no item, whatever their ids and other columns; see :func:`contained_items`.

    Rows are known by id and text, which the verdict depends on. A bit table of those that go lets nearly all others pass where
    they are; only what it knows meets the exact list."""
    hits = _hits(docs.select(F.col(row_id).alias("doc_id"), F.col(text).alias("text")), items, percent)
    if hits is None:
        return docs
    name = F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(0)), F.col("doc_id").isNull(), F.col("text_key"))
    gone = materialise(hits.select(name.alias("key"), "doc_id", "text_key").distinct())
    if (table := bit_table(gone.select("key"))) is None:
        return docs
    ident = F.col(row_id).cast("long")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(F.coalesce(ident, F.lit(0).cast("long")), ident.isNull(), F.xxhash64(text)).alias("key"))
    schema = T.StructType([*keyed.schema.fields])
    clear, near = (keyed.mapInArrow(frugal(_split(table, known)), schema) for known in (False, True))
    near = near.select("row", F.col("row").getField(row_id).cast("long").alias("i"), F.xxhash64(F.col("row").getField(text)).alias("t"))
    stays = near.join(gone.select("doc_id", "text_key"), F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_key")), "left_anti")
    return clear.select("row.*").unionByName(stays.select("row.*"))


def decontamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The pairs of :func:`contained_items` at the production limit of four fifths."""
    return contained_items(docs, items)


DECONTAMINATION_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT row_number() OVER () AS r, item_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE text IS NOT NULL),
ds AS (SELECT DISTINCT r, id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS s FROM d WHERE len(w) > 0),
bs AS (SELECT DISTINCT r, id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS s FROM b WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n_item FROM bs GROUP BY r)
SELECT ds.id AS doc_id, bs.id AS item_id, n.n_item, count(*) AS n_shared
FROM ds JOIN bs USING (s) JOIN n ON n.r = bs.r
GROUP BY ds.r, bs.r, ds.id, bs.id, n.n_item HAVING 100 * count(*) >= 80 * n.n_item
"""
