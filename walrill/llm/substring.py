"""Substring de-duplication: every word inside a 20-word window that also starts earlier in the corpus goes.

Windows are Rabin-Karp hashes over words. Three passes, none of which shuffles a row for each window:

1. Anchors. Each window holds 13 eight-word grams; the one with the least hash is its anchor, a function of the window's words
   alone, and about one position in seven is an anchor. Anchors are counted exactly in Spark; a bit table of bounded size
   remembers the repeated ones. It may say yes too often, never no, so it only saves work.
2. Windows. Each slice of texts keeps the windows with a repeated anchor, settles copies inside the slice on the spot, and
   sends one row for each anchor occurrence with the first copies of its windows packed together. Equal windows have equal
   anchors, so they meet in the same group, where all but the earliest are marked. A passage in a third of all documents
   sends one row from each slice, and a line shorter than a window, with other words around it, one from each document.
   Anchors with many rows are therefore dealt out by their windows' hashes, first to salted groups that pass on the
   earliest of each window, so no group grows with the data.
3. Removal. Marked windows merge into maximal intervals for each document; one join brings them to the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walrill.llm.common import BLOCK_BYTES, discard, frugal, materialise, mix, raw_texts, slices, windows, word_hashes
from walrill.llm.files import bit_table, maybe_in

WINDOW, GRAM = 20, 8
#: Bytes of text whose copies are settled inside a task.
SLICE_BYTES = 4 * BLOCK_BYTES

_U = np.uint64


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` grams the position of its least one, the first of equals, by doubling."""
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at, have = np.arange(len(grams)), 1
    while 2 * have <= width:
        a, b = at[:-have], at[have:]
        at, have = np.where(grams[b] < grams[a], b, a), 2 * have
    if have < width:
        a, b = at[:n], at[width - have : width - have + n]
        at = np.where(grams[b] < grams[a], b, a)
    return at[:n]


class Slice:
    """Windows of a few texts: of each its text, first word, hash, and the place and hash of its anchor."""

    def __init__(self, texts: list[bytes | None], window: int, gram: int):
        words, at = word_hashes(texts)
        self.n_words = np.diff(at)
        full = windows(words, window)
        start = np.arange(len(full))
        text = np.searchsorted(at, start, "right") - 1
        whole = start + window <= at[text + 1] if len(full) else np.zeros(0, bool)
        grams = windows(words, gram, base=0xC2B2AE3D27D4EB4F)
        place = anchors(grams, window - gram + 1) if len(full) else start
        self.text, self.start, self.hash, self.place = text[whole], (start - at[text])[whole], full[whole], place[whole]
        self.anchor = grams[self.place]


def _anchor_rows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = raw_texts(b.column(0))
            for a, z in slices(texts, SLICE_BYTES):
                s = Slice(texts[a:z], window, gram)
                if len(s.anchor):
                    # Neighbouring windows share an anchor occurrence, which counts once.
                    new = np.append(True, s.place[1:] != s.place[:-1])
                    key, n = np.unique(s.anchor[new], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int8))], names=["anchor", "n"])

    return run


def _repeated_anchors(texts: DataFrame, window: int, gram: int) -> tuple[int, str] | None:
    """The bit table of anchors that occur twice or more (bits, file), or None if none does."""
    counted = texts.mapInArrow(frugal(_anchor_rows(window, gram)), "anchor long, n byte").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    counted = materialise(counted)
    table = bit_table(counted)
    discard(counted)
    return table


def _runs(doc: np.ndarray, start: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal word intervals [low, high) covered by windows, from windows sorted by document index and start."""
    if not len(doc):
        return doc, start, start
    new = np.append(True, (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + window))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], start[last] + window


#: Kind 0: an anchor occurrence with packed window hashes from ``low``; kind 1: the words [low, high) go.
_ROWS = "kind byte, doc_id long, row_key long, low int, high int, anchor long, hashes binary, starts binary"
_FIELDS = [f.split()[0] for f in _ROWS.split(", ")]


def _candidates(window: int, gram: int, table: tuple[int, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, ids, keys = raw_texts(b.column(1)), b.column(0), b.column(2)
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            # Null ids come after all others.
            value = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            key = keys.to_numpy(zero_copy_only=False)
            for a, z in slices(texts, SLICE_BYTES):
                s = Slice(texts[a:z], window, gram)
                hit = maybe_in(table, s.anchor)
                text, start, h, anchor = s.text[hit] + a, s.start[hit], s.hash[hit], s.anchor[hit]
                # Windows are equal if their hashes and those of their anchors are, 128 bits in all.
                order = np.lexsort((start, value[text], missing[text], anchor, h))
                t, st, hh, an = text[order], start[order], h[order], anchor[order]
                same = np.append(False, (hh[1:] == hh[:-1]) & (an[1:] == an[:-1]))
                # The earliest of a hash's group; a copy goes if it starts later than that, by document and place.
                head = np.maximum.accumulate(np.where(same, 0, np.arange(len(hh))))
                equal = (value[t] == value[t[head]]) & (missing[t] == missing[t[head]]) & (st == st[head])
                # Rows that tie with the head but hold another text go on too: an earlier document may take their words.
                later, first = order[same & ~equal], order[~same | (equal & (key[t] != key[t[head]]))]
                later = later[np.lexsort((start[later], text[later]))]
                doc, low, high = _runs(text[later], start[later], window)
                if len(doc):
                    n = len(doc)
                    yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int8)), ids.take(pa.array(doc)), keys.take(pa.array(doc)), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names=_FIELDS)
                first = first[np.lexsort((start[first], text[first], anchor[first]))]
                if len(first):
                    t, st, hh, an = text[first], start[first], h[first], anchor[first]
                    cut = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (an[1:] != an[:-1]) | (st[1:] - st[:-1] > window)))
                    # Places are 16-bit offsets from the first start of a chain, so a longer chain is cut.
                    block = (st - np.repeat(st[cut], np.diff(np.append(cut, len(t))))) >> 16
                    cut = np.union1d(cut, np.flatnonzero(block[1:] != block[:-1]) + 1)
                    ends = np.append(cut[1:], len(t))
                    spots = (st - np.repeat(st[cut], ends - cut)).astype("<u2")
                    n = len(cut)
                    yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int8)), ids.take(pa.array(t[cut])), keys.take(pa.array(t[cut])), pa.array(st[cut].astype(np.int32)), pa.nulls(n, pa.int32()), pa.array(an[cut].view(np.int64)), *_packed(hh, spots, cut)], names=_FIELDS)

    return run


#: Rows that an anchor may have before its windows are dealt out one by one, about, and what one group then holds.
HOT_ROWS = 1_000
_OPEN = "anchor long, doc_id long, row_key long, low int, hashes binary, starts binary"


def _dealt(table: tuple[int, str], parts: int, hot: bool):
    """The rows of anchors that ``table`` knows, a row for each of ``parts`` groups of their windows, with a salt; or all other rows."""
    names = ["anchor", "salt", "doc_id", "row_key", "low", "hashes", "starts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            anchor = b.column(0).to_numpy(zero_copy_only=False)
            known = maybe_in(table, anchor.view(np.uint64))
            if not hot:
                yield b.filter(pa.array(~known))
                continue
            b = b.filter(pa.array(known))
            if not b.num_rows:
                continue
            packed, spots = b.column(4).to_pylist(), b.column(5).to_pylist()
            sizes = [len(p) // 8 for p in packed]
            row, h, st = np.repeat(np.arange(b.num_rows), sizes), np.frombuffer(b"".join(packed), np.uint64), np.frombuffer(b"".join(spots), "<u2")
            part = (mix(h) >> _U(33)) % _U(parts)
            order = np.lexsort((st, part, row))
            row, h, st, part = row[order], h[order], st[order], part[order]
            cut = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (part[1:] != part[:-1])))
            at = pa.array(row[cut])
            key = mix(anchor[known].view(np.uint64)[row[cut]] ^ mix(part[cut] + _U(1)))
            owner = b.column(1).fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
            salt = (mix(owner + mix(b.column(2).to_numpy(zero_copy_only=False).view(np.uint64))) >> _U(35)) % _U(parts)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(salt[row[cut]].astype(np.int32)), *(b.column(k).take(at) for k in (1, 2, 3)), *_packed(h, st, cut)], names=names)

    return run


def _packed(h: np.ndarray, spots: np.ndarray, cut: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Window hashes and their 16-bit places as one binary value of each for the windows from each of ``cut`` on."""
    offsets = np.append(cut, len(h))
    pack = lambda x, width: pa.BinaryArray.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer((offsets * width).astype(np.int32)), pa.py_buffer(x.tobytes())])
    return pack(h, 8), pack(spots.astype("<u2"), 2)


def _resolve(window: int, on: bool = False):
    """Of rows sorted by anchor: marks all windows but the earliest of each hash, an anchor's rows at a time.

    With ``on`` the result has ``_ROWS``' columns, and rows with the earliest windows go on (kind 0) beside the marked words."""

    def settle(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        keys_of, ids, keys, low, packed, spots = zip(*rows, strict=True)
        sizes = [len(p) // 8 for p in packed]
        h, place = np.frombuffer(b"".join(packed), np.uint64), np.frombuffer(b"".join(spots), "<u2")
        start = place.astype(np.int64) + np.repeat(np.array(low, np.int64), sizes)
        row = np.repeat(np.arange(len(rows)), sizes)
        missing = np.array([i is None for i in ids])
        value = np.array([0 if i is None else i for i in ids], np.int64)
        key, group = np.array(keys, np.int64), np.array(keys_of, np.int64)
        order = np.lexsort((start, value[row], missing[row], group[row], h))
        r, st, hh = row[order], start[order], h[order]
        same = np.append(False, (hh[1:] == hh[:-1]) & (group[r[1:]] == group[r[:-1]]))
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(hh))))
        equal = (value[r] == value[r[head]]) & (missing[r] == missing[r[head]]) & (st == st[head])
        gone = same & ~equal
        if gone.any():
            # Rows of the same document meet again later; intervals are merged there.
            keep = order[gone][np.lexsort((start[order[gone]], row[order[gone]]))]
            doc, a, z = _runs(row[keep], start[keep], window)
            n, found = len(doc), [pa.array([ids[i] for i in doc], pa.int64()), pa.array(key[doc]), pa.array(a.astype(np.int32)), pa.array(z.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int8)), *found, pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())] if on else found, names=_FIELDS if on else _FIELDS[1:5])
        if on:
            first = np.sort(order[~same | (equal & (key[r] != key[r[head]]))])
            cut = np.flatnonzero(np.append(True, row[first][1:] != row[first][:-1]))
            at = row[first][cut]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(at), np.int8)), pa.array([ids[i] for i in at], pa.int64()), pa.array(key[at]), pa.array(np.array(low, np.int32)[at]), pa.nulls(len(at), pa.int32()), pa.array(group[at]), *_packed(h[first], place[first], cut)], names=_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            if not b.num_rows:
                continue
            anchor = b.column(0).to_numpy(zero_copy_only=False)
            rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            cuts = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])).tolist() + [len(anchor)]
            if held and held[0][0] != anchor[0]:
                yield from settle(held)
                held = []
            # Everything before the batch's last anchor is complete; groups are settled together, since anchors tell them apart.
            if len(cuts) > 2:
                yield from settle(held + rows[: cuts[-2]])
                held = []
            held += rows[cuts[-2] :]
        if held:
            yield from settle(held)

    return run


def _cooled(spark: SparkSession, open_rows: DataFrame, window: int, hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows to resolve, words that go already): anchors with more than ``hot_rows`` rows dealt out by window and settled in part.

    Which anchors these are goes to the tasks as a bit table of bounded size; one that it takes for hot by mistake is dealt out
    too, with all its rows. Copies of one window meet in as many rows as there are salts, other windows in groups of their own."""
    names = ["anchor", "doc_id", "row_key", "low", "hashes", "starts"]
    often = materialise(open_rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows))
    most = often.agg(F.max("n")).first()[0]
    if not most:
        return open_rows, None
    table, parts = bit_table(often.select("anchor")), -(-most // hot_rows)
    salted = open_rows.mapInArrow(frugal(_dealt(table, parts, True)), "anchor long, salt int, doc_id long, row_key long, low int, hashes binary, starts binary")
    dealt = salted.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt").select(*names)
    partly = materialise(dealt.mapInArrow(frugal(_resolve(window, on=True)), _ROWS))
    rest = open_rows.mapInArrow(frugal(_dealt(table, parts, False)), _OPEN).unionByName(partly.where("kind = 0").select(*names))
    return rest, partly.where("kind = 1").select("doc_id", "row_key", "low", "high")


def repeated_intervals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Word intervals (doc_id, row_key, low, high) of ``docs`` (doc_id, text, row_key) to remove; those of one row may overlap."""
    spark = docs.sparkSession
    found = _repeated_anchors(docs.select("text"), window, gram)
    if found is None:
        return spark.createDataFrame([], "doc_id long, row_key long, low int, high int")
    rows = materialise(docs.select("doc_id", "text", "row_key").mapInArrow(frugal(_candidates(window, gram, found)), _ROWS))
    open_rows, early = _cooled(spark, rows.where("kind = 0").select("anchor", "doc_id", "row_key", "low", "hashes", "starts"), window, hot_rows)
    settled = open_rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(frugal(_resolve(window)), "doc_id long, row_key long, low int, high int")
    settled = settled.unionByName(rows.where("kind = 1").select("doc_id", "row_key", "low", "high"))
    return settled if early is None else settled.unionByName(early)


def merged(low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """The union of intervals as disjoint maximal ones."""
    out: list[list[int]] = []
    for a, z in sorted(zip(low.tolist(), high.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, spans = raw_texts(b.column(1)), b.column(2)
        n_words, n_removed, digest = [], [], []
        for i, t in enumerate(texts):
            words = (t or b"").split()
            n = len(words)
            if spans[i].is_valid:
                s = spans[i].values
                cuts = merged(s.field("low").to_numpy(zero_copy_only=False), s.field("high").to_numpy(zero_copy_only=False))
                kept, at = [], 0
                for a, z in cuts:
                    kept += words[at:a]
                    at = z
                words = kept + words[at:]
            n_words.append(n)
            n_removed.append(n - len(words))
            digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_rows: int = HOT_ROWS) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row of ``docs`` (doc_id, text).

    Null and empty texts have no words and texts of fewer than ``window`` words no window. Documents come in ascending
    order of id, null last. A window goes if an equal one has a smaller (id, start), so repeated rows, which tie, keep the same
    words; rows that share an id or have none are told apart by their texts."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row_key"))
    spans = repeated_intervals(narrow, window, gram, hot_rows)
    by_row = spans.groupBy(F.col("doc_id").alias("span_id"), F.col("row_key").alias("span_key")).agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    joined = narrow.join(by_row, F.col("doc_id").eqNullSafe(F.col("span_id")) & (F.col("row_key") == F.col("span_key")), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(frugal(_removed), "doc_id long, n_words long, n_removed long, kept_sha256 string")


SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + 19 <= len(w) THEN array_to_string(list_slice(w, i, i + 19), ' ') END AS win FROM p),
m AS (SELECT doc_id, i, word, win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1 AS later FROM k),
r AS (SELECT doc_id, i, word, max(later::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM m),
a AS (SELECT doc_id, sum(gone)::BIGINT AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '')) AS h FROM r GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(a.n_removed, 0) AS n_removed, coalesce(a.h, sha256('')) AS kept_sha256 FROM d LEFT JOIN a USING (doc_id)
"""
