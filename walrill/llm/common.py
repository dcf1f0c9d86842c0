"""Shared pieces of the corpus operators: durable intermediate tables, word hashes, arrow helpers."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from walrill.storage import discard, materialise, remove, shared_dir  # noqa: F401

#: A word is a maximal run of bytes outside these six (blank, tab, line feed, vertical tab, form feed, return).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Text bytes hashed at once by the vectorised helpers; bounds the memory of a Python worker.
BLOCK_BYTES = 1 << 20

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)


# --- tables -----------------------------------------------------------------------------------------------------


#: Rows of an arrow batch, unless the session says otherwise: texts are long, and a worker holds a batch at a time.
BATCH_ROWS = 2_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers unless their path has it, once for each Spark context."""
    context = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    there = {os.path.realpath(p) for p in (*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()) if p}
    if os.path.realpath(root) in there or getattr(context, "_walrill_shipped", False) or not os.path.isdir(root):
        return
    context.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), "walrill"), "zip", root, "walrill"))
    context._walrill_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables. Also readies the session for the operators: the package, and batches of bounded size."""
    _ship(spark)
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


# --- arrow ------------------------------------------------------------------------------------------------------


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, giving memory back to the system when a task ends: workers live on and idle beside the next stage's."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return wrapped


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string or binary column, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(texts: list[bytes | None], most: int = BLOCK_BYTES) -> Iterable[tuple[int, int]]:
    """Ranges of consecutive texts with about ``most`` bytes each, one text at least."""
    begin = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t or b"") > most:
            yield begin, i
            begin, held = i, 0
        held += len(t or b"") + 1
    if begin < len(texts):
        yield begin, len(texts)


# --- hashing ----------------------------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers (Stafford's variant 13)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


@lru_cache(maxsize=4)
def _byte_tables(fold_case: bool) -> tuple[np.ndarray, np.ndarray]:
    """A random 64-bit value for each byte (0 for white space), and which bytes are white space."""
    b = np.arange(256, dtype=_U)
    if fold_case:
        b = np.where((b >= 65) & (b <= 90), b + _U(32), b).astype(_U)
    values = mix((b + _U(1)) * _ODD)
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    values[space] = 0
    return values, space


@lru_cache(maxsize=1)
def _powers(n: int) -> np.ndarray:
    out = np.full(n, _U(0xD1342543DE82EF95))
    out[0] = 1
    return np.multiply.accumulate(out)


def _block_words(block: np.ndarray, fold_case: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a block that neither begins nor ends inside a word."""
    values, space = _byte_tables(fold_case)
    gap = space[block]
    begins = ~gap
    begins[1:] &= gap[:-1]
    at = np.flatnonzero(begins)
    if not len(at):
        return at, np.zeros(0, _U)
    span = np.diff(np.append(at, len(block)))
    depth = np.arange(at[0], len(block)) - np.repeat(at, span)
    size = 1 << max(12, int(span.max()).bit_length())
    h = np.add.reduceat(values[block[at[0] :]] * _powers(size)[depth], at - at[0])
    return at, mix(h)


def word_hashes(texts: list[bytes | None], fold_case: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts`` in order, and where each text's words begin (one more entry at the end).

    The value of a word depends on its bytes alone, so it is the same in every process and batch."""
    data = np.frombuffer(b"\n".join(t or b"" for t in texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t or b"") + 1 for t in texts], dtype=np.int64) if texts else np.zeros(0, np.int64)
    space = _byte_tables(fold_case)[1]
    at, hashes, begin = [], [], 0
    while begin < len(data):
        end = min(begin + BLOCK_BYTES, len(data))
        while end < len(data) and not space[data[end - 1]]:
            stop = np.flatnonzero(space[data[end : end + BLOCK_BYTES]])
            end += int(stop[0]) + 1 if len(stop) else min(BLOCK_BYTES, len(data) - end)
        a, h = _block_words(data[begin:end], fold_case)
        at.append(a + begin)
        hashes.append(h)
        begin = end
    where = np.concatenate(at) if at else np.zeros(0, np.int64)
    return (np.concatenate(hashes) if hashes else np.zeros(0, _U)), np.concatenate([[0], np.searchsorted(where, ends)]).astype(np.int64)


def windows(words: np.ndarray, length: int, base: int = 0x9FB21C651E98DF25) -> np.ndarray:
    """Rabin-Karp hashes (polynomials in ``base`` modulo 2**64, then mixed) of all windows of ``length`` words, by doubling."""
    if len(words) < length:
        return np.zeros(0, _U)
    part, have, out, done = words, 1, None, 0
    left = length
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                if out is None:
                    out, done = part, have
                else:
                    n = len(words) - done - have + 1
                    out, done = out[:n] * _U(pow(base, have, 1 << 64)) + part[done : done + n], done + have
            left >>= 1
            if left:
                n = len(words) - 2 * have + 1
                part, have = part[:n] * _U(pow(base, have, 1 << 64)) + part[have : have + n], 2 * have
    return mix(out + _U(length))


def shingle_sets(texts: list[bytes | None], length: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``length``-word shingles (letters A-Z in lower case) of each text as sorted hashes, and each set's bounds.

    A text of fewer words has its whole sequence as its one shingle; a text without words has none."""
    words, begin = word_hashes(texts, fold_case=True)
    sizes = np.diff(begin)
    every = windows(words, length)
    doc = np.repeat(np.arange(len(texts)), np.maximum(sizes - length + 1, 0))
    first = np.repeat(begin[:-1] - np.concatenate([[0], np.cumsum(np.maximum(sizes - length + 1, 0))[:-1]]), np.maximum(sizes - length + 1, 0)) if len(texts) else doc
    hashes = every[np.arange(len(doc)) + first] if len(doc) else np.zeros(0, _U)
    short = np.flatnonzero((sizes > 0) & (sizes < length))
    if len(short):
        doc = np.concatenate([doc, short])
        hashes = np.concatenate([hashes, np.array([windows(words[begin[i] : begin[i + 1]], int(sizes[i]))[0] for i in short], _U)])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    doc, hashes = doc[new], hashes[new]
    return hashes, np.searchsorted(doc, np.arange(len(texts) + 1))
