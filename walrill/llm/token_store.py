"""Token files: flat unsigned integers with 64-bit document offsets, written in parallel and read back by memory map.

A store is a folder with, for each shard n in order (task, then part of it; at most about ``SHARD_TOKENS`` ids, more only for a
longer document): ``tokens-n.bin`` (ids, little-endian unsigned 16 or 32 bits),
``offsets-n.bin`` (one 64-bit offset for each document and one for the end, in ids from the shard's start) and ``docs-n.bin``
(64-bit document ids, then a byte for each that is 1 where the id is null). A shard's place in the whole sequence, its base,
is the prefix sum of the lengths of the shards before it.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walrill.llm.common import BLOCK_BYTES, raw_texts, shared_dir, slices
from walrill.llm.files import keep, mapped, open_folder

#: Words whose ids a worker remembers, and the longest of them in bytes; beyond it starts afresh.
REMEMBERED, LONGEST = 1_300_000, 48
#: Ids in a file at most, unless one document has more, and bytes of text that a task encodes, about.
SHARD_TOKENS, TASK_BYTES = 64 << 20, 128 << 20
#: A sentence mark behind an ASCII letter or digit is a token sequence of its own; the tokenizer's own pattern splits there.
_MARKS = frozenset(b".,;:!?")


class _Places(dict):
    """Numbers of words; a word that is not known gets the next one and waits to be learnt."""

    def __init__(self):
        super().__init__()
        self.waiting: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.waiting.append(word)
        return n


#: What a tokenizer does to a text before its model, if ids of words make ids of texts (fixed values).
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLITTER = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}


def of_words(path: str) -> bool:
    """Whether a tokenizer file is of the kind that :class:`WordEncoder` is right for; any other is encoded text by text."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    steps = ((d.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return (d.get("normalizer") or {}).get("normalizers") == _NORMALIZER and steps == _SPLITTER and d["model"].get("end_of_word_suffix") == "</w>" and not d["model"].get("dropout") and not d.get("truncation") and not d.get("padding")


class TextEncoder:
    """Whole-text ids of any tokenizer, straight from the library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if max(self.tokenizer.get_vocab().values()) < 1 << 16 else "<u4")

    def __call__(self, texts: list[bytes | None]) -> list[np.ndarray]:
        spelled = [(t or b"").decode("utf-8", "replace") for t in texts]
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(spelled, add_special_tokens=False)]


class WordEncoder:
    """Whole-text ids of a tokenizer that never looks across white space, from the remembered ids of its words.

    ``word_bpe_49k`` is one (see :func:`of_words`): its pattern matches no white space and keeps letters apart from marks, and it lowers case, so a
    text's ids are those of its lower-case words in order. Texts that might spell a special token keep their case."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.places = _Places()
        self.pool, self.used = np.zeros(1 << 16, self.dtype), 0
        self.begin = np.zeros(1, np.int64)

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all ``words``, and where those of each begin and how many they are. Plain words, one token of which ends a word, go together."""
        spelled = [w.decode("utf-8", "replace") for w in words]
        plain = [i for i, w in enumerate(spelled) if w.isalpha()]
        sizes = np.zeros(len(words), np.int64)
        joined = np.zeros(0, self.dtype)
        if len(plain) > 1:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join([spelled[i] for i in plain])], add_special_tokens=False)[0].ids, self.dtype)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(plain) and cuts[-1] == len(ids):
                joined, sizes[plain] = ids, np.diff(cuts, prepend=0)
        rest = np.flatnonzero(sizes == 0)
        singly = [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast([spelled[i] for i in rest], add_special_tokens=False)]
        begin = np.cumsum(sizes) - sizes
        if singly:
            sizes[rest] = [len(x) for x in singly]
            begin[rest] = len(joined) + np.cumsum(sizes[rest]) - sizes[rest]
        return np.concatenate([joined, *singly]), begin, sizes

    def _learn(self, words: list[bytes]) -> None:
        """Adds the ids of ``words``, in the order of their numbers, to the pool; a marked word from those of its parts."""
        places, have = self.places, len(self.begin) - 1
        split = [(w[:-1], w[-1:]) if w[-1] in _MARKS and w[-2:-1].isalnum() else (w,) for w in words]
        flat = list(chain.from_iterable(split))
        found = {w: n if 0 <= (n := places.get(w, have)) < have else None for w in dict.fromkeys(flat)}
        names = [w for w, n in found.items() if n is None]
        ids, begin, sizes = self._encode(names)
        # Parts that are not known have the numbers after those that are; their ids stand behind the pool's.
        found.update(zip(names, range(have, have + len(names)), strict=True))
        number = np.fromiter(map(found.__getitem__, flat), np.int64, len(flat))
        data = np.concatenate([self.pool[: self.used], ids])
        first = np.concatenate([self.begin[:-1], self.used + begin])[number]
        size = np.concatenate([np.diff(self.begin), sizes])[number]
        ends = np.cumsum(size)
        new = data[np.arange(int(ends[-1])) + np.repeat(first - (ends - size), size)]
        last = np.cumsum(np.fromiter(map(len, split), np.int64, len(split))) - 1
        if self.used + len(new) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(len(self.pool), len(new)), self.dtype)])
        self.pool[self.used : self.used + len(new)] = new
        self.begin = np.concatenate([self.begin, self.used + ends[last]])
        self.used += len(new)

    def __call__(self, texts: list[bytes | None]) -> list[np.ndarray]:
        split = [(t if b"<|" in t else t.lower()).split() if t else [] for t in texts]
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(np.int64)
        if len(self.places) > REMEMBERED:
            self._forget()
        place = np.fromiter(map(self.places.__getitem__, chain.from_iterable(split)), np.int64, int(bounds[-1]))
        if new := self.places.waiting:
            self.places.waiting = []
            self._learn(new)
        sizes = np.diff(self.begin)[place] if len(place) else place
        ends = np.cumsum(sizes)
        ids = self.pool[np.arange(int(ends[-1])) + np.repeat(self.begin[place] - (ends - sizes), sizes)] if len(place) else self.pool[:0]
        at = np.concatenate([[0], ends])[bounds]
        if any(len(w) > LONGEST for w in new):
            self._forget_long(new)
        return [ids[at[i] : at[i + 1]] for i in range(len(texts))]

    def _forget_long(self, new: list[bytes]) -> None:
        """Takes the long ones of the words just learnt out of memory; their numbers stay in use."""
        for w in new:
            if len(w) > LONGEST:
                self.places[b"\n%d" % self.places.pop(w)] = -1


_ENCODERS: dict[str, WordEncoder | TextEncoder] = {}


def encoder(path: str) -> WordEncoder | TextEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path) if of_words(path) else TextEncoder(path)
    return _ENCODERS[path]


class _Shard:
    """The three files of one shard while they are written."""

    def __init__(self, files, root: str, name: str, attempt: int):
        self.files, self.names, self.attempt = files, {kind: f"{root}/{kind}-{name}.bin" for kind in ("tokens", "offsets", "docs")}, attempt
        self.out = files.open_output_stream(f"{self.names['tokens']}.{attempt}")
        self.lengths: list[int] = []
        self.ids: list[int | None] = []
        self.total = 0

    def add(self, doc_id: int | None, data: bytes, n: int) -> None:
        self.out.write(data)
        self.lengths.append(n)
        self.ids.append(doc_id)
        self.total += n

    def close(self) -> None:
        self.out.close()
        offsets = np.concatenate([[0], np.cumsum(np.array(self.lengths, np.int64))]).astype("<u8")
        ids = np.array([0 if i is None else i for i in self.ids], "<i8").tobytes() + np.array([i is None for i in self.ids], "u1").tobytes()
        for kind, data in (("offsets", offsets.tobytes()), ("docs", ids)):
            with self.files.open_output_stream(f"{self.names[kind]}.{self.attempt}") as out:
                out.write(data)
        for kind in ("docs", "offsets", "tokens"):
            keep(self.files, f"{self.names[kind]}.{self.attempt}", self.names[kind])


def _writer(folder: str, tokenizer_path: str, end_id: int, shard_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        task = TaskContext.get()
        number, attempt = task.partitionId(), task.taskAttemptId()
        end, made, shard = np.array([end_id], encode.dtype).tobytes(), [], None
        for b in batches:
            texts, ids = raw_texts(b.column(1)), b.column(0).to_pylist()
            for a, z in slices(texts, 4 * BLOCK_BYTES):
                for i, coded in enumerate(encode(texts[a:z]), a):
                    if shard is not None and shard.total + len(coded) >= shard_tokens:
                        shard.close()
                        shard = None
                    if shard is None:
                        shard = _Shard(files, root, f"{number:06d}-{len(made):04d}", attempt)
                        made.append(shard)
                    shard.add(ids[i], coded.tobytes() + end, len(coded) + 1)
        if shard is not None:
            shard.close()
        kind = pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array([number] * len(made), kind), pa.array(range(len(made)), kind), pa.array([len(m.lengths) for m in made], kind), pa.array([m.total for m in made], kind), pa.array([encode.dtype.itemsize] * len(made), kind)], names=["task", "part", "docs", "tokens", "width"])

    return write


@dataclass(frozen=True)
class TokenStore:
    """Where a store is, and of each shard its name, documents, base (ids before it) and bytes an id."""

    folder: str
    shards: tuple[tuple[str, int, int, int], ...]


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int = 2, folder: str | None = None, text: str = "text", row_id: str = "doc_id", shard_tokens: int = SHARD_TOKENS) -> TokenStore:
    """Encodes the whole texts of ``docs`` in ascending order of id, each with ``end_id`` behind it, and writes a store.

    A null or empty text has the end id alone. Rows with a null id come first; rows that share an id follow each other in
    the order of a hash of their texts. An empty table gives a store without shards. Rows move once, by ranges of the id, as
    many as all texts' bytes ask for; the driver receives one row for each shard. Other columns are left out, whatever their names."""
    spark, folder = docs.sparkSession, folder or shared_dir(docs.sparkSession)
    rows = docs.select(F.col(row_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Small inputs still use all cores, large ones get tasks of bounded size.
    n = max(1, -(-size // TASK_BYTES), min(8 * spark.sparkContext.defaultParallelism, -(-size // (10 << 20))))
    dealt = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    made = dealt.mapInArrow(_writer(folder, tokenizer_path, end_id, shard_tokens), "task long, part long, docs long, tokens long, width long").collect()
    shards, base = [], 0
    for r in sorted(made, key=lambda r: (r["task"], r["part"])):
        shards.append((f"{r['task']:06d}-{r['part']:04d}", r["docs"], base, r["width"]))
        base += r["tokens"]
    return TokenStore(folder, tuple(shards))


def _reader(store: TokenStore):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(store.folder)
        for b in batches:
            for k in b.column(0).to_pylist():
                shard, n, base, width = store.shards[k]
                tokens = mapped(files, f"{root}/tokens-{shard}.bin", f"<u{width}")
                offsets = mapped(files, f"{root}/offsets-{shard}.bin", "<u8").astype(np.int64)
                docs = mapped(files, f"{root}/docs-{shard}.bin", "u1")
                ids, nulls = docs[: 8 * n].view("<i8"), docs[8 * n : 9 * n]
                for a in range(0, n, 5_000):
                    z = min(n, a + 5_000)
                    crcs = [zlib.crc32(tokens[offsets[i] : offsets[i + 1]].astype("<u4").tobytes()) for i in range(a, z)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.array(ids[a:z]), pa.int64(), mask=nulls[a:z].astype(bool)), pa.array(base + offsets[a:z]), pa.array(np.diff(offsets[a : z + 1])), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read


def read_digests(spark, store: TokenStore) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files of ``store``; a task for each shard."""
    n = max(1, len(store.shards))
    return spark.range(0, len(store.shards), 1, n).mapInArrow(_reader(store), "doc_id long, start long, n_tokens long, ids_crc32 long")
