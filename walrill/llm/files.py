"""Binary files in the shared folder: atomic writes, memory maps, and bit tables of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

from walrill.llm.common import shared_dir

#: A bit table has 2**27 bits at most, 16 MB, whatever the size of the input; below that about 16 bits a key.
TABLE_BITS_MOST = 27

_U = np.uint64


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")


def keep(files: fs.FileSystem, done: str, name: str) -> None:
    """Moves a finished file into place; a second attempt of a task leaves the same bytes."""
    try:
        files.move(done, name)
    except OSError:
        if files.get_file_info(name).type != fs.FileType.File:
            raise
        files.delete_file(done)


def mapped(files: fs.FileSystem, name: str, dtype: str) -> np.ndarray:
    """A file as an array: memory-mapped if it is in a local or mounted folder, else read."""
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(name, dtype, "r")
    with files.open_input_file(name) as f:
        return np.frombuffer(f.read(), dtype)


def _table_part(bits: int, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits, bool)
        rows = 0
        for b in batches:
            table[(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> _U(64 - bits)).astype(np.int64)] = True
            rows += b.num_rows
        if rows:
            task = TaskContext.get()
            files, root = open_folder(folder)
            files.create_dir(root, recursive=True)
            name = f"part-{task.partitionId():06d}.bin"
            with files.open_output_stream(f"{root}/{name}.{task.taskAttemptId()}") as out:
                out.write(np.packbits(table).tobytes())
            keep(files, f"{root}/{name}.{task.taskAttemptId()}", f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

    return run


def bit_table(keys: DataFrame) -> tuple[int, str] | None:
    """A table (bits, file) that knows every key of ``keys`` (one column of well-mixed longs, a written table); None if empty.

    It may take other keys for known ones, the more so the fuller it is, and never misses one: it saves work before an exact
    step and decides nothing. At most 32 tasks each write a part of at most 16 MB, which the driver combines."""
    n = keys.count()
    if not n:
        return None
    bits = min(TABLE_BITS_MOST, max(16, (16 * n - 1).bit_length()))
    folder = shared_dir(keys.sparkSession)
    parts = [r["name"] for r in keys.coalesce(32).mapInArrow(_table_part(bits, folder), "name string").collect()]
    files, root = open_folder(folder)
    whole = np.zeros(1 << bits >> 3, np.uint8)
    for name in sorted(parts):
        whole |= mapped(files, f"{root}/{name}", "u1")
        files.delete_file(f"{root}/{name}")
    with files.open_output_stream(f"{root}/all.bin") as out:
        out.write(whole.tobytes())
    return bits, f"{folder}/all.bin"


_LOADED: dict[str, np.ndarray] = {}


def maybe_in(table: tuple[int, str], keys: np.ndarray) -> np.ndarray:
    """Which of the unsigned 64-bit ``keys`` the table knows."""
    bits, file = table
    if file not in _LOADED:
        # A task uses two at most.
        while len(_LOADED) > 1:
            _LOADED.pop(next(iter(_LOADED)))
        _LOADED[file] = mapped(*open_folder(file), "u1")
    place = keys >> _U(64 - bits)
    return (_LOADED[file][(place >> _U(3)).astype(np.int64)] >> (7 - (place & _U(7)).astype(np.uint8))) & 1 == 1
