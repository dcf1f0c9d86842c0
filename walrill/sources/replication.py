"""A streaming source of decoded replication messages with log positions as offsets.

The feed is a folder of JSON-line segments, each named by the position of its first message (16 hex digits), as a replication
client spools them, on any file system that both driver and executors reach. Offsets are positions, so a query restarts from the position that it last confirmed; segments wholly before
the confirmed one may be removed, which is what acknowledging the log means here.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "lsn bigint, body string"


def position(text: str) -> int:
    high, low = text.split("/")
    return int(high, 16) << 32 | int(low, 16)


def segment_name(first: int) -> str:
    return f"{first:016x}.jsonl"


class Segment(InputPartition):
    def __init__(self, path: str, after: int, upto: int):
        self.path, self.after, self.upto = path, after, upto


class ReplicationReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.start = position(options.get("startLsn", "0/0"))
        self.acknowledge = options.get("acknowledge", "false").lower() == "true"
        #: Positions need not be dense, so by default a feed that begins later than asked is taken as it is.
        self.gaps = options.get("failOnDataLoss", "false").lower() != "true"

    def _folder(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path.removeprefix('file:')}")

    def _segments(self) -> list[tuple[int, str]]:
        files, root = self._folder()
        return sorted((int(f.base_name[:-6], 16), f.path) for f in files.get_file_info(fs.FileSelector(root)) if f.base_name.endswith(".jsonl") and len(f.base_name) == 22)

    def initialOffset(self) -> dict:
        return {"lsn": self.start}

    def latestOffset(self) -> dict:
        """The last position of the newest segment: the only file that is looked into, and only its last line."""
        found = self._segments()
        if not found:
            return {"lsn": self.start}
        with self._folder()[0].open_input_file(found[-1][1]) as f:
            size, block = f.size(), b""
            while size and block.count(b"\n") < 2:
                step = min(size, 65536)
                size -= step
                block = f.read_at(step, size) + block
        lines = [x for x in block.split(b"\n") if x.strip()]
        return {"lsn": max(self.start, position(json.loads(lines[-1])["lsn"]))} if lines else {"lsn": max(self.start, found[-1][0] - 1)}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        """The segments that hold positions after ``start``. Raises if the one that must hold the next of them is gone."""
        found = self._segments()
        if found and start["lsn"] > self.start and found[0][0] > start["lsn"] + 1 and not self.gaps:
            raise RuntimeError(f"the feed begins at {found[0][0]}, after {start['lsn']}: segments were removed before they were read")
        nexts = [f for f, _ in found[1:]] + [1 << 64]
        return [Segment(p, start["lsn"], end["lsn"]) for (f, p), n in zip(found, nexts, strict=True) if f <= end["lsn"] and n > start["lsn"] + 1]

    def read(self, partition: Segment) -> Iterator[tuple]:
        with self._folder()[0].open_input_stream(partition.path) as f:
            rest = b""
            while True:
                chunk = f.read(1 << 20)
                *lines, rest = (rest + chunk).split(b"\n") if chunk else (rest, b"")
                for line in lines:
                    if line.strip():
                        lsn = position(json.loads(line)["lsn"])
                        if partition.after < lsn <= partition.upto:
                            yield (lsn, line.decode())
                if not chunk:
                    return

    def commit(self, end: dict) -> None:
        """Everything up to ``end`` is durable downstream; its segments may go."""
        if not self.acknowledge:
            return
        found, files = self._segments(), self._folder()[0]
        for (_, path), (after, _) in zip(found, found[1:], strict=False):
            if after <= end["lsn"]:
                files.delete_file(path)


class ReplicationSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "replication"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ReplicationReader:
        return ReplicationReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ReplicationSource)


def _segment_writer(path: str, per_segment: int):
    def write(batches):
        import pyarrow as pa

        files, root = ReplicationReader({"path": path})._folder()
        files.create_dir(root, recursive=True)
        held: list[tuple[int, str]] = []

        def flush() -> str:
            name = segment_name(held[0][0])
            part = f"{root}/_{name}"
            with files.open_output_stream(part) as out:
                out.write("".join(body + "\n" for _, body in held).encode())
            files.move(part, f"{root}/{name}")
            held.clear()
            return name

        made = []
        for b in batches:
            for pos, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.append((pos, body))
                if len(held) >= per_segment:
                    made.append(flush())
        if held:
            made.append(flush())
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], names=["name"])

    return write


def write_segments(messages: DataFrame, path: str, per_segment: int = 100_000) -> list[str]:
    """Spools messages (see ``operators.decode``) to a feed: JSON lines in order of position, a file for each ``per_segment``.

    The driver receives the files' names. A file appears at once and whole."""
    high, low = F.floor(F.col("pos") / (1 << 32)).cast("long"), F.pmod(F.col("pos"), F.lit(1 << 32))
    text = F.concat(F.hex(high), F.lit("/"), F.hex(low.cast("long")))
    body = F.to_json(F.struct(text.alias("lsn"), *(c for c in messages.columns if c != "pos")))
    dealt = messages.select("pos", body.alias("body")).repartitionByRange("pos").sortWithinPartitions("pos")
    return sorted(r["name"] for r in dealt.mapInArrow(_segment_writer(path, per_segment), "name string").collect())
