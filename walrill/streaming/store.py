"""State on shared storage: every commit writes new folders and then one small pointer, so readers see all of it or none.

Rows lie in buckets by key, and a commit rewrites only the buckets that its events touch. Markers and other logs grow by folders.
A pointer names the batch that made it: a batch that comes again after a crash finds itself done.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walrill.operators import fold
from walrill.operators.apply import DEAD_LETTERS, SETTINGS, State
from walrill.operators.registry import REGISTRY
from walrill.storage import names, read_text, remove, write_text

SCHEMAS = {"rows": fold.STATE, "markers": fold.MARKERS, "watermarks": fold.WATERMARKS, "dead_letters": DEAD_LETTERS, "registry": REGISTRY, "settings": SETTINGS}


class Store:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # --- pointer ---

    def pointer(self) -> dict:
        """The newest version: {version, batch, tables: {name: [folders]}, buckets: {number: folder}}."""
        if not (versions := self._versions()):
            return {"version": 0, "batch": None, "tables": {}, "buckets": {}, "n_buckets": self.buckets}
        return self._pointer(max(versions))

    def _versions(self) -> list[int]:
        return [int(n[8:-5]) for n in names(self.spark, self.path) if n.startswith("pointer-") and n.endswith(".json")]

    def _pointer(self, version: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.path}/pointer-{version:012d}.json"))

    # --- tables ---

    def _frame(self, name: str, folders: list[str]) -> DataFrame:
        """A table in its present form; columns that older folders don't have are null in their rows."""
        if not folders:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).parquet(*folders)

    def load(self, pointer: dict | None = None, buckets: list[int] | None = None) -> State:
        """The state of a version; of its rows only those in ``buckets``, if given."""
        p = pointer or self.pointer()
        parts = {f.name: self._frame(f.name, p["tables"].get(f.name, [])) for f in fields(State)}
        held = [v for k, v in p["buckets"].items() if buckets is None or int(k) in buckets]
        return replace(State(**parts), rows=self._frame("rows", sorted(set(held))))

    def commit(self, state: State, batch: int | None = None, touched: list[int] | None = None, expected: int | None = None, new_markers: DataFrame | None = None) -> int:
        """Writes ``state`` as the next version. ``touched`` (numbers of buckets) limits which rows are rewritten;
        with ``new_markers`` the markers, the one table that only grows, gain a folder instead of being rewritten.

        Raises if another writer has committed since ``expected``, the version that ``state`` was made from."""
        p = self.pointer()
        if expected is not None and p["version"] != expected:
            raise RuntimeError(f"another writer committed version {p['version']} after {expected}")
        version, home = p["version"] + 1, f"{self.path}/v{p['version'] + 1:012d}-{uuid.uuid4().hex[:8]}"
        n = p["n_buckets"]
        which = list(range(n)) if touched is None else touched
        by = F.pmod(F.xxhash64(*fold.KEY), F.lit(n))
        buckets = dict(p["buckets"])
        if which:
            rows = state.rows.withColumn("_bucket", by).where(F.col("_bucket").isin(which))
            rows.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{home}/rows")
            full = {int(s.getPath().getName().split("=")[1]) for s in self._fs.listStatus(self._path(f"{home}/rows")) if "=" in s.getPath().getName()}
            for k in which:
                if k in full:
                    buckets[str(k)] = f"{home}/rows/_bucket={k}"
                else:
                    buckets.pop(str(k), None)
        tables = {}
        for name in ("markers", "watermarks", "dead_letters", "registry", "settings"):
            grows = name == "markers" and new_markers is not None
            (new_markers if grows else getattr(state, name)).write.parquet(f"{home}/{name}")
            tables[name] = [*(p["tables"].get(name, []) if grows else []), f"{home}/{name}"]
        text = json.dumps({"version": version, "batch": p["batch"] if batch is None else batch, "tables": tables, "buckets": buckets, "n_buckets": n})
        if not write_text(self.spark, f"{self.path}/pointer-{version:012d}.json", text):
            raise RuntimeError(f"another writer committed version {version}")
        return version

    # --- upkeep ---

    def compact_markers(self, most: int = 16) -> int | None:
        """Makes one folder of the markers, in order of position, once they lie in more than ``most``; the new version, if any.

        Writers read only markers within a batch's positions, which sorted files let them skip to."""
        p = self.pointer()
        if len(folders := p["tables"].get("markers", [])) <= most:
            return None
        home = f"{self.path}/v{p['version'] + 1:012d}-{uuid.uuid4().hex[:8]}/markers"
        self._frame("markers", folders).repartitionByRange("lsn").sortWithinPartitions("lsn").write.parquet(home)
        version = p["version"] + 1
        text = json.dumps(p | {"version": version, "tables": p["tables"] | {"markers": [home]}})
        if not write_text(self.spark, f"{self.path}/pointer-{version:012d}.json", text):
            raise RuntimeError(f"another writer committed version {version}")
        return version

    def vacuum(self, keep: int = 2) -> list[str]:
        """Removes what none of the newest ``keep`` versions names: older pointers, folders of rows and tables, events that waited
        for an older batch. What a commit that never came to its pointer left goes too, so no writer may be at work."""
        newest = sorted(self._versions())[-keep:]
        if not newest:
            return []
        pointers = [self._pointer(v) for v in newest]
        used = {f for p in pointers for f in (*p["buckets"].values(), *(x for t in p["tables"].values() for x in t))}
        waiting = {f"pending-{-1 if p['batch'] is None else p['batch']:012d}" for p in pointers}
        gone = []
        for n in names(self.spark, self.path):
            path = f"{self.path}/{n}"
            if n.startswith("pointer-") and int(n[8:-5]) not in newest or n.startswith("pending-") and n not in waiting:
                gone.append(path)
            elif n.startswith("v") and not any(u.startswith(f"{path}/") for u in used):
                gone.append(path)
            elif n.startswith("v"):
                for kind in names(self.spark, path):
                    parts = [f"{path}/{kind}/{x}" for x in names(self.spark, f"{path}/{kind}") if x.startswith("_bucket=")] if kind == "rows" else [f"{path}/{kind}"]
                    gone += [x for x in parts if x not in used]
        for path in gone:
            remove(self.spark, path)
        return gone
