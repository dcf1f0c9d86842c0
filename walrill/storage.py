"""Intermediate tables on storage that driver and executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; without that setting only a local master gets one of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = f"/tmp/checkpoints/{os.getpid()}"
        base = f"file://{folder}"
        spark.conf.set("spark.checkpoint.dir", base)
        # Nothing in it outlives the process.
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Writes ``df`` once as Parquet in the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession)
    # Not the default codec: its direct buffers stay until the collector comes by, which adds up over many files.
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._walrill_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Removes a table that :func:`materialise` wrote, once nothing reads it any more."""
    if path := getattr(df, "_walrill_path", None):
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)




def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    files, where = _at(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Creates a small file with all of ``text`` at once; False if it is there already, unless it may be replaced."""
    files, final = _at(spark, path)
    _, part = _at(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")
    out = files.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if replace and files.exists(final):
        files.delete(final, False)
    if files.exists(final) or not files.rename(part, final):
        files.delete(part, False)
        return False
    return True


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, which is made if it isn't there."""
    files, where = _at(spark, path)
    files.mkdirs(where)
    return sorted(s.getPath().getName() for s in files.listStatus(where))
