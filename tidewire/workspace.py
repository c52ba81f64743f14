"""Shared-folder tables: the one way this package cuts lineage.

A table is written under ``spark.checkpoint.dir``, so it outlives any executor, and it is read
back column by column. A folder of our own is made only where the session names none, and only for a
local session. Each application has its own part of the folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_recorders: list[list[str]] = []


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one if none is set and all work is local."""
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        or spark.sparkContext.getCheckpointDir()
    )
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidewire-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def _own_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/tidewire/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{_own_root(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in _recorders:
        paths.append(path)
    return path


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The list of the paths given out meanwhile, for ``free``."""
    paths: list[str] = []
    _recorders.append(paths)
    try:
        yield paths
    finally:
        _recorders.pop(next(i for i, known in enumerate(_recorders) if known is paths))


def free(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete tables that are read no more."""
    for path in paths:
        _, store, folder = _store(spark, path)
        store.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name, which may hold ``*``."""
    _, store, folder = _store(spark, path)
    return bool(store.globStatus(folder)) if "*" in path else store.exists(folder)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right below a folder; none if there is no such folder."""
    _, store, folder = _store(spark, path)
    return [entry.getPath().getName() for entry in store.listStatus(folder)] if store.exists(folder) else []


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file through the store's own client; an older one of that name is replaced once this is whole."""
    jvm, store, target = _store(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    stream = store.create(part, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if store.exists(target):
        store.delete(target, False)
    if not store.rename(part, target):
        raise OSError(f"cannot write {path}")


def get_text(spark: SparkSession, path: str) -> str | None:
    """What ``put_text`` wrote there; ``None`` if there is nothing."""
    jvm, store, source = _store(spark, path)
    if not store.exists(source):
        return None
    stream = store.open(source)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def clear(spark: SparkSession) -> None:
    """Delete every table that this application has written to the shared folder.

    Call it when no DataFrame and no stream of any session made with the package is in use any more.
    """
    free(spark, [_own_root(spark)])


def ship(spark: SparkSession) -> None:
    """Send this package to the workers once per application, so that they can import it from anywhere."""
    sc = spark.sparkContext
    if getattr(sc, "_tidewire_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidewire-"), "tidewire_code.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    packed.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._tidewire_shipped = True


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the stored table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_frame(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A few known rows as one partition of literals, with no Python worker behind it."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields

    def record(values):
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, fields)])

    if not rows:
        nothing = record([None] * len(fields))
        return spark.range(0, 0, 1, 1).select(nothing.alias("r")).select("r.*")
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*map(record, rows))))
