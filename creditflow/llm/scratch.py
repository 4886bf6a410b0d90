"""Shared working folders: tables that cut lineage, and files that tasks write.

Everything lies under ``spark.checkpoint.dir``, which driver and executors share; only a local
session may fall back to a folder of its own. Each call takes a fresh folder, so runs never meet.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import time
import uuid
from collections.abc import Iterator
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditflow.session import checkpoint_root


#: The C library's own settings: blocks of a megabyte are mapped and returned, few arenas.
_WORKER_MEMORY = {
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20), "MALLOC_ARENA_MAX": "2",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


#: Rows go to workers in batches of about this size; both sides hold a few copies of one.
_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


class Scratch:
    """One fresh folder for one run of one operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
        self._tables, self._paths = 0, {}
        importable(spark)

    def table(self, df: DataFrame, name: str, instead: str | None = None) -> DataFrame:
        """Write ``df`` and read it back: lost executors cost nothing that lies before it.

        The table named by ``instead``, which nothing reads any more, is deleted once ``df`` is written.
        """
        self._tables += 1
        path = f"{self.root}/{self._tables:03d}-{name}"
        df.write.parquet(path)
        if instead in self._paths:
            old = self.spark._jvm.org.apache.hadoop.fs.Path(self._paths.pop(instead))
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)
        self._paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Let Spark drop shuffle files whose results have been written: no plan needs them.

        Spark drops them when the driver's garbage collector finds that nothing refers to them,
        which may otherwise happen only long after. What one round frees may hold the next.
        """
        for _ in range(2):
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(0.5)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose machines lack that folder, ship the package with ``--py-files``. Workers
    also give freed blocks back to the system, since they are kept and serve later stages.
    """
    home, env = str(Path(__file__).parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, home])
    for name, value in _WORKER_MEMORY.items():
        env.setdefault(name, value)
    if spark.conf.get(_BATCH, None) is None:  # not set by the user
        spark.conf.set(_BATCH, BATCH_BYTES)


def other_columns(df: DataFrame, *but: str) -> Column:
    """The columns of ``df`` but for some as one struct, so that their names meet no others."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns if c not in but)).alias("row")


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder given as path or URI, created if need be."""
    fs, path = pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)
    fs.create_dir(path, recursive=True)
    return fs, path


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 0
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from batches sorted by ``keys``, with the first row of each group.

    A table ends with its last group, so memory holds a batch and one group; with ``rows`` batches
    are gathered to about that many rows first.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < rows or not batch.num_rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        bounds = _bounds(table, keys)
        if len(bounds) > 1:
            yield table.slice(0, bounds[-1]), bounds[:-1]
            table = table.slice(bounds[-1])
        held = table.to_batches()
    if held and sum(b.num_rows for b in held):
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _bounds(table, keys)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for key in keys:
        x = table.column(key).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def return_memory() -> None:
    """Give this worker's freed memory back to the system, where the C library can."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


#: The C library's names for two of the settings of _WORKER_MEMORY, and what a busy step takes instead.
_TRIM, _MMAP, _BUSY_TRIM, _BUSY_MMAP = -1, -3, 64 << 20, 8 << 20


@contextlib.contextmanager
def reused_memory() -> Iterator[None]:
    """Let this worker use its freed blocks again until the step ends, then give them back.

    Blocks that are mapped anew for each array cost a step of many passing arrays as much CPU time as
    its own work. Where the C library can't be told, its settings stay.
    """
    set_ = lambda what, to: None
    with contextlib.suppress(OSError, AttributeError):
        set_ = ctypes.CDLL(None).mallopt
    set_(_TRIM, _BUSY_TRIM)
    set_(_MMAP, _BUSY_MMAP)
    try:
        yield
    finally:
        for what, name in ((_TRIM, "MALLOC_TRIM_THRESHOLD_"), (_MMAP, "MALLOC_MMAP_THRESHOLD_")):
            set_(what, int(os.environ.get(name) or _WORKER_MEMORY[name]))
        return_memory()


def reusing(step):
    """``step`` over batches, for ``mapInArrow``, under :func:`reused_memory`."""
    return partial(_reusing, step)


def _reusing(step, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with reused_memory():
        yield from step(batches)


def narrow(function, *args):
    """``function`` with leading arguments bound, for ``mapInArrow``."""
    return partial(function, *args)


def chained(*steps):
    """``steps`` over batches one after another, for one ``mapInArrow``.

    A ``mapInArrow`` on top of another one holds two Python workers in each task, which Spark keeps.
    """
    return partial(_through, steps)


def _through(steps, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for step in steps:
        batches = step(batches)
    return batches
