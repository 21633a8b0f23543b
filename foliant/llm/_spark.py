"""Session helpers: tables, shared folders and lineage cuts."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on one machine, as in tests, an own one where that is unset."""
    set_by_cluster = spark.conf.get("spark.checkpoint.dir", None)
    if set_by_cluster:
        return set_by_cluster
    ours = spark.sparkContext._jsc.sc().getCheckpointDir()
    if ours.isDefined():
        return ours.get().rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that driver and executors share")
    base = f"file://{tempfile.mkdtemp(prefix='foliant-')}"
    spark.sparkContext.setCheckpointDir(base)
    return base


def cut(df: DataFrame, by_workers: bool = False) -> DataFrame:
    """The rows of ``df``, written once as a table in the shared folder and read again; lost executors cost nothing of it.

    by_workers: Python workers write it, if the folder is one of files; for rows
    that come out of an exchange, and so may lie in very many small partitions.
    For each file and folder that Spark writes there, Hadoop starts a process
    (chmod), which for a moment has the whole memory of the executor's JVM.
    """
    spark = df.sparkSession
    base = shared(spark)
    path = f"{base}/foliant-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_sweep)
    _written.append((spark, path))
    schema = df.schema
    if by_workers and base.startswith("file:"):
        _by_workers(df, "/" + path.removeprefix("file:").lstrip("/"))
    else:
        df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._foliant_path = path
    return out


#: Bytes that a worker holds before it writes them as a row group.
ROW_GROUP = 1 << 24


def _by_workers(df: DataFrame, path: str) -> None:
    """``df`` as Parquet files in the folder ``path``, one a partition that has rows: whole or not at all; a task that runs again replaces its file."""
    os.makedirs(path)

    @tidy
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, held, size = f"{path}/.{uuid.uuid4().hex}", None, [], 0
        for batch in batches:
            if batch.num_rows:
                writer = writer or pq.ParquetWriter(part, batch.schema, store_schema=False)
                held.append(batch)
                size += batch.nbytes
                if size >= ROW_GROUP:
                    writer.write_table(pa.Table.from_batches(held))
                    held, size = [], 0
        if writer:
            if held:
                writer.write_table(pa.Table.from_batches(held))
            writer.close()
            os.replace(part, f"{path}/part-{TaskContext.get().partitionId():05d}.parquet")
        yield from ()

    df.mapInArrow(written, "none int").collect()


_written: list[tuple[SparkSession, str]] = []


def release(*tables: DataFrame) -> None:
    """Deletes tables of ``cut`` (None is passed over) that nothing will read again."""
    for df in tables:
        path = getattr(df, "_foliant_path", None)
        if path:
            _delete(df.sparkSession, path)
            _written[:] = [x for x in _written if x[1] != path]


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _sweep() -> None:
    """Tables of a session go with it."""
    for spark, path in _written:
        with contextlib.suppress(Exception):
            _delete(spark, path)


def tidy(work: Callable) -> Callable:
    """A function of mapInArrow whose worker gives freed memory back at the end of each task: workers live on and add up."""

    @functools.wraps(work)
    def done(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return done


#: Pages of 4 kB that a worker may keep between tasks; giving less back would cost more time than it saves memory.
KEPT_PAGES = 50_000


def give_back() -> None:
    with contextlib.suppress(OSError), open("/proc/self/statm") as f:
        if int(f.read().split()[1]) < KEPT_PAGES:
            return
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def folder(spark: SparkSession, name: str) -> str:
    """A new POSIX folder below the shared one, for files that workers write once and memory-map."""
    base = shared(spark)
    scheme, mark, rest = base.partition(":")
    if mark and scheme not in ("file",) and not base.startswith("/"):
        raise ValueError(f"memory-mapped files need a shared POSIX folder; spark.checkpoint.dir is {base}")
    path = "/" + (rest if mark else base).lstrip("/")
    return f"{path}/{name}-{uuid.uuid4().hex}"


def text_key(text: Column) -> list[Column]:
    """96 bits that name a text: grouping on them groups equal texts without moving them."""
    return [F.xxhash64(text).alias("k1"), F.hash(text, F.lit(17)).alias("k2")]
