"""Operator 10, token counts of flat, unindexed token files.

A flat file is nothing but token ids, documents ended by one separator id. It
is read in fixed blocks that know nothing of documents. Each block is searched
for the separator with one vectorised comparison; a document that spans blocks
is stitched by a prefix scan over the blocks' summaries (how many separators,
how many ids after the last one). The scan is two-level: inside runs of
RUN_BLOCKS blocks, then over the runs, so one long file does not meet in one
task and no count is made by a single process.

``write_flat`` writes tokenised documents as such files, with a manifest (which
document stands where) that the scan never sees; ``scan_files`` lists files,
plans byte ranges and lets each task read its own, so a file of any length is
spread over all tasks; ``separator_scan`` counts in blocks from anywhere.

Defined results: a null or empty text is a document of the separator alone
(n_tokens 0); ids after a file's last separator are a last, unended document;
an empty file or table gives no rows; repeated rows count each, so ties need no
order; a text of any length is a document over many blocks; extra columns are
ignored; a file that is no whole number of ids is an error.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._spark import cut, folder, tidy
from ._tokens import column_ids

BLOCK_TOKENS = 1 << 18
RUN_BLOCKS = 64


def write_flat(docs: DataFrame, tokenizer: str, separator: int) -> tuple[str, DataFrame]:
    """A shared folder of flat files of little-endian uint16 ids, one a task, and their manifest (file, ordinal, doc_id)."""
    path = folder(docs.sparkSession, "flat")
    os.makedirs(path, exist_ok=True)  # a table without partitions writes nothing

    @tidy
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, ordinal = TaskContext.get().partitionId(), 0
        # whole or not at all; hidden until then, and a task that runs again writes the same
        part = f"{path}/.{name}-{uuid.uuid4().hex}"
        with open(part, "wb") as out:
            for batch in batches:
                for row, chunk, offsets in column_ids(tokenizer, batch.column(1)):
                    stream = np.insert(chunk, offsets[1:], separator)
                    if stream.max(initial=0) > 0xFFFF:
                        raise ValueError("ids do not fit 16 bits")
                    out.write(stream.astype("<u2").tobytes())
                    n = len(offsets) - 1
                    yield pa.RecordBatch.from_pydict({"file": pa.array(np.full(n, name, np.int64)), "ordinal": pa.array(ordinal + np.arange(n)), "doc_id": batch.column(0).slice(row, n).cast(pa.int64())})
                    ordinal += n
        os.replace(part, f"{path}/{name}")

    return path, cut(docs.select("doc_id", "text").mapInArrow(written, "file long, ordinal long, doc_id long"))


def scan_files(spark: SparkSession, path: str, separator: int, id_bytes: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``separator_scan`` of the flat binary files below ``path``; file_id is a file's path."""
    size = block_tokens * id_bytes
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    ranges = files.select(F.col("path").alias("file_id"), "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))).alias("block_no"))
    ranges = ranges.repartition("file_id", "block_no").select("file_id", "block_no", "length")

    @tidy
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, block, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if length % id_bytes:
                    raise ValueError(f"{name}: {length} bytes are no whole number of {id_bytes}-byte ids")
                ids = np.frombuffer(_bytes_at(name, block * size, min(size, length - block * size)), f"<u{id_bytes}")
                yield _found(pa.array([name]), pa.array([block], pa.int64()), [ids], separator)

    return _stitched(ranges.mapInArrow(searched, "file_id string, block_no long, n long, ends array<int>"))


def _bytes_at(name: str, start: int, size: int) -> bytes:
    """From any store that Arrow knows."""
    if name.startswith("file:"):
        name = "/" + name[5:].lstrip("/")
    store, path = (pyarrow.fs.LocalFileSystem(), name) if name.startswith("/") else pyarrow.fs.FileSystem.from_uri(name)
    with store.open_input_file(path) as f:
        return f.read_at(size, start)


def _found(names: pa.Array, blocks: pa.Array, ids: list[np.ndarray], separator: int) -> pa.RecordBatch:
    ends = [np.flatnonzero(x == separator).astype(np.int32) for x in ids]
    return pa.RecordBatch.from_pydict({"file_id": names, "block_no": blocks, "n": pa.array([len(x) for x in ids], pa.int64()), "ends": pa.array(ends, pa.list_(pa.int32()))})


def separator_scan(blocks: DataFrame, separator: int, id_bytes: int = 2) -> DataFrame:
    """One row per document: file_id, ordinal (in its file), start (id offset in its file), n_tokens (without the separator), ended.

    blocks: (file_id, block_no, ids binary little-endian).
    """
    kind = f"<u{id_bytes}"

    @tidy
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(x.as_buffer(), kind) if x.is_valid else np.zeros(0, kind) for x in batch.column(2)]
            yield _found(batch.column(0), batch.column(1), ids, separator)

    named = blocks.schema["file_id"].dataType.simpleString()
    return _stitched(blocks.select("file_id", "block_no", "ids").mapInArrow(searched, f"file_id {named}, block_no long, n long, ends array<int>"))


def _stitched(found: DataFrame) -> DataFrame:
    """Documents from what was found in each block (file_id, block_no, n, ends)."""
    named = found.schema["file_id"].dataType.simpleString()
    # blocks are searched once, whatever the scans read
    found = cut(found).withColumn("run", F.floor(F.col("block_no") / RUN_BLOCKS))
    # the open ids after a block's last separator, or the whole block
    inside = Window.partitionBy("file_id", "run").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumns({
        "n_before": F.coalesce(F.sum("n").over(inside), F.lit(0)),
        "ends_before": F.coalesce(F.sum(F.size("ends")).over(inside), F.lit(0)),
        # position in the run just after the last separator before this block
        "open_at": F.last(F.when(F.size("ends") > 0, F.element_at("ends", -1) + 1), ignorenulls=True).over(inside),
    })
    found = found.withColumn("run_open", F.last(F.when(F.size("ends") > 0, F.struct(F.col("n_before").alias("b"), (F.element_at("ends", -1) + 1).alias("e"))), ignorenulls=True).over(inside))
    runs = found.groupBy("file_id", "run").agg(
        F.sum("n").alias("run_n"), F.sum(F.size("ends")).alias("run_ends"), F.max(F.when(F.size("ends") > 0, F.col("n_before") + F.element_at("ends", -1) + 1)).alias("run_last")
    )
    over = Window.partitionBy("file_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("at", F.coalesce(F.sum("run_n").over(over), F.lit(0)))
    runs = runs.select(
        "file_id",
        "run",
        F.col("at").alias("run_at"),
        F.coalesce(F.sum("run_ends").over(over), F.lit(0)).alias("run_ends_before"),
        F.coalesce(F.max(F.when(F.col("run_last").isNotNull(), F.col("at") + F.col("run_last"))).over(over), F.lit(0)).alias("run_open_at"),
        (F.sum("run_n").over(Window.partitionBy("file_id"))).alias("file_n"),
    )
    block = found.join(runs, ["file_id", "run"])
    begin = F.col("run_at") + F.col("n_before")
    opened = F.coalesce(F.col("run_at") + F.col("run_open.b") + F.col("run_open.e"), F.col("run_open_at"))
    last = begin + F.col("n") == F.col("file_n")
    block = block.select("file_id", "ends", "n", begin.alias("begin"), opened.alias("opened"), (F.col("run_ends_before") + F.col("ends_before")).alias("first"), last.alias("last"))

    @tidy
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (n, begin, opened, first, last) in enumerate(zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)):
                ends = begin + batch.column(1)[k].values.to_numpy().astype(np.int64)
                starts = np.concatenate([[opened], ends + 1])
                ended = np.ones(len(ends), bool)
                if last and starts[-1] < begin + n:
                    ends, ended = np.append(ends, begin + n), np.append(ended, False)
                m = len(ends)
                if m:
                    names = pa.DictionaryArray.from_arrays(pa.array(np.zeros(m, np.int32)), batch.column(0).slice(k, 1)).dictionary_decode()
                    yield pa.RecordBatch.from_arrays([names, pa.array(first + np.arange(m)), pa.array(starts[:m]), pa.array(ends - starts[:m]), pa.array(ended)], ["file_id", "ordinal", "start", "n_tokens", "ended"])

    return block.mapInArrow(listed, f"file_id {named}, ordinal long, start long, n_tokens long, ended boolean")
