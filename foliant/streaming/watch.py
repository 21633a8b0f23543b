"""A watched folder as a stream: every file is taken once, by checkpoint, not by looking at outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import parsing


def watched(spark: SparkSession, path: str, kind: str = "binaryFile", schema: str | None = None, excluded: tuple[int, ...] = ()) -> DataFrame:
    """New files below ``path``; volumes in ``excluded`` are passed over. Writers must move finished files in."""
    reader = spark.readStream.format(kind)
    if schema:
        reader = reader.schema(schema)
    elif kind == "binaryFile":
        reader = reader.schema("path string, modificationTime timestamp, length long, content binary")
    rows = reader.load(path)
    if excluded:
        name = F.col("path") if kind == "binaryFile" else F.input_file_name()
        rows = rows.filter(~F.coalesce(parsing.volume_of(F.url_decode(name)).isin(list(excluded)), F.lit(False)))
    return rows


def drain(stream: DataFrame, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Take all that is there now, write it as Parquet, and stop; a later call takes only what is new."""
    rows = transform(stream) if transform else stream
    rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def counts_by_window(stream: DataFrame, ts: str, keys: list[str], width: str, late: str) -> DataFrame:
    """Counts in event-time windows; rows later than ``late`` are left out."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n"))
