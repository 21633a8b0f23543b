"""File sources and sinks. Paths may lie on any store that Spark reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import parsing


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): one row a file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def lossy_texts(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """(path, text): bytes that are no UTF-8 become replacement characters."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def volumes(spark: SparkSession, path: str) -> DataFrame:
    """(number, display, authors, path) from the names of the files "Volume N - Names.txt" below ``path``."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path")
    named = found.withColumn("v", parsing.volume_name(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))))
    return named.filter("v.number is not null").select("v.number", "v.display", parsing.name_list(F.col("v.display")).alias("authors"), "path")


def pdf_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.{pdf,PDF}").load(path)


def pdf_pages(files: DataFrame, offset: int = 0) -> DataFrame:
    """(path, page, width, height, x0, y0, x1, y1, text, btype) of binary files; page = i + 1 - offset, from 1. Needs a PDF library on the workers."""
    import pandas as pd

    def pages(frames):
        import fitz

        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                with fitz.open(stream=bytes(content), filetype="pdf") as doc:
                    for i, page in enumerate(doc):
                        rows = [(path, i + 1 - offset, page.rect.width, page.rect.height, *b[:5], b[6]) for b in page.get_text("blocks") if i + 1 - offset >= 1]
                        yield pd.DataFrame(rows, columns=["path", "page", "width", "height", "x0", "y0", "x1", "y1", "text", "btype"])

    return files.select("path", "content").mapInPandas(pages, "path string, page int, width double, height double, x0 double, y0 double, x1 double, y1 double, text string, btype int")


def listing(spark: SparkSession, files: list[tuple[str, int]] | DataFrame) -> DataFrame:
    """(vol, name, size) of a remote listing's PDF files (name, size), by volume, those without a number last."""
    rows = files if isinstance(files, DataFrame) else spark.createDataFrame(files, "name string, size long")
    rows = rows.filter(F.lower("name").endswith(".pdf"))
    return rows.select(parsing.volume_of(F.col("name")).alias("vol"), "name", "size").orderBy(F.col("vol").asc_nulls_last(), "name")


def listing_report(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("files"), F.round(F.sum("size") / 1e9, 2).alias("gb"))


def missing(wanted: DataFrame, have: DataFrame, key: str) -> DataFrame:
    return wanted.join(have.select(key).distinct(), key, "left_anti")


def require(value: Column, message: str) -> Column:
    """``value``, or an error that stops the query where it is null."""
    return F.coalesce(value, F.raise_error(F.lit(message)).cast("int"))


def preferred(paths: list[str], exists) -> str | None:
    """The first of several folders for which ``exists`` holds."""
    return next((p for p in paths if exists(p)), None)


def write_texts(rows: DataFrame, path: str, key: str, text: str = "text") -> None:
    """One text file a key, in a folder of its own."""
    rows.select(key, text).repartition(key).write.mode("overwrite").partitionBy(key).text(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """Header and all fields as text; null is empty."""
    rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns]).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def replace_partitions(rows: DataFrame, path: str, key: str, keys: list | None = None) -> None:
    """Delete, then load: the partitions that ``rows`` has are replaced, those of ``keys`` that it lacks go, all others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
    loaded = {r[0] for r in rows.select(key).distinct().collect()} if keys else set()
    jvm, conf = rows.sparkSession.sparkContext._jvm, rows.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for k in set(keys or ()) - loaded:
        where = jvm.org.apache.hadoop.fs.Path(f"{path}/{key}={k}")
        where.getFileSystem(conf).delete(where, True)


def init_tables(spark: SparkSession, tables: dict[str, str], path: str) -> None:
    """Empty tables of these schemas where there are none yet."""
    for name, schema in tables.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet LOCATION '{path}/{name}'")


def reset_tables(spark: SparkSession, tables: dict[str, str], path: str) -> None:
    """Tables of these schemas, empty: those there are go with their files."""
    jvm = spark.sparkContext._jvm
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        where = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    init_tables(spark, tables, path)


def file_name(name: Column, known: Column) -> Column:
    """A chapter's file: the known one, or one derived from its name ("GOOD AND EVIL" to "Good & Evil.txt")."""
    from foliant.functions.text import title_case

    return F.coalesce(known, F.concat(F.replace(title_case(name), F.lit(" And "), F.lit(" & ")), F.lit(".txt")))


def chapter_file(name: Column, intro: Column, outline: Column, refs: Column, crossrefs: Column) -> Column:
    """A chapter's file: its sections under their headers, empty ones left out."""
    part = lambda header, body: F.when(F.length(body) > 0, F.concat(F.lit(f"{header}\n\n"), body))
    return F.concat_ws("\n\n", F.concat(F.lit("CHAPTER: "), name), part("INTRODUCTION", intro), F.when(F.length(outline) > 0, outline), part("REFERENCES", refs), F.when(F.length(crossrefs) > 0, crossrefs))


def combined_file(intro: Column, outline: Column, refs: Column, crossrefs: Column, additional: Column) -> Column:
    """As ``chapter_file``; a chapter without references says so."""
    return F.concat_ws("\n\n", F.nullif(intro, F.lit("")), F.nullif(outline, F.lit("")), F.concat(F.lit("REFERENCES\n\n"), F.coalesce(F.nullif(refs, F.lit("")), F.lit("[sem referências]"))), F.nullif(crossrefs, F.lit("")), F.nullif(additional, F.lit("")))


def map_file(number: Column, name: Column, refs: Column) -> Column:
    return F.when(F.length(refs) > 0, F.concat(F.lit("Chapter "), number.cast("string"), F.lit(": "), name, F.lit("\n\n"), refs))


def as_json(row: Column) -> Column:
    return F.to_json(row)
