"""Dimensions, counts, and catalogue reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import parsing
from foliant.sources.shared import cut


def counted(parents: DataFrame, key: str, children: DataFrame, child_key: str | None = None, name: str = "n", distinct: str | None = None) -> DataFrame:
    """``parents`` with the number of ``children`` rows (or of distinct values) of each; 0 without any.

    The children are added up before they meet the parents.
    """
    child_key = child_key or key
    n = F.count_distinct(distinct) if distinct else F.count("*")
    counts = children.groupBy(F.col(child_key).alias(key)).agg(n.alias(name))
    return parents.join(counts, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def counted_by(parents: DataFrame, keys: list[str], children: DataFrame, name: str = "n") -> DataFrame:
    counts = children.groupBy(*keys).agg(F.count("*").alias(name))
    return parents.join(counts, keys, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def best_per_group(rows: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in ``order``, which must name ties apart."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter("_rank = 1").drop("_rank")


def first_seen(rows: DataFrame, key: list[str], position: str, name: str = "id") -> DataFrame:
    """A dimension of the distinct keys, numbered from 1 in order of first appearance.

    The numbering sorts by range; each partition is numbered by itself and then
    lifted by the sizes of those before it, so no task sees all keys.
    """
    dims = rows.groupBy(*key).agg(F.min(position).alias("_first"))
    dims = dims.repartitionByRange("_first", *key).sortWithinPartitions("_first", *key)
    dims = dims.withColumn("_part", F.spark_partition_id())
    # written once: what follows reads it twice and must see the same partitions
    own = cut(dims.withColumn("_nth", F.row_number().over(Window.partitionBy("_part").orderBy("_first", *key))))
    # (partitions) rows: their sizes, added up
    lifts = own.groupBy("_part").agg(F.count("*").alias("_size")).withColumn("_lift", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return own.join(F.broadcast(lifts.select("_part", "_lift")), "_part").select((F.col("_lift") + F.col("_nth")).cast("long").alias(name), *key)


def get_or_create_authors(rows: DataFrame, name: str, number: str, position: str) -> DataFrame:
    """Authors (id, name, number): names under 3 letters become "Author N" or "Unknown"; one for each canonical name and number, first spelling kept."""
    from foliant.functions.similarity import canonical

    clean = F.when(F.length(F.trim(name)) >= 3, F.trim(name)).otherwise(F.coalesce(F.concat(F.lit("Author "), F.col(number).cast("string")), F.lit("Unknown")))
    keyed = rows.select(clean.alias("name"), F.col(number).alias("number"), F.col(position).alias("_at")).withColumn("_canon", F.coalesce(parsing.or_null(canonical(F.col("name"))), F.lower("name")))
    named = keyed.groupBy("_canon", "number").agg(F.min_by("name", F.struct("_at", "name")).alias("name"), F.min("_at").alias("_at"))
    return first_seen(named, ["name", "number"], "_at")


def get_or_create_works(rows: DataFrame, volume: str, title: str, position: str) -> DataFrame:
    """Works (id, volume_id, title, title_norm): one for each volume and lower-cased title, first spelling kept."""
    keyed = rows.select(F.col(volume).alias("volume_id"), F.trim(title).alias("title"), F.lower(F.trim(title)).alias("title_norm"), F.col(position).alias("_at"))
    named = keyed.groupBy("volume_id", "title_norm").agg(F.min_by("title", F.struct("_at", "title")).alias("title"), F.min("_at").alias("_at"))
    return first_seen(named, ["volume_id", "title_norm", "title"], "_at").select("id", "volume_id", "title", "title_norm")


def cascade_match(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], left_id: str, right_id: str) -> DataFrame:
    """``left`` matched to one ``right`` row by the first key pair that agrees; least right id among several."""
    tries = None
    for rank, (a, b) in enumerate(keys):
        hit = left.select(left_id, F.col(a).alias("_k")).filter("_k is not null and _k != ''").join(right.select(F.col(right_id), F.col(b).alias("_k")), "_k").select(left_id, right_id, F.lit(rank).alias("matched_by"))
        tries = hit if tries is None else tries.unionByName(hit)
    return tries.groupBy(left_id).agg(F.min(F.struct("matched_by", right_id)).alias("m")).select(left_id, f"m.{right_id}", "m.matched_by")


def page_range(pages: DataFrame, volume: int, start: str, end: str) -> DataFrame:
    """Pages of a volume with numbers between those of two markers (swapped if reversed), in the order of their names."""
    number = lambda c: F.regexp_replace(c, "[a-d]$", "").try_cast("int")
    a, b = number(F.lit(start)), number(F.lit(end))
    return pages.filter((F.col("volume_id") == volume) & number(F.col("page_marker")).between(F.least(a, b), F.greatest(a, b))).orderBy("page_marker", "text_offset")


def pages_of(pages: DataFrame, markers: DataFrame) -> DataFrame:
    """``pages`` whose (volume_id, page_marker) is in a list of markers of any length."""
    return pages.join(markers.select("volume_id", "page_marker").distinct(), ["volume_id", "page_marker"], "left_semi")


def references_on_pages(references: DataFrame, pages: DataFrame) -> DataFrame:
    """Each page marker with the references that begin on it; a reference without a column begins in column a.

    references: (volume_id, page_start, ...); pages: (volume_id, page_marker).
    """
    m = parsing.marker(F.col("page_start"))
    keyed = references.withColumn("page_marker", F.concat(m["page"].cast("string"), F.coalesce(m["col"], F.lit("a")))).filter("page_marker is not null")
    return pages.select("volume_id", "page_marker").distinct().join(keyed, ["volume_id", "page_marker"])


def merge_volumes(chapters: DataFrame, ranges: list[tuple[int, int, int]]) -> DataFrame:
    """Chapters (volume_id, number, ...) of several volumes as one list: of each volume those in its range (volume, first, last)."""
    own = F.lit(False)
    for volume, first, last in ranges:
        own = own | ((F.col("volume_id") == volume) & F.col("number").between(first, last))
    return chapters.filter(own)


def order_key(label: Column) -> list[Column]:
    """Topics without a parent first, then by number, then by label."""
    return [parsing.parent_label(label).isNotNull(), parsing.label_number(label), label]


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: list[Column] | None = None) -> DataFrame:
    """``old`` with rows of ``new`` in place of those with their key; of several new ones the first in ``order`` (or of the greatest values)."""
    rest = [c for c in old.columns if c not in key]
    latest = best_per_group(new, key, order or [F.desc(c) for c in rest]).select(*old.columns)
    return old.join(latest.select(*key), key, "left_anti").unionByName(latest)


def insert_ignore(old: DataFrame, new: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """``old`` and the first of ``new`` for each key that ``old`` lacks."""
    return old.unionByName(best_per_group(new.join(old.select(*key), key, "left_anti"), key, order).select(*old.columns))


def remap(references: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """``references`` with ids of ``column`` moved along ``mapping`` (variant, canonical)."""
    m = mapping.select(F.col("variant").alias(column), F.col("canonical").alias("_to"))
    return references.join(m, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to").select(*references.columns)


def merge_works(works: DataFrame, authorships: DataFrame, references: DataFrame, mapping: DataFrame) -> dict[str, DataFrame]:
    """The tables after variants (mapping: variant, canonical) are merged into their works: references moved, authorships united, variants gone."""
    variants = mapping.filter("variant != canonical")
    return {
        "works": works.join(variants.select(F.col("variant").alias("id")), "id", "left_anti"),
        "authorships": remap(authorships, "work_id", variants).distinct(),
        "references": remap(references, "work_id", variants),
    }


def build_statistics(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n_rows): the size of each table of a build, counted where its rows lie."""
    counts = None
    for name, rows in tables.items():
        one = rows.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


# Invariants.


def orphans(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    return rows.join(parents.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def duplicates(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("c")).filter("c > 1")


def missing_numbers(rows: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """Numbers from ``first`` to ``last`` that do not occur."""
    return rows.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias(column)).join(rows.select(F.col(column).cast("int")).distinct(), column, "left_anti")


def share(condition: Column) -> Column:
    """Aggregate: the share of rows for which a condition holds."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("int"))
