"""Building the catalogue's tables from parsed rows: volumes, references, the star schema for export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions import parsing, similarity, text as T

from .catalogue import first_seen, get_or_create_authors, get_or_create_works


def author_key(name: Column) -> Column:
    """What names of one author have in common: canonical letters, or the lower-cased name without any."""
    return F.coalesce(parsing.or_null(similarity.canonical(name)), F.lower(name))


def index_volumes(volumes: DataFrame) -> dict[str, DataFrame]:
    """volumes (number, display, path) as tables: volumes, authors, works (one placeholder a volume and author) and authorships."""
    listed = volumes.withColumn("names", parsing.name_list(F.col("display")))
    split = listed.select(F.col("number").alias("volume_id"), F.posexplode("names").alias("nth", "name")).withColumn("at", F.col("volume_id") * 1000 + F.col("nth"))
    authors = get_or_create_authors(split, "name", "volume_id", "at")
    works = get_or_create_works(split, "volume_id", "name", "at")
    return {
        "volumes": listed.select("number", F.col("display").alias("display_name"), F.array_join("names", ", ").alias("authors"), F.lit("").alias("works"), F.col("path").alias("txt_path"), F.col("number").isin(2, 3).alias("is_index")),
        "authors": authors,
        "works": works,
        "authorships": _authorships(split, authors, works),
    }


def _authorships(rows: DataFrame, authors: DataFrame, works: DataFrame) -> DataFrame:
    """Distinct (author_id, work_id) of rows (volume_id, name): author by name and volume, work by name and volume."""
    a = authors.select(F.col("id").alias("author_id"), F.col("number").alias("volume_id"), author_key(F.col("name")).alias("k"))
    w = works.select(F.col("id").alias("work_id"), "volume_id", "title_norm")
    keyed = rows.select("volume_id", author_key(F.col("name")).alias("k"), F.lower(F.trim("name")).alias("title_norm"))
    return keyed.join(a, ["volume_id", "k"]).join(w, ["volume_id", "title_norm"]).select("author_id", "work_id").distinct()


def build_references(citations: DataFrame, volume_of: DataFrame, topics: DataFrame) -> dict[str, DataFrame]:
    """authors, works, authorships and references of citations.

    citations: (position, idea_number, topic_label, author_number, author,
    work, page_start, page_end, cited); volume_of: (author_number, volume_id);
    topics: (idea_number, label). Citations of unknown volumes are dropped
    first; those of unknown topics only after the dimensions were made.
    """
    known = citations.join(volume_of, "author_number")
    authors = get_or_create_authors(known, "author", "author_number", "position")
    works = get_or_create_works(known, "volume_id", "work", "position")
    a = authors.select(F.col("id").alias("author_id"), F.col("number").alias("author_number"), author_key(F.col("name")).alias("author_key"))
    w = works.select(F.col("id").alias("work_id"), "volume_id", "title_norm")
    placed = known.withColumns({"author_key": author_key(F.col("author")), "title_norm": F.lower(F.trim("work"))}).join(a, ["author_number", "author_key"]).join(w, ["volume_id", "title_norm"])
    ref_text = F.coalesce(parsing.or_null(F.col("cited")), F.col("work"))
    kept = placed.join(topics.select("idea_number", F.col("label").alias("topic_label")), ["idea_number", "topic_label"], "left_semi")
    return {
        "authors": authors,
        "works": works,
        "authorships": placed.select("author_id", "work_id").distinct(),
        "references": kept.select("position", "idea_number", "topic_label", "author_id", "work_id", "page_start", "page_end", ref_text.alias("ref_text")),
    }


def star_schema(rows: DataFrame) -> dict[str, DataFrame]:
    """The eight export tables of structured references (number, name, ord, code, description, refs); ids follow first appearance."""
    at = F.col("number") * 100_000 + F.col("ord")
    rows = rows.withColumn("at", at.cast("long"))
    topics = rows.groupBy("number", "name").agg(F.array_sort(F.collect_list(F.struct("ord", "code", "description"))).alias("s"))
    topic = topics.select(F.col("number").alias("id"), F.lit(1).alias("referrer_id"), T.title_case(F.lower("name")).alias("name"), F.to_json(F.transform("s", lambda x: F.struct(x["code"].alias("id"), x["description"].alias("desc")))).alias("subtopics"))
    ids = first_seen(rows, ["number", "code"], "at")
    subtopic = rows.join(ids, ["number", "code"]).select("id", F.col("number").alias("topic_id"), F.col("code").alias("alt_id"), F.lit(1).alias("referrer_id"), "description")
    lines = rows.select("number", "code", "at", F.posexplode("refs").alias("k", "line")).withColumns({"p": F.col("at") * 1000 + F.col("k"), "r": parsing.csv_reference(F.col("line"))})
    lines = lines.filter("r.number is not null").select("number", "code", "p", F.col("r.number").cast("int").alias("volume"), F.col("r.author").alias("author"), F.col("r.title").alias("title"), "r.page_start", "r.page_end", F.left("line", F.lit(299)).alias("notes"))
    author = first_seen(lines, ["author"], "p")
    work = first_seen(lines, ["volume", "author", "title"], "p")
    reference = (
        lines.join(author.withColumnRenamed("id", "author_id"), "author")
        .join(work.withColumnRenamed("id", "work_id"), ["volume", "author", "title"])
        .join(ids.withColumnRenamed("id", "subtopic_id"), ["number", "code"])
    )
    numbered = first_seen(reference, ["p"], "p").join(reference, "p")
    dash = F.lit("—")
    return {
        "referrer": rows.sparkSession.range(1, 2).select("id", F.lit(1).alias("user_id"), F.lit("").alias("last_name"), F.lit("").alias("first_name")),
        "author": author.select("id", T.title_case(F.lower("author")).alias("last_name"), F.lit("").alias("first_name")),
        "work": work.join(author.withColumnRenamed("id", "author_id"), "author").select("id", F.col("volume").alias("volume_id"), "author_id", "author", "title", F.lit("").alias("translator")),
        "topic": topic,
        "subtopic": subtopic,
        "summary": numbered.select("id", dash.alias("summary"), F.col("code").alias("alt_id")),
        "excerpt": numbered.select("id", F.col("code").alias("alt_id"), dash.alias("text"), F.col("id").alias("reference_id")),
        "reference": numbered.select("id", F.col("number").alias("topic_id"), "subtopic_id", "author_id", "work_id", "author", "volume", "page_start", "page_end", "notes", F.col("id").alias("summary_id"), F.col("id").alias("excerpt_id"), F.lit(1).alias("referrer_id"), F.lit(0).alias("upvotes"), F.lit(0).alias("downvotes")),
    }


def with_fallback(chapters: DataFrame, other: DataFrame, key: str, column: str) -> DataFrame:
    """``chapters`` with an empty ``column`` filled from ``other``."""
    spare = other.select(key, F.col(column).alias("_spare"))
    return chapters.join(spare, key, "left").withColumn(column, F.coalesce(parsing.or_null(F.col(column)), "_spare", F.lit(""))).drop("_spare")


def intro_start(text: Column, name: Column, begin: Column, end: Column) -> Column:
    """Position (from 0) of the block with the rightmost "NAME ... INTRODUCTION" (at most 400 characters apart) in [begin, end); -1 if none."""
    part = F.substr(text, (begin + 1).cast("int"), (end - begin).cast("int"))
    anchor = F.concat(F.regexp_replace(F.left(name, F.lit(4)), r"([^\p{L}\p{N}])", r"\\$1"), F.lit(r"\S*.{0,400}?INTRODUCTION\b"))
    before = F.concat(F.lit(r"(?is)^(.*)\b"), anchor)
    upto = F.call_function("regexp_extract", part, before, F.lit(0))
    start = F.length(F.call_function("regexp_extract", part, before, F.lit(1)))
    block = F.length(F.regexp_extract(F.substr(part, F.lit(1), start), r"(?s)^(.*\n\n)", 1))
    near = (block > 0) & (start - block <= 50)
    return F.when(upto == "", -1).otherwise(begin + F.when(near, block).otherwise(start))


def chapter_map(pages: DataFrame, key: str, last_wins: bool = True) -> DataFrame:
    """(number, name, key): the page on whose first 600 characters a chapter's header stands; of several the last or the first."""
    head = F.left("text", F.lit(600))
    shape = r"(?i)Chapter\s+([0-9]{1,3})\s*[:.]\s*([A-Z][A-Z &/-]{2,})"
    found = pages.withColumn("number", F.regexp_extract(head, shape, 1).try_cast("int")).filter("number is not null").withColumn("name", T.strip(F.upper(F.regexp_extract(head, shape, 2))))
    pick = F.max_by if last_wins else F.min_by
    return found.groupBy("number").agg(pick(F.struct("name", key), F.struct(key)).alias("b")).select("number", "b.*")


def better_intro(old: Column, new: Column, least: int = 500, gain: float = 1.05) -> Column:
    """``new`` if it is long enough and by that factor longer, else ``old``."""
    return F.when((F.length(new) > least) & (F.length(new) > F.length(F.coalesce(old, F.lit(""))) * gain), new).otherwise(old)
