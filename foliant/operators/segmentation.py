"""Ordered text: lines, marked pages, chapters, paragraphs.

Input rows carry their order (``line_no``); nothing relies on the order in
which rows happen to arrive. Segments are islands of a running sum over the
lines of one document, so documents spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import parsing, text as T

MARKER = r"^\s*\[([0-9]{1,4}[a-d]?)\](?:\s|$)"
MARKER_ANYWHERE = r"\[([0-9]{1,4}[a-d]?)\](?=\s|$)"
ILLUSTRATED = "[página ilustrada]"


def lines(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, line_no from 1, line)."""
    return docs.select(key, F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)


def ordered_text(order: str, line: str, separator: str = "\n") -> Column:
    """Aggregate: the lines of a group in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line))), lambda x: x[line]), separator)


def up_to_here(key: str, order: str = "line_no"):
    return Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def marked_pages(rows: DataFrame, key: str, least_words: int = 5) -> DataFrame:
    """Pages of marked text: (key, page_marker, text_offset, text, word_count) of rows (key, line_no, line).

    A page runs from its marker (the first one of a line) to the next; what
    stands before the first marker is dropped, and so are pages that are
    illustrated or have under ``least_words`` words. text_offset counts
    characters, line breaks included, before the marker.
    """
    rows = rows.withColumn("mark", parsing.or_null(F.regexp_extract("line", MARKER_ANYWHERE, 1)))
    w = up_to_here(key)
    rows = rows.withColumns({
        "page": F.sum(F.col("mark").isNotNull().cast("int")).over(w),
        "before": F.sum(F.length("line") + 1).over(w) - F.length("line") - 1,
        "at": F.regexp_instr("line", F.lit(MARKER_ANYWHERE)) - 1,
    })
    body = F.when(F.col("mark").isNotNull(), F.substr("line", F.col("at") + F.length("mark") + 3)).otherwise(F.col("line"))
    pages = (
        rows.filter("page > 0")
        .withColumn("body", body)
        .groupBy(key, "page")
        .agg(F.max("mark").alias("page_marker"), F.max(F.when(F.col("mark").isNotNull(), F.col("before") + F.col("at"))).cast("long").alias("text_offset"), T.strip(ordered_text("line_no", "body")).alias("text"))
    )
    pages = pages.withColumn("word_count", T.word_count(F.col("text")))
    return pages.filter((F.col("text") != "") & (F.col("text") != ILLUSTRATED) & (F.col("word_count") >= least_words)).select(key, "page_marker", "text_offset", "text", "word_count")


def join_split_headers(rows: DataFrame, key: str) -> DataFrame:
    """A chapter header broken after its number takes the next line in; that line goes, numbers stay."""
    w = Window.partitionBy(key).orderBy("line_no")
    open_header = lambda c: c.rlike(r"(?i)^\s*Chapter\s*[ivxlcdm0-9S]{1,5}\s*$")
    after = F.lead("line").over(w)
    joined = open_header(F.col("line")) & after.rlike(r"^\s*[:.]")
    rows = rows.withColumns({"whole": F.when(joined, F.concat(T.strip(F.col("line")), T.strip(after))).otherwise(F.col("line")), "taken": F.coalesce(open_header(F.lag("line").over(w)) & F.col("line").rlike(r"^\s*[:.]"), F.lit(False))})
    return rows.filter(~F.col("taken")).select(key, "line_no", F.col("whole").alias("line"))


def _with_starts(rows: DataFrame, key: str) -> DataFrame:
    """(key, line_no, line, c): c is (number, name, start) on the line where a chapter starts, else null; all windows share one exchange."""
    rows = join_split_headers(rows, key)
    header = F.col("line").rlike(parsing.CHAPTER)
    raw, name = F.regexp_extract("line", parsing.CHAPTER, 1), T.clean_idea_name(F.regexp_extract("line", parsing.CHAPTER, 2))
    rows = rows.withColumn("raw", F.when(header, raw)).withColumn("name", F.when(header, name)).withColumn("number", F.when(header, parsing.chapter_number(F.col("raw"), F.col("name"))))
    order = F.struct((F.col("name") != F.upper("name")).alias("small"), "line_no")
    best = F.min(F.when(F.col("number").isNotNull(), order)).over(Window.partitionBy(key, "number"))
    return rows.select(key, "line_no", "line", F.when(best["line_no"] == F.col("line_no"), F.struct("number", "name", F.col("line_no").alias("start"))).alias("c"))


def chapter_starts(rows: DataFrame, key: str) -> DataFrame:
    """(key, number, name, line_no, next_line): one start a chapter, names in capitals preferred, then the earliest line; next_line by line order."""
    best = _with_starts(rows, key).filter("c is not null")
    return best.select(key, "c.number", "c.name", "line_no", F.lead("line_no").over(Window.partitionBy(key).orderBy("line_no")).alias("next_line"))


def chapter_lines(rows: DataFrame, key: str) -> DataFrame:
    """(key, number, name, line_no, line) of the lines below each chapter's header."""
    held = _with_starts(rows, key).withColumn("c", F.last("c", ignorenulls=True).over(up_to_here(key)))
    return held.filter(F.col("c").isNotNull() & (F.col("line_no") > F.col("c.start"))).select(key, "c.number", "c.name", "line_no", "line")


def paragraphs(rows: DataFrame, key: str) -> DataFrame:
    """(key, para, text): lines between blank ones joined by one space; noise lines are left out."""
    rows = rows.filter(~T.is_noise_line(F.col("line"))).withColumn("blank", T.strip(F.col("line")) == "")
    rows = rows.withColumn("island", F.sum(F.col("blank").cast("int")).over(up_to_here(key))).filter(~F.col("blank"))
    joined = rows.withColumn("part", T.strip(F.col("line"))).groupBy(key, "island").agg(ordered_text("line_no", "part", " ").alias("text"))
    return joined.select(key, F.row_number().over(Window.partitionBy(key).orderBy("island")).alias("para"), "text")


def structured_references(rows: DataFrame, key: str) -> DataFrame:
    """(key, number, name, ord, code, description, refs) of the format "§==Chapter N: NAME==", "#code. description", reference lines.

    Lines before a chapter's first subtopic are dropped; of chapters with one number the last counts.
    """
    chapter, sub = r"^§==Chapter\s+([0-9]+):\s*(.*?)\s*==", r"^#\s*(\S+?)\.\s*(.*)$"
    w = up_to_here(key)
    line = T.strip(F.col("line"))
    rows = rows.withColumn("line", line).filter("line != ''")
    rows = rows.withColumn("chapter", F.last(F.when(F.col("line").rlike(chapter), F.struct("line_no", F.regexp_extract("line", chapter, 1).try_cast("int").alias("number"), F.upper(F.regexp_extract("line", chapter, 2)).alias("name"))), ignorenulls=True).over(w)).filter("chapter is not null")
    inside = Window.partitionBy(key, "chapter.line_no").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("sub", F.last(F.when(F.col("line").rlike(sub), F.struct("line_no", F.regexp_extract("line", sub, 1).alias("code"), F.regexp_extract("line", sub, 2).alias("description"))), ignorenulls=True).over(inside)).filter("sub is not null")
    latest = F.max("chapter.line_no").over(Window.partitionBy(key, "chapter.number"))
    rows = rows.withColumn("latest", latest).filter("chapter.line_no = latest")
    grouped = rows.groupBy(key, F.col("chapter.number").alias("number"), F.col("chapter.name").alias("name"), F.col("sub.line_no").alias("at"), F.col("sub.code").alias("code"), F.col("sub.description").alias("description"))
    refs = F.transform(F.array_sort(F.collect_list(F.when(F.col("line_no") > F.col("sub.line_no"), F.struct("line_no", "line")))), lambda x: x["line"])
    out = grouped.agg(refs.alias("refs"))
    return out.select(key, "number", "name", F.row_number().over(Window.partitionBy(key, "number").orderBy("at")).alias("ord"), "code", "description", "refs")


#: Headers of an index's front matter and their order. Headers that hold a work's own title come as a parameter.
FRONT_MATTER = {"PREFACE": 1, "EXPLANATION OF REFERENCE STYLE": 2}


def front_matter(rows: DataFrame, key: str, headers: dict[str, int] | None = None) -> DataFrame:
    """(key, section, ord, body): first header of each kind that prose follows within five lines; to the next header or chapter.

    A header may have a page number of at most 8 characters behind it. Such
    lines stand at the head of pages too, and are left out of bodies, as are
    page marks and scraps; a body's paragraphs are parted by blank lines.
    """
    headers = headers or FRONT_MATTER
    table = F.create_map(*[F.lit(x) for pair in headers.items() for x in pair])
    w = Window.partitionBy(key).orderBy("line_no")
    prose = F.col("line").rlike(r"\p{Ll}") & (F.length(T.strip(F.col("line"))) >= 30)
    soon = F.coalesce(F.max(prose.cast("int")).over(w.rowsBetween(1, 5)) == 1, F.lit(False))
    stop = F.col("line").rlike(r"^\s*Chapteri?\s*[:0-9]")
    line = T.strip(F.col("line"))
    title = F.lit(None).cast("string")
    for h in sorted(headers, key=len):
        title = F.when(F.upper(line).startswith(h) & (F.length(line) <= len(h) + 8), h).otherwise(title)
    rows = rows.withColumn("title", title).withColumn("opens", F.when(soon, F.col("title")))
    first = F.row_number().over(Window.partitionBy(key, "opens").orderBy("line_no")) == 1
    rows = rows.withColumn("bound", F.when(F.col("opens").isNotNull() & first, F.col("opens")).when(stop, ""))
    rows = rows.withColumn("section", F.last("bound", ignorenulls=True).over(up_to_here(key)))
    kept = rows.filter((F.col("section") != "") & F.col("title").isNull() & ~T.is_noise_line(F.col("line")))
    blank = line == ""
    in_section = Window.partitionBy(key, "section").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = kept.withColumn("island", F.sum(blank.cast("int")).over(in_section)).filter(~blank).withColumn("part", line)
    paragraphs = kept.groupBy(key, "section", "island").agg(ordered_text("line_no", "part", " ").alias("text"))
    body = paragraphs.groupBy(key, "section").agg(ordered_text("island", "text", "\n\n").alias("body"))
    return body.select(key, "section", F.coalesce(F.try_element_at(table, F.col("section")), F.lit(99)).alias("ord"), "body")


def idea_bodies(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, introduction, cross_references) of chapter lines: before the outline; between cross-references and additional readings."""
    line = T.strip(F.col("line"))
    at = lambda pattern: F.min(F.when(line.rlike(pattern), F.col("line_no")))
    bounds = rows.groupBy(*keys).agg(at(r"(?i)^OUTLINE\s+OF\s+TOPICS$").alias("outline"), at(r"(?i)^(THE GREAT IDEAS\s+)?CROSS[- ]REFERENCES?$").alias("cross"), at(r"(?i)^ADDITIONAL READINGS$").alias("more"))
    placed = rows.join(bounds, keys).filter(~T.is_noise_line(F.col("line")))
    far = F.lit(1 << 30)
    part = F.when(F.col("line_no") < F.coalesce("outline", far), "i").when((F.col("line_no") > F.col("cross")) & (F.col("line_no") < F.coalesce("more", far)), "c")
    text = lambda k: F.coalesce(T.strip(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(part == k, F.struct("line_no", "line")))), lambda x: x["line"]), "\n")), F.lit(""))
    return placed.groupBy(*keys).agg(text("i").alias("introduction"), text("c").alias("cross_references"))
