"""Folds whose state depends on every line before: one chapter or volume a group.

Lines are classified by native expressions first; Python sees only the lines
that matter, dealt by chapter (small by nature) and sorted, and folds one
chapter after the other.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import count, groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from foliant.functions import parsing, text as T

# The formats of section headers, stop lines and continuations.
OUTLINE_HEADER = r"(?i)^OUTLINE\s+OF\s+TOPICS$"
REFERENCES_HEADER = r"(?i)^REFERENCES$"
CROSS_LINE = r"(?i)\bCROSS[- ]REFERENCES?\b|^\s*For\s*[:.]|^\s*For\s+another\b"
CONTINUED = r"(?i)^\s*(?:q\s|qq\s|a\s|aa\s|ans|rep|ch|chapter|bk\s|book\s|part\s|section\s|sect\s|vol\s|volume\s|tome\s|tr\s|[0-9]+\s*\.)"


def folded(rows: DataFrame, keys: list[str], order: str, fold: Callable[[list[tuple]], Iterable[tuple]], out: str) -> DataFrame:
    """(keys, out) of ``fold`` over each group's rows, tuples of the columns but the keys, in ``order``; a task holds one group at a time."""
    rest = [c for c in rows.columns if c not in keys]
    schema = StructType([*[f for f in rows.schema.fields if f.name in keys], *_parse_datatype_string(out).fields])
    arrow = to_arrow_schema(schema)
    rows = rows.select(*keys, *rest)
    schema = StructType([schema[k] for k in keys] + [f for f in schema.fields if f.name not in keys])
    arrow = to_arrow_schema(schema)

    def tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for key, group in groupby(tuples(batches), key=lambda r: r[: len(keys)]):
            held += [(*key, *r) for r in fold([r[len(keys) :] for r in group])]
            if len(held) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)

    return rows.repartition(*keys).sortWithinPartitions(*keys, order).mapInArrow(each, schema)


def _parts(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Lines with kind and section (0 before the outline, 1 in it, 2 in the references, 3 after)."""
    line = T.strip(F.col("line"))
    w = Window.partitionBy(*keys).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = lambda c: F.max(c.cast("int")).over(w)
    lines = lines.withColumn("outline", seen(line.rlike(OUTLINE_HEADER)))
    # stop lines count only after the outline began: prose may start with "For"
    lines = lines.withColumn("refs", seen((F.col("outline") == 1) & line.rlike(REFERENCES_HEADER))).withColumn("over", seen((F.col("outline") == 1) & line.rlike(CROSS_LINE)))
    section = F.when(F.col("over") == 1, 3).when(F.col("refs") == 1, 2).otherwise(F.col("outline"))
    return lines.withColumn("section", section).drop("outline", "refs", "over")


def outline_labels(numbers: list[int]) -> list[str | None]:
    """Labels by position: a number may repeat or advance by one; a greater jump is misread; a lesser one is a stray.

    The first line of a parent is "3", then "3a", "3b", ... and after "3z" "3aa".
    """
    labels: list[str | None] = []
    parent, used = 1, 0
    for n in numbers:
        if n < parent:
            labels.append(None)
            continue
        if n == parent + 1:
            parent, used = n, 0
        labels.append(f"{parent}{letters(used)}")
        used += 1
    return labels


def letters(n: int) -> str:
    """"", a, b, ..., z, aa, ab, ..."""
    out = ""
    while n:
        n, last = divmod(n - 1, 26)
        out = chr(97 + last) + out
    return out


def topics(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, title, parent_label, line_no) of the outlines of chapter lines (keys, line_no, line)."""
    found = _parts(lines, keys).filter((F.col("section") == 1) & F.col("line").rlike(parsing.TOPIC))
    found = found.select(*keys, "line_no", F.regexp_extract("line", parsing.TOPIC, 1).cast("int").alias("n"), T.strip(F.regexp_extract("line", parsing.TOPIC, 3)).alias("title"))

    def labelled(rows: list[tuple]) -> Iterator[tuple]:
        seen = set()
        for (line_no, _, title), label in zip(rows, outline_labels([r[1] for r in rows]), strict=True):
            if label is not None and label not in seen:
                seen.add(label)
                yield label, title, line_no

    out = folded(found, keys, "line_no", labelled, "label string, title string, line_no int")
    return out.select(*keys, "label", "title", parsing.parent_label(F.col("label")).alias("parent_label"), "line_no")


_CITATION, _CONTINUED = re.compile(parsing.CITATION), re.compile(CONTINUED)


def citations(lines: DataFrame, keys: list[str], repeat_absorbed: bool = True, pages: str = parsing.PAGE_REF) -> DataFrame:
    """(keys, topic_label, author_number, author, work_raw, page_start, page_end, line_no, cited).

    The i-th topic line of the references takes the i-th outline label. A
    citation whose text has no page yet absorbs the lines below it up to one
    that has. Lines with pages but no author continue the last citation.
    repeat_absorbed: absorbed lines are looked at once more as continuations.
    pages: the pattern of page references, one of ``parsing.page_ref``.
    """
    parts = _parts(lines, keys).withColumn("line", T.strip(F.col("line"))).filter(F.col("section").isin(1, 2) & (F.col("line") != ""))
    title = T.strip(F.regexp_extract("line", parsing.TOPIC, 3))
    # the number of an outline's topic, and whether a line of the references is one
    number = F.when((F.col("section") == 1) & F.col("line").rlike(parsing.TOPIC), F.regexp_extract("line", parsing.TOPIC, 1).cast("int"))
    is_topic = F.col("line").rlike(parsing.TOPIC) & parsing.is_topic_title(title)
    parts = parts.withColumn("n", number).filter(F.when(F.col("section") == 1, F.col("n").isNotNull()).otherwise(~F.col("line").rlike(REFERENCES_HEADER)))
    parts = parts.select(*keys, "line_no", "line", "n", ((F.col("section") == 2) & is_topic).alias("is_topic"))

    def cited_by(lines_of: list[tuple]) -> Iterator[tuple]:
        labels = list(dict.fromkeys(x for x in outline_labels([n for _, _, n, _ in lines_of if n is not None]) if x is not None))
        rows = [(line_no, line, is_topic) for line_no, line, n, is_topic in lines_of if n is None]
        heads = [None if is_topic else _CITATION.match(line) for _, line, is_topic in rows]
        author, label, nth, skip = None, None, 0, -1
        for i, (line_no, line, is_topic) in enumerate(rows):
            if is_topic:
                author, label, nth = None, labels[nth] if nth < len(labels) else None, nth + 1
            elif heads[i] and label:
                author = (int(heads[i][1]), heads[i][2].strip().rstrip(".'`\""))
                rest = heads[i][3].strip()
                for k in count(i + 1):
                    if re.search(pages, rest) or k >= len(rows) or rows[k][2] or heads[k]:
                        break
                    rest, skip = f"{rest} {rows[k][1]}".strip(), k
                yield line_no, label, *author, rest, line, False
            elif author and label and re.search(pages, line) and (repeat_absorbed or i > skip):
                yield line_no, label, *author, line, line, bool(_CONTINUED.match(line))

    cited = folded(parts, keys, "line_no", cited_by, "line_no int, topic_label string, author_number int, author string, rest string, cited string, inherits boolean")
    # chunks without a work of their own, and continued parts, take the last work named for the same author in the topic
    chunks = cited.select("*", F.posexplode(parsing.reference_chunks(F.col("rest"), pages)).alias("chunk", "c"))
    own = F.when((F.col("c.work") != parsing.SAME_WORK) & ~(F.col("inherits") & (F.col("chunk") >= 0)), F.col("c.work"))
    run = Window.partitionBy(*keys, "topic_label").orderBy("line_no", "chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = chunks.withColumn("work_raw", F.last(own, ignorenulls=True).over(run))
    return named.filter("work_raw is not null").select(*keys, "topic_label", "author_number", "author", "work_raw", F.col("c.start").alias("page_start"), F.col("c.end").alias("page_end"), "line_no", "chunk", "cited")


def chapter_boundaries(texts: DataFrame, key: str, chapters: list[tuple[int, str]], window: int = 600) -> DataFrame:
    """(key, number, start): where each known chapter (number, name) begins in a whole text, searched forward only.

    First its numbered header, then its name before INTRODUCTION; if the first
    leads into references and the second comes earlier, the second. Failing
    both, its number before any capital.
    """

    def refs_page(text: str, at: int) -> bool:
        ahead = text[at : at + window]
        return bool(re.search(r"REFERENCES|To find the passages cited|^\d{1,2} \w+:", ahead, re.I | re.M) or re.search(r"^\s*\d{2,4}\s*$", ahead[:200], re.M))

    def candidates(number: int, name: str) -> list[re.Pattern]:
        return [
            re.compile(rf"Chapter\W{{0,3}}{number}\s*[;:.\-,']+\s*{re.escape(name[:4])}", re.I),
            re.compile(rf"\b{re.escape(name[:5])}.{{0,50}}INTRODUCTION\b", re.I | re.S),
            re.compile(rf"Chapter\s+{number}\s*[;:.\-,]+\s*[A-Z]", re.I),
        ]

    def found(text: str):
        at = 0
        for number, name in sorted(chapters):
            header, intro, bare = (p.search(text, at) for p in candidates(number, name))
            starts = [m.start() for m in (header, intro) if m]
            if header and intro and not refs_page(text, header.start()):
                start = min(starts)
            elif starts:
                start = min(starts)
            elif bare:
                start = bare.start()
            else:
                continue
            yield number, start
            at = start + 1

    def mapped(frames):
        for frame in frames:
            rows = [(k, n, s) for k, t in zip(frame[key], frame["text"], strict=True) if isinstance(t, str) for n, s in found(t)]
            yield pd.DataFrame(rows, columns=[key, "number", "start"])

    kind = dict(texts.dtypes)[key]
    return texts.select(key, "text").mapInPandas(mapped, f"{key} {kind}, number int, start long")


def block_paragraphs(blocks: DataFrame, keys: list[str], indent: float = 8.0) -> DataFrame:
    """(keys, para, text) of layout blocks (keys, pos, x0, margin, text): a block that is indented begins a paragraph.

    Not if it begins in lower case, nor after a broken word, which is joined.
    """

    def grouped(rows: list[tuple]) -> Iterator[tuple]:
        out: list[str] = []
        for _, x0, margin, text in rows:
            text = (text or "").strip()
            if not text:
                continue
            broken = bool(out) and out[-1].endswith("-")
            first = text.lstrip("\"'“”‘’(")[:1]
            if not out or (x0 - margin >= indent and not first.islower() and not broken):
                out.append(text)
            else:
                out[-1] = out[-1][:-1] + text if broken else f"{out[-1]} {text}"
        return enumerate(out, 1)

    return folded(blocks.select(*keys, "pos", "x0", "margin", "text"), keys, "pos", grouped, "para int, text string")
