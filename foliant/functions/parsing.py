"""Column functions for the small languages of a topical index: numbers, labels, page references, citations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import squeeze, strip


# The formats of page references, topics, citations and chapter headers.


def page_ref(digits: int) -> str:
    """The pattern of a page reference: so many digits at most and a column letter, perhaps a range."""
    return rf"\b([0-9]{{1,{digits}}}[a-d])(?:\s*[-—–]\s*([0-9]{{1,{digits}}}[a-d]))?\b"


#: Page references of books.
PAGE_REF = page_ref(4)
TOPIC = r"^\s*([0-9]{1,3})\s*([a-zA-Z^/]?)\s*[.,]\s+([A-Z][^\n]{3,})$"
CITATION = r"^\s*([0-9]{1,3})\s+([A-Z][A-Za-z'\- ]{1,40}?)\s*[:.]\s*(.*)$"
CHAPTER = r"(?i)^\s*Chapter\s*([ivxlcdm0-9S]{1,5})\s*[.:]\s*([A-Z][A-Z0-9 &/().\-]{2,}?)\s*(?:INTRODUCTION.*|OUTLINE.*|\[.*|[0-9]+)?$"

#: What may follow a comma after a work's title.
PARTS_OF_WORKS = "bk book part parts chapter ch sect section q qq a aa ans rep vol volume pp page pages no n tome tr trans en sec esp prop def defs".split()

#: Misread chapter headers, raw number and name.
CHAPTER_NUMBERS = {("3S", "HONOR"): 35}

#: Stands for "the work named before" in the chunks of a reference.
SAME_WORK = "\x00same"


def or_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def roman(text: Column) -> Column:
    """The number a Roman numeral stands for, null if it is none."""
    value = lambda c: F.element_at(F.create_map(*[F.lit(x) for pair in zip("ivxlcdm", (1, 5, 10, 50, 100, 500, 1000), strict=True) for x in pair]), c)
    letters = F.split(F.reverse(F.lower(text)), "")
    zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("top"))
    step = lambda s, c: F.struct(F.when(value(c) < s["top"], s["sum"] - value(c)).otherwise(s["sum"] + value(c)).alias("sum"), F.greatest(s["top"], value(c)).alias("top"))
    return F.when(F.lower(text).rlike("^[ivxlcdm]+$"), F.aggregate(letters, zero, step, lambda s: s["sum"]))


def chapter_number(raw: Column, name: Column) -> Column:
    """Arabic, Roman or a known misreading; only 1 to 102."""
    known = F.lit(None).cast("int")
    for (number, title), right in CHAPTER_NUMBERS.items():
        known = F.when((raw == number) & (name == title), right).otherwise(known)
    n = F.coalesce(F.when(raw.rlike("^[0-9]+$"), raw.try_cast("int")), roman(raw), known)
    return F.when(n.between(1, 102), n)


def parent_label(label: Column) -> Column:
    """"2a" to "2"; null for a label that is no part of another."""
    return or_null(F.regexp_extract(label, "^([0-9]+)[a-z]$", 1))


def label_number(label: Column) -> Column:
    """The digits a label begins with, 0 without any."""
    return F.coalesce(F.regexp_extract(label, "^([0-9]+)", 1).try_cast("int"), F.lit(0))


def page_refs(text: Column, pattern: str = PAGE_REF) -> Column:
    """array<struct<start, end>>: all page references; a single page is its own end."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = lambda x: F.regexp_extract(x, pattern, 1)
    return F.transform(found, lambda x: F.struct(start(x).alias("start"), F.coalesce(or_null(F.regexp_extract(x, pattern, 2)), start(x)).alias("end")))


def marker(text: Column) -> Column:
    """struct<page, col> of a page marker such as "53a"; nulls if it is none."""
    page = F.regexp_extract(text, "^([0-9]+)([a-d])?$", 1).try_cast("int")
    return F.struct(page.alias("page"), or_null(F.regexp_extract(text, "^([0-9]+)([a-d])?$", 2)).alias("col"))


def _rtrim(text: Column, marks: str) -> Column:
    return F.regexp_replace(text, f"[{marks}]+$", "")


def work_title(raw: Column, pattern: str = PAGE_REF) -> Column:
    """The title of a work without the parts of it that a reference names; "" if nothing is left that could be one."""
    s = F.regexp_replace(raw, "^[^A-Za-z]+", "")
    cut = r"(?i)^(.*?),\s*\b(?:%s)\b.*$" % "|".join(PARTS_OF_WORKS)
    s = F.when(s.rlike(cut), _rtrim(strip(F.regexp_extract(s, cut, 1)), ",")).otherwise(s)
    page = rf"^(.*?){pattern}.*$"
    s = F.when(s.rlike(page), _rtrim(strip(F.regexp_extract(s, page, 1)), ",")).otherwise(s)
    s = _rtrim(squeeze(s), ",.;:")
    fragment = s.rlike(r"^[IVXivx]+\s*[\[0-9]") | s.rlike(r"^[IVXivx]+\s+\S{0,4}$") | s.rlike("^[IVXivx]+$")
    return F.when(fragment | (F.length(s) < 2), "").otherwise(s)


#: What ``strip`` takes off, as characters: those of \\s and \\p{Z} in Java's patterns.
_SPACES = " \t\n\x0b\f\r"
_BLANKS = _SPACES + "\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _trimmed(text: Column, marks: str = "") -> Column:
    """``strip`` and then ``_rtrim`` without patterns; "$" also stands before a last U+0085, which only the patterns know."""
    plain, exact = F.trim(text, F.lit(_BLANKS)), strip(text)
    if marks:
        plain, exact = F.rtrim(plain, F.lit(marks)), _rtrim(exact, marks)
    return F.when(text.contains("\x85"), exact).otherwise(plain)


def reference_chunks(rest: Column, pattern: str = PAGE_REF) -> Column:
    """array<struct<work, start, end>> of the body of a reference.

    "/" parts works, ";" parts page ranges of one work. A part that begins with
    its pages belongs to SAME_WORK; one without pages has none. pattern: one of
    ``page_ref``. It runs once a work and once a part, for patterns are what
    this costs.
    """
    flat = F.regexp_replace(F.translate(rest, "—–", "--"), r"(?i)\b(passim|esp)\b", "")
    trimmed = lambda x: _trimmed(x, ",;.")
    # each step is an array of its own, so that no pattern runs more often than it must
    works = F.filter(F.transform(F.split(flat, "/"), trimmed), lambda x: x != "")
    placed = F.transform(works, lambda x: F.struct(x.alias("x"), F.regexp_instr(x, F.lit(pattern)).alias("at")))

    def split(s: Column) -> Column:
        name = F.when(s["at"] > 0, _trimmed(F.substr(s["x"], F.lit(1), s["at"] - 1))).otherwise(s["x"])
        parts = F.filter(F.transform(F.split(F.substr(s["x"], s["at"]), ";"), trimmed), lambda y: y != "")
        return F.struct(F.when(name == "", SAME_WORK).otherwise(name).alias("work"), F.when(s["at"] > 0, parts).otherwise(F.array(F.lit(""))).alias("parts"))

    def ranges(s: Column) -> Column:
        found = F.transform(s["parts"], lambda y: F.regexp_extract(y, pattern, 0))
        first = lambda m: F.when(m != "", F.rtrim(F.substring_index(m, "-", 1), F.lit(_SPACES)))
        last = lambda m: F.when(m != "", F.ltrim(F.substring_index(m, "-", -1), F.lit(_SPACES)))
        # a single page has no dash: it is its own end
        return F.transform(found, lambda m: F.struct(s["work"].alias("work"), first(m).alias("start"), last(m).alias("end")))

    return F.flatten(F.transform(F.transform(placed, split), ranges))


def chunk_rows(rows: DataFrame, rest: str, pattern: str = PAGE_REF) -> DataFrame:
    """``rows`` with work, start, end in place of ``rest``, a row for each of its ``reference_chunks``; no order.

    Rows instead of arrays, for Spark compiles what it does with columns, but not with the elements of arrays.
    """
    kept = [c for c in rows.columns if c != rest]
    flat = F.regexp_replace(F.translate(F.col(rest), "—–", "--"), r"(?i)\b(passim|esp)\b", "")
    works = rows.select(*kept, F.explode(F.split(flat, "/")).alias("x")).withColumn("x", _trimmed(F.col("x"), ",;.")).filter("x != ''").withColumn("at", F.regexp_instr("x", F.lit(pattern)))
    name = F.when(F.col("at") > 0, _trimmed(F.substr("x", F.lit(1), F.col("at") - 1))).otherwise(F.col("x"))
    parts = F.when(F.col("at") > 0, F.split(F.substr("x", F.col("at")), ";")).otherwise(F.array(F.lit("")))
    found = works.select(*kept, "at", name.alias("name"), F.explode(parts).alias("y")).withColumn("y", _trimmed(F.col("y"), ",;.")).filter("at = 0 or y != ''").withColumn("m", or_null(F.regexp_extract("y", pattern, 0)))
    return found.select(*kept, F.when(F.col("name") == "", SAME_WORK).otherwise(F.col("name")).alias("work"), F.rtrim(F.substring_index("m", "-", 1), F.lit(_SPACES)).alias("start"), F.ltrim(F.substring_index("m", "-", -1), F.lit(_SPACES)).alias("end"))


def is_topic_title(title: Column) -> Column:
    """No colon and no page reference, three words or more, and a word of over two letters that begins in lower case."""
    words = F.split(squeeze(title), " ")
    return ~title.contains(":") & (F.size(words) >= 3) & F.exists(words, lambda w: w.rlike(r"^\p{Ll}") & (F.length(w) > 2)) & ~title.rlike(r"\b[0-9]+[a-d](?:[-–—][0-9]+[a-d])?\b")


def csv_reference(line: Column) -> Column:
    """struct<number, author, title, page_start, page_end> of a line "7 PLATO: Republic, 451c-453b"."""
    shape = r"^([0-9]+)\s+([A-Z][A-Z\s\-'.]+?):\s*(.+)$"
    body = F.regexp_extract(line, shape, 3)
    title = F.when(body.contains(","), F.substring_index(body, ",", 1)).otherwise(F.left(body, F.lit(80)))
    pages = r"([0-9]+[a-d]?)-?([0-9]+[a-d]?)?"
    return F.struct(
        or_null(F.regexp_extract(line, shape, 1)).alias("number"),
        or_null(F.regexp_extract(line, shape, 2)).alias("author"),
        or_null(F.left(strip(title), F.lit(80))).alias("title"),
        or_null(F.regexp_extract(body, pages, 1)).alias("page_start"),
        or_null(F.regexp_extract(body, pages, 2)).alias("page_end"),
    )


def title_key(title: Column) -> Column:
    """A title for comparison: trimmed of end marks, lower case, brackets gone, one space between words."""
    s = F.lower(F.regexp_replace(strip(title), r"[.,;:\- ]+$", ""))
    return squeeze(F.regexp_replace(s, r"[\[\](){}]", ""))


def passes_noise_gate(title: Column) -> Column:
    """A title of 6 or more characters without digits or brackets, and with a word of 5 or more letters."""
    return (F.length(title) >= 6) & ~title.rlike(r"[0-9\[]") & ~title.rlike(r"[\]-]$") & (F.length(title_key(title)) >= 6) & title_key(title).rlike("[a-z]{5,}")


def volume_name(path: Column) -> Column:
    """struct<number, display> of a file "... Volume 7 - Plato.txt"; nulls if it is none."""
    shape = r"(?i)Volume\s+([0-9]+)\s+-\s+(.+?)\.txt$"
    return F.struct(F.regexp_extract(path, shape, 1).try_cast("int").alias("number"), or_null(F.regexp_extract(path, shape, 2)).alias("display"))


def volume_of(path: Column) -> Column:
    """The first "Volume N" in a name, null without one."""
    return F.regexp_extract(path, r"(?i)Volume\s+([0-9]+)", 1).try_cast("int")


def name_list(names: Column) -> Column:
    return F.filter(F.transform(F.split(names, ","), strip), lambda x: x != "")


# Section headers of a chapter as scanned, by name.
SECTIONS = {
    "outline": r"(?i)OUTLINE\W{0,15}\w{1,3}\W{0,10}TOPICS|OUTLINE\W{0,5}TOPICS",
    "references": r"(?i)(?<!CROSS[-\s])REFERENCES'?\b(?!\s+For:)(?!\s+[0-9]+[a-z])",
    "crossrefs": r"(?i)\bCROSS[-\s]REFERENCES\b",
    "additional": r"(?i)\bADDITIONAL\s+READINGS\b",
}


def sections(text: Column, strict: bool = False) -> Column:
    """struct<intro, outline, refs, crossrefs, additional> of a chapter; a missing section is "".

    strict: headers must be lines of their own.
    """
    names = {"outline": "OUTLINE OF TOPICS", "references": "REFERENCES", "crossrefs": "CROSS-REFERENCES", "additional": "ADDITIONAL READINGS"}
    at = {k: F.regexp_instr(text, F.lit(rf"(?m)^{names[k]}$" if strict else p)) for k, p in SECTIONS.items()}
    end = F.length(text) + 1
    none = end  # a section that is not there begins at the end
    out = F.when(at["outline"] > 0, at["outline"]).otherwise(none)
    ref = F.when((at["references"] > out), at["references"]).otherwise(none)
    cross = F.when((at["crossrefs"] > F.when(ref < end, ref).otherwise(out)), at["crossrefs"]).otherwise(none)
    add = F.when(at["additional"] > 0, at["additional"]).otherwise(none)
    part = lambda a, b: F.when(a < end, F.substr(text, a, F.greatest(b - a, F.lit(0)))).otherwise("")
    return F.struct(
        F.substr(text, F.lit(1), out - 1).alias("intro"),
        part(out, F.least(ref, cross)).alias("outline"),
        part(ref, cross).alias("refs"),
        part(cross, F.when(add > cross, add).otherwise(end)).alias("crossrefs"),
        part(add, end).alias("additional"),
    )
