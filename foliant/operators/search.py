"""Ranked full-text search over an inverted index table.

The index is a table of postings (term, doc, field counts) that Parquet can hold
partitioned by a hash of the term; a query touches only its terms' postings.
Ranking is BM25 with the usual k1 = 1.2 and b = 0.75. ``search`` takes words,
all required; ``match`` takes a query language with phrases, prefixes, AND, OR
and NOT over an index with positions, whose terms have no diacritics.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75


def terms(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def postings(docs: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(term, doc, tf, length): counted over all fields; length is the document's number of terms."""
    all_terms = F.concat(*[terms(F.coalesce(F.col(f), F.lit(""))) for f in fields])
    rows = docs.select(F.col(key).alias("doc"), all_terms.alias("t")).withColumn("length", F.size("t"))
    return rows.select("doc", "length", F.explode("t").alias("term")).groupBy("term", "doc", "length").agg(F.count("*").alias("tf"))


def statistics(docs: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row: n documents, their mean length."""
    all_terms = F.concat(*[terms(F.coalesce(F.col(f), F.lit(""))) for f in fields])
    return docs.agg(F.count(key).alias("n"), F.avg(F.size(all_terms)).alias("mean"))


def search(index: DataFrame, stats: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """(doc, score): documents that hold every term of the query, best first; none for a blank query."""
    wanted = sorted({m[0] for m in re.finditer(r"[^\W_]+", query.lower())})
    if not wanted:
        return index.select("doc", F.lit(0.0).alias("score")).limit(0)
    hits = index.filter(F.col("term").isin(wanted))
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    # df has a row a query term, stats one row
    scored = hits.join(F.broadcast(df), "term").crossJoin(F.broadcast(stats))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    found = scored.groupBy("doc").agg(F.count("*").alias("k"), F.sum(part).alias("score")).filter(F.col("k") == len(wanted))
    return found.select("doc", "score").orderBy(F.desc("score"), "doc").limit(limit)


def refreshed(index: DataFrame, changed: DataFrame, deleted: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """The index after rows changed or went: their postings replaced."""
    gone = changed.select(F.col(key).alias("doc")).unionByName(deleted.select(F.col(key).alias("doc"))).distinct()
    return index.join(gone, "doc", "left_anti").unionByName(postings(changed, key, fields).select(*index.columns))


# The query language.

#: Latin letters with diacritics, by rule from their canonical decompositions.
_MARKED = {c: unicodedata.normalize("NFD", c)[0] for c in map(chr, range(0xC0, 0x250)) if c == c.lower() and len(unicodedata.normalize("NFD", c)) > 1}


def folded_terms(text: Column) -> Column:
    """Runs of letters and digits, lower-cased, Latin letters without their diacritics."""
    return terms(F.translate(F.regexp_replace(F.lower(text), r"\p{Mn}", ""), "".join(_MARKED), "".join(_MARKED.values())))


def _folded(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word.lower()) if not unicodedata.combining(c))


def positions(docs: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(term, doc, field, at array<int>): where each term stands in each field."""
    of = F.explode(F.array(*[F.struct(F.lit(k).alias("field"), folded_terms(F.coalesce(F.col(f), F.lit(""))).alias("t")) for k, f in enumerate(fields)]))
    rows = docs.select(F.col(key).alias("doc"), of.alias("f")).select("doc", "f.field", F.posexplode("f.t").alias("at", "term"))
    return rows.groupBy("term", "doc", "field").agg(F.array_sort(F.collect_list("at")).alias("at"))


def lengths(docs: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(doc, length): each document's number of terms in all fields."""
    return docs.select(F.col(key).alias("doc"), sum((F.size(folded_terms(F.coalesce(F.col(f), F.lit("")))) for f in fields), F.lit(0)).alias("length"))


@dataclass(frozen=True)
class Atom:
    """A phrase of one or more terms, the last one perhaps a prefix."""

    words: tuple[str, ...]
    prefix: bool


def parse(query: str) -> tuple[object, list[Atom]]:
    """The tree of a query, ("and" | "or" | "not", left, right) or an atom's number, and its atoms.

    Words and "phrases" side by side are all required; a ``*`` behind a word or
    phrase makes its last word a prefix; AND binds closer than OR, NOT closest.
    None for a blank query; an unclosed parenthesis or a missing side is an error.
    """
    atoms: list[Atom] = []
    tokens = re.findall(r'"[^"]*"\s*\*?|\(|\)|[^\W_]+\*?', query)
    at = 0

    def peek():
        return tokens[at] if at < len(tokens) else None

    def take():
        nonlocal at
        at += 1
        return tokens[at - 1]

    def either():
        left = both()
        while peek() == "OR":
            take()
            left = ("or", left, both())
        return left

    def both():
        left = without()
        while peek() not in (None, "OR", ")"):
            if peek() == "AND":
                take()
            left = ("and", left, without())
        return left

    def without():
        left = one()
        while peek() == "NOT":
            take()
            left = ("not", left, one())
        return left

    def one():
        token = peek()
        if token is None or token in ("AND", "OR", "NOT", ")"):
            raise ValueError(f"nothing to search for at {token or 'the end'}: {query}")
        take()
        if token == "(":
            inner = either()
            if peek() != ")":
                raise ValueError(f"unclosed parenthesis: {query}")
            take()
            return inner
        words = tuple(re.findall(r"[^\W_]+", _folded(token)))
        atom = Atom(words, token.endswith("*"))
        if atom not in atoms:
            atoms.append(atom)
        return atoms.index(atom)

    if not tokens:
        return None, []
    tree = either()
    if peek() is not None:
        raise ValueError(f"unexpected {peek()}: {query}")
    return tree, atoms


def match(index: DataFrame, sizes: DataFrame, query: str, limit: int | None = 20) -> DataFrame:
    """(doc, score) of the documents that a query (see ``parse``) selects, best first.

    index: ``positions``; sizes: ``lengths``. The score adds up over the atoms
    that occur, weighed by log((N - n + 0.5) / (n + 0.5)), which is never taken
    for less than 1e-6: n documents of N have the atom. Scores are rounded to nine
    places, so that the order of equal ones does not hang on that of additions.
    """
    tree, atoms = parse(query)
    if tree is None:
        return index.select("doc", F.lit(0.0).alias("score")).limit(0)
    hits = None
    for k, atom in enumerate(atoms):
        found = _occurrences(index, atom).select("doc", "tf", F.lit(k).alias("atom"))
        hits = found if hits is None else hits.unionByName(found)
    hits = hits.filter("tf > 0")
    df = hits.groupBy("atom").agg(F.count("*").alias("df"))
    stats = sizes.agg(F.count("*").alias("n"), F.avg("length").alias("mean"))
    # df has a row an atom, stats one row
    scored = hits.join(F.broadcast(df), "atom").join(sizes, "doc").crossJoin(F.broadcast(stats))
    idf = F.greatest(F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(1e-6))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    found = scored.groupBy("doc").agg(F.collect_set("atom").alias("has"), F.round(F.sum(part), 9).alias("score"))

    def holds(node) -> Column:
        if isinstance(node, int):
            return F.array_contains("has", node)
        kind, left, right = node
        return {"and": lambda: holds(left) & holds(right), "or": lambda: holds(left) | holds(right), "not": lambda: holds(left) & ~holds(right)}[kind]()

    out = found.filter(holds(tree)).select("doc", "score").orderBy(F.desc("score"), "doc")
    return out if limit is None else out.limit(limit)


def _occurrences(index: DataFrame, atom: Atom) -> DataFrame:
    """(doc, tf): how often a phrase stands in a document."""
    last = len(atom.words) - 1
    of = lambda k: F.col("term").startswith(atom.words[k]) if k == last and atom.prefix else F.col("term") == atom.words[k]
    rows = index.filter(of(0)).select("doc", "field", F.explode("at").alias("at"))
    for k in range(1, last + 1):
        after = index.filter(of(k)).select("doc", "field", F.explode("at").alias("next"))
        rows = rows.join(after.select("doc", "field", (F.col("next") - k).alias("at")).distinct(), ["doc", "field", "at"], "left_semi")
    return rows.groupBy("doc").agg(F.count("*").alias("tf"))


def hits(found: DataFrame, references: DataFrame, authors: DataFrame, works: DataFrame, volumes: DataFrame, ideas: DataFrame, topics: DataFrame) -> DataFrame:
    """The hits (doc, score) as rows to show: each reference with its idea, topic, author, work and volume; best first.

    references: (id, idea_number, topic_label, author_id, work_id, page_start,
    page_end, ref_text). A hit without author, work or idea is left out, one
    without topic or volume stays.
    """
    out = found.join(references, found["doc"] == references["id"]).drop("doc")
    out = out.join(authors.select(F.col("id").alias("author_id"), F.col("name").alias("author_name")), "author_id")
    out = out.join(works.select(F.col("id").alias("work_id"), F.col("title").alias("work_title"), "volume_id"), "work_id")
    out = out.join(volumes.select(F.col("number").alias("volume_id"), F.col("display_name").alias("volume_display")), "volume_id", "left")
    out = out.join(ideas.select(F.col("number").alias("idea_number"), F.col("name").alias("idea_name")), "idea_number")
    out = out.join(topics.select("idea_number", F.col("label").alias("topic_label"), F.col("title").alias("topic_title")), ["idea_number", "topic_label"], "left")
    return out.select("id", "idea_number", "idea_name", "topic_label", "topic_title", "author_name", "work_title", "volume_id", "volume_display", "page_start", "page_end", "ref_text", "score").orderBy(F.desc("score"), "id")
