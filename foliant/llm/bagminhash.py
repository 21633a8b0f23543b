"""Operator 5, near duplicates by BagMinHash.

A document is the multiset of its five-word shingles. Each distinct shingle of
count w owns Poisson processes over the discretised weights [0,1), [1,2), [2,4),
[4,8), ...: the intervals below w count whole, the one that w falls into is
thinned by each point's own level, so equal parts of two multisets produce equal
points. Points come in ascending time and go to random registers; a register
keeps its least point. Two signatures agree in a register with a probability
that equals the weighted Jaccard similarity. Points later than what could still
enter a register are never made, so a shingle costs about one draw.

Signatures are cut into bands; texts that share a band are candidates, verified
by exact multiset overlap (sum of smaller counts over sum of larger counts).
Equal texts are grouped first by a 96-bit name, so copies cost one row each.
Links become classes by distributed union-find.

Defined results: a null text counts as empty and all empty texts are copies; a
text of fewer than five words is one shingle; words are runs of ASCII digits
and letters and of all other characters beyond ASCII, A-Z lower-cased; repeated
rows are copies; the class id is the least doc_id of the class (rows without
doc_id count last); a text of any length is signed and compared whole; an empty
table gives no rows; extra columns are ignored by near_classes and kept by
drop_near; of rows that tie in doc_id the one of the least text name stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes, _sorted
from ._links import FINE, band_keys, bitmaps, folded, link, lists, packed, verifier
from ._spark import cut, release, text_key, tidy

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(row: np.ndarray, element: np.ndarray, count: np.ndarray, rows: int, registers: int) -> np.ndarray:
    """rows x registers of float64; registers of a row without elements are inf."""
    out = np.full((rows, registers), np.inf)
    total = np.bincount(row, count, rows)
    limit = np.zeros(rows)
    limit[total > 0] = (np.log(registers) + 3) / total[total > 0]
    todo = total > 0
    while todo.any():
        take = todo[row]
        _points(out, row[take], element[take], count[take], limit, registers)
        full = np.isfinite(out).all(axis=1)
        # a register is final when its least point came before the limit, up to which all points were made
        todo &= ~full
        limit[todo] *= 2
    return out


def _points(out: np.ndarray, row: np.ndarray, element: np.ndarray, count: np.ndarray, limit: np.ndarray, registers: int) -> None:
    top = int(count.max(initial=1))
    low, width = 0, 1
    flat = out.reshape(-1)
    while low < top:
        at = np.flatnonzero(count > low)
        seed = _bytes.mix(element[at] ^ np.uint64(low * 0x9E3779B97F4A7C15 % (1 << 64)))
        r, c, x = row[at], count[at], np.zeros(len(at))
        draw = 0
        while len(seed):
            draw += 1
            value = _bytes.mix(seed + np.uint64(draw * 0xD1B54A32D192ED03 % (1 << 64)))
            x = x - np.log(_uniform(value)) / (registers * width)
            early = x <= limit[r]
            seed, r, c, x = seed[early], r[early], c[early], x[early]
            again = _bytes.mix(value[early] ^ np.uint64(0x5851F42D4C957F2D))
            level = low + width * _uniform(_bytes.mix(again + np.uint64(1)))
            inside = level < c
            register = (again % np.uint64(registers)).astype(np.int64)
            np.minimum.at(flat, r[inside] * registers + register[inside], x[inside])
        low, width = low + width, max(width, low + width)


def text_bags(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, 52-bit shingle hash, count) of the texts of a chunk."""
    low, starts, ends, before = _bytes.words(data, offsets)
    return _bytes.bags(*_bytes.shingles(_bytes.span_hashes(low, starts, ends), before, width))


def signed(docs: DataFrame, n_bands: int = BANDS, n_rows: int = ROWS, width: int = WIDTH) -> DataFrame:
    """(k1, k2, doc_id, keys, n, map, fine): the text's name, its band keys, number of shingles and their bitmaps, one row per document."""

    @tidy
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, maps, n = np.zeros((batch.num_rows, n_bands), np.uint64), np.zeros((batch.num_rows, FINE), np.int64), np.zeros(batch.num_rows, np.int32)
            for start, end, data, offsets in _bytes.chunks(batch.column(3)):
                row, element, count = text_bags(data, offsets, width)
                keys[start:end] = band_keys(signatures(row, element, count, end - start, n_bands * n_rows).view(np.uint64), n_bands)
                maps[start:end] = bitmaps(row, element, count, end - start)
                n[start:end] = np.bincount(row, count, end - start)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed(keys), pa.array(n), lists(folded(maps)), packed(maps)], ["k1", "k2", "doc_id", "keys", "n", "map", "fine"])

    text = F.coalesce("text", F.lit(""))
    return docs.select(*text_key(text), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).mapInArrow(made, "k1 long, k2 int, doc_id long, keys binary, n int, map array<long>, fine binary")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, n_bands: int = BANDS, n_rows: int = ROWS, width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, k1 and k2 (its text's name), root (its class), class_id (the class's least doc_id), class_rows."""
    rows = cut(signed(docs, n_bands, n_rows, width))
    text_of = rows.groupBy("k1", "k2").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.any_value(F.struct("keys", "n", "map", "fine")).alias("s"))
    # a 64-bit name for the distinct text, unique because k1 alone is only shared by chance: then both stay apart
    text_of = cut(text_of.select("k1", "k2", "least", "copies", "s.*", F.xxhash64("k1", "k2").alias("id")), by_workers=True)
    listed = text_of.select("id", "keys")
    members = _sorted.members(listed, _sorted.shared_keys(listed)).distinct()
    members = cut(members, by_workers=True)
    wanted = text_of.join(members.select("id").distinct(), "id", "left_semi").select(_place("least", "k1", "k2").alias("key"), F.lit(0).alias("value"))
    text = F.coalesce("text", F.lit(""))
    named = docs.select(_place(F.col("doc_id").cast("long"), *text_key(text)).alias("place"), F.xxhash64(*text_key(text)).alias("id"), text.alias("text"))
    # the text of each name is taken from its least doc_id, where it lies
    texts = cut(_sorted.where_held(named, "place", _sorted.key_files(wanted)).select("id", "text").dropDuplicates(["id"]), by_workers=True)
    known = cut(text_of.select("id", "n", "map", "fine").join(members.select("id").distinct(), "id", "left_semi"), by_workers=True)
    roots = link(members, known, listed, verifier(texts, lambda data, offsets: text_bags(data, offsets, width)), threshold)
    release(members, known, texts)
    classed = text_of.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    of_root = classed.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_rows"))
    known = classed.join(of_root, "root").select("k1", "k2", "root", "class_id", "class_rows")
    return rows.select("k1", "k2", "doc_id").join(known, ["k1", "k2"])


def drop_near(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class: of its least doc_id, and of rows that share it the one of the least text name."""
    classes = cut(near_classes(docs, **options), by_workers=True)
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "k1", "k2")
    best = classes.groupBy("root").agg(F.min(place).alias("p"))
    keep = _sorted.key_files(best.select(_place("p.doc_id", "p.k1", "p.k2").alias("key"), F.lit(0).alias("value")))
    own = _place(F.col("doc_id").cast("long"), *text_key(F.coalesce("text", F.lit(""))))
    kept = _sorted.where_held(docs.withColumn("_place", own), "_place", keep)
    again = cut(classes.groupBy(_place("doc_id", "k1", "k2").alias("_place")).agg(F.count("*").alias("n")).filter("n > 1").select("_place"), by_workers=True)
    if again.isEmpty():
        return kept.drop("_place").select(*docs.columns)
    once = kept.join(again, "_place", "left_semi").dropDuplicates(["_place"])
    return kept.join(again, "_place", "left_anti").unionByName(once).drop("_place").select(*docs.columns)


def _place(*columns):
    """One number for a row's doc_id and text name."""
    return F.xxhash64(*columns)
