"""Operator 2, fuzzy duplicate lines by MinHash.

A line is what stands between two line breaks. All lines but empty ones (of
fewer than MIN_CHARS characters) are compared, A-Z lower-cased, by their character shingles: a
signature is banded with high recall, candidates are verified by exact Jaccard
similarity of their shingle sets, links become components by distributed
union-find, and of each component the first line stays (least doc_id, then line
number); every other occurrence is removed from its text.

Two lines of similarity 0.8 share a band with probability 0.992
(1 - (1 - 0.8^ROWS)^BANDS); lines at random agree in 0.04 of the registers or
so, and hardly ever in a band. Lines shorter than a shingle are like their
equals alone; these are grouped by key, unsigned.

Defined results: a null text stays null; empty lines stay as they are, even
repeated; a line shorter than a shingle is one shingle; repeated rows (equal
doc_id and text) count as one document and get the same result; extra columns
are kept (with counts, own n_lines and n_dropped are replaced); a document of
which every line goes keeps its row with an empty text; rows without doc_id come
last, and rows that tie in doc_id are ordered by the hash of their text; a line
of any length is signed and compared whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from xxhash import xxh3_64_intdigest

from . import _bytes, _sorted
from ._links import band_keys, bitmaps, described, link, packed, record, record_verifier
from ._spark import cut, release, tidy

SHINGLE = 5  # char_shingles is written for five
MIN_CHARS = 1
THRESHOLD = 0.8
BANDS, ROWS = 16, 6

#: Shingles that are hashed at a time.
BLOCK = 1 << 16

_FACTORS = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def split_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, line number from 0, first byte, end byte) of every line of every row."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    counts = np.diff(np.searchsorted(breaks, offsets)) + 1
    row = np.repeat(np.arange(len(counts)), counts)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    return row, np.arange(len(row)) - first[row], starts, ends


def char_places(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many characters begin before each ascending byte place; the places themselves where all is ASCII."""
    beyond = np.flatnonzero((data & 0xC0) == 0x80)
    return places - np.searchsorted(beyond, places) if len(beyond) else places


def char_shingles(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of the shingles of SHINGLE characters of the byte spans, in order; not distinct. A shorter line has none."""
    a, b, points = char_places(data, starts), char_places(data, ends), data
    if a is not starts:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    count = np.maximum(b - a - SHINGLE + 1, 0)
    if not count.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # five code points of 21 bits: three fill a word, which is mixed before the other two enter
    p = points.astype(np.uint64)
    n = len(p) - SHINGLE + 1
    hashes = _bytes.mix(p[:n] | p[1 : n + 1] << np.uint64(21) | p[2 : n + 2] << np.uint64(42))
    hashes = _bytes.mix(hashes ^ (p[3 : n + 3] | p[4 : n + 4] << np.uint64(21)) * np.uint64(0x9E3779B97F4A7C15))
    line = np.repeat(np.arange(len(starts)), count)
    first = np.cumsum(count) - count
    return line, hashes[np.arange(len(line)) + np.repeat(a - first, count)]


def sign(line: np.ndarray, hashes: np.ndarray, n_lines: int) -> np.ndarray:
    """MinHash registers of the lines, each of which has a shingle; ``line`` ascends."""
    out = np.zeros((BANDS * ROWS, n_lines), np.uint32)
    if len(line):
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        at = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
        # runs of whole lines that stay in the cache while they are hashed again and again
        cuts = np.unique(np.concatenate([np.searchsorted(at, np.arange(0, len(line), BLOCK)), [n_lines]]))
        scratch = np.zeros(len(short), np.uint32)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own = short[at[a] : at[b] if b < n_lines else len(short)]
            place, held = at[a:b] - at[a], scratch[: len(own)]
            for k, factor in enumerate(_FACTORS):
                np.multiply(own, factor, out=held)
                np.minimum.reduceat(held, place, out=out[k, a:b])
    return np.ascontiguousarray(out.T)


def line_bags(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, 52-bit hash, 1) of the distinct shingles of each line."""
    found = []
    for first in range(0, len(starts), _bytes.CHUNK_ROWS):
        own = slice(first, first + _bytes.CHUNK_ROWS)
        line, hashes, _ = _bytes.bags(*char_shingles(low, starts[own], ends[own]))
        found.append((line + first, hashes))
    line, hashes = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    return line, hashes, np.ones(len(line), np.int64)


def _compared(batch_column: pa.Array, min_chars: int):
    """(first row, row, line number, line key, low, starts, ends) of the compared lines of each chunk."""
    for first, _, data, offsets in _bytes.chunks(batch_column):
        row, number, starts, ends = split_lines(data, offsets)
        low = _bytes.LOWER[data]
        # a line of a byte is one of a character
        chars = ends - starts if min_chars <= 1 else char_places(data, ends) - char_places(data, starts)
        use = np.flatnonzero(chars >= min_chars)
        row, number, starts, ends = row[use], number[use], starts[use], ends[use]
        yield first, row, number, line_keys(low, starts, ends), low, starts, ends


def line_keys(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit name of each line, by a hash that is no polynomial."""
    raw = low.tobytes()
    return np.fromiter((xxh3_64_intdigest(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))


def _row_key():
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, doc_id, doc, line, n, keys) of the distinct lines of each chunk: where a line first stands there, how often, and its band keys (null for short ones)."""

    @tidy
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unnamed = batch.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
            doc_id, doc = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for first, row, number, key, low, starts, ends in _compared(batch.column(2), min_chars):
                if not len(row):
                    continue
                row = first + row
                order = _sorted.place_order(key, unnamed[row], doc_id[row], doc[row], number)
                at = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
                pick, n = order[at], np.diff(np.append(at, len(order)))
                line, hashes = char_shingles(low, starts[pick], ends[pick])
                long = line[np.diff(line, prepend=-1) != 0]
                keys = packed(band_keys(sign(line, hashes, len(long)), BANDS))
                signed = np.full(len(pick), -1)
                signed[long] = np.arange(len(long))
                place = pa.array(row[pick])
                yield pa.RecordBatch.from_arrays([pa.array(key[pick].view(np.int64)), batch.column(0).take(place), batch.column(1).take(place), pa.array(number[pick].astype(np.int32)), pa.array(n), keys.take(pa.array(signed, mask=signed < 0))], ["id", "doc_id", "doc", "line", "n", "keys"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("doc"), "text")
    return rows.mapInArrow(made, "id long, doc_id long, doc long, line int, n long, keys binary")


def line_records(docs: DataFrame, places: _sorted.StayFiles, min_chars: int = MIN_CHARS) -> _sorted.RecordFiles:
    """The lines at ``places``, lower-cased as compared, and their long bitmaps; their numbers are those of distinct shingles."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids, texts = [np.zeros(0, np.int64)], []
            for first, row, number, key, low, starts, ends in _compared(batch.column(1), min_chars):
                own = key.view(np.int64)
                at = np.flatnonzero(places.hold(own, doc[first + row], number))
                raw = low.tobytes() if len(at) else b""
                ids.append(own[at])
                texts += [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            ids = np.concatenate(ids)
            for start, end, data, offsets in _bytes.chunks(pa.array(texts, pa.large_binary())):
                line, element, count = _bags(data, offsets)
                yield ids[start:end], np.bincount(line, minlength=end - start), record(bitmaps(line, element, count, end - start), texts[start:end])

    return _sorted.record_files(docs.select(_row_key().alias("doc"), "text"), made)


def _bags(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return line_bags(data, offsets[:-1], offsets[1:])


def kept_places(docs: DataFrame, threshold: float = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, doc, line): for each line text that repeats or is like others where the one that stays stands; doc is the row's key."""
    seen = cut(occurrences(docs, min_chars))
    listed = seen.select("id", "keys").filter("keys is not null")
    # a bucket of one line's text, however often it occurs, has no candidates
    members = cut(_sorted.members(listed, _sorted.shared_keys(listed)).distinct(), by_workers=True)
    candidates = _sorted.key_files(members.select(F.col("id").alias("key"), F.lit(0).alias("value")))
    first = cut(_sorted.first_places(seen.drop("keys"), candidates))
    # the text of each candidate is read at its first place
    records = line_records(docs, _sorted.stay_files(first.filter("candidate").select("id", "doc", "line")), min_chars)
    roots = link(members, described(records), listed.dropDuplicates(["id"]), record_verifier(records, _bags, threshold), threshold)
    _sorted.discard(records)
    release(members)
    placed = first.join(roots, "id", "left").filter("n > 1 or root is not null").withColumn("root", F.coalesce("root", "id"))
    placed = cut(placed.select("id", "root", F.struct("unnamed", "doc_id", "doc", "line").alias("p")), by_workers=True)
    stays = placed.groupBy("root").agg(F.min("p").alias("stay"))
    out = cut(placed.join(stays, "root").select("id", "stay.doc", "stay.line"), by_workers=True)
    release(seen, first, roots, placed)
    return out


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD, min_chars: int = MIN_CHARS, counts: bool = False) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text`` (and n_chars, if there is one, counted anew); ``counts`` adds n_lines and n_dropped."""
    kept = kept_places(docs, threshold, min_chars)
    stay = _sorted.stay_files(kept)
    release(kept)
    own = docs.drop("n_lines", "n_dropped") if counts else docs
    at = own.columns.index("text")
    n_chars = own.columns.index("n_chars") if "n_chars" in own.columns else None

    @tidy
    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[:-1]
            doc = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            gone: dict[int, set[int]] = {}
            lines = [(first + row, number, key) for first, row, number, key, *_ in _compared(columns[at], min_chars)]
            if lines:
                row, number, key = (np.concatenate(x) for x in zip(*lines, strict=True))
                goes = np.flatnonzero(~stay.stays(key.view(np.int64), doc[row], number))
                for r, k in zip(row[goes].tolist(), number[goes].tolist(), strict=True):
                    gone.setdefault(r, set()).add(k)
            if counts:
                breaks = pc.fill_null(pc.count_substring(columns[at], "\n"), -1).to_numpy(zero_copy_only=False)
                dropped = np.array([len(gone.get(r, ())) for r in range(batch.num_rows)], np.int64)
            if gone:
                texts, chars = columns[at].to_pylist(), columns[n_chars].to_pylist() if n_chars is not None else None
                for r, lines in gone.items():
                    texts[r] = "\n".join(x for k, x in enumerate(texts[r].split("\n")) if k not in lines)
                    if chars is not None:
                        chars[r] = len(texts[r])
                columns[at] = pa.array(texts, columns[at].type)
                if chars is not None:
                    columns[n_chars] = pa.array(chars, columns[n_chars].type)
            if counts:
                columns += [pa.array((breaks + 1).astype(np.int64)), pa.array(dropped)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    schema = StructType([*own.schema.fields, *([StructField("n_lines", LongType()), StructField("n_dropped", LongType())] if counts else [])])
    return own.withColumn("_doc", _row_key()).mapInArrow(cleaned, schema)
