"""Operator 9, SpotSigs fingerprints.

A spot is a common word (an anchor); its signature is the anchor and the chain of
the next CHAIN content words after it. A text's fingerprint is the multiset of
its signatures, 32 bits each, written as sorted hexadecimal, so likeness (the
multiset Jaccard similarity) is a function of two fingerprints alone. A text
that has words but no spot has one signature of all its words.

``compare_next`` sets each document against its own edited text and against its
successor. Documents are dealt once, by ranges of the order, over buckets with
splits from a bounded sample of keys; the one document that follows each bucket
is sent to it beside. Nothing else moves, and tasks stream through their bucket.

``near_classes`` joins fingerprints: partitioned by set length, so only lengths
that the threshold allows meet, indexed inside a partition by the signatures
that a pair must share (prefix filter). Pairs are pruned by their sets' lengths
and bitmaps and then compared in full, where the fingerprints lie; groups of any
size take bounded work a document (see ``_links``).

Defined results: a null text is empty; texts without words have an empty
fingerprint and are alike (1); equal keys and texts follow each other; a null
doc_id is the last; a single document follows itself; an empty table gives no
rows; texts of any length are read whole; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _bytes, _sorted
from ._links import bitmaps, described, link, record, record_verifier
from ._spark import cut, release, tidy

CHAIN = 2
THRESHOLD = 0.8
#: Keys sampled a bucket to find the splits.
SAMPLED = 40
MOST_SAMPLED = 1_000_000

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their there they this to was we were which who will with you "
    "als am auch auf aus bei bin bis da das dass dem den der des die durch ein eine einem einen einer es für hat ich im ist mit nach nicht noch nur oder sich sie sind so über um und uns vom von vor war was wie wir zu zum zur "
    "au aux avec ce ces cette comme dans de des du elle en est et eux il ils je la le les leur lui mais ne nous on ou où par pas pour qu que qui sa se ses son sur un une vous "
    "al como con del donde el ella ellos era esta este fue ha hay la las lo los más me mi muy no nos o para pero por porque se sin sobre su sus también te tiene un una unos y ya"
)


def _anchor_hashes() -> np.ndarray:
    raw = " ".join(sorted(set(ANCHORS.split()))).encode()
    data = np.frombuffer(raw, np.uint8)
    low, starts, ends, _ = _bytes.words(data, np.array([0, len(data)]))
    return np.unique(_bytes.span_hashes(low, starts, ends))


_anchors = _anchor_hashes()
_gate = np.zeros(1 << 16, bool)
_gate[(_anchors >> np.uint64(48)).astype(np.int64)] = True


def spots(data: np.ndarray, offsets: np.ndarray, chain: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """(row, 32-bit signature) of all spots of a chunk, sorted by row and signature."""
    low, starts, ends, before = _bytes.words(data, offsets)
    hashes = _bytes.span_hashes(low, starts, ends)
    counts = np.diff(before)
    row = np.repeat(np.arange(len(counts)), counts)
    anchor = _gate[(hashes >> np.uint64(48)).astype(np.int64)]
    maybe = np.flatnonzero(anchor)
    place = np.minimum(np.searchsorted(_anchors, hashes[maybe]), len(_anchors) - 1)
    anchor[maybe] = _anchors[place] == hashes[maybe]
    content = np.flatnonzero(~anchor)
    spot = np.flatnonzero(anchor)
    first = np.searchsorted(content, spot)
    fits = first + chain <= len(content)
    spot, first = spot[fits], first[fits]
    fits = row[content[first + chain - 1]] == row[spot] if len(spot) else fits[:0]
    spot, first = spot[fits], first[fits]
    value = hashes[spot]
    for k in range(chain):
        value = _bytes.mix(value * np.uint64(0x9E3779B97F4A7C15) ^ hashes[content[first + k]])
    rows = row[spot]
    # no spot: one signature of all words
    bare = np.flatnonzero((counts > 0) & (np.bincount(rows, minlength=len(counts)) == 0))
    if len(bare):
        whole = np.array([_bytes._run(hashes[before[r] : before[r + 1]]) for r in bare], np.uint64)
        rows, value = np.concatenate([rows, bare]), np.concatenate([value, whole])
    key = np.sort((rows.astype(np.uint64) << np.uint64(32)) | (value >> np.uint64(32)))
    return (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def fingerprint_sets(texts: pa.Array, chain: int = CHAIN) -> list[np.ndarray]:
    """The sorted signature multiset of each text."""
    out: list[np.ndarray] = []
    for start, end, data, offsets in _bytes.chunks(texts):
        row, value = spots(data, offsets, chain)
        out += np.split(value, np.searchsorted(row, np.arange(1, end - start)))
    return out


def written(fingerprint: np.ndarray) -> str:
    return raw(fingerprint).hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Multiset Jaccard similarity of two sorted fingerprints; 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    if len(a) == len(b) and (a == b).all():
        return 1.0
    merged = np.sort(np.concatenate([_numbered(a), _numbered(b)]))
    shared = int((merged[1:] == merged[:-1]).sum())
    return shared / (len(a) + len(b) - shared)


def _numbered(a: np.ndarray) -> np.ndarray:
    """Repeats made distinct: the value and how many equal ones stand before it."""
    return (a.astype(np.uint64) << np.uint64(32)) | (np.arange(len(a)) - np.searchsorted(a, a)).astype(np.uint64)


def fingerprints(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """``docs`` with its fingerprint in place of the text."""
    own = docs.drop("fingerprint")
    at = own.columns.index("text")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([written(f) for f in fingerprint_sets(batch.column(at), chain)], pa.string())
            yield pa.RecordBatch.from_arrays([*[c for i, c in enumerate(batch.columns) if i != at], prints], [*[n for i, n in enumerate(batch.schema.names) if i != at], "fingerprint"])

    from pyspark.sql.types import StringType, StructField, StructType

    return own.mapInArrow(made, StructType([*[f for f in own.schema.fields if f.name != "text"], StructField("fingerprint", StringType())]))


def _bucket(key: Column, splits: list) -> Column:
    """How many of the ascending splits are at or below ``key``, in two steps of about their square root."""
    if not splits:
        return F.lit(0)
    width = max(int(len(splits) ** 0.5), 1)
    literal = lambda s: F.struct(F.lit(s[0]).cast("long").alias("d"), F.lit(s[1]).cast("long").alias("h"))
    heads = F.array(*[literal(s) for s in splits[::width]])
    groups = F.array(*[F.array(*[literal(s) for s in splits[k + 1 : k + width]]) if splits[k + 1 : k + width] else F.array().cast("array<struct<d:bigint,h:bigint>>") for k in range(0, len(splits), width)])
    top = F.size(F.filter(heads, lambda s: s <= key))
    inner = F.size(F.filter(F.element_at(groups, F.greatest(top, F.lit(1))), lambda s: s <= key))
    return F.when(top == 0, 0).otherwise((top - 1) * width + 1 + inner)


def compare_next(docs: DataFrame, chain: int = CHAIN, buckets: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of (doc_id, text) in descending order.

    A document's edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of its successor; the last's successor is the first.
    """
    spark = docs.sparkSession
    buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"), F.xxhash64(text).alias("h")).alias("key"))
    # about SAMPLED keys a bucket, at most MOST_SAMPLED in all, chosen by their hash
    share = min(1.0, min(SAMPLED * buckets, MOST_SAMPLED) / max(docs.count(), 1))
    sampled = rows.select("key").filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30))).select("key.*").collect()
    sampled = sorted((r["d"], r["h"]) for r in sampled)
    splits = sorted({sampled[k * len(sampled) // buckets] for k in range(1, buckets)} if sampled else set())
    rows = rows.withColumn("bucket", _bucket(F.col("key"), splits).cast("int"))
    # in descending order a bucket is followed by the greatest key of the next lower one that has rows
    tops = {r["bucket"]: r["top"] for r in rows.groupBy("bucket").agg(F.max("key").alias("top")).collect()}
    order = sorted(tops, reverse=True)
    after = [(tops[order[(i + 1) % len(order)]], b) for i, b in enumerate(order)]
    if not after:
        return spark.createDataFrame([], _COMPARED)
    guests = spark.createDataFrame([((t["d"], t["h"]), b) for t, b in after], "key struct<d:bigint,h:bigint>, bucket int")
    # one row a bucket; equal keys are equal texts, so any of them will do
    beside = _beside(rows, guests)
    both = rows.select("bucket", "doc_id", "text", "key", F.lit(False).alias("guest")).unionByName(beside)
    dealt = both.repartitionById(max(tops) + 1, F.col("bucket")).sortWithinPartitions("bucket", "guest", F.desc("key"))
    return dealt.select("doc_id", "text", "guest").mapInArrow(lambda batches: _compared(batches, chain), _COMPARED)


_COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _beside(rows: DataFrame, guests: DataFrame) -> DataFrame:
    """The successor of each bucket; guests has a row a bucket."""
    found = rows.drop("bucket").join(F.broadcast(guests), "key")
    return found.dropDuplicates(["bucket"]).select("bucket", "doc_id", "text", "key", F.lit(True).alias("guest"))


def _compared(batches: Iterator[pa.RecordBatch], chain: int) -> Iterator[pa.RecordBatch]:
    """Rows in order, a bucket's guest after its rows."""
    held: tuple | None = None  # the row that waits for its successor
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            prints = fingerprint_sets(part.column(1), chain)
            rows = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), prints, strict=True))
            if held is not None:
                rows.insert(0, held)
            pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if not a[2]]
            held = rows[-1]
            if not pairs:
                continue
            edited = [a[1][: len(a[1]) - len(a[1]) // 2] + b[1][: len(a[1]) // 2] for a, b in pairs]
            new = fingerprint_sets(pa.array(edited, pa.string()), chain)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([a[0] for a, _ in pairs], pa.int64()),
                "n_chars": pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                "edited_sha256": pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
                "fingerprint": pa.array([written(a[3]) for a, _ in pairs]),
                "edited_fingerprint": pa.array([written(f) for f in new]),
                "near_edited": pa.array([likeness(a[3], f) for (a, _), f in zip(pairs, new, strict=True)], pa.float64()),
                "near_next": pa.array([likeness(a[3], b[3]) for a, b in pairs], pa.float64()),
            })


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def raw(fingerprint: np.ndarray) -> bytes:
    """As ``written``, in half the bytes."""
    return fingerprint.astype(">u4").tobytes()


def print_bags(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, 52-bit element, count) of raw fingerprints."""
    value = np.frombuffer(data.tobytes(), ">u4").astype(np.uint64)
    return _bytes.bags(np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) // 4), _bytes.mix(value))


def partition_keys(fingerprint: np.ndarray, threshold: float) -> np.ndarray:
    """A key for each signature of the prefix in each partition of lengths where the fingerprint may meet another.

    Lengths are cut into partitions [l, l / threshold). A pair meets in that of
    its longer side: a fingerprint stands in its own and the next one. Two that
    reach the threshold share one of the first n - ceil(threshold n) + 1
    signatures in ascending order.
    """
    n = len(fingerprint)
    if not n:
        return np.zeros(0, np.uint64)
    signs = np.unique(fingerprint[: n - int(np.ceil(n * threshold - 1e-9)) + 1]).astype(np.uint64)
    band = int(np.floor(np.log(n) / np.log(1 / threshold) + 1e-9))
    return np.concatenate([_bytes.mix(signs << np.uint64(16) | np.uint64(b)) for b in (band, band + 1)])


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id: documents whose fingerprints are linked; equal fingerprints have one id before the join.

    Fingerprints never move: they are records beside their bitmaps, which pairs are verified by where they lie.
    """

    @tidy
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = fingerprint_sets(batch.column(1))
            keys = [partition_keys(f, threshold).tobytes() for f in prints]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([raw(f) for f in prints], pa.binary()), pa.array(keys, pa.binary())], ["doc_id", "print", "keys"])

    printed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(made, "doc_id long, print binary, keys binary")
    prints = cut(printed.withColumn("id", F.xxhash64("print")))
    listed = prints.select("id", "keys")
    members = cut(_sorted.members(listed, _sorted.shared_keys(listed)).distinct(), by_workers=True)
    records = print_records(prints)
    roots = link(members, described(records), listed.dropDuplicates(["id"]), record_verifier(records, print_bags, threshold), threshold)
    _sorted.discard(records)
    release(members)
    named = prints.select("doc_id", "id")
    classed = named.groupBy("id").agg(F.min("doc_id").alias("least")).join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = classed.groupBy("root").agg(F.min("least").alias("class_id"))
    return named.join(classed.join(least, "root").select("id", "class_id"), "id").select("doc_id", "class_id")


def print_records(prints: DataFrame) -> _sorted.RecordFiles:
    """Records of (id, print)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
        for batch in batches:
            ids, own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(1).cast(pa.large_binary())
            for start, end, data, offsets in _bytes.chunks(own):
                row, element, count = print_bags(data, offsets)
                yield ids[start:end], np.bincount(row, count, end - start).astype(np.int32), record(bitmaps(row, element, count, end - start), own.slice(start, end - start).to_pylist())

    return _sorted.record_files(prints.select("id", "print"), made)
