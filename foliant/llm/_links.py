"""From buckets of candidates to verified links and connected components.

``link`` finds the components inside buckets, of any size, as if all members of
each had been compared. It goes through passes, each over what the last left open:

1. every member of a bucket is compared with the bucket's leader;
2. in buckets that still hold several components, members of different ones are
   compared with each other, but in buckets of more than TINY members with
   LEADERS of them only;
3. buckets of more than TINY members are finished, all members of different
   components compared;
4. buckets of more than SMALL members are not in the second and third pass
   themselves. Before these, all members are compared with LEADERS others in up
   to ROUNDS rounds, and split by SPLITS further band keys, again and again,
   into small buckets, which those passes take. This finds most of their links
   cheaply, but not those of members that agree in few bands. So they are
   finished at last like the others, all members of different components
   compared, dealt into blocks of which each two meet in a task.

The last pass looks at the bitmaps of a bucket's pairs, a square of its members,
in as many tasks as there are pairs of blocks; copies of a member are at most
MOST_BLOCKS.

A pair is verified only if its bitmaps allow the threshold. A bitmap has, for
each of its bits, the parity of the elements that fall on it; two bitmaps differ
in no more bits than their sets have elements of their own, so this test never
loses a link. The first pass uses short ones, the others, over fewer rows, long
ones, which tell pairs just below the threshold from links. All steps are joins and aggregates with partial sums, which Spark
splits if a bucket is hot.

``components`` is a distributed union-find: alternating large-star and
small-star contractions until every node points at the least one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from . import _bytes
from ._sorted import RecordFiles
from ._spark import cut, release, tidy

LEADERS = 8
#: Pairs that are verified at a time; a row's number takes 12 bits of a sort key.
PAIRS = 256
#: A bucket of more members is split before its members are compared with each other.
SMALL = 2048
SPLITS = 2
MOST_SPLITS = 8
#: Rounds of LEADERS that a larger bucket goes through, and how many blocks its members are dealt into at most.
ROUNDS = 4
MOST_BLOCKS = 64
#: Bitmaps that are held against a block's at a time.
ABREAST = 128
#: In buckets of so few members all are compared at once.
TINY = 32
#: 64-bit words of the bitmaps of the first pass and of the others; the first divides the second.
COARSE, FINE = 4, 32


def bitmaps(row: np.ndarray, element: np.ndarray, count: np.ndarray, rows: int, words: int = FINE) -> np.ndarray:
    """rows x words of int64: per bit the parity of a row's elements on it; an element of count 3 is three elements.

    row, element, count: distinct elements.
    """
    extra = np.repeat(np.arange(len(count)), count - 1)
    copy = np.arange(len(extra)) - np.repeat(np.cumsum(count - 1) - (count - 1), count - 1) + 1
    bit = np.concatenate([element, _bytes.mix(element[extra] + copy.astype(np.uint64))]) % np.uint64(64 * words)
    out = np.zeros(rows * words, np.uint64)
    np.bitwise_xor.at(out, np.concatenate([row, row[extra]]) * words + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out.view(np.int64).reshape(rows, words)


def folded(maps: np.ndarray) -> np.ndarray:
    """Long bitmaps as short ones."""
    return np.bitwise_xor.reduce(maps.reshape(len(maps), maps.shape[1] // COARSE, COARSE), axis=1)


def lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1]), pa.int32()), pa.array(rows.reshape(-1)))


def packed(rows: np.ndarray) -> pa.Array:
    """Rows of 64-bit words as binary values, which cost far less on their way than lists."""
    n, size = len(rows), rows.shape[1] * 8
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * size).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def unpacked(column: pa.Array, words: int) -> np.ndarray:
    """The rows of uint64 of a column of ``packed``; no nulls."""
    if not len(column):
        return np.zeros((0, words), np.uint64)
    data, ends = np.frombuffer(column.buffers()[2], np.uint8), np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return data[ends[0] : ends[-1]].copy().view(np.uint64).reshape(len(column), words)


def key_lists(keys: DataFrame) -> DataFrame:
    """(id, keys binary) with the keys as array<long>."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.frombuffer(k, np.int64) for k in batch.column(1).to_pylist()], pa.list_(pa.int64()))], ["id", "keys"])

    return keys.select("id", "keys").mapInArrow(listed, "id long, keys array<long>")


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """rows x bands of uint64 from rows x registers."""
    parts = signature.reshape(len(signature), bands, -1)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(parts.shape[2]):
        key = _bytes.mix(key * np.uint64(0x9E3779B97F4A7C15) ^ parts[:, :, k].astype(np.uint64))
    return key


def verifier(texts: DataFrame, bags: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Callable[[DataFrame], DataFrame]:
    """For ``link``: the exact overlap of the texts (id, text) of pairs (a, b), sum of smaller counts over sum of larger ones.

    bags: (row, element, count), sorted, of the texts in a run of bytes.
    """

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")

        @tidy
        def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sims = [np.zeros(0)]
                for at in range(0, batch.num_rows, PAIRS):
                    part = batch.slice(at, PAIRS)
                    # the text of an id that stands in several pairs is taken apart once
                    ids = np.concatenate([part.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)])
                    _, first, back = np.unique(ids, return_index=True, return_inverse=True)
                    texts_of = pa.concat_arrays([part.column(2), part.column(3)]).take(pa.array(first))
                    sims.append(_text_overlaps(texts_of, back[: part.num_rows], back[part.num_rows :], bags))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(sims))], ["a", "b", "sim"])

        return both.select("a", "b", "ta", "tb").mapInArrow(compared, "a long, b long, sim double")

    return verify


def _text_overlaps(texts: pa.Array, i: np.ndarray, j: np.ndarray, bags: Callable) -> np.ndarray:
    """The overlap of the texts at each i and j, PAIRS at most."""
    row, element, count = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for start, _, data, offsets in _bytes.chunks(texts):
        own = bags(data, offsets)
        row.append(own[0] + start)
        element.append(own[1])
        count.append(own[2])
    bag = [np.concatenate(x) for x in (row, element, count)]
    return overlaps(_gathered(bag, i, len(texts)), _gathered(bag, j, len(texts)), len(i))


def record(maps: np.ndarray, texts: list[bytes]) -> list[bytes]:
    """Records of long bitmaps and texts, as ``described`` and ``record_verifier`` read them."""
    size, raw = maps.shape[1] * 8, maps.tobytes()
    return [raw[k * size : (k + 1) * size] + text for k, text in enumerate(texts)]


def _maps_at(records: RecordFiles, places: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(records.read(places, 0, FINE * 8)), np.uint64).reshape(len(places), FINE)


def described(records: RecordFiles) -> Callable[[DataFrame], DataFrame]:
    """For ``link``: rows with an id, and n and map, the long bitmap, beside."""

    def known(rows: DataFrame) -> DataFrame:
        at, names = rows.columns.index("id"), [*rows.columns, "n", "map"]

        @tidy
        def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places = records.find(batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places["n"].copy()), packed(_maps_at(records, places))], names)

        return rows.mapInArrow(made, StructType([*rows.schema.fields, StructField("n", IntegerType()), StructField("map", BinaryType())]))

    return known


def record_verifier(records: RecordFiles, bags: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]], threshold: float) -> Callable[[DataFrame], DataFrame]:
    """As ``verifier``, of the texts in records, read where they lie; pairs that cannot reach the threshold by sizes and bitmaps are left out."""

    def verify(pairs: DataFrame) -> DataFrame:
        @tidy
        def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, back = np.unique(np.concatenate([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1)]), return_inverse=True)
                places = records.find(ids)
                i, j = _near(threshold, places["n"].astype(np.int64), np.arange(len(ids)), _maps_at(records, places), back[: batch.num_rows], back[batch.num_rows :])
                order = np.lexsort((j, i))
                i, j, sims = i[order], j[order], [np.zeros(0)]
                for at in range(0, len(i), PAIRS):
                    x, own = np.unique(np.concatenate([i[at : at + PAIRS], j[at : at + PAIRS]]), return_inverse=True)
                    half = len(own) // 2
                    sims.append(_text_overlaps(pa.array(records.read(places[x], FINE * 8), pa.large_binary()), own[:half], own[half:], bags))
                yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[j]), pa.array(np.concatenate(sims))], ["a", "b", "sim"])

        return pairs.mapInArrow(compared, "a long, b long, sim double")

    return verify


def _gathered(bag: list[np.ndarray], rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bags of ``rows``, numbered from 0, of n bags."""
    begin = np.searchsorted(bag[0], np.arange(n + 1))
    size = np.diff(begin)[rows]
    at = np.arange(int(size.sum())) + np.repeat(begin[rows] - (np.cumsum(size) - size), size)
    return np.repeat(np.arange(len(rows)), size), bag[1][at], bag[2][at]


def overlaps(a: tuple[np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray], rows: int) -> np.ndarray:
    """The overlap of the multisets of each row, 1 for two empty ones; elements of 52 bits."""
    total = np.bincount(a[0], a[2], rows) + np.bincount(b[0], b[2], rows)
    key, other = ((x[0].astype(np.uint64) << np.uint64(52)) | x[1] for x in (a, b))
    shared = np.zeros(rows)
    if len(key) and len(other):
        at = np.minimum(np.searchsorted(other, key), len(other) - 1)
        same = other[at] == key
        shared = np.bincount(a[0][same], np.minimum(a[2][same], b[2][at[same]]), rows)
    return np.where(total > 0, shared / np.maximum(total - shared, 1), 1.0)


def _may_link(threshold: float, words: int, a: str, b: str) -> Column:
    """Whether sets of n elements with these bitmaps can reach the threshold; columns {a}n, {a}map and {b}n, {b}map."""
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    apart = sum((F.bit_count(F.col(f"{a}map")[i].bitwiseXOR(F.col(f"{b}map")[i])) for i in range(words)), F.lit(0))
    # a hair of room for rounding
    return (F.least(na, nb) >= F.greatest(na, nb) * (threshold - 1e-9)) & (apart <= (na + nb) * ((1 - threshold) / (1 + threshold) + 1e-9))


def link(members: DataFrame, known: DataFrame | Callable[[DataFrame], DataFrame], keys: DataFrame, verify: Callable[[DataFrame], DataFrame], threshold: float) -> DataFrame:
    """(id, root) of all ids that have a link: components over verified links.

    members: (bucket long, id long), distinct. known: (id, n int, map
    array<long>, fine binary), the number of elements of each id, its short and
    its long bitmap; or a function that puts n and map, the long bitmap, beside
    rows with an id (``described``). keys: (id, keys binary), the band keys of each id, its
    buckets among them; read only to split a large bucket. verify: takes distinct (a, b), a < b, and returns (a, b, sim) for each
    of them; where known is a function, it tests bitmaps itself and may leave out pairs below the threshold.
    """
    lead = members.groupBy("bucket").agg(F.min("id").alias("o_id"), F.count("*").alias("rows")).filter("rows > 1")
    led = cut(members.join(lead, "bucket"), by_workers=True)
    pairs = _pairs(led.filter("id != o_id"))
    joined = isinstance(known, DataFrame)
    if joined:
        table = known
        for side in ("a", "b"):
            pairs = pairs.join(table.select(F.col("id").alias(side), F.col("n").alias(f"{side}_n"), F.col("map").alias(f"{side}_map")), side)
        pairs = pairs.filter(_may_link(threshold, COARSE, "a_", "b_")).select("a", "b")
        known = lambda rows: rows.join(table.select("id", "n", F.col("fine").alias("map")), "id")
    roots = _joined(None, verify(pairs), threshold)

    # what is left: buckets with several components; one of two members has no other pair
    left = cut(known(_mixed(led.filter("rows > 2").select("bucket", "id"), roots)).select("bucket", "id", "n", "root", "map", "rows"), by_workers=joined)
    small, large, depth = left.filter(F.col("rows") <= SMALL), left.filter(F.col("rows") > SMALL), 0
    tables = [led, left]

    def added(tries: DataFrame, roots: DataFrame) -> tuple[DataFrame, bool]:
        """The components with the links among ``tries``, and whether there are any."""
        links = cut(verify(_pairs(tries)).filter(F.col("sim") >= threshold))
        found = not links.isEmpty()
        out = _joined(roots, links, threshold) if found else roots
        release(links, *([roots] if found else []))
        return out, found

    def open_rows(rows: DataFrame, roots: DataFrame) -> DataFrame:
        """Of ``rows``: the buckets in which several components still meet."""
        out = cut(_mixed(rows.select("bucket", "id", "n", "map"), roots).select("bucket", "id", "n", "root", "map", "rows"), by_workers=True)
        tables.append(out)
        return out

    some_large = not large.isEmpty()
    for turn in range(ROUNDS if some_large else 0):
        roots, found = added(_crossed(_led_blocks(large, turn), threshold), roots)
        if not found:
            break
        large = open_rows(large, roots)
        if large.isEmpty():
            break
    whole, some_large = large, some_large and not large.isEmpty()
    while depth < MOST_SPLITS and some_large and not large.isEmpty():
        depth += 1
        split = large.drop("rows").join(key_lists(keys), "id")
        if depth == 1:
            split = split.withColumn("band", (F.array_position("keys", F.col("bucket")) - 1).cast("int"))
        split = split.withColumn("step", F.explode(F.array(*[F.lit(k + 1) for k in range(SPLITS)]))).withColumn("band", F.pmod(F.col("band") + F.col("step"), F.size("keys")))
        split = split.withColumn("bucket", F.xxhash64("bucket", F.col("keys")[F.col("band")])).drop("keys", "step")
        of = split.groupBy("bucket").agg(F.count("*").alias("rows"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("bucket", "rows")
        split = cut(split.join(of, "bucket"), by_workers=True)
        tables.append(split)
        small = small.unionByName(split.filter(F.col("rows") <= SMALL).select(*small.columns))
        large = split.filter(F.col("rows") > SMALL)

    def tried(rows: DataFrame, leaders: int | None, roots: DataFrame) -> DataFrame:
        tries = _together(rows.select("bucket", "id", "n", "root", "map"), "bucket").mapInArrow(_across(threshold, leaders), "id long, o_id long")
        out = _joined(roots, verify(_pairs(tries)), threshold)
        release(roots)
        return out

    roots = tried(small, LEADERS, roots)
    rest = small.filter(F.col("rows") > TINY).select("bucket", "id", "n", "map")
    if not rest.isEmpty():
        roots = tried(_mixed(rest, roots), None, roots)
    if some_large:
        whole = open_rows(whole, roots)
        if not whole.isEmpty():
            roots, _ = added(_crossed(_block_pairs(whole), threshold), roots)
    release(*tables)
    return roots


def _blocks(rows: DataFrame) -> DataFrame:
    """``rows`` of large buckets with blocks, the number of the bucket's blocks, and own, the one of a member."""
    dealt = rows.withColumn("blocks", F.least(F.ceil(F.col("rows") / SMALL), F.lit(MOST_BLOCKS)).cast("int"))
    return dealt.withColumn("own", F.pmod(F.xxhash64("id", "bucket"), F.col("blocks")).cast("int"))


def _cell(a: str, b: str) -> Column:
    """A number for two blocks of a bucket; if cells should share one by chance, more is compared."""
    return F.xxhash64("bucket", a, b)


#: The sides of a cell: rows of the first meet those of the second; rows of both meet each other.
FIRST, SECOND, BOTH = 0, 1, 2


def _block_pairs(rows: DataFrame) -> DataFrame:
    """(cell, id, n, root, side, map): each two members of a bucket meet in one cell."""
    met = _blocks(rows).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), BOTH).when(F.col("own") < F.col("other"), FIRST).otherwise(SECOND)
    met = met.withColumns({"side": side, "lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
    return met.select(_cell("lo", "hi").alias("cell"), "id", "n", "root", "side", "map")


def _led_blocks(rows: DataFrame, turn: int) -> DataFrame:
    """(cell, id, n, root, side, map): each member of a bucket meets LEADERS of them, drawn anew each turn."""
    drawn = [F.min_by("id", F.xxhash64("id", F.lit(turn * LEADERS + k))) for k in range(LEADERS)]
    leaders = rows.groupBy("bucket").agg(F.array_distinct(F.array(*drawn)).alias("ids")).select("bucket", F.explode("ids").alias("id"))
    dealt = _blocks(rows)
    led = dealt.join(leaders, ["bucket", "id"], "left_semi").withColumn("own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", F.lit(FIRST))
    both = led.unionByName(dealt.withColumn("side", F.lit(SECOND)))
    return both.select(_cell("own", "own").alias("cell"), "id", "n", "root", "side", "map")


def _crossed(cells: DataFrame, threshold: float) -> DataFrame:
    """The pairs (id, o_id) that meet in a cell, differ in root and may reach the threshold."""
    share = (1 - threshold) / (1 + threshold) + 1e-9

    def pairs(ids, n, root, side, maps) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        short = folded(maps)
        first, second = (own[np.argsort(n[own], kind="stable")] for own in (np.flatnonzero(side != SECOND), np.flatnonzero(side != FIRST)))
        of, sizes, roots = np.ascontiguousarray(short[second].T), n[second], root[second]
        for at in range(0, len(first), ABREAST):
            x = first[at : at + ABREAST]
            # only sets of like size can be alike
            lo = int(np.searchsorted(sizes, n[x[0]] * (threshold - 1e-9), "left"))
            hi = int(np.searchsorted(sizes, n[x[-1]] / (threshold - 1e-9), "right"))
            apart = np.zeros((len(x), hi - lo), np.uint16)
            for k in range(COARSE):
                apart += np.bitwise_count(short[x, k][:, None] ^ of[k, lo:hi])
            near = (apart <= (n[x][:, None] + sizes[lo:hi]) * share) & (root[x][:, None] != roots[lo:hi])
            # of rows on both sides each pair is met twice
            near &= (side[x][:, None] != BOTH) | (side[second[lo:hi]] != BOTH) | (ids[x][:, None] < ids[second[lo:hi]])
            i, j = np.nonzero(near)
            yield _near(threshold, n, root, maps, x[i], second[lo:hi][j])

    @tidy
    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, *own in _whole(batches, 5):
            at = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            for a, b in zip(at.tolist(), [*at[1:].tolist(), len(cell)], strict=True):
                one = [x[a:b] for x in own]
                for i, j in pairs(*one):
                    if len(i):
                        yield pa.RecordBatch.from_arrays([pa.array(one[0][i]), pa.array(one[0][j])], ["id", "o_id"])

    return _together(cells, "cell").mapInArrow(crossed, "id long, o_id long")


def _together(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` sorted by ``key`` (long), all rows of a key in one partition.

    Dealt by another expression than joins on the key are: Spark leaves out a
    repartition that repeats a join's, and may then read that join's input by the
    tasks that wrote it, or split its large partitions.
    """
    return rows.repartition(F.xxhash64(key)).sortWithinPartitions(key)


def _near(threshold: float, n: np.ndarray, root: np.ndarray, maps: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the index pairs (i, j): those that differ in root and may reach the threshold by sizes and bitmaps."""
    share = (1 - threshold) / (1 + threshold) + 1e-9
    a, b = n[i], n[j]
    open_ = np.flatnonzero((root[i] != root[j]) & (np.minimum(a, b) >= np.maximum(a, b) * (threshold - 1e-9)))
    i, j = i[open_], j[open_]
    found = []
    for at in range(0, len(i), 1 << 14):
        x, y = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
        apart = np.bitwise_count(maps[x] ^ maps[y]).sum(axis=1, dtype=np.int64)
        near = apart <= (n[x] + n[y]) * share
        found.append((x[near], y[near]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def _whole(batches: Iterator[pa.RecordBatch], longs: int) -> Iterator[list[np.ndarray]]:
    """Runs of whole groups, by the first of ``longs`` columns of whole numbers, beside the unpacked bitmaps after these."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        own = [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(longs)] + [unpacked(batch.column(longs), FINE)]
        # the last group may go on in the next batch
        end = int(np.searchsorted(own[0], own[0][-1]))
        if end or (held and held[-1][0][-1] != own[0][0]):
            done = [*held, [x[:end] for x in own]]
            yield [np.concatenate(x) for x in zip(*done, strict=True)]
            held = []
        held.append([x[end:] for x in own])
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _across(threshold: float, leaders: int | None):
    """For sorted runs of (bucket, id, n, root, map): the pairs (id, o_id) of a bucket that differ in root and may reach the threshold.

    leaders: how many members of a run of more than TINY the others are compared with; None for all.
    """

    def pairs(bucket, ids, n, root, maps) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        size = np.diff(np.append(at, len(bucket)))
        left = np.repeat(at + size, size) - np.arange(len(bucket))
        few = np.repeat(size <= TINY, size)
        for d in range(1, min(int(size.max(initial=0)), TINY)):
            i = np.flatnonzero(few & (left > d))
            yield _near(threshold, n, root, maps, i, i + d)
        order = _bytes.mix(ids.view(np.uint64) ^ bucket.view(np.uint64))
        for k in np.flatnonzero(size > TINY).tolist():
            run = at[k] + np.argsort(order[at[k] : at[k] + size[k]], kind="stable")
            for i in range(len(run) - 1 if leaders is None else min(leaders, len(run) - 1)):
                yield _near(threshold, n, root, maps, np.full(len(run) - 1 - i, run[i]), run[i + 1 :])

    @tidy
    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done in _whole(batches, 4):
            for i, j in pairs(*done):
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(done[1][i]), pa.array(done[1][j])], ["id", "o_id"])

    return across


def _pairs(tries: DataFrame) -> DataFrame:
    return tries.select(F.least("id", "o_id").alias("a"), F.greatest("id", "o_id").alias("b")).distinct()


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` of buckets in which several components meet, with root and the bucket's number of rows."""
    placed = members.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    of = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("rows")).filter("lo != hi").select("bucket", "rows")
    return placed.join(of, "bucket")


def _joined(roots: DataFrame | None, verified: DataFrame, threshold: float) -> DataFrame:
    """(id, root) after the links are added to the components so far."""
    links = verified.filter(F.col("sim") >= threshold).select("a", "b")
    if roots is None:
        return components(links)
    named = links
    for side in ("a", "b"):
        own = roots.select(F.col("id").alias(side), F.col("root").alias(f"{side}_root"))
        named = named.join(own, side, "left").withColumn(f"{side}_root", F.coalesce(f"{side}_root", side))
    merged = components(named.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")))
    moved = roots.join(merged.select(F.col("id").alias("root"), F.col("root").alias("new")), "root", "left").select("id", F.coalesce("new", "root").alias("root"))
    # roots that were single ids before
    single = merged.join(roots.select("id"), "id", "left_anti")
    out = cut(moved.unionByName(single), by_workers=True)
    release(merged)
    return out


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every node of the links (a, b): root is the least id of its component."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), by_workers=True)
    while True:
        # done when every node points at one other that points at none
        ends = edges.groupBy("u").agg(F.count("*").alias("out")).select(F.col("u").alias("id"), "out").unionByName(edges.select(F.col("v").alias("id")).distinct().withColumn("out", F.lit(1).cast("long")))
        if ends.groupBy("id").agg(F.sum("out").alias("out")).filter("out > 1").isEmpty():
            break
        # large star: every greater neighbour of u moves to the least of u and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        # small star: u's lesser neighbours and u move to the least of them
        lesser = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(lesser, "u")
        edges, old = cut(hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lesser.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), by_workers=True), edges
        release(old)
    roots = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    out = cut(roots.unionByName(roots.select("root").distinct().select(F.col("root").alias("id"), "root")), by_workers=True)
    release(edges)
    return out
