"""Sets of 64-bit keys as sorted files in the shared folder, memory-mapped by workers.

A task sends one sorted array of keys for each hash range, already without
repeats, so a key that is everywhere costs a task one entry. A range is merged
by one task and stored as flat files. Lookups then filter rows where they lie:
wide rows (texts, band keys) never move to meet a set. ``first_places`` and
``stay_files`` do the same for where lines stand.
"""

from __future__ import annotations

import mmap
import os
import shutil
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _bytes
from ._spark import folder, tidy

BLOB = "part int, k binary, c binary"


def write_array(path: str, array: np.ndarray) -> None:
    """Whole or not at all; a task that runs again writes the same."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        f.write(array.tobytes())
    os.replace(part, path)


def map_array(path: str, kind) -> np.ndarray:
    if not os.path.exists(path) or not os.path.getsize(path):
        return np.zeros(0, kind)
    with open(path, "rb") as f:
        return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), kind)


def key_range(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def by_part(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): rows by part, and where each part begins; small numbers are sorted by radix."""
    order = np.argsort(part.astype(np.uint16 if parts <= 1 << 16 else np.uint32), kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])


def blobs(keys: np.ndarray, values: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """One row a range of sorted keys: the keys and their 32-bit values."""
    bounds = np.searchsorted(key_range(keys, parts), np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(bounds)).tolist():
        own = slice(bounds[p], bounds[p + 1])
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([keys[own].tobytes()], pa.binary()), pa.array([values[own].astype(np.uint32).tobytes()], pa.binary())], ["part", "k", "c"])


def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(part, keys, values) sorted by key then value, a part at a time, of blob rows sorted by part."""
    part, keys, values = None, [], []

    def done():
        k, v = np.concatenate(keys), np.concatenate(values)
        order = np.lexsort((v, k))
        return part, k[order], v[order]

    for batch in batches:
        for p, k, c in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            if p != part:
                if keys:
                    yield done()
                part, keys, values = p, [], []
            keys.append(np.frombuffer(k.as_buffer(), np.uint64))
            values.append(np.frombuffer(c.as_buffer(), np.uint32))
    if keys:
        yield done()


@dataclass
class KeyFiles:
    path: str
    parts: int

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query index, value) of every entry of each of these int64 keys."""
        hashed = _bytes.mix(keys.view(np.uint64))
        order = np.argsort(hashed)
        sorted_keys = hashed[order]
        bounds = np.searchsorted(key_range(sorted_keys, self.parts), np.arange(self.parts + 1))
        at, values = [], []
        for p in np.flatnonzero(np.diff(bounds)).tolist():
            known = self._file("key", p, "u8")
            if not len(known):
                continue
            own = sorted_keys[bounds[p] : bounds[p + 1]]
            lo, hi = np.searchsorted(known, own, "left"), np.searchsorted(known, own, "right")
            n = hi - lo
            hit = np.flatnonzero(n)
            if len(hit):
                n, lo = n[hit], lo[hit]
                at.append(np.repeat(order[bounds[p] + hit], n))
                values.append(self._file("value", p, "u4")[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))])
        none = np.zeros(0, np.int64)
        return (np.concatenate(at), np.concatenate(values)) if at else (none, none.astype(np.uint32))

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), bool)
        out[self.find(keys)[0]] = True
        return out

    def _file(self, name: str, part: int, kind: str) -> np.ndarray:
        at = (self.path, name, part)
        if at not in _open:
            if len(_open) > 20_000:
                _open.clear()
            _open[at] = map_array(f"{self.path}/{name}/{part}", kind)
        return _open[at]


_open: dict[tuple[str, str, int], np.ndarray] = {}


def _stored(rows: DataFrame, parts: int) -> KeyFiles:
    """Blob rows merged and stored."""
    path = folder(rows.sparkSession, "keys")

    @tidy
    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, keys, values in ranges(batches):
            use = np.concatenate([[True], (keys[1:] != keys[:-1]) | (values[1:] != values[:-1])])
            write_array(f"{path}/key/{part}", keys[use])
            write_array(f"{path}/value/{part}", values[use])
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32())})

    rows.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(stored, "part int").agg({"part": "count"}).collect()
    return KeyFiles(path, parts)


def _parts(df: DataFrame, parts: int | None) -> int:
    return parts or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def key_files(rows: DataFrame, parts: int | None = None) -> KeyFiles:
    """The distinct (key long, value int from 0) rows."""
    parts = _parts(rows, parts)

    @tidy
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
        for batch in batches:
            keys.append(_bytes.mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)))
            values.append(batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint32))
        k, v = np.concatenate(keys), np.concatenate(values)
        order = np.lexsort((v, k))
        k, v = k[order], v[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (v[1:] != v[:-1])]) if len(k) else np.zeros(0, bool)
        yield from blobs(k[new], v[new], parts)

    return _stored(rows.mapInArrow(sent, BLOB), parts)


#: Bits of an id's hash beside the 40 low bits of a key's.
_ID_BITS = np.uint64(24)


@dataclass
class SharedKeys:
    """Keys that different ids have, as their 40 low hash bits in files by the range of the high ones."""

    path: str
    parts: int

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Of int64 keys: all that are shared, and by chance one of others now and then."""
        hashed = _bytes.mix(keys.view(np.uint64))
        part = key_range(hashed, self.parts)
        low = hashed & np.uint64((1 << 40) - 1)
        order, bounds = by_part(part, self.parts)
        out = np.zeros(len(keys), bool)
        for p in np.flatnonzero(np.diff(bounds)).tolist():
            known = map_array(f"{self.path}/{p}", "u8")
            if len(known):
                own = order[bounds[p] : bounds[p + 1]]
                at = np.minimum(np.searchsorted(known, low[own]), len(known) - 1)
                out[own] = known[at] == low[own]
        return out


def shared_keys(rows: DataFrame, parts: int | None = None) -> SharedKeys:
    """The keys that two different ids have; rows: (id long, keys binary of 64-bit words, or one long)."""
    parts = _parts(rows, parts)
    path = folder(rows.sparkSession, "shared")

    def ends(entries: np.ndarray) -> np.ndarray:
        """Of sorted entries the first and the last of each key: they differ if the key has several ids."""
        key = entries >> _ID_BITS
        new = np.concatenate([[True], key[1:] != key[:-1]])
        last = np.concatenate([new[1:], [True]])
        return entries[new | last]

    @tidy
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in range(parts)]
        for batch in batches:
            key, row = flat(batch.column(1))
            hashed = _bytes.mix(key.view(np.uint64))
            ids = _bytes.mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) >> np.uint64(40)
            entry = (hashed << _ID_BITS) | ids[row]
            part = key_range(hashed, parts)
            order, bounds = by_part(part, parts)
            entry = entry[order]
            for p in np.flatnonzero(np.diff(bounds)).tolist():
                held[p].append(entry[bounds[p] : bounds[p + 1]])
        for p, own in enumerate(held):
            if own:
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([ends(np.sort(np.concatenate(own))).tobytes()], pa.binary())], ["part", "k"])

    @tidy
    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def done():
            entries = ends(np.sort(np.concatenate(held)))
            key = entries >> _ID_BITS
            # two different entries of one key are two ids
            several = (key[1:] == key[:-1]) & (entries[1:] != entries[:-1])
            write_array(f"{path}/{part}", np.unique(key[1:][several]))

        for batch in batches:
            for p, k in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if p != part:
                    if held:
                        done()
                    part, held = p, []
                held.append(np.frombuffer(k.as_buffer(), np.uint64))
        if held:
            done()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part if part is not None else -1], pa.int32())})

    rows.mapInArrow(sent, "part int, k binary").repartition(parts, "part").sortWithinPartitions("part").mapInArrow(stored, "part int").agg({"part": "count"}).collect()
    return SharedKeys(path, parts)


def flat(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(int64 words, row of each) of a column of binary values of whole words, nulls empty, or of longs."""
    if isinstance(packed, pa.ChunkedArray):
        packed = packed.combine_chunks()
    if pa.types.is_int64(packed.type):
        return packed.to_numpy(zero_copy_only=False).astype(np.int64), np.arange(len(packed))
    if not len(packed):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if packed.null_count:
        packed = packed.fill_null(b"")
    ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1].astype(np.int64)
    data = packed.buffers()[2]
    words = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].copy().view(np.int64) if data is not None else np.zeros(0, np.int64)
    return words, np.repeat(np.arange(len(packed)), np.diff(ends) // 8)


def _once(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The first row of each id: its keys are the same in all."""
    _, first = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_index=True)
    return batch.take(pa.array(np.sort(first))) if len(first) < batch.num_rows else batch


def members(rows: DataFrame, keys: SharedKeys) -> DataFrame:
    """(bucket, id) of the keys in ``keys``; rows: (id long, keys binary)."""

    @tidy
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _once(batch)
            key, row = flat(batch.column(1))
            use = keys.holds(key)
            yield pa.RecordBatch.from_arrays([pa.array(key[use]), batch.column(0).take(pa.array(row[use]))], ["bucket", "id"])

    return rows.mapInArrow(kept, "bucket long, id long")


def where_held(rows: DataFrame, column: str, *keys: KeyFiles | SharedKeys) -> DataFrame:
    """``rows`` whose ``column`` (long) is in one of the ``keys``, filtered where they lie."""
    at = rows.columns.index(column)

    @tidy
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            yield batch.filter(pa.array(np.any([k.holds(own) for k in keys], axis=0)))

    return rows.mapInArrow(kept, rows.schema)


#: Of each key the least place (unnamed rows last, then doc_id, doc, line) and how often it occurs.
PLACES = (("key", "u8"), ("unnamed", "u1"), ("doc_id", "i8"), ("doc", "i8"), ("line", "i4"), ("n", "i8"))


def place_order(key: np.ndarray, unnamed: np.ndarray, doc_id: np.ndarray, doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The order by key and place; places are looked at only where a key repeats."""
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    several = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same])) if len(key) else np.zeros(0, np.int64)
    if len(several):
        own = order[several]
        order[several] = own[np.lexsort((line[own], doc[own], doc_id[own], unnamed[own], key[own]))]
    return order


def least_places(columns: list[np.ndarray]) -> list[np.ndarray]:
    """PLACES of the distinct keys among rows of PLACES, sorted by key."""
    key, unnamed, doc_id, doc, line, n = columns
    order = place_order(*columns[:-1])
    at = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0])) if len(key) else np.zeros(0, np.int64)
    out = [c[order[at]] for c in columns[:-1]]
    return [*out, np.add.reduceat(n[order], at) if len(at) else n]


def first_places(rows: DataFrame, candidates: KeyFiles, parts: int | None = None) -> DataFrame:
    """(id, unnamed, doc_id, doc, line, n, candidate) of the ids that occur more than once or are in ``candidates``.

    rows: (id, doc_id, doc, line, n), n times each at this or a later place. A
    task sends one entry an id, so an id that is everywhere costs little.
    """
    parts = _parts(rows, parts)

    def taken(batches: Iterator, read: Callable) -> list[np.ndarray]:
        """What ``read`` gives of each, merged whenever it has doubled."""
        held = least_places([np.zeros(0, kind) for _, kind in PLACES])
        more, size = [], 0
        for batch in batches:
            for columns in read(batch):
                more.append(columns)
                size += len(columns[0])
                if size > max(len(held[0]), 1 << 18):
                    held, more, size = least_places([np.concatenate(c) for c in zip(held, *more, strict=True)]), [], 0
        return least_places([np.concatenate(c) for c in zip(held, *more, strict=True)])

    def plain(batch):
        ids, doc_id = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
        unnamed = doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
        rest = [batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4)]
        yield [_bytes.mix(ids.astype(np.int64).view(np.uint64)), unnamed, doc_id.fill_null(0).to_numpy(zero_copy_only=False), *[c.astype(k) for c, k in zip(rest, ("i8", "i4", "i8"), strict=True)]]

    @tidy
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = taken(batches, plain)
        bounds = np.searchsorted(key_range(least[0], parts), np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(bounds)).tolist():
            own = b"".join(c[bounds[p] : bounds[p + 1]].tobytes() for c in least)
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([own], pa.binary())], ["part", "k"])

    def opened(blob) -> list[np.ndarray]:
        data, out, at = blob.as_buffer(), [], 0
        n = data.size // sum(np.dtype(kind).itemsize for _, kind in PLACES)
        for _, kind in PLACES:
            out.append(np.frombuffer(data, kind, n, at))
            at += n * np.dtype(kind).itemsize
        return out

    @tidy
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows_of):
            key, unnamed, doc_id, doc, line, n = taken(rows_of, lambda blob: [opened(blob)])
            ids = _unmix(key).view(np.int64)
            candidate = candidates.holds(ids)
            use = (n > 1) | candidate
            names = ("id", "unnamed", "doc_id", "doc", "line", "n", "candidate")
            columns = [ids, unnamed.astype(bool), doc_id, doc, line, n, candidate]
            return pa.RecordBatch.from_arrays([pa.array(c[use], mask=unnamed[use].astype(bool) if k == 2 else None) for k, c in enumerate(columns)], names)

        for _, group in groupby(((p, k) for batch in batches for p, k in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)), key=lambda x: x[0]):
            yield out(k for _, k in group)

    blobs_of = rows.mapInArrow(sent, "part int, k binary").repartition(parts, "part").sortWithinPartitions("part")
    return blobs_of.mapInArrow(merged, "id long, unnamed boolean, doc_id long, doc long, line int, n long, candidate boolean")


def _unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``_bytes.mix``."""
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x = x * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


@dataclass
class StayFiles:
    """Of each id a place (doc, line), in files sorted by id."""

    path: str
    parts: int

    def stays(self, ids: np.ndarray, doc: np.ndarray, line: np.ndarray) -> np.ndarray:
        """Whether lines (id, doc, line) stay: those of ids that are not here, and those at the kept place."""
        known, here = self._found(ids, doc, line)
        return ~known | here

    def hold(self, ids: np.ndarray, doc: np.ndarray, line: np.ndarray) -> np.ndarray:
        """Whether lines are here with their place."""
        return self._found(ids, doc, line)[1]

    def _found(self, ids: np.ndarray, doc: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the id is here, and whether with this place."""
        hashed = _bytes.mix(ids.view(np.uint64))
        part = key_range(hashed, self.parts)
        order, bounds = by_part(part, self.parts)
        known, here = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        for p in np.flatnonzero(np.diff(bounds)).tolist():
            keys = self._file("key", p, "u8")
            if len(keys):
                own = order[bounds[p] : bounds[p + 1]]
                at = np.minimum(np.searchsorted(keys, hashed[own]), len(keys) - 1)
                found = np.flatnonzero(keys[at] == hashed[own])
                own, place = own[found], self._file("place", p, "i8").reshape(-1, 2)[at[found]]
                known[own] = True
                here[own] = (place[:, 0] == doc[own]) & (place[:, 1] == line[own])
        return known, here

    _file = KeyFiles._file


def stay_files(rows: DataFrame, parts: int | None = None) -> StayFiles:
    """rows: (id, doc, line), one an id."""
    parts = _parts(rows, parts)
    path = folder(rows.sparkSession, "stay")
    kind = np.dtype([("key", "u8"), ("doc", "i8"), ("line", "i8")])

    @tidy
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.zeros(batch.num_rows, kind)
            own["key"] = _bytes.mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            own["doc"], own["line"] = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
            own = own[np.argsort(own["key"])]
            bounds = np.searchsorted(key_range(own["key"], parts), np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(bounds)).tolist():
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([own[bounds[p] : bounds[p + 1]].tobytes()], pa.binary())], ["part", "k"])

    @tidy
    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, group in groupby(((p, k) for batch in batches for p, k in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)), key=lambda x: x[0]):
            own = np.concatenate([np.frombuffer(k.as_buffer(), kind) for _, k in group])
            own = own[np.argsort(own["key"])]
            write_array(f"{path}/place/{p}", np.stack([own["doc"], own["line"]], axis=1))
            write_array(f"{path}/key/{p}", own["key"])
            yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int32())})

    rows.mapInArrow(sent, "part int, k binary").repartition(parts, "part").sortWithinPartitions("part").mapInArrow(stored, "part int").agg({"part": "count"}).collect()
    return StayFiles(path, parts)


#: Of an id's record: the file it lies in, its first byte and size there, and a number that belongs to it.
RECORD = np.dtype([("key", "u8"), ("file", "i8"), ("start", "i8"), ("size", "i4"), ("n", "i4")])


@dataclass
class RecordFiles:
    """Of each id a record of bytes, in the file of the task that made it, and its RECORD in files sorted by id: records are read where they lie."""

    path: str
    parts: int

    def find(self, ids: np.ndarray) -> np.ndarray:
        """The RECORD of each of these int64 ids, all of which have one."""
        hashed = _bytes.mix(ids.view(np.uint64))
        order, bounds = by_part(key_range(hashed, self.parts), self.parts)
        out = np.zeros(len(ids), RECORD)
        out["key"] = ~hashed
        for p in np.flatnonzero(np.diff(bounds)).tolist():
            own, known = order[bounds[p] : bounds[p + 1]], self._file("key", p, "u8")
            if len(known):
                out[own] = self._file("place", p, RECORD)[np.minimum(np.searchsorted(known, hashed[own]), len(known) - 1)]
        if (out["key"] != hashed).any():
            raise KeyError("an id has no record")
        return out

    def read(self, places: np.ndarray, start: int, end: int | None = None) -> list[bytes]:
        """Bytes ``start`` to ``end`` (the last, if None) of the records at these places."""
        first = places["start"] + start
        last = places["start"] + (places["size"] if end is None else end)
        return [self._file("record", f, "u1")[a:b].tobytes() for f, a, b in zip(places["file"].tolist(), first.tolist(), last.tolist(), strict=True)]

    _file = KeyFiles._file


def record_files(rows: DataFrame, made: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]], parts: int | None = None) -> RecordFiles:
    """made: for a task's batches of ``rows`` runs of (ids, their numbers n, their records); of several records of an id, which must be equal, one is kept."""
    parts = _parts(rows, parts)
    path = folder(rows.sparkSession, "records")

    @tidy
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a file of this run of the task alone: places of another run, in which rows may come in another order, do not lead here
        name, end, places = uuid.uuid4().int >> 65, 0, [np.zeros(0, RECORD)]
        os.makedirs(f"{path}/record", exist_ok=True)
        with open(f"{path}/record/{name}", "wb") as f:
            for ids, n, records in made(batches):
                own = np.zeros(len(ids), RECORD)
                own["key"], own["file"], own["n"] = _bytes.mix(ids.view(np.uint64)), name, n
                own["size"] = [len(r) for r in records]
                own["start"] = end + np.cumsum(own["size"], dtype=np.int64) - own["size"]
                end += f.write(b"".join(records))
                places.append(own)
        own = np.concatenate(places)
        own = own[np.argsort(own["key"])]
        bounds = np.searchsorted(key_range(own["key"], parts), np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(bounds)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([own[bounds[p] : bounds[p + 1]].tobytes()], pa.binary())], ["part", "k"])

    @tidy
    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, group in groupby(((p, k) for batch in batches for p, k in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)), key=lambda x: x[0]):
            own = np.concatenate([np.frombuffer(k.as_buffer(), RECORD) for _, k in group])
            key, first = np.unique(own["key"], return_index=True)
            write_array(f"{path}/place/{p}", own[first])
            write_array(f"{path}/key/{p}", key)
            yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int32())})

    rows.mapInArrow(written, "part int, k binary").repartition(parts, "part").sortWithinPartitions("part").mapInArrow(stored, "part int").agg({"part": "count"}).collect()
    return RecordFiles(path, parts)


def discard(files: RecordFiles) -> None:
    """Deletes files that nothing will read again."""
    shutil.rmtree(files.path, ignore_errors=True)
