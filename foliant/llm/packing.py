"""Operator 1, cost-balanced packing.

The cost of a piece of n tokens is estimated as ``linear * n + quadratic * n^2``
(its feed-forward and its attention work). Documents are tokenised and packed
where they lie: each task packs the documents of its own partition in groups of
about GROUP_TOKENS, so nothing is shuffled and nothing but the group is held.
Whole sequences are cut off a document's front; what remains is assigned, in
descending length, to the sequence of least cost that has room. A group opens
just as many sequences as its tokens need; a remainder that fits no sequence
whole is cut over those with most room, so a group wastes less than one
sequence.

Defined results: a null text is an empty one (only the end id); repeated rows
are packed each on its own; ties go to the earlier document and the lower
sequence; extra columns are ignored; an empty table gives no rows; a text of any length is
tokenised and packed whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ._spark import tidy
from ._tokens import column_ids

GROUP_TOKENS = 2_000_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def assign(lengths: np.ndarray, size: int, linear: float = 1.0, quadratic: float = 1.0 / 512) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of all pieces of documents of these lengths."""
    pieces, free = [], 0
    for i in np.flatnonzero(lengths >= size).tolist():
        for k in range(int(lengths[i]) // size):
            pieces.append((i, k * size, size, free, 0))
            free += 1
    rest = lengths % size
    room = np.full(-(-int(rest.sum()) // size), size, np.int64)
    cost = np.zeros(len(room))
    order = np.argsort(-rest, kind="stable")

    def put(i: int, start: int, n: int, s: int) -> None:
        pieces.append((i, start, n, free + s, size - int(room[s])))
        room[s] -= n
        cost[s] += linear * n + quadratic * n * n

    for i in order[: np.count_nonzero(rest)].tolist():
        n = int(rest[i])
        start = int(lengths[i]) - n
        s = int(np.argmin(np.where(room >= n, cost, np.inf)))
        if room[s] >= n:
            put(i, start, n, s)
            continue
        while n:
            s = int(np.argmax(room))
            take = min(n, int(room[s]))
            put(i, start, take, s)
            start, n = start + take, n - take
    return pieces


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text); ``with_ids`` adds the piece's ids as an array of ints."""

    @tidy
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        used, names, ids, lengths, held = 0, [], [], [], 0

        def flush():
            nonlocal used
            stream = np.concatenate(ids)
            n = np.concatenate(lengths)
            at = np.concatenate([[0], np.cumsum(n)])
            pieces = assign(n, size)
            doc, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
            begin = at[doc] + start
            crc = np.fromiter((zlib.crc32(stream[b : b + k].data) for b, k in zip(begin.tolist(), length.tolist(), strict=True)), np.int64, len(doc))
            all_names = pa.chunked_array(names, pa.int64()).combine_chunks()
            columns = [all_names.take(pa.array(doc)), start, length, crc, n[doc], base + used + sequence, offset]
            out = {k: pa.array(v) for k, v in zip(("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"), columns, strict=True)}
            used += int(sequence.max()) + 1
            if with_ids:
                out["ids"] = pa.array([stream[b : b + k].astype(np.int32) for b, k in zip(begin.tolist(), length.tolist(), strict=True)], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            doc_id = batch.column(0)
            for row, chunk, offsets in column_ids(tokenizer, batch.column(1)):
                ends = offsets[1:]
                stream = np.insert(chunk, ends, end_id).astype("<u4")
                names.append(doc_id.slice(row, len(ends)).cast(pa.int64()))
                ids.append(stream)
                lengths.append(np.diff(offsets) + 1)
                held += len(stream)
                if held >= GROUP_TOKENS:
                    yield flush()
                    names, ids, lengths, held = [], [], [], 0
        if ids:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(packed, SCHEMA + (", ids array<int>" if with_ids else ""))
