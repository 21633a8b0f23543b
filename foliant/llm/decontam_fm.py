"""Operator 6, benchmark decontamination by an FM-index per training shard.

Each task gathers shards of about SHARD_WORDS words of its own partition. Words
that no benchmark window has become breaks, and stretches between breaks that
are shorter than the shortest window are left out (no window can occur there).
Over the rest an FM-index is built: suffix array by prefix doubling, the
Burrows-Wheeler transform in a wavelet matrix with packed ranks, and sampled
suffix positions. All windows are searched backward at once; occurrences are
located by stepping to the nearest sample. Word spans of occurrences merge to
removal spans.

Documents are not shuffled. The benchmark is the query set. It is searched in
blocks of about BLOCK_CHARS characters: a single one is broadcast, several are
files in the shared folder, of which driver and tasks hold one at a time.

A window is WINDOW consecutive words of an item; a shorter item, unless it has
no words, is one window. Defined results: a null text has no words; repeated
rows are judged each; items that share an item_id are one item; a null item_id
is written as an empty string; an empty benchmark hits nothing; an empty
documents table gives no rows; a text is never cut, however long, and makes a
shard of its own if it must; extra columns are kept, but own columns of the
results' names are replaced.
"""

from __future__ import annotations

import os
import pickle
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from . import _bytes
from ._spark import folder, tidy

WINDOW = 13
SHARD_WORDS = 1_000_000
BLOCK_CHARS = 2_000_000
SAMPLE = 16


class WaveletMatrix:
    """Ranks of every symbol in a sequence of small integers."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.bits, self.levels = len(symbols), bits, []
        at = symbols
        for k in range(bits - 1, -1, -1):
            bit = (at >> k) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + (-len(packed)) % 8, np.uint8)]).view(np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed))[:-1]]).astype(np.int64)
            self.levels.append((packed, before, int(self.n - bit.sum())))
            at = np.concatenate([at[bit == 0], at[bit == 1]])

    @staticmethod
    def _ones(level, i: np.ndarray) -> np.ndarray:
        packed, before, _ = level
        w = i >> 6
        return before[w] + np.bitwise_count(packed[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before position i."""
        start = np.zeros_like(i)
        for k, level in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            one = ((symbol >> k) & 1).astype(bool)
            a, b = self._ones(level, i), self._ones(level, start)
            i = np.where(one, level[2] + a, i - a)
            start = np.where(one, level[2] + b, start - b)
        return i - start

    def symbol(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros_like(i)
        for level in self.levels:
            bit = ((level[0][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            a = self._ones(level, i)
            i = np.where(bit == 1, level[2] + a, i - a)
            out = out * 2 + bit
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling. Zeros are breaks: they differ from each other by place, so no comparison runs past one."""
    n = len(text)
    zeros = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(zeros)
    rank[zeros] = np.arange(len(zeros))
    k = 1
    while True:
        key = rank << 32
        key[: n - k] |= rank[k:] + 1
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        k *= 2


class FMIndex:
    """text: symbols from 1 up, 0 for breaks; it must begin and end with a break."""

    def __init__(self, text: np.ndarray, n_symbols: int, sample: int = SAMPLE):
        sa = suffix_array(text)
        bwt = text[sa - 1]
        self.n = len(text)
        self.wavelet = WaveletMatrix(bwt.astype(np.int64), max(int(n_symbols).bit_length(), 1))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))])
        kept = (sa % sample == 0) | (bwt == 0)
        self.kept = kept
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])
        self.kept_at = sa[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lo, hi) rows of the suffixes that begin with each phrase (left-aligned rows, 0 beyond the length)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        active = np.flatnonzero(lengths > 0)
        for step in range(int(lengths.max(initial=0))):
            active = active[(lengths[active] > step) & (hi[active] > lo[active])]
            if not len(active):
                break
            c = phrases[active, lengths[active] - 1 - step].astype(np.int64)
            lo[active] = self.first[c] + self.wavelet.rank(c, lo[active])
            hi[active] = self.first[c] + self.wavelet.rank(c, hi[active])
        return lo, np.maximum(hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, none of which begins with a break."""
        out, steps, left = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(left):
            at = rows[left]
            done = self.kept[at]
            out[left[done]] = self.kept_at[self.kept_before[at[done]]] + steps
            left = left[~done]
            at = rows[left]
            c = self.wavelet.symbol(at)
            rows[left] = self.first[c] + self.wavelet.rank(c, at)
            steps += 1
        return out


class Block:
    """Windows of some benchmark items: distinct phrases over a vocabulary of word hashes, and the items of each."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        hashes, owner = [np.zeros(0, np.uint64)], []
        for item, text in items:
            data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            low, starts, ends, _ = _bytes.words(data, np.array([0, len(data)]))
            hashes.append(_bytes.span_hashes(low, starts, ends))
            owner.append(item)
        self.vocabulary = np.unique(np.concatenate(hashes))
        self.items = sorted({item for item, h in zip(owner, hashes[1:], strict=True) if len(h)})
        place = {item: i for i, item in enumerate(self.items)}
        rows, of = [np.zeros((0, window), np.int32)], [np.zeros(0, np.int64)]
        for h, item in zip(hashes[1:], owner, strict=True):
            symbols = (np.searchsorted(self.vocabulary, h) + 1).astype(np.int32)
            if len(symbols) >= window:
                rows.append(np.lib.stride_tricks.sliding_window_view(symbols, window))
            elif len(symbols):
                rows.append(np.pad(symbols, (0, window - len(symbols)))[None])
            else:
                continue
            of.append(np.full(len(rows[-1]), place[item]))
        self.phrases, back = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        self.lengths = (self.phrases > 0).sum(axis=1)
        pairs = np.unique(np.stack([back.reshape(-1), np.concatenate(of)], axis=1), axis=0)
        self.item_begin = np.searchsorted(pairs[:, 0], np.arange(len(self.phrases) + 1))
        self.item_list = pairs[:, 1].copy()

    def find(self, hashes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, end word, phrase) of every occurrence in a shard's word hashes; ``before`` bounds its documents."""
        none = np.zeros(0, np.int64)
        if not len(self.phrases) or not len(hashes):
            return none, none, none
        gate = np.zeros(1 << 16, bool)
        gate[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True
        maybe = np.flatnonzero(gate[(hashes >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
        hit = self.vocabulary[at] == hashes[maybe]
        place, symbol = maybe[hit], at[hit] + 1
        if not len(place):
            return none, none, none
        cut = np.zeros(len(hashes) + 1, bool)
        cut[before] = True
        new = np.concatenate([[True], (np.diff(place) > 1) | cut[place[1:]]])
        run = np.cumsum(new) - 1
        size = np.bincount(run)
        long = (size >= self.lengths.min())[run]
        place, symbol, run = place[long], symbol[long], run[long]
        if not len(place):
            return none, none, none
        breaks = np.flatnonzero(np.diff(run)) + 1
        text = np.concatenate([[0], np.insert(symbol, breaks, 0), [0]])
        word = np.concatenate([[-1], np.insert(place, breaks, -1), [-1]])
        index = FMIndex(text, len(self.vocabulary))
        lo, hi = index.search(self.phrases, self.lengths)
        count = hi - lo
        phrase = np.repeat(np.arange(len(count)), count)
        rows = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
        begin = word[index.locate(rows)]
        return begin, begin + self.lengths[phrase], phrase


def blocks(benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> Iterator[Block]:
    """The benchmark (item_id, text) in blocks of about ``block_chars`` characters, one at a time."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").filter("text is not null")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(-(-chars // block_chars), 1)
    for k in range(n):
        own = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield Block([(r["item"], r["text"]) for r in own.collect()], window)


def _sent(spark: SparkSession, found: Iterator[Block]) -> Callable[[], Iterator[Block]]:
    """What gives a task the blocks, one after the other."""
    first, second = next(found), next(found, None)
    if second is None:
        sent = spark.sparkContext.broadcast(first)  # about BLOCK_CHARS characters
        return lambda: iter([sent.value])
    path, n = folder(spark, "benchmark"), 0
    os.makedirs(path)
    for block in chain([first, second], found):
        with open(f"{path}/{n}", "wb") as f:
            pickle.dump(block, f)
        n += 1

    def read() -> Iterator[Block]:
        for k in range(n):
            with open(f"{path}/{k}", "rb") as f:
                yield pickle.load(f)

    return read


SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside occurrences), items (ids of items with an occurring window, sorted as strings) and spans (code points of the text to remove, merged)."""
    block_at = _sent(docs.sparkSession, blocks(benchmark, window, block_chars))
    own = docs.drop("n_words", "n_hit", "items", "spans")
    text_at = own.columns.index("text")

    @tidy
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hashes, counts, words = [], [], [], 0

        def flush():
            before = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
            shard = np.concatenate(hashes)
            delta = np.zeros(len(shard) + 1, np.int64)
            found: list[set] = [set() for _ in range(len(before) - 1)]
            for block in block_at():
                begin, end, phrase = block.find(shard, before)
                np.add.at(delta, begin, 1)
                np.add.at(delta, end, -1)
                doc = np.searchsorted(before, begin, side="right") - 1
                many = block.item_begin[phrase + 1] - block.item_begin[phrase]
                item = block.item_list[np.repeat(block.item_begin[phrase] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
                pair = np.unique(np.repeat(doc, many) * max(len(block.items), 1) + item)
                for d, i in zip((pair // max(len(block.items), 1)).tolist(), (pair % max(len(block.items), 1)).tolist(), strict=True):
                    found[d].add(block.items[i])
            hit = np.cumsum(delta[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(hit)])
            n_hit = total[before[1:]] - total[before[:-1]]
            row = 0
            for batch in held:
                n = batch.num_rows
                spans = [_spans(batch.column(text_at)[i].as_py(), hit[before[row + i] : before[row + i + 1]]) if n_hit[row + i] else [] for i in range(n)]
                extra = [pa.array(np.diff(before)[row : row + n]), pa.array(n_hit[row : row + n]), pa.array([sorted(x) for x in found[row : row + n]], pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "n_words", "n_hit", "items", "spans"])
                row += n

        for batch in batches:
            for start, end, data, offsets in _bytes.chunks(batch.column(text_at)):
                low, starts, ends, before = _bytes.words(data, offsets)
                held.append(batch.slice(start, end - start))
                hashes.append(_bytes.span_hashes(low, starts, ends))
                counts.append(np.diff(before))
                words += len(starts)
                if words >= SHARD_WORDS:
                    yield from flush()
                    held, hashes, counts, words = [], [], [], 0
        if held:
            yield from flush()

    schema = StructType([*own.schema.fields, StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("items", ArrayType(StringType())), StructField("spans", SPANS)])
    return own.mapInArrow(searched, schema)


def _spans(text: str, hit: np.ndarray) -> list[dict]:
    """Merged code point spans of the hit words, white space between two hit words included."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    _, starts, ends, _ = _bytes.words(data, np.array([0, len(data)]))
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return [{"start": int(heads[starts[a]]), "end": int(heads[ends[b - 1]])} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


def without_spans(text, spans):
    """Column: ``text`` with the code point ``spans`` taken out."""
    cuts = F.concat(F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))), spans)
    stop = lambda i: F.when(i + 1 < F.size(cuts), F.element_at(cuts, F.least(i + 2, F.size(cuts)))["start"]).otherwise(F.char_length(text).cast("long"))
    pieces = F.transform(cuts, lambda c, i: F.substr(text, (c["end"] + 1).cast("int"), (stop(i) - c["end"]).cast("int")))
    return F.when(text.isNotNull(), F.array_join(pieces, ""))


def is_contaminated():
    """The share of hit words, a twentieth or more, that marks a document."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
