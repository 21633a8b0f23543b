"""Operator 7, an interpolated modified Kneser-Ney language model.

Counting runs in Spark in two passes over the training texts. The first counts
tokens: each task adds up its own partition and sends one sorted array of
(hash, count) for each hash range; a range is merged by one task and stored as
two flat files, sorted hashes and counts. A token's id is its place in the
concatenated ranges. The second pass maps tokens to ids through these
memory-mapped files and counts bigrams (64-bit key: context id, word id) the
same way. Contexts that own more than a quarter of a range's even share of all
tokens are spread over all ranges by their word id, so no context, however
frequent, meets in one task. A third, small exchange sums for each word what
smoothing needs: in how many contexts it was seen and how many words followed
it once, twice or more often.

Scoring memory-maps the same files in every worker (the page cache is shared)
and looks up each chunk's sorted distinct keys. Nothing that grows with the
corpus is broadcast or collected; the driver sees counts of counts only.

p(w|v) = max(c(vw) - D(c), 0) / c(v) + g(v) p(w)
p(w)   = max(n(w) - E(n), 0) / n + g / (V + 1)
with c counts, n(w) the number of contexts of w, n their sum, D and E the
modified discounts for counts of 1, 2 and 3 or more, and g the mass they free.

The order is 2: at order 3 the model and its exchange do not fit the disk that the
check tool allows (see README). Tokens: A-Z lower-cased, runs of anything but
ASCII white space, then one end token; a text begins in a start context that is
no token. Counts may pass 32 bits (those that do stand in a file of their own);
a vocabulary whose bigram keys would pass 63 bits is an error. Bigrams fall into
as many ranges as their number of tokens needs (RANGE_TOKENS), so a range does
not grow with the corpus. Defined results: a null text is empty (only the end
token); repeated rows count and score each; an unknown word has the uniform
share alone; with no training text every token has probability 1 / (V + 1); an
empty table gives no rows; a text of any length is counted and scored whole;
extra columns are kept, own columns of the results' names are replaced.
"""

from __future__ import annotations

import mmap
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _bytes
from ._spark import folder, tidy

END = int(_bytes.mix(np.array([0xE0D], np.uint64))[0])
#: Texts gathered in a task before their counts are merged.
GATHER = 4_000_000
#: Training tokens a range of bigrams.
RANGE_TOKENS = 4_000_000
#: A stored count from here on stands in the file of great counts.
GREAT = (1 << 32) - 1


def tokenised(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of words and end tokens, tokens before each row) of chunks of a text column."""
    for row, _, data, offsets in _bytes.chunks(column):
        low, starts, ends, before = _bytes.words(data, offsets, _bytes.SPACED)
        hashes = np.insert(_bytes.span_hashes(low, starts, ends), before[1:], np.uint64(END))
        yield row, hashes, before + np.arange(len(before))


def _write(path: str, array: np.ndarray) -> None:
    """Whole or not at all; a task that runs again writes the same."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        f.write(array.tobytes())
    os.replace(part, path)


def _map(path: str, kind: str) -> np.ndarray:
    if not os.path.exists(path) or not os.path.getsize(path):
        return np.zeros(0, kind)
    with open(path, "rb") as f:
        return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), kind)


def _merge(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct sorted keys with summed values."""
    if not len(keys):
        return keys, *values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], *(np.add.reduceat(v[order], at) for v in values)


BLOB = "part int, k binary, c binary"


def _blobs(part: np.ndarray, keys: np.ndarray, *values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row a part: its keys and their values as arrays; keys are sorted inside a part."""
    order = np.argsort(part, kind="stable")
    part, keys, values = part[order], keys[order], [v[order] for v in values]
    ends = np.append(np.flatnonzero(np.diff(part)) + 1, len(part)) if len(part) else []
    begin = 0
    for end in ends:
        rows = [pa.array([int(part[begin])], pa.int32()), pa.array([keys[begin:end].tobytes()], pa.binary())]
        rows.append(pa.array([np.stack([v[begin:end] for v in values]).astype(np.uint32).tobytes()], pa.binary()))
        yield pa.RecordBatch.from_arrays(rows, ["part", "k", "c"])
        begin = int(end)


def _gathered(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """(part, sorted distinct keys, summed values) of rows sorted by part, a part at a time."""
    part, keys, values = None, [], []

    def done():
        k, *v = _merge(np.concatenate(keys), *np.concatenate(values, axis=1).astype(np.int64))
        return part, k, v

    for batch in batches:
        for p, k, c in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            if p != part:
                if keys:
                    yield done()
                part, keys, values = p, [], []
            keys.append(np.frombuffer(k.as_buffer(), np.uint64))
            values.append(np.frombuffer(c.as_buffer(), np.uint32).reshape(width, -1))
    if keys:
        yield done()


def _dealt(blobs: DataFrame, parts: int) -> DataFrame:
    return blobs.repartition(parts, "part").sortWithinPartitions("part")


@dataclass
class Model:
    """Where the sorted arrays are and the few numbers that belong to them."""

    path: str
    parts: int
    sizes: list[int]  # distinct tokens of each hash range
    texts: int  # training texts
    n: int  # training tokens
    hot: list[int]  # ids of spread contexts, at most 4 a range
    pair_parts: int = 1  # ranges of bigrams
    discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    lower_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    pairs: int = 0  # distinct bigrams
    lower_mass: float = 1.0

    @property
    def v(self) -> int:
        return sum(self.sizes)


class Arrays:
    """A worker's view of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.begin = np.concatenate([[0], np.cumsum(model.sizes)]).astype(np.int64)
        self.hot = np.sort(np.array(model.hot, np.int64))
        self._files: dict[tuple[str, int], np.ndarray] = {}

    def file(self, name: str, part: int, kind: str) -> np.ndarray:
        if (name, part) not in self._files:
            self._files[name, part] = _map(f"{self.model.path}/{name}/{part}", kind)
        return self._files[name, part]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted distinct hashes, -1 where unknown."""
        out = np.full(len(hashes), -1, np.int64)
        bounds = np.searchsorted(_range(hashes, self.model.parts), np.arange(self.model.parts + 1))
        for p in np.flatnonzero(np.diff(bounds)).tolist():
            own = hashes[bounds[p] : bounds[p + 1]]
            known = self.file("word", p, "u8")
            if len(known):
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                out[bounds[p] : bounds[p + 1]] = np.where(known[at] == own, self.begin[p] + at, -1)
        return out

    def part_of(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        return pair_part(context, word, self.model.v, self.model.pair_parts, self.hot)

    def of_words(self, name: str, kind: str, ids: np.ndarray) -> np.ndarray:
        """Values of the array ``name`` (rows by word id) at sorted ids >= 0."""
        out = np.zeros(len(ids), np.int64)
        bounds = np.searchsorted(ids, self.begin)
        for p in np.flatnonzero(np.diff(bounds)).tolist():
            values = self.file(name, p, kind)
            if len(values):
                out[bounds[p] : bounds[p + 1]] = values[ids[bounds[p] : bounds[p + 1]] - self.begin[p]]
        return out

    def pair_counts(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        part, key = self.part_of(context, word), _key(context, word, self.model.v)
        order = np.lexsort((key, part))
        out = np.zeros(len(key), np.int64)
        bounds = np.searchsorted(part[order], np.arange(self.model.pair_parts + 1))
        for p in np.flatnonzero(np.diff(bounds)).tolist():
            at = order[bounds[p] : bounds[p + 1]]
            known = self.file("pair", p, "u8")
            if len(known):
                place = np.minimum(np.searchsorted(known, key[at]), len(known) - 1)
                count = self.file("pair_count", p, "u4")[place].astype(np.int64)
                great = np.flatnonzero(count == GREAT)
                if len(great):
                    count[great] = self.file("great_count", p, "i8")[np.searchsorted(self.file("great", p, "i8"), place[great])]
                out[at] = np.where(known[place] == key[at], count, 0)
        return out


def _range(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _key(context: np.ndarray, word: np.ndarray, v: int) -> np.ndarray:
    return (context * (v + 1) + word).astype(np.uint64)


def _store_counts(path: str, part: int, counts: np.ndarray) -> None:
    """Counts in 32 bits, and those that need more beside them."""
    great = np.flatnonzero(counts >= GREAT)
    _write(f"{path}/pair_count/{part}", np.minimum(counts, GREAT).astype(np.uint32))
    if len(great):
        _write(f"{path}/great/{part}", great.astype(np.int64))
        _write(f"{path}/great_count/{part}", counts[great].astype(np.int64))


def pair_part(context: np.ndarray, word: np.ndarray, v: int, parts: int, hot: np.ndarray) -> np.ndarray:
    """The range of a bigram: by its context, or for a hot context by its word."""
    own = context * parts // (v + 1)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
        own = np.where(hot[at] == context, word * parts // max(v, 1), own)
    return own


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified discounts from how many keys were counted once, twice, three and four times."""
    n1, n2, n3, n4 = n
    if not n1 or not n2:
        return 0.5, 0.75, 0.75  # too few counts to estimate from
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2.0)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


def train(texts: DataFrame, parts: int | None = None) -> Model:
    """A model of ``texts`` (text)."""
    spark = texts.sparkSession
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    path = folder(spark, "kneser-ney")
    texts = texts.select("text")

    @tidy
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held, done = [], [], 0
        for batch in batches:
            for _, hashes, _ in tokenised(batch.column(0)):
                held.append(hashes)
                done += len(hashes)
                if done >= GATHER:
                    sums.append(np.unique(np.concatenate(held), return_counts=True))
                    held, done = [], 0
        sums.append(np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True))
        keys, counts = _merge(np.concatenate([k for k, _ in sums]), np.concatenate([c for _, c in sums]))
        yield from _blobs(_range(keys, parts), keys, counts)

    @tidy
    def stored_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, keys, (counts,) in _gathered(batches, 1):
            _write(f"{path}/word/{part}", keys)
            _write(f"{path}/count/{part}", counts.astype(np.uint64))
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "size": pa.array([len(keys)], pa.int64()), "total": pa.array([int(counts.sum())], pa.int64())})

    rows = _dealt(texts.mapInArrow(words, BLOB), parts).mapInArrow(stored_words, "part int, size long, total long").collect()
    sizes = [0] * parts
    for r in rows:
        sizes[r["part"]] = r["size"]
    model = Model(path, parts, sizes, 0, sum(r["total"] for r in rows), [])
    if not model.n:
        return model
    if (model.v + 1) ** 2 >= 1 << 63:
        raise OverflowError(f"{model.v} distinct tokens: a bigram's key does not fit 63 bits")
    begin = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    pair_parts = model.pair_parts = max(parts, -(-model.n // RANGE_TOKENS))
    least = max(model.n // (4 * pair_parts), 1)

    def hot_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column(0).to_pylist():
                counts = _map(f"{path}/count/{part}", "u8")
                at = np.flatnonzero(counts >= least)
                yield pa.RecordBatch.from_pydict({"id": pa.array(begin[part] + at, pa.int64()), "c": pa.array(counts[at].astype(np.int64))})

    all_parts = spark.range(parts, numPartitions=min(parts, 64)).select(F.col("id").cast("int").alias("part"))
    model.hot = sorted({r["id"] for r in all_parts.mapInArrow(hot_words, "id long, c long").collect()} | {model.v})
    v = model.v

    @tidy
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = Arrays(model)
        sums, held, done = [], [], 0

        def counted():
            keys, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            sums.append((keys, counts))

        for batch in batches:
            for _, hashes, before in tokenised(batch.column(0)):
                distinct, back = np.unique(hashes, return_inverse=True)
                ids = arrays.ids(distinct)[back]
                context = np.concatenate([[v], ids[:-1]]) if len(ids) else ids
                context[before[:-1][before[:-1] < len(ids)]] = v
                held.append(_key(context, ids, v))
                done += len(ids)
                if done >= GATHER:
                    counted()
                    held, done = [], 0
        counted()
        keys, counts = _merge(np.concatenate([k for k, _ in sums]), np.concatenate([c for _, c in sums]))
        whole = keys.astype(np.int64)
        yield from _blobs(pair_part(whole // (v + 1), whole % (v + 1), v, pair_parts, arrays.hot), keys, counts)

    @tidy
    def stored_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array(begin, np.int64)
        for part, keys, (counts,) in _gathered(batches, 1):
            _write(f"{path}/pair/{part}", keys)
            _store_counts(path, part, counts)
            whole = keys.astype(np.int64)
            context, word = whole // (v + 1), whole % (v + 1)
            # for each word: once, twice, more often followed (as a context); contexts before it
            first = np.concatenate([context, word])
            rows = np.zeros((4, len(first)), np.int64)
            rows[0, : len(context)] = counts == 1
            rows[1, : len(context)] = counts == 2
            rows[2, : len(context)] = counts >= 3
            rows[3, len(context) :] = 1
            word_id, *sums = _merge(first.astype(np.uint64), *rows)
            own = np.minimum(np.searchsorted(edges, word_id.astype(np.int64), side="right") - 1, parts - 1)
            yield from _blobs(own, word_id, *sums)

    @tidy
    def stored_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, values in _gathered(batches, 4):
            at = ids.astype(np.int64) - begin[part]
            size = sizes[part] + (part == parts - 1)  # the start context stands after the last word
            for name, value in zip(("once", "twice", "more", "contexts"), values, strict=True):
                full = np.zeros(size, np.uint32)
                full[at] = value
                _write(f"{path}/{name}/{part}", full)
            seen = values[3]
            yield pa.RecordBatch.from_pydict({"n": pa.array([[int((seen == k).sum()) for k in (1, 2, 3, 4)]], pa.list_(pa.int64())), "types": pa.array([int((seen > 0).sum())], pa.int64()), "more": pa.array([int((seen >= 3).sum())], pa.int64()), "pairs": pa.array([int(seen.sum())], pa.int64())})

    sums = _dealt(texts.mapInArrow(pairs, BLOB), pair_parts).mapInArrow(stored_pairs, BLOB)
    found = _dealt(sums, parts).mapInArrow(stored_sums, "n array<long>, types long, more long, pairs long").collect()

    def counts_of_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column(0).to_pylist():
                c = _map(f"{path}/pair_count/{part}", "u4")
                yield pa.RecordBatch.from_pydict({"n": pa.array([[int((c == k).sum()) for k in (1, 2, 3, 4)]], pa.list_(pa.int64()))})

    pair_ranges = spark.range(pair_parts, numPartitions=min(pair_parts, 64)).select(F.col("id").cast("int").alias("part"))
    upper = pair_ranges.mapInArrow(counts_of_counts, "n array<long>").collect()
    model.discounts = discounts(np.sum([r["n"] for r in upper], axis=0).tolist())
    lower = np.sum([r["n"] for r in found], axis=0).tolist()
    model.lower_discounts = discounts(lower)
    model.pairs = sum(r["pairs"] for r in found)
    e1, e2, e3 = model.lower_discounts
    model.lower_mass = (e1 * lower[0] + e2 * lower[1] + e3 * sum(r["more"] for r in found)) / max(model.pairs, 1)
    end_range = int(_range(np.array([END], np.uint64), parts)[0])
    ends = _map(f"{path}/word/{end_range}", "u8")
    model.texts = int(_map(f"{path}/count/{end_range}", "u8")[np.searchsorted(ends, np.uint64(END))])
    return model


def _discount(count: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(count - np.choose(np.clip(count, 0, 3), (0.0, *d)), 0.0)


_views: dict[str, Arrays] = {}


def _view(model: Model) -> Arrays:
    if model.path not in _views:
        _views.clear()
        _views[model.path] = Arrays(model)
    return _views[model.path]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text) with n_tokens, n_known, base_score and score (log10), text dropped."""
    own = docs.drop("n_tokens", "n_known", "base_score", "score")
    text_at = own.columns.index("text")
    v, d, e = model.v, model.discounts, model.lower_discounts

    @tidy
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _view(model)
        for batch in batches:
            out = [np.zeros(batch.num_rows) for _ in range(4)]
            for start, hashes, before in tokenised(batch.column(text_at)):
                end = start + len(before) - 1
                distinct, back = np.unique(hashes, return_inverse=True)
                word_id = arrays.ids(distinct)
                known = word_id >= 0
                count = np.zeros(len(distinct), np.int64)
                contexts = count.copy()
                # ids of sorted hashes are sorted
                count[known] = arrays.of_words("count", "u8", word_id[known])
                contexts[known] = arrays.of_words("contexts", "u4", word_id[known])
                lower = _discount(contexts, e) / max(model.pairs, 1) + model.lower_mass / (v + 1)
                free = np.ones(len(distinct))
                if known.any():
                    once, twice, more = (arrays.of_words(k, "u4", word_id[known]) for k in ("once", "twice", "more"))
                    free[known] = np.where(once + twice + more > 0, (d[0] * once + d[1] * twice + d[2] * more) / np.maximum(count[known], 1), 1.0)
                ids = word_id[back]
                first = np.zeros(len(ids), bool)
                first[before[:-1]] = True
                context = np.concatenate([[v], ids[:-1]])
                context[first] = v
                total = np.concatenate([[0], count[back][:-1]])
                left = np.concatenate([[1.0], free[back][:-1]])
                total[first] = model.texts
                if model.n:
                    s = [arrays.file(k, model.parts - 1, "u4") for k in ("once", "twice", "more")]
                    left[first] = sum(x * int(y[-1]) for x, y in zip(d, s, strict=True) if len(y) > model.sizes[-1]) / max(model.texts, 1)
                both = (context >= 0) & (ids >= 0)
                pair = np.zeros(len(ids), np.int64)
                if both.any():
                    keys, place = np.unique(_key(context[both], ids[both], v), return_inverse=True)
                    whole = keys.astype(np.int64)
                    pair[both] = arrays.pair_counts(whole // (v + 1), whole % (v + 1))[place]
                low = lower[back]
                p = np.where(context >= 0, _discount(pair, d) / np.maximum(total, 1) + left * low, low)
                base = (count[back] + 1) / (model.n + v + 1)
                for k, x in enumerate((np.ones(len(ids)), known[back].astype(float), np.log10(base), np.log10(p))):
                    out[k][start:end] = np.add.reduceat(x, before[:-1])
            rest = [c for i, c in enumerate(batch.columns) if i != text_at]
            names = [n for i, n in enumerate(batch.schema.names) if i != text_at]
            extra = [pa.array(out[0].astype(np.int64)), pa.array(out[1].astype(np.int64)), pa.array(out[2]), pa.array(out[3])]
            yield pa.RecordBatch.from_arrays([*rest, *extra], [*names, "n_tokens", "n_known", "base_score", "score"])

    from pyspark.sql.types import DoubleType, LongType, StructField, StructType

    fields = [f for f in own.schema.fields if f.name != "text"]
    schema = StructType([*fields, StructField("n_tokens", LongType()), StructField("n_known", LongType()), StructField("base_score", DoubleType()), StructField("score", DoubleType())])
    return own.mapInArrow(scored, schema)


def perplexity() -> Column:
    return F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
