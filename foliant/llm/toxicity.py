"""Operator 4, a toxicity classifier regularised by counterfactuals.

Features of a text are hashes of its words, of word beginnings and of character
5-grams inside words; only their presence counts, so a long text is not a more
toxic one. The features that part the classes best (by G^2 on document
frequencies) enter a logistic regression. For every training text that names a
group ("women", "muslims", ...), the same text with the identity terms swapped
is formed, and the squared change of the score between the two is added to the
loss. A mention of a group alone therefore cannot carry weight. To the listed
groups come pairs of terms of the training texts themselves (``neutral_terms``):
words that are frequent, stand in toxic and other texts alike and follow the
same words, so that swapping one for the other must not change a score either.
A model says how many counterfactual texts it was held to; one that was held to
none warns.

Training reads at most MAX_ROWS labelled rows a class (the smallest hashes of
doc_id, so the choice does not depend on partitions); their texts are read once
more for each of three passes, in parallel. Texts that share their least
five-word shingle count as copies, and one of them is used. Only the chosen
features' presence lists, bounded by MAX_ROWS * FEATURES, reach the driver. The
model (FEATURES hashes and weights) is the only thing broadcast. Scoring covers
every whole text in one pass without a shuffle.

Defined results: a null or empty text scores by the intercept alone; repeated
rows score each; a doc_id with several labels trains on the highest; labels that
are null are ignored; without rows of both classes every score is the share of
toxic rows (0 without any labels); texts of any length are read whole; an empty
documents table gives no rows; own columns named score or predicted are
replaced, other extra columns stay; ties between features go to the lesser hash.
"""

from __future__ import annotations

import re
import warnings
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes
from ._spark import cut, tidy

MAX_ROWS = 4000
FEATURES = 1500
#: G^2 below which a feature is taken for chance.
LEAST_G2 = 15.0
PREFIXES = (4, 5, 6)
INNER = 5
#: Terms of the training texts that are swapped, their least share of the texts, and the G^2 up to which one counts as neutral.
TERMS = 40
TERM_SHARE = 0.01
NEUTRAL_G2 = 1.0

#: Identity terms by group; a term is swapped for the next one of its group.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("black", "white", "asian", "latino"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("disabled", "blind", "deaf"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit feature), not distinct, of all texts of a chunk."""
    low, starts, ends, _ = _bytes.words(data, offsets)
    found = [(starts, _bytes.span_hashes(low, starts, ends))]
    for k in PREFIXES:
        long = ends - starts >= k
        found.append((starts[long], _bytes.span_hashes(low, starts[long], starts[long] + k) ^ np.uint64(k)))
    if len(low) >= INNER:
        length = ends - starts
        room = np.maximum(length - INNER + 1, 0)
        begin = np.repeat(starts - np.concatenate([[0], np.cumsum(room)[:-1]]), room) + np.arange(int(room.sum()))
        found.append((begin, _bytes.span_hashes(low, begin, begin + INNER) ^ np.uint64(99)))
    at = np.concatenate([x for x, _ in found])
    return np.searchsorted(offsets, at, side="right") - 1, np.concatenate([x for _, x in found])


def swap_identities(text: str, groups=IDENTITY_TERMS) -> str:
    """``text`` with every identity term replaced by the next one of its group, lower-cased; equal if it has none."""
    after = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    return _LETTERS.sub(lambda m: after.get(m[0].lower(), m[0]), text)


_LETTERS = re.compile(r"[^\W\d_]+")


def _g2(n1, n0, bad: int, good: int):
    """Column: how far a feature's texts (n1 toxic, n0 others) depart from the shares of all."""
    n, p, seen = bad + good, bad / (bad + good), n1 + n0
    term = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(F.lit(0.0))
    return 2 * (term(n1, seen * p) + term(n0, seen * (1 - p)) + term(bad - n1, (n - seen) * p) + term(good - n0, (n - seen) * (1 - p)))


def neutral_terms(chosen: DataFrame, bad: int, good: int, terms: int = TERMS) -> tuple[tuple[str, str], ...]:
    """Pairs of frequent words of ``chosen`` (text, toxic) that say nothing about the label and follow the same words."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[toxic].update({w.lower() for w in _LETTERS.findall(text or "")})
        for toxic, words in seen.items():
            yield pa.RecordBatch.from_pydict({"word": pa.array(list(words), pa.string()), "toxic": pa.array([toxic] * len(words), pa.int32()), "n": pa.array(list(words.values()), pa.int64())})

    of = chosen.select("text", "toxic").mapInArrow(counted, "word string, toxic int, n long").groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("n1"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("n0"))
    seen = F.col("n1") + F.col("n0")
    of = of.filter((seen >= TERM_SHARE * (bad + good)) & (seen <= 0.5 * (bad + good)) & (F.length("word") >= 3)).filter(_g2(F.col("n1"), F.col("n0"), bad, good) <= NEUTRAL_G2)
    found = [r["word"] for r in of.orderBy(seen.desc(), "word").limit(terms).collect()]
    known = set(found)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: set[tuple[str, str]] = set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = [w.lower() for w in _LETTERS.findall(text or "")]
                pairs |= {(b, a) for a, b in zip(words, words[1:], strict=False) if b in known}
        yield pa.RecordBatch.from_pydict({"word": pa.array([w for w, _ in pairs], pa.string()), "before": pa.array([b for _, b in pairs], pa.string())})

    # what stands before at most ``terms`` words in the bounded sample
    after = defaultdict(set)
    for r in chosen.select("text").mapInArrow(neighbours, "word string, before string").distinct().collect():
        after[r["word"]].add(r["before"])
    likeness = lambda a, b: len(after[a] & after[b]) / max(len(after[a] | after[b]), 1)
    order = sorted(((-likeness(a, b), a, b) for k, a in enumerate(found) for b in found[k + 1 :] if after[a] & after[b]))
    out, used = [], set()
    for _, a, b in order:
        if not {a, b} & used:
            out.append((a, b))
            used |= {a, b}
    return tuple(out)


@dataclass
class Model:
    features: np.ndarray  # sorted uint64
    weights: np.ndarray
    intercept: float
    #: counterfactual texts formed in training, and those among them of other features
    swapped: int = 0
    held: int = 0


def _present(model_features: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index into model_features), distinct and sorted."""
    row, value = features(data, offsets)
    if not len(model_features):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gate = np.zeros(1 << 16, bool)
    gate[(model_features >> np.uint64(48)).astype(np.int64)] = True
    maybe = gate[(value >> np.uint64(48)).astype(np.int64)]
    row, value = row[maybe], value[maybe]
    at = np.minimum(np.searchsorted(model_features, value), len(model_features) - 1)
    hit = model_features[at] == value
    both = np.unique(row[hit] * len(model_features) + at[hit])
    return both // len(model_features), both % len(model_features)


def sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of at most ``max_rows`` labelled texts of each class."""
    marked = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    few = [marked.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows) for c in (0, 1)]
    chosen = few[0].unionByName(few[1])
    texts = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id"))  # at most 2 * max_rows rows

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.zeros(batch.num_rows, np.uint64)
            for start, end, data, offsets in _bytes.chunks(batch.column(2)):
                low, starts, ends, before = _bytes.words(data, offsets)
                row, hashes = _bytes.shingles(_bytes.span_hashes(low, starts, ends), before, 5)
                least = np.full(end - start, np.iinfo(np.uint64).max, np.uint64)
                np.minimum.at(least, row, hashes)
                keys[start:end] = least
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys.view(np.int64))], ["doc_id", "toxic", "key"])

    # among texts that share their least shingle, the first stays
    first = texts.select("doc_id", "toxic", "text").mapInArrow(keyed, "doc_id long, toxic int, key long").groupBy("key", "toxic").agg(F.min("doc_id").alias("doc_id"))
    return cut(texts.join(F.broadcast(first.select("doc_id").distinct()), "doc_id", "left_semi").dropDuplicates(["doc_id"]), by_workers=True)


def train(chosen: DataFrame, n_features: int = FEATURES, ridge: float = 1.0, counterfactual: float = 10.0, groups=IDENTITY_TERMS, prior: float | None = None) -> Model:
    """chosen: (text, toxic) of a bounded sample. prior: share of toxic rows outside the sample."""
    sizes = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if prior is None:
        prior = bad / max(bad + good, 1)
    odds = float(np.log(max(prior, 1e-12) / max(1 - prior, 1e-12)))
    if not bad or not good:
        return Model(np.zeros(0, np.uint64), np.zeros(0), odds)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, marks = [], []
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for start, _, data, offsets in _bytes.chunks(batch.column(0)):
                row, value = features(data, offsets)
                order = np.lexsort((value, row))
                row, value = row[order], value[order]
                new = np.concatenate([[True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])]) if len(row) else np.zeros(0, bool)
                keys.append(value[new])
                marks.append(toxic[start + row[new]])
        if keys:
            key, back = np.unique(np.concatenate(keys), return_inverse=True)
            mark = np.concatenate(marks)
            n1 = np.bincount(back, mark, len(key)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"feature": pa.array(key.view(np.int64)), "n1": pa.array(n1), "n0": pa.array(np.bincount(back, minlength=len(key)) - n1)})

    counts = chosen.select("text", "toxic").mapInArrow(counted, "feature long, n1 long, n0 long").groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    seen = F.col("n1") + F.col("n0")
    g2 = _g2(F.col("n1"), F.col("n0"), bad, good)
    best = counts.filter(seen >= 3).withColumn("g2", g2).filter(F.col("g2") >= LEAST_G2).orderBy(F.desc("g2"), "feature").limit(n_features).select("feature").collect()
    kept = np.sort(np.array([r[0] for r in best], np.int64).view(np.uint64))
    if not len(kept):
        return Model(kept, np.zeros(0), odds)

    # words of a listed group stay in it
    own_terms = {t for g in groups for t in g}
    groups = (*groups, *(g for g in neutral_terms(chosen, bad, good) if not own_terms & set(g)))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, batch in enumerate(batches):
            texts = batch.column(0).fill_null("")
            other = pa.array([swap_identities(t, groups) for t in texts.to_pylist()], pa.string())
            for column, swapped in ((texts, False), (other, True)):
                for start, end, data, offsets in _bytes.chunks(column):
                    row, at = _present(kept, data, offsets)
                    lists = np.split(at.astype(np.int32), np.searchsorted(row, np.arange(1, end - start)))
                    yield pa.RecordBatch.from_pydict({"n": pa.array([start + i for i in range(end - start)], pa.int64()), "part": pa.array([part] * (end - start), pa.int64()), "swapped": pa.array([swapped] * (end - start)), "toxic": batch.column(1).slice(start, end - start).cast(pa.int32()), "at": pa.array(lists, pa.list_(pa.int32())), "changed": pa.array([texts[start + i].as_py() != other[start + i].as_py() for i in range(end - start)])})

    rows = chosen.select("text", "toxic").mapInArrow(listed, "n long, part long, swapped boolean, toxic int, at array<int>, changed boolean").withColumn("task", F.spark_partition_id()).filter("not swapped or changed").collect()
    own = [r for r in rows if not r["swapped"]]
    place = {(r["task"], r["part"], r["n"]): i for i, r in enumerate(own)}
    x = np.zeros((len(own), len(kept)), np.float32)
    for i, r in enumerate(own):
        x[i, r["at"]] = 1
    y = np.array([r["toxic"] for r in own], np.float64)
    differences, swapped = [], 0
    for r in rows:
        if r["swapped"]:
            swapped += 1
            d = x[place[r["task"], r["part"], r["n"]]].copy()
            d[r["at"]] -= 1
            if d.any():
                differences.append(d)
    weights, intercept = fit(x, y, np.array(differences, np.float32).reshape(-1, len(kept)), ridge, counterfactual)
    # the sample is near balanced; the intercept goes back to the share outside it
    share = float(y.mean())
    if not swapped:
        warnings.warn("no training text has a term to swap: the classifier is not held to counterfactuals", stacklevel=2)
    return Model(kept, weights, intercept + 0.5 * (odds - float(np.log(share / (1 - share)))), swapped, len(differences))


def fit(x: np.ndarray, y: np.ndarray, differences: np.ndarray, ridge: float, counterfactual: float, steps: int = 12) -> tuple[np.ndarray, float]:
    """Newton steps on log loss + ridge |w|^2 / 2 + counterfactual |differences w|^2 / 2."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    penalty = np.diag(np.append(np.full(x.shape[1] - 1, ridge), 1e-6))
    if len(differences):
        d = np.hstack([differences, np.zeros((len(differences), 1), np.float32)]).astype(np.float64)
        penalty += counterfactual * d.T @ d
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty @ w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, gradient)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 if score >= threshold) beside all its own columns."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.features, model.weights, model.intercept))  # at most FEATURES entries
    own = docs.drop("score", "predicted")
    at = own.columns.index("text")

    @tidy
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, weights, intercept = sent.value
        for batch in batches:
            z = np.full(batch.num_rows, intercept)
            for start, end, data, offsets in _bytes.chunks(batch.column(at)):
                row, feature = _present(kept, data, offsets)
                z[start:end] += np.bincount(row, weights[feature], end - start) if len(row) else 0
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], [*batch.schema.names, "score", "predicted"])

    from pyspark.sql.types import DoubleType, IntegerType, StructType

    schema = StructType([*own.schema.fields]).add("score", DoubleType()).add("predicted", IntegerType())
    return own.mapInArrow(scored, schema)


def classifier(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, **options) -> Model:
    """Train on a bounded sample of ``labels`` (doc_id, toxic) over ``docs``."""
    shares = labels.filter("toxic is not null and doc_id is not null").agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    return train(sample(docs, labels, max_rows), prior=shares or 0.0, **options)
