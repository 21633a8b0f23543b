"""Entity resolution: fuzzy lookups, merges and title clusters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import parsing, similarity as S
from foliant.sources.shared import cut


def fuzzy_lookup(names: DataFrame, name: str, known: DataFrame, known_name: str, known_id: str, threshold: float = 0.78) -> DataFrame:
    """(name, id, score): the known row that fits each distinct name best, if it reaches ``threshold``.

    A pair must share a word, an ending or a beginning of three letters of its
    canonical names to reach a usual threshold; these are the join keys, so
    there is no comparison of all with all.
    """
    keys = lambda c: F.array_distinct(F.filter(F.concat(S.fragments(c), F.array(F.concat(F.lit("<"), F.left(S.canonical(c), F.lit(3))), F.concat(F.lit(">"), F.right(S.canonical(c), F.lit(3))))), lambda k: F.length(k) >= 2))
    left = names.select(F.col(name).alias("name")).filter(S.canonical(F.col(name)) != "").distinct().withColumn("key", F.explode(keys(F.col("name"))))
    right = known.select(F.col(known_id).alias("id"), F.col(known_name).alias("other")).withColumn("key", F.explode(keys(F.col("other"))))
    pairs = left.join(right, "key").select("name", "id", "other").distinct()
    scored = pairs.withColumn("score", S.lookup_likeness("name", "other")).filter(F.col("score") >= threshold)
    return scored.groupBy("name").agg(F.min_by(F.struct("id", "other", "score"), F.struct(-F.col("score"), "id")).alias("b")).select("name", "b.id", F.col("b.other").alias("matched"), "b.score")


#: Rows of a block and beginning that a task holds against as many others at a time.
ABREAST = 2048


def blocked_pairs(rows: DataFrame, key: str, name: str, block: str, prefix: int = 3, gap: int = 4) -> DataFrame:
    """(block, prefix, a, b, name_a, name_b): pairs in a block that share a beginning and differ in length by at most ``gap``, a < b.

    The rows of a block and beginning are dealt into runs of about ABREAST by a
    hash of their keys; each two runs meet in a cell of their own, so that
    pairs, not rows, are spread over tasks, and a task holds one run at a time.
    """
    own = rows.select(F.col(block).alias("block"), F.col(key).alias("k"), S.merge_key(F.col(name)).alias("n")).filter("n != '' and k is not null").withColumns({"prefix": F.left("n", F.lit(prefix)), "size": F.length("n")})
    runs = own.groupBy("block", "prefix").agg(F.ceil(F.count("*") / ABREAST).cast("int").alias("runs"))
    dealt = own.join(runs, ["block", "prefix"]).withColumn("run", F.pmod(F.xxhash64("k"), F.col("runs")).cast("int"))
    cell = ["block", "prefix", "lo", "hi"]
    last = F.col("runs") - 1
    sides = {"x": (F.col("run"), F.explode(F.sequence("run", last))), "y": (F.explode(F.sequence(F.lit(0), "run")), F.col("run"))}
    # a number of tasks of its own: cells are small in bytes, and Spark would join them in a few
    context = rows.sparkSession.sparkContext
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * context.defaultParallelism)
    x, y = (dealt.select("block", "prefix", lo.alias("lo"), hi.alias("hi"), *[F.col(c).alias(f"{c}_{s}") for c in ("k", "n", "size")]).repartition(tasks, *cell) for s, (lo, hi) in sides.items())
    first = F.col("k_x") < F.col("k_y")
    # of two runs each pair is met once, inside a run twice
    met = x.hint("merge").join(y, cell).filter((F.abs(F.col("size_x") - F.col("size_y")) <= gap) & (first | (F.col("lo") < F.col("hi")) & (F.col("k_x") > F.col("k_y"))))
    pick = lambda c, s, t: F.when(first, F.col(f"{c}_{s}")).otherwise(F.col(f"{c}_{t}"))
    return met.select("block", "prefix", pick("k", "x", "y").alias("a"), pick("k", "y", "x").alias("b"), pick("n", "x", "y").alias("name_a"), pick("n", "y", "x").alias("name_b"))


def merge_authors(authors: DataFrame, threshold: float = 0.6) -> DataFrame:
    """(id, keeper) of authors (id, name, number): same canonical name and number, then alike by prefix inside blocks; keeper is the least id.

    Equal names collapse before pairs form; what remains is linked transitively.
    """
    exact = authors.withColumn("canon", S.canonical(F.col("name")))
    exact = exact.withColumn("rep", F.min("id").over(_by("number", "canon")))
    heads = exact.filter("id = rep")
    pairs = blocked_pairs(heads, "id", "name", "number").withColumn("score", S.prefix_likeness("name_a", "name_b")).filter(F.col("score") >= threshold)
    roots = connected(pairs.select("a", "b"))
    return exact.join(roots.select(F.col("id").alias("rep"), "root"), "rep", "left").select("id", F.coalesce("root", "rep").alias("keeper"))


def _by(*columns):
    from pyspark.sql import Window

    return Window.partitionBy(*columns)


def connected(edges: DataFrame) -> DataFrame:
    """(id, root): least id of each component, by hooking to the least neighbour and jumping until nothing moves."""
    both = edges.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("id"), F.col("a").alias("other"))).distinct()
    both = cut(both)
    labels = both.groupBy("id").agg(F.least(F.min("other"), F.first("id")).alias("root"))
    while True:
        near = both.join(labels.select(F.col("id").alias("other"), F.col("root").alias("r")), "other").groupBy("id").agg(F.min("r").alias("r"))
        lower = labels.join(near, "id").select("id", F.col("root").alias("old"), F.least("root", "r").alias("root"))
        jump = lower.select(F.col("id").alias("root"), F.col("root").alias("top"))
        lower = lower.join(jump, "root", "left").select("id", "old", F.coalesce("top", "root").alias("root"))
        lower = cut(lower)
        labels = lower.select("id", "root")
        if lower.filter("old != root").isEmpty():
            return labels


def title_clusters(works: DataFrame, volume: str, key: str, title: str, weight: str, threshold: float = 0.85) -> DataFrame:
    """(volume, key, head): greedy clusters of titles in a volume; heaviest first, a head takes every later title alike enough that is not taken.

    Greedy and not transitive: a title joins the first head that takes it. The
    length bound of the ratio is tried before the ratio.
    """

    def greedy(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values(["w", "k"], ascending=[False, True])
        heads: list[tuple[object, str]] = []
        out = []
        for k, t in zip(rows["k"], rows["t"], strict=True):
            for head, name in heads:
                bound = 2 * min(len(t), len(name)) / max(len(t) + len(name), 1)
                if t == name or bound >= threshold and S.alike(name, t) >= threshold:
                    out.append((group["v"].iloc[0], k, head))
                    break
            else:
                heads.append((k, t))
                out.append((group["v"].iloc[0], k, k))
        return pd.DataFrame(out, columns=["v", "k", "head"])

    rows = works.select(F.col(volume).alias("v"), F.col(key).alias("k"), parsing.title_key(F.col(title)).alias("t"), F.col(weight).alias("w"))
    kinds = dict(rows.dtypes)
    # equal titles share one comparison: only the first of each goes into the fold
    firsts = rows.withColumn("n", F.row_number().over(_by("v", "t").orderBy(F.desc("w"), "k")))
    folded = firsts.filter("n = 1").groupBy("v").applyInPandas(greedy, f"v {kinds['v']}, k {kinds['k']}, head {kinds['k']}")
    of_title = firsts.filter("n = 1").select("v", "t", "k").join(folded, ["v", "k"]).select("v", "t", "head")
    return rows.join(of_title, ["v", "t"]).select(F.col("v").alias(volume), F.col("k").alias(key), "head")


def near_titles(works: DataFrame, volume: str, key: str, title: str, threshold: float = 0.85) -> DataFrame:
    """(volume, a, b, score): pairs of lower-cased titles of a volume that are near duplicates, a < b; a check of a finished catalogue.

    Titles so alike share a pair of letters in a row, which is the join key;
    pairs whose lengths leave no room are not scored.
    """
    own = works.select(F.col(volume).alias("v"), F.col(key).alias("k"), F.lower(F.col(title)).alias("t"))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("t") - 1, F.lit(1))), lambda i: F.substring("t", i, F.lit(2))))
    keyed = own.withColumn("g", F.explode(grams))
    a, b = (keyed.select("v", "g", F.col("k").alias(x), F.col("t").alias(f"t_{x}")) for x in "ab")
    pairs = a.join(b, ["v", "g"]).filter((F.col("a") < F.col("b")) & S.can_reach(F.col("t_a"), F.col("t_b"), threshold))
    pairs = pairs.groupBy("v", "a", "b", "t_a", "t_b").agg(F.count("*").alias("shared"))
    scored = pairs.withColumn("score", S.ratio("t_a", "t_b")).filter(F.col("score") >= threshold)
    return scored.select(F.col("v").alias(volume), "a", "b", "score")


def works_catalogue(works: DataFrame, volume: str = "volume_id", key: str = "id", title: str = "title", weight: str = "n_refs", threshold: float = 0.85) -> DataFrame:
    """The works to list: past the noise gate, the most cited of each normalised title, heads of clusters only, by lower-cased title."""
    from .catalogue import best_per_group

    passed = works.filter(parsing.passes_noise_gate(F.col(title))).withColumn("_norm", parsing.title_key(F.col(title)))
    best = best_per_group(passed, [volume, "_norm"], [F.desc(weight), F.col(key)]).drop("_norm")
    heads = title_clusters(best, volume, key, title, weight, threshold).filter(F.col("head") == F.col(key)).select(key)
    return best.join(heads, key, "left_semi").orderBy(F.lower(title), key)


def collapse_splits(authors: DataFrame) -> DataFrame:
    """Authors (id, name, number, n_refs): a Roman numeral at the end of the first of a number goes; of those alike by canonical name the cited ones stay, or the first."""
    first = F.row_number().over(_by("number").orderBy("id")) == 1
    plain = F.when(first, F.regexp_replace("name", r"\s+(I|II|III|IV|V)$", "")).otherwise(F.col("name"))
    named = authors.withColumn("name", plain).withColumn("canon", S.canonical(F.col("name")))
    rank = F.row_number().over(_by("number", "canon").orderBy((F.col("n_refs") > 0).desc(), "id"))
    return named.withColumn("rank", rank).filter("rank = 1 and n_refs > 0").drop("rank", "canon")
