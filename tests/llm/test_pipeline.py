"""The pipeline, stage by stage, against brute force on small tables."""

import random
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from foliant.llm import _links, _spark
from foliant.llm.queries import tokenizer_path

from . import plain
from .test_near import stars

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(21)
    sentence = lambda n: " ".join(rng.choice(["the", "of", *[f"w{k}x" for k in range(300)]]) for _ in range(n))
    items = [(k, sentence(30)) for k in range(4)] + [(9, None)]
    texts, toxic = [], []
    for i in range(240):
        lines = [sentence(rng.choice([8, 40, 120])) for _ in range(rng.randint(1, 3))]
        bad = i % 4 == 0
        if bad:
            lines[0] += " " + rng.choice(["idiotic", "idiots", "scumbag"])
        if i % 11 == 5:
            lines.append("A line that many documents share, word for word, in this corpus.")
        if i % 13 == 6:
            lines.append(items[i % 4][1])
        texts.append("\n".join(lines))
        toxic.append((i, int(bad)))
    texts[101], texts[103] = texts[1], plain.edited(rng, texts[3], 0.02)
    texts[105] = items[0][1] + " " + sentence(900)
    texts += [None, "", "tiny"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCUMENTS)
    path = str(tmp_path_factory.mktemp("tables"))
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in toxic], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, texts, items


def test_every_stage(spark, tables):
    path, texts, items = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        if k < 4:
            assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]
        out.write.mode("overwrite").parquet(f"{path}/out-{name}")
        docs = spark.read.parquet(f"{path}/out-{name}")
        kept[name] = {r.doc_id: r for r in docs.collect()} if k < 4 else docs.collect()
    # toxic documents go, the others stay
    assert set(kept["toxicity"]) == {i for i in range(len(texts)) if i >= 240 or i % 4}
    # of each class of lines the first stays
    places = [(i, k, x) for i in sorted(kept["toxicity"]) for k, x in enumerate((texts[i] or "").split("\n")) if len(x) >= 20]
    root = plain.classes([plain.char_shingles(x) for _, _, x in places])
    gone = {places[n][:2] for n, r in enumerate(root) if n != r}
    lined = {i: None if texts[i] is None else "\n".join(x for k, x in enumerate(texts[i].split("\n")) if (i, k) not in gone) for i in kept["toxicity"]}
    assert {i: r.text for i, r in kept["line_dedup"].items()} == lined
    assert all(r.n_chars == len(r.text or "") for r in kept["line_dedup"].values())
    # one document of each class of near copies stays
    order = sorted(lined)
    classes = plain.classes([plain.shingles(lined[i]) for i in order])
    near = {order[c] for c in classes}
    assert {i: r.text for i, r in kept["near_dedup"].items()} == {i: lined[i] for i in near}
    # contaminated documents go; stray passages are cut out
    windows = {tuple(w[j : j + 13]) for _, t in items for w in [plain.words(t)] for j in range(max(len(w) - 12, 1 if w else 0))}
    hits = {}
    for i in near:
        w = plain.words(lined[i])
        hit = [0] * len(w)
        for j in range(len(w) - 12):
            if tuple(w[j : j + 13]) in windows:
                hit[j : j + 13] = [1] * 13
        hits[i] = (sum(hit), len(w))
    clean = {i for i, (h, n) in hits.items() if not (h and 20 * h >= n)}
    assert set(kept["decontamination"]) == clean and 105 in clean and hits[105][0] == 30
    for i in clean:
        assert len(plain.words(kept["decontamination"][i].text)) == hits[i][1] - hits[i][0]
    # every token of what is left is packed once
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = {i: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for i, r in kept["decontamination"].items()}
    got = {}
    for p in kept["packing"]:
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
    assert got == want
    assert corpus_pipeline.run(spark, path).count() == len(kept["packing"])


def test_stages_on_empty_tables(spark, tables, tmp_path):
    path, *_ = tables
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_its_stages_finish_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(_links, "SMALL", 4)
    lines, texts = stars(13, 12, 0.09), stars(14, 60, 0.01)
    table = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(rows)], DOCUMENTS)
    left = {r.doc_id for r in corpus_pipeline.drop_repeated_lines(spark, table(lines), "").collect() if r.text}
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, table(texts), "").collect()}
    assert left == set(plain.classes([plain.char_shingles(x) for x in lines]))
    assert kept == set(plain.classes([plain.shingles(x) for x in texts]))


def test_its_stages_keep_buckets_whole_in_every_pass(spark, monkeypatch, tmp_path):
    real, seen = _links._across, str(tmp_path)

    def watched(threshold, leaders):
        work = real(threshold, leaders)

        def across(batches):
            import uuid

            held = list(batches)
            with open(f"{seen}/{leaders}-{uuid.uuid4().hex}", "w") as f:
                f.write(" ".join({str(x) for b in held for x in b.column(0).to_pylist()}))
            yield from work(iter(held))

        return across

    monkeypatch.setattr(_links, "_across", watched)
    monkeypatch.setattr(_links, "TINY", 2)
    monkeypatch.setattr(_links, "LEADERS", 1)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "4k"}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(stars(13, 12, 0.09))], DOCUMENTS)
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()
    finally:
        for key in settings:
            spark.conf.unset(key)
    pieces = Counter((f.name.split("-")[0], x) for f in tmp_path.iterdir() for x in f.read_text().split())
    assert any(leaders == "None" for leaders, _ in pieces) and set(pieces.values()) == {1}


def test_dealt_tables_of_its_stages_are_written_without_a_process_a_file(spark, monkeypatch):
    # Spark's writer has Hadoop start a process for each file, which counts as another whole JVM while it begins
    by_spark, all_of = [], []
    writer, cut = type(spark.range(1).write), _spark.cut
    monkeypatch.setattr(writer, "parquet", lambda self, path, *a, f=writer.parquet, **b: by_spark.append(path) or f(self, path, *a, **b))
    for module in (_links, corpus_pipeline.line_dedup, corpus_pipeline.bagminhash):
        monkeypatch.setattr(module, "cut", lambda df, **b: all_of.append(df) or cut(df, **b))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(stars(13, 12, 0.09))], DOCUMENTS)
    for stage, most in ((corpus_pipeline.drop_repeated_lines, 3), (corpus_pipeline.drop_near_copies, 1)):
        by_spark.clear()
        all_of.clear()
        stage(spark, docs, "").collect()
        assert len(by_spark) <= most < len(all_of) / 4


def test_a_table_by_workers_is_the_table(spark, monkeypatch):
    monkeypatch.setattr(_spark, "ROW_GROUP", 1 << 12)
    df = spark.range(0, 3000, 1, 7).selectExpr("if(id % 5 = 0, null, id) id", "cast(id as int) n", "struct(id % 2 = 0 as odd, cast(id as string) as s) p", "array(id, null) a", "cast(cast(id as string) as binary) b", "id / 3 d", "'é' || id s")
    out = _spark.cut(df, by_workers=True)
    assert out.dtypes == df.dtypes and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    none = _spark.cut(df.filter("n < 0").repartition(3), by_workers=True)
    assert none.dtypes == df.dtypes and none.count() == 0
    _spark.release(out, none)
