import os

import pytest
from pyspark.sql import functions as F

from foliant.operators import catalogue as C
from foliant.operators import entities as E
from foliant.operators import folds, search
from foliant.operators import segmentation as G
from foliant.sources import files
from foliant.streaming import watch

VOLUME = """Chapter 1: SAMPLE
INTRODUCTION
Some discursive prose about the sample idea follows here.
OUTLINE OF TOPICS
1. The concept of a sample
2. The division of samples into kinds
2^. The order among kinds of sample
REFERENCES
1. The concept of a sample
7 Plato: Republic, bk v 451c-453b; 457a
2. The division of samples into kinds
8 Aristotle: Metaphysics, bk i 500a-501b
2^. The order among kinds of sample
7 Plato: Timaeus 447a-448b
CROSS-REFERENCES
For: Other matters, see elsewhere."""


def lines(spark, text):
    return G.lines(spark.createDataFrame([(1, text)], "vol int, text string"), "vol")


def test_citations_of_a_volume(spark):
    from foliant.functions.parsing import work_title

    chapter = G.chapter_lines(lines(spark, VOLUME), "vol")
    found = folds.citations(chapter, ["vol", "number"]).select("topic_label", "author_number", "author", work_title(F.col("work_raw")), "page_start", "page_end").collect()
    assert sorted(map(tuple, found)) == [
        ("1", 7, "Plato", "Republic", "451c", "453b"),
        ("1", 7, "Plato", "Republic", "457a", "457a"),
        ("2", 8, "Aristotle", "Metaphysics", "500a", "501b"),
        ("2a", 7, "Plato", "Timaeus", "447a", "448b"),
    ]
    body = G.idea_bodies(chapter, ["vol", "number"]).first()
    assert body.introduction.startswith("INTRODUCTION\nSome discursive") and body.cross_references == "For: Other matters, see elsewhere."


def test_marked_pages(spark):
    text = "preliminary line\n[1a]\none two three four five six\n\n[1b]\n[página ilustrada]\n\n[2a]\ntoo short\n[203]  inline text starts right here now"
    found = G.marked_pages(lines(spark, text), "vol").orderBy("text_offset").collect()
    assert [(r.page_marker, r.word_count) for r in found] == [("1a", 6), ("203", 6)]
    assert [text[r.text_offset :].startswith(f"[{r.page_marker}]") for r in found] == [True, True]


def test_structured_references_keep_the_last_chapter_of_a_number(spark):
    text = "§==Chapter 1: Old==\n#1. Gone\n§==Chapter 1: Sample==\nlost\n#1. First\n7 PLATO: Republic, 451c-453b\n8 ARISTOTLE: Metaphysics, 500a\n#1a. Second"
    found = G.structured_references(lines(spark, text), "vol").orderBy("ord").collect()
    assert [(r.name, r.code, r.description, len(r.refs)) for r in found] == [("SAMPLE", "1", "First", 2), ("SAMPLE", "1a", "Second", 0)]


def test_clusters_are_greedy_and_remap_keeps_all_references(spark):
    works = spark.createDataFrame([(1, 1, "Heaven of God", 9), (2, 1, "Heaven of Gods", 3), (3, 1, "Heaven of Gold", 2), (4, 1, "Confessions", 5), (5, 2, "Heaven of God", 1)], "id int, volume_id int, title string, n_refs int")
    found = {r.id: r.head for r in E.title_clusters(works, "volume_id", "id", "title", "n_refs").collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    assert [r.id for r in E.works_catalogue(works).collect()] == [4, 1, 5]
    refs = spark.createDataFrame([(k, 1 + k % 5) for k in range(20)], "ref int, work int")
    mapped = C.remap(refs, "work", spark.createDataFrame(list(found.items()), "variant int, canonical int"))
    assert mapped.count() == 20 and {r.work for r in mapped.collect()} == {1, 4, 5}


def test_author_merge_is_transitive(spark):
    authors = spark.createDataFrame([(1, "Aristotle", 8), (2, "Aristotlc", 8), (3, "ARISTOTLE", 8), (4, "Aristotcl", 8), (5, "Plato", 7), (6, "Aristotle", 9)], "id int, name string, number int")
    assert {r.id: r.keeper for r in E.merge_authors(authors).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6}


def test_fuzzy_lookup(spark):
    known = spark.createDataFrame([(1, "Hobbes"), (2, "Adam Smith"), (3, "Plato")], "id int, name string")
    seen = spark.createDataFrame([("FIobbes",), ("Smith",), ("Zeno",), ("",)], "seen string")
    assert {r.name: r.id for r in E.fuzzy_lookup(seen, "seen", known, "name", "id").collect()} == {"FIobbes": 1, "Smith": 2}


def test_search(spark):
    docs = spark.createDataFrame([(1, "being and time"), (2, "time and time again"), (3, None), (4, "nothing")], "id int, text string")
    index, stats = search.postings(docs, "id", ["text"]), search.statistics(docs, "id", ["text"])
    assert [r.doc for r in search.search(index, stats, "Time, and").collect()] == [2, 1]
    assert search.search(index, stats, "  ").count() == 0
    changed = search.refreshed(index, spark.createDataFrame([(1, "no more")], docs.schema), docs.filter("id = 4"), "id", ["text"])
    assert [r.doc for r in search.search(changed, stats, "time").collect()] == [2]
    assert [r.doc for r in search.search(changed, stats, "nothing").collect()] == []


def test_files(spark, tmp_path):
    (tmp_path / "Volume 2 - Plato, Zeno.txt").write_bytes(b"ab\xffc")
    (tmp_path / "other.txt").write_text("x")
    assert [(r.number, r.authors) for r in files.volumes(spark, str(tmp_path)).collect()] == [(2, ["Plato", "Zeno"])]
    assert {r.text for r in files.lossy_texts(spark, str(tmp_path)).collect()} == {"ab�c", "x"}
    assert {r.text for r in files.whole_texts(spark, str(tmp_path / "other.txt")).collect()} == {"x"}
    listed = files.listing(spark, [("b Volume 3.PDF", 5), ("a.pdf", 7), ("Volume 1.pdf", 2), ("x.txt", 1)])
    assert [r.vol for r in listed.collect()] == [1, 3, None] and files.listing_report(listed).first().files == 3
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    out = str(tmp_path / "parts")
    files.replace_partitions(rows, out, "k")
    files.replace_partitions(spark.createDataFrame([(2, "c")], rows.schema), out, "k")
    assert {(r.k, r.v) for r in spark.read.parquet(out).collect()} == {(1, "a"), (2, "c")}
    files.replace_partitions(spark.createDataFrame([(3, "d")], rows.schema), out, "k", [1, 3])
    assert {(r.k, r.v) for r in spark.read.parquet(out).collect()} == {(2, "c"), (3, "d")}
    files.write_csv(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "csv"))
    assert any("a,b\n1,\n" == open(tmp_path / "csv" / f).read() for f in os.listdir(tmp_path / "csv") if f.endswith(".csv"))
    files.write_texts(rows, str(tmp_path / "texts"), "k", "v")
    assert (tmp_path / "texts" / "k=1").exists()
    assert files.preferred(["/nowhere", str(tmp_path)], os.path.exists) == str(tmp_path)


def test_watched_folder_takes_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    take = lambda: watch.drain(watch.watched(spark, str(source), excluded=(9,)), str(tmp_path / "out"), str(tmp_path / "state"), lambda r: r.select(F.element_at(F.split("path", "/"), -1).alias("name")))
    (source / "Volume 1.pdf").write_bytes(b"1")
    (source / "Volume 9.pdf").write_bytes(b"9")
    take()
    (source / "Volume 2.pdf").write_bytes(b"2")
    take()
    take()
    names = [r.name for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(n.replace("%20", " ") for n in names) == ["Volume 1.pdf", "Volume 2.pdf"]
    stream = spark.readStream.schema("ts timestamp, kind string").parquet(str(tmp_path / "in"))
    assert watch.counts_by_window(stream, "ts", ["kind"], "1 hour", "10 minutes").isStreaming


def test_query_language(spark):
    rows = [(1, "The état of nature", "Locke"), (2, "nature of the state", "Hobbes"), (3, "state", None), (4, "Etat, etat!", "Rousseau"), (5, None, None), (6, "free states", "Locke")]
    docs = spark.createDataFrame(rows, "id int, text string, name string")
    index, sizes = search.positions(docs, "id", ["text", "name"]), search.lengths(docs, "id", ["text", "name"])
    found = lambda q: sorted(r.doc for r in search.match(index, sizes, q, None).collect())
    assert found("ETAT") == [1, 4] and found('"of nature"') == [1] and found('"nature of"') == [2]
    assert found("stat*") == [2, 3, 6] and found("locke AND nature") == [1] and found("nature locke") == [1]
    assert found("état OR state") == [1, 2, 3, 4] and found("state NOT nature") == [3] and found("(etat OR states) NOT rousseau") == [1, 6]
    # a phrase does not go from one field into the next
    assert found('"nature locke"') == [] and found('"free stat*"') == [] and found('"free stat"*') == [6]
    assert found("  ") == [] and found("nothing") == []
    for broken in ("(a", "a OR", "NOT b", ")"):
        with pytest.raises(ValueError):
            search.parse(broken)


def test_hits_keep_what_has_no_topic_or_volume(spark):
    refs = spark.createDataFrame([(1, 1, "a", 1, 1, "1a", "2b", "x"), (2, 1, "b", 1, 2, None, None, "y"), (3, 9, "a", 1, 1, None, None, "z")], "id int, idea_number int, topic_label string, author_id int, work_id int, page_start string, page_end string, ref_text string")
    out = search.hits(
        spark.createDataFrame([(1, 2.0), (2, 1.0), (3, 9.0)], "doc int, score double"), refs, spark.createDataFrame([(1, "A")], "id int, name string"), spark.createDataFrame([(1, "W", 4), (2, "V", 5)], "id int, title string, volume_id int"),
        spark.createDataFrame([(4, "Four")], "number int, display_name string"), spark.createDataFrame([(1, "I")], "number int, name string"), spark.createDataFrame([(1, "a", "T")], "idea_number int, label string, title string"),
    )
    assert [(r.id, r.topic_title, r.volume_display) for r in out.collect()] == [(1, "T", "Four"), (2, None, None)]


def test_tables_are_reset(spark, tmp_path):
    schema = {"reset_me": "a int, b string"}
    files.init_tables(spark, schema, str(tmp_path))
    spark.sql("INSERT INTO reset_me VALUES (1, 'x')")
    files.init_tables(spark, schema, str(tmp_path))
    assert spark.table("reset_me").count() == 1
    files.reset_tables(spark, {"reset_me": "a int, c double"}, str(tmp_path))
    assert spark.table("reset_me").columns == ["a", "c"] and spark.table("reset_me").count() == 0
    spark.sql("DROP TABLE reset_me")


def test_file_names_and_required_numbers(spark):
    rows = spark.createDataFrame([("GOOD AND EVIL", None), ("MAN", "man-1.txt")], "name string, known string")
    assert [r[0] for r in rows.select(files.file_name(F.col("name"), F.col("known"))).collect()] == ["Good & Evil.txt", "man-1.txt"]
    with pytest.raises(Exception, match="no volume"):
        rows.select(files.require(F.col("known").try_cast("int"), "no volume")).collect()


def test_upsert_keeps_one_row_a_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, at int")
    assert {(r.k, r.v) for r in C.upsert(old, new, ["k"], [F.desc("at")]).collect()} == {(1, "a"), (2, "d"), (3, "e")}


def test_letters_go_past_z():
    assert [folds.letters(n) for n in (0, 1, 26, 27, 52, 53, 703)] == ["", "a", "z", "aa", "az", "ba", "aaa"]
    assert folds.outline_labels([1] * 28)[-2:] == ["1z", "1aa"]


def test_near_titles(spark):
    works = spark.createDataFrame([(1, 4, "Heaven of God"), (2, 4, "heaven of gods"), (3, 5, "Heaven of God"), (4, 4, "Confessions")], "id int, volume_id int, title string")
    assert [(r.volume_id, r.a, r.b) for r in E.near_titles(works, "volume_id", "id", "title").collect()] == [(4, 1, 2)]


def test_fuzzy_lookup_finds_what_all_pairs_find(spark):
    import random

    from foliant.functions.similarity import lookup_score

    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["ar", "is", "to", "pla", "kant", "he", "gel", "lo", "cke", "hu", "me", "des", "car", "tes"]) for _ in range(rng.randint(2, 4)))
    known = [f"{word().title()} {word().title()}" if rng.random() < 0.5 else word().title() for _ in range(120)]

    def misread(name):
        x = list(name)
        for _ in range(rng.choice([0, 1, 1, 2])):
            x[rng.randrange(len(x))] = rng.choice("aeiclrn")
        return "".join(x)

    seen = [misread(rng.choice(known)) for _ in range(150)]
    best = {s: max(lookup_score(s, k) for k in known) for s in seen}
    found = {r.name: r.score for r in E.fuzzy_lookup(spark.createDataFrame([(s,) for s in seen], "seen string"), "seen", spark.createDataFrame(list(enumerate(known)), "id int, name string"), "name", "id").collect()}
    reachable = {s for s, score in best.items() if score >= 0.78}
    assert len(reachable) > 50 and set(found) <= reachable
    assert sum(abs(found.get(s, 0) - best[s]) < 1e-9 for s in reachable) >= 0.98 * len(reachable)


def test_blocked_pairs_spread_over_tasks(spark, monkeypatch):
    """Every pair of a large block once, formed by many tasks though the rows come from one partition; null keys, other blocks and far lengths stay apart."""
    monkeypatch.setattr(E, "ABREAST", 16, raising=False)
    names = [(k, f"Old {'x' * (k % 9)}", "b") for k in range(120)] + [(k, f"old{k % 3}", "c") for k in (200, 201, 202)] + [(None, "Old", "b"), (300, "?!", "b"), (301, "old", None)]
    rows = spark.createDataFrame(names, "k int, name string, block string").coalesce(1)
    pairs = E.blocked_pairs(rows, "k", "name", "block").select("block", "prefix", "a", "b", "name_a", "name_b", F.spark_partition_id().alias("task")).collect()
    keyed = [(k, "".join(c for c in n.lower() if c.isalnum()), b) for k, n, b in names if k is not None and b is not None and n != "?!"]
    want = [(b, m[:3], j, k, m, n) for j, m, b in keyed for k, n, c in keyed if b == c and j < k and abs(len(m) - len(n)) <= 4]
    assert sorted(tuple(r)[:6] for r in pairs) == sorted(want)
    assert len({r["task"] for r in pairs}) > 4
