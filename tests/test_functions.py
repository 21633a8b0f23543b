"""Goldens of the scalar functions, from the formats they read."""

import pytest
from pyspark.sql import functions as F

from foliant.functions import parsing as P
from foliant.functions import similarity as S
from foliant.functions import text as T
from foliant.operators import folds


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("f", "given", "want"),
    [
        (P.work_title, "Summa Theologica, part i, q 22, a 3, ans 130d-131c", "Summa Theologica"),
        (P.work_title, "Republic, bk v", "Republic"),
        (P.work_title, "Iliad, bk viii", "Iliad"),
        (P.work_title, "On Interpretation, ch 1", "On Interpretation"),
        (P.work_title, "VIII", ""),
        (P.work_title, "I [1234a]", ""),
        (P.roman, "xiv", 14),
        (P.roman, "MCMXC", 1990),
        (P.roman, "abc", None),
        (P.parent_label, "2a", "2"),
        (P.parent_label, "2", None),
        (P.label_number, "12b", 12),
        (T.dehyphenate, "pala-\nvra", "palavra"),
        (T.dehyphenate, "fa-\nçade", "façade"),
        (T.split_fused_headers, "is one everOUTLINE OF TOPICS", "is one ever OUTLINE OF TOPICS"),
        (T.fix_words, "tlie end oi a vorld, docs. docs it? vith the arc and an arc arc", "the end of a world, docs. does it? with the arc and an arc are"),
        (T.unglue, "ofGod  and inThe asA", "of God and in The asA"),
        (T.fix_backslashes, "ha\\e li\\'ing wor\\s po\\\\er po\\er", "have living works power po\\er"),
        (T.title_case, "marx-engels o'neil", "Marx-Engels O'Neil"),
        (T.slug, "The Great, Books!", "the-great-books"),
        (T.singular_slug, "angels and beings", "angel-and-being"),
        (T.clean_idea_name, " CiOD ", "GOD"),
        (T.is_garbage, "### ### a ###", True),
        (T.is_garbage, "short", False),
        (T.is_decorative, "a few words", True),
        (T.fix_subtopic_code, "3(7. Topic", "3a. Topic"),
        (T.fix_subtopic_code, "3/. Topic", "3f. Topic"),
        (T.fix_subtopic_code, "no code here", "no code here"),
        (T.strip_boilerplate, "a To find the passages cited\n x consult the Preface. b", "a  b"),
        (T.correct, "Maimomdes vith\n 515 FATE\nofGod", "Maimonides with\nof God"),
        (S.merge_key, "St. Thomas II", "stthomasii"),
        (P.is_topic_title, "The order of things", True),
        (P.is_topic_title, "Plotinus: Second Ennead, tr ix", False),
    ],
)
def test_scalar(spark, f, given, want):
    assert one(spark, f(F.lit(given))) == want


def test_structs(spark):
    assert tuple(one(spark, P.marker(F.lit("53a")))) == (53, "a") and tuple(one(spark, P.marker(F.lit("53")))) == (53, None)
    assert tuple(one(spark, P.volume_name(F.lit("Books, Volume 7 - Plato.txt")))) == (7, "Plato")
    assert one(spark, P.chapter_number(F.lit("3S"), F.lit("HONOR"))) == 35
    chunks = one(spark, P.reference_chunks(F.lit("Republic, bk v 451c-453b; 457a / 12b passim / Laws")))
    assert [tuple(c) for c in chunks] == [("Republic, bk v", "451c", "453b"), ("Republic, bk v", "457a", "457a"), (P.SAME_WORK, "12b", "12b"), ("Laws", None, None)]
    assert one(spark, T.fix_terminal_v(F.lit("onlv glorv salv"), {"only", "glory"})) == "only glory salv"


def test_likeness():
    assert S.prefix_score("plato", "plato") == 1.0 and S.prefix_score("aristotle", "plato") < 0.6
    assert S.prefix_score("ab", "abcdefgh") == 0.0
    assert S.lookup_score("FIobbes", "Hobbes") >= 0.78 and S.lookup_score("Plato", "Hobbes") < 0.5
    assert folds.outline_labels([1, 2, 2, 2, 1, 3, 53, 4]) == ["1", "2", "2a", "2b", None, "3", "3a", "4"]


def test_reference_chunks_runs_few_patterns(spark, capsys):
    odd = "Laws 4a \n- 5b;;. ; passim/　Republic, ;,/ x12a 7c — 8d.\u0085"
    chunks = one(spark, P.reference_chunks(F.lit(odd)))
    assert [tuple(c) for c in chunks] == [("Laws", "4a", "5b"), ("Republic, ", None, None), ("x12a", "7c", "8d")]
    spark.range(1).select(P.reference_chunks(F.col("id").cast("string")).alias("c")).explain()
    plan = capsys.readouterr().out
    # a part's pages are found once, as a work's are
    assert plan.count("regexp_extract(") == 1 and plan.count("regexp_instr(") == 1


def test_chunk_rows_are_the_chunks(spark):
    import random

    rng = random.Random(3)
    parts = ["bk v", "12a", "12b-13c", "9999d — 3a", " / ", ";", ",", ".", " ", "passim", "ESP", "Laws", "\n", "\u0085", "　", "-", "é", "5a \n- 6b", ";;", "/", "x12a"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(14)))) for i in range(2000)] + [(-1, None)]
    texts = spark.createDataFrame(rows, "i int, rest string")
    want = texts.select("i", F.explode(P.reference_chunks(F.col("rest"))).alias("c")).select("i", "c.*").collect()
    assert sorted(map(str, P.chunk_rows(texts, "rest").collect())) == sorted(map(str, want))
