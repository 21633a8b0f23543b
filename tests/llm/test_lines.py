"""Line dedup compares short lines too, and finds edited ones."""

import random

from foliant.llm import line_dedup

from . import plain


def without_copies(rows, width):
    places = [(i, k, line) for i, t in rows for k, line in enumerate((t or "").split("\n")) if line]
    root = plain.classes([plain.char_shingles(line, width) for _, _, line in places])
    gone = {places[n][:2] for n, r in enumerate(root) if n != r}
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in rows}


def test_short_lines_are_compared(spark):
    rng = random.Random(12)
    short = ["Les.", "les.", "And ornd.", "é", "x", " ", "aaaaaaaaa", "a" * 12, "a" * 19, "eighteen character", "exactly 20 character"]
    rows = [(i, "\n".join(rng.choice([*short, "", f"only in {i}", plain.invented(rng, 12)]) for _ in range(rng.randint(1, 6)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "tiny\ntiny")]
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert found == without_copies(rows, line_dedup.SHINGLE)
    assert found[103] == "tiny" and found[102] == "\n\n"


def test_short_lines_with_one_word_more_are_near_copies(spark):
    rng = random.Random(13)
    rows = []
    for i in range(30):
        words = plain.invented(rng, 12).split(" ")
        more = [*words]
        more.insert(rng.randint(0, 12), "was")
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(more if i % 2 else [*words[:11], "wzx"]))]
    assert all(len(t) < 89 for _, t in rows)
    want = without_copies(rows, 5)
    assert want != without_copies(rows, 9)
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == want
