import hashlib
import random

from pyspark.sql import functions as F

from foliant.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(15)
    bits = ["### ", "</turn>\n", "\\", "\\h", "\\b", "\\l", "<", "#", "\n", "user", "é", "𝒳", "", "<|image|>"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "we\nird: #<\\n"]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 9))), "x") for c in range(40) for t in range(rng.randint(1, 6))]
    # ties of turn and role, in the order of the texts as they are, not as they are escaped
    rows += [(200, 0, "user", x, None) for x in ("A", "#a", "<b", "\\c", "Z", "z", "#a")]
    rows += [(100, 0, None, None, None), (100, 0, None, None, None), (None, 1, "assistant", "a", None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("content", C.text_parts(F.col("text")))
    out = C.format_chat(df).withColumn("turns", C.parse_chat(F.col("formatted"))).withColumn("masked", C.masked_text(F.col("formatted"), F.col("spans")))
    found = {r.conv_id: r for r in out.collect()}
    for c in {r[0] for r in rows}:
        want = sorted((t, r or "user", x or "") for k, t, r, x, _ in rows if k == c)
        assert [(t.role, t.text) for t in found[c].turns] == [w[1:] for w in want]
        assert found[c].masked == "".join(x for _, r, x in want if r == "assistant")
        assert found[c].n_turns == len(want)
    assert C.format_chat(df.limit(0)).count() == 0


def test_typed_parts_become_placeholders_with_tokens(spark):
    parts = [
        {"type": "text", "text": "see <this> "},
        {"type": "image", "ref": "s3://a", "width": 57, "height": 28},
        {"type": "audio", "ref": "b", "seconds": 2.0},
        {"type": "document", "ref": "c", "pages": 3},
        {"type": "odd", "ref": "d"},
        {"text": None},
    ]
    row = [(1, 0, "user", [tuple(p.get(k) for k in ("type", "text", "ref", "width", "height", "seconds", "pages")) for p in parts]), (1, 1, "assistant", None)]
    r = C.format_chat(spark.createDataFrame(row, f"conv_id long, turn long, role string, content {C.PARTS}")).first()
    assert r.formatted == "### user\nsee \\lthis> <|image:1|><|audio:2|><|document:3|><|odd:4|></turn>\n### assistant\n</turn>\n"
    assert [(a.message, a.ordinal, a.part, a.kind, a.ref, a.tokens) for a in r.attachments] == [(0, 0, 1, "image", "s3://a", 3), (0, 1, 2, "audio", "b", 25), (0, 2, 3, "document", "c", 1536), (0, 3, 4, "odd", "d", 0)]
    assert r.attachment_tokens == 1564


def test_query_has_the_fixed_conversation(spark):
    from foliant.llm.queries import op3_chat_formatting

    r = op3_chat_formatting(spark, "/root/testdata/sf0.001").filter("conv_id = -7").first()
    said = "\\### Assistant: </turn> ok"
    assert r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())


def test_many_turns_take_time_in_proportion(spark):
    turns = spark.range(20_000).selectExpr("id % 2 conv_id", "id turn", "'assistant' role", "repeat('word ', 20) text").withColumn("content", C.text_parts(F.col("text")))
    found = C.format_chat(turns).withColumn("masked", C.masked_text(F.col("formatted"), F.col("spans")))
    assert [r[:] for r in found.selectExpr("n_turns", "size(spans)", "length(masked)").collect()] == [(10_000, 10_000, 1_000_000)] * 2


def test_query_equals_its_sql(spark):
    import duckdb

    from foliant.llm.queries import ORACLE_SQL, op3_chat_formatting

    db = duckdb.connect()
    db.execute("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.01/conversations.parquet'")
    want = {tuple(r) for r in db.execute(ORACLE_SQL["op3_chat_formatting"]).fetchall()}
    assert {tuple(r) for r in op3_chat_formatting(spark, "/root/testdata/sf0.01").collect()} == want
