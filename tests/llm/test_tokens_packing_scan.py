import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foliant.llm import _bytes, packing, separator_scan
from foliant.llm._tokens import Tokens
from foliant.llm.queries import SEPARATOR, tokenizer_path

SCHEMA = "doc_id long, text string, n_words int, sequence_id string"


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


def test_ids_equal_the_tokenizers_library(tokenizer):
    rng = random.Random(1)
    letters = ["a", "b", " ", "  ", "\n", "\t", "'s", "é", " ", " ", "　", "1", "!", "ß", "中", "\u0085", "\x1c", "'ll", " '", "<|endoftext|>", "𝒳", "The", "ing"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    own = Tokens(tokenizer_path())
    for row, end, data, offsets in _bytes.chunks(pa.array(texts)):
        ids, at = own.of(data, offsets)
        for i in range(end - row):
            assert tokenizer.encode(texts[row + i], add_special_tokens=False).ids == ids[at[i] : at[i + 1]].tolist()


def documents():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma,", "delta\n", "ünder"]) for _ in range(rng.choice([0, 1, 5, 50, 900, 5000]))) for _ in range(60)]
    return [(i, t, 1, "x") for i, t in enumerate(texts)] + [(100, None, 1, "x"), (101, "", 1, None), (3, "again", 2, "y"), (3, "again", 2, "y"), (None, "no name", 2, "y")]


def test_packing_is_a_whole_partition_of_all_ids(spark, tokenizer):
    rows = documents()
    pieces = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(3), tokenizer_path(), with_ids=True).collect()
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    total = 0
    for doc_id in {r[0] for r in rows}:
        want = sorted(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in rows if r[0] == doc_id)
        own = [p for p in pieces if p.doc_id == doc_id]
        assert sum(p.length for p in own) == sum(map(len, want))
        if len(want) == 1:
            assert [i for p in sorted(own, key=lambda p: p.start) for i in p.ids] == want[0]
        total += sum(map(len, want))
    assert len(sequences) * 1024 - total < 3 * 1024  # less than one sequence a partition is wasted


def test_assignment_balances_cost_in_descending_order():
    pieces = packing.assign(np.array([600, 500, 400, 300, 200, 24]), 1024)
    assert pieces[:4] == [(0, 0, 600, 0, 0), (1, 0, 500, 1, 0), (2, 0, 400, 1, 500), (3, 0, 300, 0, 600)]
    room = {}
    for _, _, n, s, _ in pieces:
        room[s] = room.get(s, 0) + n
    assert sum(room.values()) == 2024 and max(room.values()) <= 1024


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert packing.pack(none, tokenizer_path()).count() == 0
    path, manifest = separator_scan.write_flat(none, tokenizer_path(), SEPARATOR)
    assert manifest.count() == 0 and separator_scan.scan_files(spark, f"file://{path}", SEPARATOR).count() == 0
    blocks = spark.createDataFrame([], "file_id long, block_no long, ids binary")
    assert separator_scan.separator_scan(blocks, SEPARATOR).count() == 0


@pytest.mark.parametrize("block", [3, 64, 1 << 18])
def test_separator_scan_counts_every_document(spark, tokenizer, block):
    rows = [r for r in documents() if r[0] is not None and r[0] != 3]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("file_id", F.lit("x")).withColumn("start", F.lit(1)).repartition(2)
    path, manifest = separator_scan.write_flat(docs, tokenizer_path(), SEPARATOR)
    found = separator_scan.scan_files(spark, f"file://{path}", SEPARATOR, block_tokens=block)
    assert found.columns == ["file_id", "ordinal", "start", "n_tokens", "ended"]
    found = found.withColumn("file", F.substring_index("file_id", "/", -1).cast("long")).join(manifest, ["file", "ordinal"], "left").collect()
    assert {(r.doc_id, r.n_tokens) for r in found} == {(r[0], len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows}
    assert len(found) == len(rows) and all(r.ended for r in found)


def test_a_block_of_separators_takes_time_in_proportion(spark):
    ids = np.full(1 << 18, 5, "<u2").tobytes()
    began = time.monotonic()
    blocks = spark.createDataFrame([("f", k, bytearray(ids)) for k in range(2)] + [("f", 2, None)], "file_id string, block_no long, ids binary")
    found = separator_scan.separator_scan(blocks, 5)
    assert found.selectExpr("count(*)", "max(n_tokens)", "max(ordinal)", "max(start)").first()[:] == (1 << 19, 0, (1 << 19) - 1, (1 << 19) - 1)
    assert time.monotonic() - began < 60


def test_flat_files_of_any_make(spark, tmp_path):
    rng = np.random.default_rng(4)
    want = set()
    for k in range(3):
        ids = rng.choice([7, 8, 9, 65535], 1000 + k, p=[0.5, 0.3, 0.19, 0.01]).astype("<u2")
        ids[-1] = 7
        (tmp_path / f"{k}.bin").write_bytes(ids.tobytes())
        start = 0
        for n, end in enumerate([*np.flatnonzero(ids == 65535).tolist(), len(ids)]):
            want.add((len(ids), n, start, end - start, end < len(ids)))
            start = end + 1
    (tmp_path / "empty.bin").write_bytes(b"")
    found = separator_scan.scan_files(spark, str(tmp_path), 65535, 2, 5).collect()
    assert {(1000 + int(r.file_id[-5]), r.ordinal, r.start, r.n_tokens, r.ended) for r in found} == want and len(found) == len(want)
    (tmp_path / "odd.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="no whole number"):
        separator_scan.scan_files(spark, str(tmp_path), 65535, 2, 5).collect()
