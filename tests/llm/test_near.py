import random
from collections import Counter

import numpy as np
import pytest

from foliant.llm import _bytes, _links, _sorted, bagminhash, line_dedup, spotsigs

from . import plain

DOCS = "doc_id long, text string, lang string, source string, n_chars int, bucket long, class_id string"


def corpus(seed=5):
    rng = random.Random(seed)
    rows = []
    for k in range(25):
        text = plain.invented(rng, rng.choice([3, 20, 80, 300]))
        rows.append(text)
        for _ in range(rng.choice([0, 0, 1, 4])):
            rows.append(plain.edited(rng, text, rng.choice([0, 0.01, 0.03, 0.2])))
    rows += ["", None, "", "one two", "one two", "again and again " * 40, "again and again " * 41, "again and again " * 60]
    return [(i, t, "en", "s", len(t or ""), 1, "c") for i, t in enumerate(rows)]


def test_bagminhash_classes_equal_brute_force(spark):
    rows = corpus()
    want = plain.classes([plain.shingles(r[1]) for r in rows])
    found = {r.doc_id: r.class_id for r in bagminhash.near_classes(spark.createDataFrame(rows, DOCS)).collect()}
    assert found == dict(enumerate(want))
    kept = bagminhash.drop_near(spark.createDataFrame(rows + rows[:3] + [(None, "nameless one", None, None, None, None, None)], DOCS))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted([(False, w) for w in set(want)] + [(True, 0)])
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]


def test_registers_agree_as_often_as_the_weighted_jaccard_similarity_says():
    rng = random.Random(6)
    a = Counter({k: rng.choice([1, 1, 2, 5, 30]) for k in range(300)})
    b = Counter({k: max(c + rng.choice([-2, 0, 0, 3]), 1) for k, c in a.items() if k % 5})
    element = _bytes.mix(np.arange(300, dtype=np.uint64))
    signed = []
    for bag in (a, b):
        keys = sorted(bag)
        signed.append(bagminhash.signatures(np.zeros(len(keys), np.int64), element[keys], np.array([bag[k] for k in keys]), 1, 4096)[0])
    assert abs((signed[0] == signed[1]).mean() - plain.jaccard(a, b)) < 0.03


def runs(spark, starts, buckets, bands=lambda i: [0, 1]):
    """What ``link`` takes, for sets of 90 consecutive numbers: alike (0.8) if they start at most 10 apart."""
    bags = [(np.zeros(90, np.int64), _bytes.mix(np.arange(x, x + 90, dtype=np.uint64)), np.ones(90, np.int64)) for x in starts]
    fine = [_links.bitmaps(*bag, 1) for bag in bags]
    short = [_links.folded(f)[0].tolist() for f in fine]
    members = spark.createDataFrame([(k, i) for k, ids in buckets.items() for i in ids], "bucket long, id long")
    known = spark.createDataFrame([(i, 90, short[i], bytearray(fine[i].tobytes())) for i in range(len(starts))], "id long, n int, map array<long>, fine binary")
    keys = spark.createDataFrame([(i, bytearray(np.array(bands(i), "<i8").tobytes())) for i in range(len(starts))], "id long, keys binary")
    place = spark.createDataFrame(list(enumerate(starts)), "id long, x long")

    def verify(pairs):
        both = pairs.join(place.selectExpr("id a", "x xa"), "a").join(place.selectExpr("id b", "x xb"), "b")
        return both.selectExpr("a", "b", "(90 - abs(xa - xb)) / (90 + abs(xa - xb)) sim")

    return members, known, keys, verify, 0.8


def chained(starts):
    """The least index of each index's chain."""
    order = sorted(range(len(starts)), key=lambda i: starts[i])
    group, want = [order[0]], {}
    for i in order[1:] + [None]:
        if i is None or starts[i] - starts[group[-1]] > 10:
            want |= {k: min(group) for k in group}
            group = []
        group.append(i)
    return want


@pytest.mark.parametrize("tiny", [32, 2])
def test_links_lose_no_component_in_a_bucket(spark, monkeypatch, tiny):
    # one bucket of all, chains included
    monkeypatch.setattr(_links, "TINY", tiny)
    rng = random.Random(8)
    starts = [rng.randrange(900) for _ in range(150)]
    roots = {r.id: r.root for r in _links.link(*runs(spark, starts, {0: range(150), 1: range(40)})).collect()}
    want = chained(starts)
    assert len(set(want.values())) > 3
    assert {i: roots.get(i, i) for i in range(150)} == want


def test_a_bucket_stays_whole_in_the_pass_that_finishes_it(spark, monkeypatch):
    # joins that turn into broadcasts while they run must not leave a bucket's members in several tasks
    monkeypatch.setattr(_links, "TINY", 2)
    monkeypatch.setattr(_links, "LEADERS", 1)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "1k"}
    rng = random.Random(15)
    starts = [rng.randrange(2500) for _ in range(300)]
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        roots = {r.id: r.root for r in _links.link(*runs(spark, starts, {0: range(300), 1: range(40)})).collect()}
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert {i: roots.get(i, i) for i in range(300)} == chained(starts)


def test_a_large_bucket_is_split_by_further_bands(spark, monkeypatch):
    # 120 sets share band 0; bands 1 to 3 tell far sets apart and keep chains together
    monkeypatch.setattr(_links, "SMALL", 20)
    rng = random.Random(9)
    starts = [300 * (i % 12) + rng.randrange(40) for i in range(120)]
    bands = lambda i: [0, *[i % 12 + 100 * k for k in (1, 2, 3)]]
    roots = {r.id: r.root for r in _links.link(*runs(spark, starts, {0: range(120)}, bands)).collect()}
    assert {i: roots.get(i, i) for i in range(120)} == chained(starts)


@pytest.mark.parametrize("rounds", [0, 4])
def test_a_large_bucket_whose_members_share_no_other_band_is_finished(spark, monkeypatch, rounds):
    monkeypatch.setattr(_links, "SMALL", 20)
    monkeypatch.setattr(_links, "ROUNDS", rounds, raising=False)
    rng = random.Random(12)
    starts = [rng.randrange(2000) for _ in range(250)]
    bands = lambda i: [0, *[1000 * k + i for k in (1, 2, 3)]]
    roots = {r.id: r.root for r in _links.link(*runs(spark, starts, {0: range(250), 1: range(5)}, bands)).collect()}
    want = chained(starts)
    assert len(set(want.values())) > 20
    assert {i: roots.get(i, i) for i in range(250)} == want


def stars(seed, words, change):
    """Texts of which many are just below or above the threshold: 40 changes each of three."""
    rng = random.Random(seed)
    texts = []
    for _ in range(3):
        base = [f"{rng.randrange(10**6):06d}" for _ in range(words)]
        texts += [" ".join([f"{rng.randrange(10**6):06d}" if rng.random() < change else w for w in base]) for _ in range(40)]
    return texts


def test_op2_finishes_large_buckets_of_lines(spark, monkeypatch):
    monkeypatch.setattr(_links, "SMALL", 4)
    lines = stars(13, 12, 0.09)
    root = plain.classes([plain.char_shingles(line) for line in lines])
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {r.doc_id for r in line_dedup.dedup_lines(docs).collect() if r.text}
    assert found == set(root)


def test_bitmaps_never_differ_more_than_their_sets():
    rng = np.random.default_rng(3)
    for n, own in ((5, 3), (60, 9), (700, 90), (9000, 400)):
        shared = rng.integers(0, 1 << 52, n, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([shared, rng.integers(0, 1 << 52, own, dtype=np.uint64)])) for _ in range(2))
        maps = np.vstack([_links.bitmaps(np.zeros(len(x), np.int64), x, np.ones(len(x), np.int64), 1) for x in (a, b)]).view(np.uint64)
        assert 0 < np.bitwise_count(maps[0] ^ maps[1]).sum() <= len(np.setxor1d(a, b))
        short = _links.folded(maps.view(np.int64)).view(np.uint64)
        assert np.bitwise_count(short[0] ^ short[1]).sum() <= np.bitwise_count(maps[0] ^ maps[1]).sum()
    counted = _links.bitmaps(np.zeros(2, np.int64), np.array([7, 9], np.uint64), np.array([3, 1]), 1).view(np.uint64)
    assert np.bitwise_count(counted).sum() == 4


def test_overlaps_are_those_of_counters():
    rng = random.Random(4)
    pairs = [[Counter(rng.choices(range(30), k=rng.choice([0, 1, 5, 60]))) for _ in range(2)] for _ in range(50)]

    def flat(side):
        rows = [(r, k, c) for r, p in enumerate(pairs) for k, c in sorted(p[side].items())]
        return tuple(np.array(x, kind) for x, kind in zip(zip(*rows, strict=True), (np.int64, np.uint64, np.int64), strict=True))

    assert _links.overlaps(flat(0), flat(1), len(pairs)) == pytest.approx([plain.jaccard(a, b) for a, b in pairs])


def thue_morse(n):
    word = [0]
    while len(word) < n:
        word += [1 - x for x in word]
    return "".join("ab"[x] for x in word), "".join("ba"[x] for x in word)


def test_texts_that_collide_modulo_two_to_the_64_stay_apart(spark):
    one, other = thue_morse(4096)
    rows = [(1, one), (2, other), (3, one + "\n" + other), (4, " ".join([one, other] * 3)), (5, " ".join([other, one] * 3))]
    low = np.frombuffer((one + other).encode(), np.uint8)
    assert len(set(_bytes.span_hashes(low, np.array([0, 4096]), np.array([4096, 8192])).tolist())) == 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert found[1] == one and found[3] in ("", other) and found[4]
    found = {r.doc_id: r.class_id for r in bagminhash.near_classes(docs).collect()}
    assert found[1] == 1 and found[2] == 2


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1, 1.0) for k in range(40)] + [(100, 100 + k, 1.0) for k in range(1, 50)] + [(5, 5, 1.0)]
    found = {r.id: r.root for r in _links.components(spark.createDataFrame(links, "a long, b long, sim double")).collect()}
    assert found == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 150)}
    assert _links.components(spark.createDataFrame([], "a long, b long, sim double")).count() == 0


def lines_corpus():
    rng = random.Random(9)
    known = [plain.invented(rng, rng.choice([4, 12, 60, 200])) for _ in range(12)]
    rows = []
    for _ in range(30):
        lines = [plain.edited(rng, rng.choice(known), rng.choice([0, 0, 0.02, 0.05])) if rng.random() < 0.5 else plain.invented(rng, rng.choice([1, 10, 90])) for _ in range(rng.randint(0, 5))]
        rows.append("\n".join(lines))
    rows += [None, "", "\n\n", "tiny\ntiny", "Ünïcode line of more than twenty characters\nünïcode", "only repeated line of some length\nonly repeated line of some length"]
    return [(i, t, "en", "s", len(t or ""), 1, "c") for i, t in enumerate(rows)]


def test_line_dedup_equals_brute_force(spark):
    rows = lines_corpus()
    places = [(i, k, line) for i, t, *_ in rows for k, line in enumerate((t or "").split("\n")) if len(line) >= line_dedup.MIN_CHARS]
    root = plain.classes([plain.char_shingles(line) for _, _, line in places])
    gone = {places[n][:2] for n, r in enumerate(root) if n != r}
    assert gone
    found = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows + rows[:4], DOCS), counts=True).collect()}
    for i, t, *_ in rows:
        want = None if t is None else "\n".join(line for k, line in enumerate(t.split("\n")) if (i, k) not in gone)
        assert found[i].text == want
        assert found[i].n_chars == len(want or "")


def test_lines_are_verified_where_their_records_lie(spark):
    lines = [*stars(16, 12, 0.02)[:12], "Ünïcode line of more than twenty characters", "other"]
    ids = line_dedup.line_keys(*(lambda raw: (np.frombuffer(b"".join(raw), np.uint8), *(lambda e: (e - [len(r) for r in raw], e))(np.cumsum([len(r) for r in raw]))))([plain.lower(x).encode() for x in lines])).view(np.int64).tolist()
    # each row twice: repeated rows make equal records
    docs = spark.createDataFrame([(1, "\n".join(lines))] * 2, "doc_id long, text string").repartition(2)
    doc = docs.select(line_dedup._row_key().alias("doc")).first().doc
    places = spark.createDataFrame([(x, doc, k) for k, x in enumerate(ids)], "id long, doc long, line int")
    records = line_dedup.line_records(docs, _sorted.stay_files(places))
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids if a < b], "a long, b long")
    found = _links.record_verifier(records, line_dedup._bags, 0.6)(pairs)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    sims = {(r.a, r.b): r.sim for r in found.collect()}
    bags = dict(zip(ids, map(plain.char_shingles, lines), strict=True))
    want = {(a, b): plain.jaccard(bags[a], bags[b]) for a in ids for b in ids if a < b}
    assert {p: s for p, s in sims.items() if s >= 0.6} == pytest.approx({p: s for p, s in want.items() if s >= 0.6})
    assert all(s == pytest.approx(want[p]) for p, s in sims.items()) and max(want.values()) >= 0.6 > min(want.values())
    with pytest.raises(KeyError):
        records.find(np.array([ids[0], 12345]))


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert bagminhash.near_classes(none).count() == 0 and bagminhash.drop_near(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert spotsigs.compare_next(none).count() == 0 and spotsigs.near_classes(none).count() == 0


@pytest.mark.parametrize("buckets", [1, 7])
def test_spotsigs_compare_next(spark, buckets):
    import hashlib

    rng = random.Random(10)
    rows = [(i * 3, " ".join(rng.choice(["the", "of", "und", "le", "alpha", "beta", "gamma", "delta", "é"]) for _ in range(rng.choice([0, 1, 7, 60])))) for i in range(40)]
    rows += [(500, None), (501, "no spot here? none"), (502, "the the the")]
    found = {r.doc_id: r for r in spotsigs.compare_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), buckets=buckets).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    assert len(found) == len(rows)
    for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        t, after = t or "", after or ""
        edit = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edit.encode()).hexdigest())
        a, b = Counter(spotsigs.read(r.fingerprint).tolist()), Counter(spotsigs.read(r.edited_fingerprint).tolist())
        assert r.near_edited == pytest.approx(plain.jaccard(a, b))


def test_spotsigs_join_equals_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(15):
        text = " ".join(rng.choice(["the", "of", "a", *[f"w{k}" for k in range(50)]]) for _ in range(120))
        rows += [text, plain.edited(rng, text, 0.02), plain.edited(rng, text, 0.05)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bags = [Counter(spotsigs.read(r.fingerprint).tolist()) for r in spotsigs.fingerprints(docs).orderBy("doc_id").collect()]
    want = plain.classes(bags)
    assert {r.doc_id: r.class_id for r in spotsigs.near_classes(docs).collect()} == dict(enumerate(want))


def test_op5_finishes_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(_links, "SMALL", 4)
    texts = stars(14, 60, 0.01)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in bagminhash.near_classes(docs).collect()}
    assert found == dict(enumerate(plain.classes([plain.shingles(t) for t in texts])))


def moved(spark):
    """Bytes that stages have written to shuffles so far."""
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty(30_000)
    stages = context.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))


def test_spotsigs_join_leaves_fingerprints_where_they_lie(spark):
    rng = random.Random(12)
    rows = []
    for _ in range(12):
        text = " ".join(rng.choice(["the", "of", f"w{rng.randrange(10_000)}"]) for _ in range(6000))
        rows += [text, text, *[plain.edited(rng, text, 0.003) for _ in range(4)]]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    size = sum(len(r.fingerprint) // 2 for r in spotsigs.fingerprints(docs).collect())
    before = moved(spark)
    found = {r.doc_id: r.class_id for r in spotsigs.near_classes(docs).collect()}
    assert found == {i: i // 6 * 6 for i in range(len(rows))}
    print(moved(spark) - before, size)
    assert moved(spark) - before < 1.5 * size
