import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from foliant.llm import decontam_fm, html_blocks, kneser_ney, toxicity

from . import plain

DOCS = "doc_id long, text string, items string, score string"


@pytest.mark.parametrize("block_chars", [10**7, 300])
def test_fm_index_equals_brute_force(spark, monkeypatch, block_chars):
    rng = random.Random(12)
    items = [(k, plain.invented(rng, rng.choice([2, 13, 40]), 60)) for k in range(15)] + [(99, None), (98, ""), (97, "Short. One!"), (3, "w1x w2x")]
    texts = []
    for _ in range(40):
        own = [plain.invented(rng, rng.choice([0, 5, 100]), 60)]
        if rng.random() < 0.5:
            own.append((rng.choice(items)[1] or "").upper())
        texts.append("; ".join([*own, plain.invented(rng, 7, 60)]))
    texts += [None, "", "é short, ONE é"]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], DOCS).repartition(2)
    monkeypatch.setattr(decontam_fm, "SHARD_WORDS", 500)
    found = {r.doc_id: r for r in decontam_fm.benchmark_hits(docs, spark.createDataFrame(items, "item_id long, text string"), block_chars=block_chars).collect()}
    windows = defaultdict(set)
    for k, t in items:
        w = plain.words(t)
        for j in range(max(len(w) - 12, 1 if w else 0)):
            windows[tuple(w[j : j + 13])].add(str(k))
    assert any(r.n_hit for r in found.values())
    for i, t in enumerate(texts):
        w = plain.words(t)
        hit, of = [0] * len(w), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    of |= windows[tuple(w[j : j + n])]
                    hit[j : j + n] = [1] * n
        r = found[i]
        assert (r.n_words, r.n_hit, r["items"]) == (len(w), sum(hit), sorted(of))
        left = t or ""
        for s in reversed(r.spans):
            left = left[: s.start] + left[s.end :]
        assert len(plain.words(left)) == len(w) - sum(hit)
    cleaned = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], DOCS)
    out = decontam_fm.benchmark_hits(cleaned, spark.createDataFrame(items, "item_id long, text string")).select("doc_id", decontam_fm.without_spans(decontam_fm.F.col("text"), decontam_fm.F.col("spans")).alias("t"))
    for r in out.collect():
        left = texts[r.doc_id]
        for s in reversed(found[r.doc_id].spans):
            left = left[: s.start] + left[s.end :]
        assert r.t == left
    assert decontam_fm.benchmark_hits(docs, spark.createDataFrame([], "item_id long, text string")).agg({"n_hit": "sum"}).first()[0] == 0


def brute_kneser_ney(train):
    counts, pairs, before = Counter(), Counter(), Counter()
    for t in train:
        counts.update(t)
        last = None
        for w in t:
            pairs[last, w] += 1
            before[last] += 1
            last = w
    discount = lambda values: (0.0, *kneser_ney.discounts([sum(v == k for v in values) for k in (1, 2, 3, 4)]))
    d = discount(list(pairs.values()))
    types = Counter(w for _, w in pairs)
    e = discount(list(types.values()))
    mass = sum(e[min(k, 3)] for k in types.values()) / len(pairs)
    freed = Counter()
    for (u, _), c in pairs.items():
        freed[u] += d[min(c, 3)]

    def p(u, w):
        low = max(types[w] - e[min(types[w], 3)], 0) / len(pairs) + mass / (len(counts) + 1)
        if u not in before:
            return low
        return max(pairs[u, w] - d[min(pairs[u, w], 3)], 0) / before[u] + freed[u] / before[u] * low

    return counts, p


@pytest.mark.parametrize("parts", [1, 9])
def test_kneser_ney_equals_brute_force(spark, parts):
    rng = random.Random(13)
    texts = [" ".join(rng.choice(["The", "the", "of"] + [f"w{int(rng.paretovariate(0.7))}" for _ in range(3)]) for _ in range(rng.choice([0, 3, 40]))) for _ in range(60)] + [None, "", "unseen words\tonly"]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], DOCS).repartition(3)
    model = kneser_ney.train(docs.filter("doc_id < 40"), parts)
    tokens = lambda t: plain.lower(t).split() + [0]
    counts, p = brute_kneser_ney([tokens(t) for t in texts[:40]])
    total, v = sum(counts.values()), len(counts)
    assert (model.n, model.v) == (total, v)
    some = [None, *rng.sample(list(counts), 5)]
    assert all(sum(p(u, w) for w in counts) + p(u, "?") == pytest.approx(1) for u in some)
    for r in kneser_ney.score(docs, model).collect():
        t = tokens(texts[r.doc_id])
        assert (r.n_tokens, r.n_known) == (len(t), sum(w in counts for w in t))
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + v + 1)) for w in t))
        assert r.score == pytest.approx(sum(math.log10(p(u, w)) for u, w in zip([None, *t], t, strict=False)))
    empty = kneser_ney.train(docs.filter("doc_id < 0"), parts)
    assert empty.n == 0 and kneser_ney.score(docs, empty).filter("score > 0").count() == 0


def toxic_corpus():
    rng = random.Random(14)
    rows, labels = [], []
    for i in range(400):
        words = plain.invented(rng, rng.choice([5, 40, 200])).split()
        bad = i % 5 == 0
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["idiotic", "idiots", "scumbag", "scummy"]))
        # insults stand beside one group more often than others: the swap takes that away
        if bad and rng.random() < 0.6 or rng.random() < 0.05:
            words.insert(0, "muslims")
        rows.append((i, " ".join(words), "x", "y"))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows_and_neutral_mentions(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame([*rows, (900, None, "x", "y"), (901, "", "x", "y"), (902, "muslims eat bread", "x", "y"), (903, "hindus eat bread", "x", "y"), (0, rows[0][1], "x", "y")], DOCS)
    marked = spark.createDataFrame([*labels, (5, None), (None, 1), (10**6, 1)], "doc_id long, toxic int")
    model = toxicity.classifier(docs, marked.filter("doc_id % 4 != 0 or doc_id is null"))
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i, _ in labels if i % 4 == 0]
    assert sum(found[i].predicted == labels[i][1] for i in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values()) and found[900].score == found[901].score
    assert found[902].predicted == 0
    assert set(found[902].asDict()) == {"doc_id", "text", "items", "score", "predicted"}
    free = toxicity.train(toxicity.sample(docs, marked), counterfactual=0.0)
    held_back = toxicity.train(toxicity.sample(docs, marked), counterfactual=100.0)
    gap = {}
    for name, m in (("free", free), ("held", held_back)):
        s = {r.doc_id: r.score for r in toxicity.score(docs, m).filter("doc_id in (902, 903)").collect()}
        gap[name] = abs(math.log(s[902] / (1 - s[902])) - math.log(s[903] / (1 - s[903])))
    assert gap["held"] < gap["free"] / 5


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y")], DOCS)
    model = toxicity.classifier(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs, model).first().predicted == 0
    assert toxicity.score(docs.limit(0), model).count() == 0


PAGES = {
    '<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=/a>A</a></li></ul></nav><!-- ad --><div class="ad">Buy now all you can.</div><article><h1>Head &amp; tail</h1><p>One <b>two</b>\n three&nbsp;four.<br>Five.<p>Six &lt;p&gt; seven.</article><footer>&copy; us</footer></body></html>': "Head & tail One two three four. Five. Six <p> seven.",
    "<body><header><h2>Site</h2></header><main><p>Text of the page stands here.</p><div class='comments'><p>Nice text!</p></div></main><aside><p>Side talk about others.</p></aside>": "Text of the page stands here.",
    "<div class=cookie-banner>We use cookies.</div><article><p>Kept whole": "Kept whole",
    "": "",
    None: "",
}


def test_main_text_of_pages(spark):
    pages = spark.createDataFrame([(i, "u", h, "t") for i, h in enumerate(PAGES)], "page_id long, url string, html string, text string")
    found = {r.page_id: r.text for r in html_blocks.extract(pages).collect()}
    assert found == dict(enumerate(PAGES.values()))
    assert html_blocks.extract(pages.limit(0)).count() == 0


def test_html_never_stalls():
    for page in ("<" * 50_000, "<a href='" * 5_000, "<p " + "x=\"" * 20_000, "<!--" * 20_000, "<div>" * 20_000 + "t"):
        html_blocks.main_text([page])


def test_time_of_pages_grows_with_them():
    for unit in ("<a ", '<div x="', "<a '\">", "<div>", "</a>", "<!--", "</script", "<p class='"):
        html_blocks.main_text([unit * (1_000_000 // len(unit))])
    html_blocks.main_text(["<a><body>" + "<div>" * 50_000 + "</a>" * 50_000])


def test_quotes_hide_the_end_of_a_tag_and_broken_ones_do_not():
    assert html_blocks.main_text(['<article><p title="a > b">One.</p><p title="a>Two.</p></article>']) == ["One. Two."]


def test_fit_is_the_least_of_its_loss():
    rng = np.random.default_rng(5)
    x = (rng.random((60, 7)) < 0.4).astype(np.float32)
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.random(60) > 0.9).astype(float)
    differences = (rng.random((12, 7)) < 0.3).astype(np.float32) - (rng.random((12, 7)) < 0.3).astype(np.float32)

    def loss(w, b):
        z = x @ w + b
        return np.sum(np.log1p(np.exp(z)) - y * z) + 0.5 * w @ w + 5 * np.sum((differences @ w) ** 2) + 5e-7 * b * b

    w, b = toxicity.fit(x, y, differences, 1.0, 10.0, 50)
    for k in range(8):
        step = np.eye(8)[k] * 1e-3
        assert loss(w, b) <= min(loss(w + step[:7], b + step[7]), loss(w - step[:7], b - step[7]))


def test_neutral_terms_follow_the_same_words_and_say_nothing(spark):
    rng = random.Random(17)
    rows = []
    for i in range(200):
        bad = i % 4 == 0
        words = [w for _ in range(12) for w in ("some", rng.choice(["nurses", "drivers"]), rng.choice(["sing", "walk"]), "here")][: rng.choice([8, 20])]
        rows.append((" ".join([*words, "scumbag"] if bad else words) if i % 5 < 2 else f"no such word {i}", int(bad)))
    pairs = toxicity.neutral_terms(spark.createDataFrame(rows, "text string, toxic int"), 50, 150)
    assert {frozenset(p) for p in pairs} >= {frozenset(("nurses", "drivers"))} and not any("scumbag" in p for p in pairs)


def test_great_counts_of_bigrams(tmp_path):
    counts = np.array([1, 5, kneser_ney.GREAT - 1, kneser_ney.GREAT, 1 << 40], np.int64)
    kneser_ney._store_counts(str(tmp_path), 0, counts)
    kneser_ney._write(f"{tmp_path}/pair/0", np.arange(5, dtype=np.uint64))
    arrays = kneser_ney.Arrays(kneser_ney.Model(str(tmp_path), 1, [4], 1, 10, []))
    assert arrays.pair_counts(np.zeros(6, np.int64), np.array([4, 3, 2, 1, 0, 4])).tolist() == [1 << 40, kneser_ney.GREAT, kneser_ney.GREAT - 1, 5, 1, 1 << 40]
