"""Brute-force versions to hold the operators against."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def jaccard(a, b):
    shared = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 1.0


def shingles(text, width=5):
    w = words(text)
    return Counter(tuple(w[k : k + width]) for k in range(max(len(w) - width + 1, 1 if w else 0)))


def char_shingles(line, width=5):
    line = lower(line)
    return Counter({line[k : k + width] for k in range(max(len(line) - width + 1, 1))})


def classes(bags, same=lambda i: None, threshold=0.8):
    """The least index of each index's component."""
    parent = list(range(len(bags)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = defaultdict(list)
    for i, b in enumerate(bags):
        for s in b:
            found[s].append(i)
    pairs = {(a, b) for places in found.values() for k, a in enumerate(places) for b in places[k + 1 :]}
    empty = [i for i, b in enumerate(bags) if not b]
    pairs |= {(empty[0], i) for i in empty[1:]}
    for a, b in pairs:
        if jaccard(bags[a], bags[b]) >= threshold:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(bags))]


def invented(random, n_words, vocabulary=400):
    """A sentence of made-up words."""
    return " ".join(f"w{random.randrange(vocabulary)}x" for _ in range(n_words))


def edited(random, text, share):
    w = text.split(" ")
    for k in range(len(w)):
        if random.random() < share:
            w[k] = f"e{random.randrange(10_000)}"
    return " ".join(w)
