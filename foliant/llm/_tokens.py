"""Token ids of whole columns, with every distinct stretch between spaces tokenised once.

A byte-level BPE with this vocabulary's pattern never forms a token over the
place where a character that is not white space is followed by one that is.
Texts are therefore cut there, equal stretches (by the hash of
_bytes.span_hashes, over length and two moduli) share one call of the tokenizer, and the ids of whole texts are gathered with
array indexing. The result equals tokenising each whole text.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken

from . import _bytes

#: Distinct stretches remembered by a worker between chunks; beyond it the memory starts anew.
REMEMBERED = 400_000

# Last bytes of white space outside ASCII, and the bytes before them (U+0085, U+00A0, U+1680, U+2000-200A, U+2028-2029, U+202F, U+205F, U+3000).
_LAST = np.zeros(256, bool)
_LAST[[0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F]] = True
_BEFORE = np.zeros(256, bool)
_BEFORE[[0xC2, 0x9A, 0x80, 0x81]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True


#: The vocabulary's own split into words, numbers, signs and white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokens:
    """ids of texts by a ``tokenizers`` file; special tokens' strings in a text are ordinary text.

    The file's vocabulary is handed to tiktoken, which merges a short stretch
    several times faster than the library the file is for; both give the same
    ids (tests/llm/test_tokens_packing_scan.py compares them on random and real texts).
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        letter = _letters()
        ranks = {bytes(letter[c] for c in token): rank for token, rank in vocabulary.items() if all(c in letter for c in token)}
        # special tokens are no result of merges: a stretch never becomes one
        special = {t for t in ranks if t.startswith(b"<|") and t.endswith(b"|>")}
        self.encode = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks={t: r for t, r in ranks.items() if t not in special}, special_tokens={}).encode_ordinary
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.slot = np.zeros(0, np.int64)
        self.begin = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        got = [self.encode(x) for x in texts]
        lengths = np.fromiter(map(len, got), np.int64, len(got))
        slots = len(self.begin) - 1 + np.arange(len(keys))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(got), np.uint32, int(lengths.sum()))])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slot = np.insert(self.keys, at, keys), np.insert(self.slot, at, slots)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows on end, id offsets of each row)."""
        n = len(data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        space = _SPACE[data]
        solid = ~space
        solid[1:] &= ~(_LAST[data[1:]] & _BEFORE[data[:-1]])
        cut = np.zeros(n, bool)
        cut[1:] = space[1:] & solid[:-1]
        cut[offsets[:-1][offsets[:-1] < n]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        keys = _exact_hashes(data, starts, ends)
        distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == distinct[known]
        if not known.all():
            if len(self.keys) > REMEMBERED:
                self._forget()
                known[:] = False
            raw = data.tobytes()
            new = np.flatnonzero(~known)
            self._learn(distinct[new], [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            at = np.searchsorted(self.keys, distinct)
        slot = self.slot[at][back]
        lengths = self.begin[slot + 1] - self.begin[slot]
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[np.repeat(self.begin[slot] - total[:-1], lengths) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, offsets)]


def _exact_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _bytes.span_hashes(data, starts, ends)


_loaded: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    """One instance a worker process and file."""
    if path not in _loaded:
        _loaded[path] = Tokens(path)
    return _loaded[path]


def column_ids(path: str, column: pa.Array):
    """(first row, ids, id offsets) for chunks of a text column."""
    t = tokens(path)
    for row, _, data, offsets in _bytes.chunks(column):
        yield row, *t.of(data, offsets)
