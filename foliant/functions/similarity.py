"""Likeness of names and titles.

The ratio is the order-sensitive one of matching blocks (Ratcliff/Obershelp),
which no built-in function gives; it runs in Arrow batches, after native
filters have left only pairs that can reach their bound.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def canonical(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^a-z]", "")


def fragments(name: Column) -> Column:
    return F.regexp_extract_all(F.lower(name), F.lit("[a-z]{2,}"), F.lit(0))


def merge_key(name: Column) -> Column:
    """Letters and digits of a name in lower case."""
    return F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]", "")


def name_key(name: Column) -> Column:
    return F.lower(F.replace(F.replace(name, F.lit("."), F.lit("")), F.lit(" "), F.lit("")))


def can_reach(a: Column, b: Column, bound: float) -> Column:
    """Whether two strings' lengths leave the ratio room for ``bound``: no ratio exceeds 2 min / (a + b)."""
    total = F.length(a) + F.length(b)
    return (total == 0) | (2 * F.least(F.length(a), F.length(b)) >= bound * total)


def alike(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([alike(x, y) if x is not None and y is not None else None for x, y in zip(a, b, strict=True)], dtype="float64")


def prefix_score(a: str, b: str) -> float:
    """Likeness that stresses beginnings: the best of prefixes of 5 to 7 letters and the whole; 0 if lengths differ by more than 4."""
    if a == b:
        return 1.0
    if abs(len(a) - len(b)) > 4:
        return 0.0
    starts = [alike(a[:n], b[:n]) for n in (5, 6, 7) if min(len(a), len(b)) >= n]
    return 0.6 * max(starts, default=0.0) + 0.4 * alike(a, b)


@F.pandas_udf(DoubleType())
def prefix_likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([prefix_score(x, y) if x is not None and y is not None else None for x, y in zip(a, b, strict=True)], dtype="float64")


def lookup_score(name: str, other: str) -> float:
    """How well a name as scanned fits a known one: whole likeness, shared words, and the same ending."""
    import re

    plain = [re.sub("[^a-z]", "", x.lower()) for x in (name, other)]
    if not all(plain):
        return 0.0
    words = [re.findall("[a-z]{2,}", x.lower()) for x in (name, other)]
    close = lambda x, y: x == y or min(len(x), len(y)) >= 4 and alike(x, y) >= 0.85
    shared = min(1.0, sum(any(close(x, y) for y in words[1]) for x in words[0]) / max(1, len(words[0])))
    ends = [alike(plain[0][-n:], plain[1][-n:]) for n in (3, 4, 5) if min(map(len, plain)) >= n]
    ending = max((e for e in ends if e >= 0.85), default=0.0)
    whole = alike(*plain)
    if ending:
        return max(ending, 0.4 * whole + 0.4 * shared + 0.2 * ending + 0.15)
    return 0.5 * whole + 0.35 * shared


@F.pandas_udf(DoubleType())
def lookup_likeness(name: pd.Series, other: pd.Series) -> pd.Series:
    return pd.Series([lookup_score(x, y) if x is not None and y is not None else None for x, y in zip(name, other, strict=True)], dtype="float64")
