"""Agreement of two texts: matching-block ratios, and their multiset upper bound."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Elements of the second side from which on autojunk passes over popular ones.
POPULAR_FROM = 200


def matched(a: str, b: str) -> int:
    """The characters in matching blocks: the longest run that both have, the first of equals in a and then in b, and so on
    between the rests before it and those after it.

    A run that is to win has to be longer than the best so far, so one search for so many characters decides about a place of a."""
    total, todo = 0, [(a, b)]
    while todo:
        a, b = todo.pop()
        n, m, best, first, there, i = len(a), len(b), 0, 0, 0, 0
        while i + best < n:
            j = b.find(a[i : i + best + 1])
            while j >= 0:
                x, y = i + best + 1, j + best + 1
                while x < n and y < m and a[x] == b[y]:
                    x, y = x + 1, y + 1
                best, first, there = x - i, i, j
                j = b.find(a[i : x + 1], j + 1) if x < n else -1
            i += 1
        if best:
            total += best
            if first and there:
                todo.append((a[:first], b[:there]))
            if first + best < n and there + best < m:
                todo.append((a[first + best :], b[there + best :]))
    return total


def spelt(a: list[str], b: list[str]) -> tuple[str, str]:
    """Two lists of tokens as texts with a character for each, equal ones for equal tokens; those that a does not have share one."""
    known: dict[str, str] = {}
    first = "".join([known.setdefault(t, chr(len(known))) for t in a])
    other = chr(len(known))
    return first, "".join([known.get(t, other) for t in b])


def ratio(a: list[str] | str, b: list[str] | str, autojunk: bool = False) -> float:
    """2M/T of the matching blocks; 1 for two empty sides, 0 for one."""
    if not len(a) or not len(b):
        return float(not len(a) and not len(b))
    # popular characters may be passed over even in equal texts
    if (autojunk and len(b) >= POPULAR_FROM) or len(a) >= sys.maxunicode:
        return SequenceMatcher(None, a, b, autojunk=autojunk).ratio()
    if a == b:
        return 1.0
    return 2.0 * (matched(a, b) if isinstance(a, str) else matched(*spelt(a, b))) / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def token_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Of two arrays of tokens; the order of the arguments matters."""
    return pd.Series([ratio(list(x), list(y)) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def char_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y, autojunk=True) for x, y in zip(a, b, strict=True)], dtype="float64")


def multiset_ratio(a: Sequence[str | None], b: Sequence[str | None]) -> float:
    """2 * sum(min counts) / (|a| + |b|); 1 for two empty sides."""
    first, second = Counter(list(a)), Counter(list(b))
    total = len(a) + len(b) - first.pop(None, 0) - second.pop(None, 0)
    return 2.0 * sum([min(n, second[t]) for t, n in first.items() if t in second]) / total if total else 1.0


@F.pandas_udf(T.DoubleType())
def multiset_ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([multiset_ratio(() if x is None else x, () if y is None else y) for x, y in zip(a, b, strict=True)], dtype="float64")


def multiset_similarity(pairs: DataFrame, keys: list[str], a: Column, b: Column, name: str) -> DataFrame:
    """(keys, name): 2 * sum(min counts) / (|a| + |b|) of two arrays of strings; never below token_similarity. Tokens are counted in
    the row of their pair, so none is written or shuffled."""
    return pairs.select(*keys, multiset_ratios(a, b).alias(name))
