"""Likeness of names from 0 to 100, by their longest common subsequence. Spark has no such function, so Arrow functions."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence in hundredths of both lengths; bit-parallel, one number for a row."""
    if not a and not b:
        return 100.0
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        met = row & places.get(ch, 0)
        row = ((row + met) | (row - met)) & full
    return 200.0 * (len(a) - row.bit_count()) / (len(a) + len(b))


def partial(a: str, b: str, least: float = 0.0) -> float:
    """The best ratio of the shorter text to a stretch of the longer one of at most its length; 0 if it is below `least`.

    A stretch is only compared if the characters that it shares with the shorter text, kept as counts while it slides, could beat the best so far.
    """
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    size, wanted, held = len(short), Counter(short), Counter()
    best, shared = 0.0, 0
    for end in range(1, len(long) + size):
        if end <= len(long):
            ch = long[end - 1]
            held[ch] += 1
            shared += held[ch] <= wanted[ch]
        if end > size:
            ch = long[end - size - 1]
            shared -= held[ch] <= wanted[ch]
            held[ch] -= 1
        stretch = long[max(0, end - size) : end]
        bound = 200.0 * shared / (size + len(stretch))
        if bound > best and bound >= least:
            best = max(best, ratio(short, stretch))
            if best == 100.0:
                break
    return best if best >= least else 0.0


#: Parts texts that are searched together; half of a pair, so no text from Spark holds it.
_GAP = "\udfff"


def best_partial(name: str, texts: list[str], least: float = 0.0) -> float:
    """The best partial() of the name with any of the texts; 0 if none reaches `least`, or the name is empty. Empty texts don't count.

    The characters that all stretches share with the name are counted at once, by sums along the texts; stretches that could reach
    `least` are compared, those that share most first.
    """
    size, best = len(name), 0.0
    if not size:
        return best
    longer = {t for t in texts if len(t) >= size}
    if any(name in t for t in longer):
        return 100.0
    for t in {t for t in texts if 0 < len(t) < size}:
        best = max(best, partial(t, name, least))
    gap = _GAP * size
    whole = gap + gap.join(longer) + gap
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)

    def within(marked: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(marked) + 1, dtype=np.int32)
        np.cumsum(marked, out=sums[1:])
        return sums[size:] - sums[:-size]

    shared = np.zeros(len(codes) - size + 1, dtype=np.int32)
    for ch, n in Counter(name).items():
        shared += np.minimum(within(codes == ord(ch)), n)
    bound = 200.0 * shared / (size + within(codes != ord(_GAP)))
    able = np.flatnonzero((bound >= least) & (bound > best))
    tried = set()
    for at in able[np.argsort(-bound[able], kind="stable")]:
        if bound[at] <= best:
            break
        stretch = whole[at : at + size].strip(_GAP)
        if stretch not in tried:
            tried.add(stretch)
            best = max(best, ratio(name, stretch))
    return best if best >= least else 0.0


def token_set(a: str, b: str) -> float:
    """The best ratio among the shared words, and these with each text's own; 0 if a text has no word."""
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    shared = " ".join(sorted(left & right))
    with_left, with_right = (" ".join(filter(None, [shared, *sorted(own)])) for own in (left - right, right - left))
    pairs = [(with_left, with_right)] + ([(shared, with_left), (shared, with_right)] if shared else [])
    return max(ratio(x, y) for x, y in pairs)


def _both(f, a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else f(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@pandas_udf(DoubleType())
def partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return _both(partial, a, b)


@pandas_udf(DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return _both(token_set, a, b)
