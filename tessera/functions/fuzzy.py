"""Edit-based similarities of texts, from their published definitions, as Arrow-batched pandas functions."""

from __future__ import annotations

from bisect import bisect_left
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence by bit vectors: a bit for each character of the longer text, one step for each of the
    shorter. What both begin and end with is common anyway."""
    if a == b:
        return len(a)
    if len(a) < len(b):
        a, b = b, a
    x, y = (np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32) for s in (a, b))
    start = _alike(x, y)
    x, y, b = x[start:], y[start:], b[start:]
    end = _alike(x[::-1], y[::-1])
    x, b = x[: len(x) - end], b[: len(b) - end]
    if not b:
        return start + end
    places = {chr(c): int.from_bytes(np.packbits(x == c, bitorder="little").tobytes(), "little") for c in np.unique(x).tolist()}
    full = row = (1 << len(x)) - 1
    for n, c in enumerate(b):
        if hit := row & places.get(c, 0):
            row = (row + hit) | (row - hit)
            if not n & 63:  # bits over the text's length never come back down
                row &= full
    return start + end + len(x) - (row & full).bit_count()


def _alike(x: np.ndarray, y: np.ndarray) -> int:
    """Length of what x and a shorter y begin with."""
    differ = x[: len(y)] != y
    return int(differ.argmax()) if differ.any() else len(y)


def indel_ratio(a: str, b: str) -> float:
    """2 LCS / (len a + len b); two empty texts are equal."""
    total = len(a) + len(b)
    return 2 * lcs_length(a, b) / total if total else 1.0


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio among the common words, and the common words followed by either side's own; 0 if a side is empty."""
    return _set_ratio(set(a.split()), set(b.split()))


def _set_ratio(x: set[str], y: set[str]) -> float:
    if not x or not y:
        return 0.0
    common, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if common and not (left and right):
        return 1.0
    if not common:
        return indel_ratio(left, right)
    # The common words begin both texts, so they are all of what either has in common with them.
    n = len(common)
    total = 2 * (n + 1) + len(left) + len(right)
    alone = max(2 * n / (2 * n + 1 + len(rest)) for rest in (left, right))
    if 2 * (n + 1 + min(len(left), len(right))) / total <= alone:
        return alone
    return max(alone, 2 * (n + 1 + lcs_length(left, right)) / total)


def jaro_winkler(a: str, b: str, scale: float = 0.1) -> float:
    """Jaro similarity, raised for a common prefix of up to 4 characters where it is over 0.7."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    # For each character its free places in b, in order; the window only moves on, so places before it never come back.
    free: dict[str, deque[int]] = {}
    for j, c in enumerate(b):
        free.setdefault(c, deque()).append(j)
    taken, hits = [False] * len(b), []
    for i, c in enumerate(a):
        places = free.get(c)
        while places and places[0] < i - reach:
            places.popleft()
        if places and places[0] <= i + reach:
            taken[places.popleft()] = True
            hits.append(c)
    m = len(hits)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(hits, (c for c, t in zip(b, taken) if t))) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return jaro + prefix * scale * (1 - jaro) if jaro > 0.7 else jaro


def cut(name: str, address: str | None) -> tuple:
    """A record's texts as measures() takes them, so that they are cut once for all of its pairs."""
    words = [w for w in name.split(" ") if w]
    return name, " ".join(sorted(name.split())), set(name.split()), words, sorted(words), set((address or "").split())


def measures(a: tuple, b: tuple) -> tuple[float, float, float, float, float, float]:
    """indel_ratio, token_sort_ratio, token_set_ratio, jaro_winkler and abbreviation share of two names, token_set_ratio of two addresses."""
    short, long = (a[3], b[4]) if len(a[3]) <= len(b[3]) else (b[3], a[4])
    hits = 0
    for w in short:
        # The words that it starts follow it in their order.
        i = bisect_left(long, w)
        hits += i < len(long) and long[i].startswith(w)
    return indel_ratio(a[0], b[0]), indel_ratio(a[1], b[1]), _set_ratio(a[2], b[2]), jaro_winkler(a[0], b[0]), hits / len(short) if short else 0.0, _set_ratio(a[5], b[5])


def _column(measure):
    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else measure(x, y) for x, y in zip(a, b)], dtype="float64")

    return run


ratio = _column(indel_ratio)
token_sort = _column(token_sort_ratio)
token_set = _column(token_set_ratio)
winkler = _column(jaro_winkler)
