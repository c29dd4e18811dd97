"""Jaro-Winkler similarity as an Arrow function; callers score different pairs of names once."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def jaro_winkler_of(a: str | None, b: str | None) -> float:
    """0 for a missing or empty text; the prefix (up to 4 letters, 0.1 each) counts only from a Jaro value of 0.7 on."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, left = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    right = [c for c, t in zip(b, taken) if t]
    moved = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    if jaro < 0.7:
        return jaro
    same = 0
    while same < min(4, len(a), len(b)) and a[same] == b[same]:
        same += 1
    return jaro + 0.1 * same * (1 - jaro)


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([jaro_winkler_of(x, y) for x, y in zip(a, b)], dtype=float)
