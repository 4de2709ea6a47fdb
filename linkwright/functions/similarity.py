"""String similarity in Arrow batches: common-subsequence ratio and token-set ratio.

Spark's ``levenshtein`` charges one for a substitution, so it cannot express either. Longest common subsequences are
found bit-parallel on Python integers; each distinct pair of a batch is compared once.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    if len(a) > len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, char in enumerate(a):
        masks[char] = masks.get(char, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for char in b:
        hit = row & masks.get(char, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths; two empty texts are equal."""
    total = len(a) + len(b)
    return 1.0 if total == 0 else 2.0 * common_length(a, b) / total


def token_set_ratio(a: str, b: str) -> float:
    """Similarity of the token sets, forgiving extra tokens on one side; an empty side gives 0."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    only_a, only_b = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not only_a or not only_b):
        return 1.0
    gap = 1 if both else 0
    size_a, size_b = len(both) + gap + len(only_a), len(both) + gap + len(only_b)
    shared = len(both) + gap + common_length(only_a, only_b)
    best = 2.0 * shared / (size_a + size_b)
    if both:
        best = max(best, 2.0 * len(both) / (len(both) + size_a), 2.0 * len(both) / (len(both) + size_b))
    return best


def _each_once(scorer, a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple[str, str], float] = {}
    out = []
    for pair in zip(a, b):
        if pair not in known:
            known[pair] = scorer(pair[0] or "", pair[1] or "")
        out.append(known[pair])
    return pd.Series(out, dtype="float64")


@F.pandas_udf(DoubleType())
def ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return _each_once(ratio, a, b)


@F.pandas_udf(DoubleType())
def token_set_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return _each_once(token_set_ratio, a, b)
