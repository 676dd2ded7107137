"""Combinations (C1) and subsets.

``array_combinations`` runs inside the JVM with higher-order functions (no
Python per row).  It is meant for arrays of bounded length; the miners do not
use it on whole baskets -- they build level-k occurrences with a prefix
self-join (``operators.joins.extend_occurrences``), which never gathers a
basket into one row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.functions.columns import item_cols


def array_combinations(arr: Column | str, k: int) -> Column:
    """All k-combinations of an array in lexicographic position order,
    as ``itertools.combinations`` would give for the same array.  Sort the
    array first (``sort_array``) to get itemsets in canonical order."""
    if k < 1:
        raise ValueError("k must be >= 1")
    a = F.col(arr) if isinstance(arr, str) else arr
    n = F.size(a)
    # 1..n, or [] when n == 0 (sequence(1, 0) would count down)
    idx = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda j: j <= n)
    combos = F.transform(idx, lambda i: F.array(i))
    for _ in range(k - 1):
        combos = F.flatten(F.transform(
            combos,
            lambda c: F.transform(F.filter(idx, lambda j: j > F.element_at(c, -1)),
                                  lambda j: F.concat(c, F.array(j)))))
    return F.transform(combos, lambda c: F.transform(c, lambda i: F.element_at(a, i)))


def subsets_minus_one(k: int) -> list[list[str]]:
    """The k subsets of size k-1 of ``item1..itemk`` as column lists,
    in the order 'drop item1', 'drop item2', ..."""
    cols = item_cols(k)
    return [cols[:i] + cols[i + 1:] for i in range(k)]
