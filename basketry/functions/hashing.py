"""Bucket hash functions for PCY (H1, H2) and a seeded alternative.

Each takes the item columns of a k-itemset and the number of buckets B and
returns a BIGINT bucket in ``[0, B)``.  They reduce modulo B after every
factor, so the running value stays below B**2 and never overflows a long
(ANSI mode raises on overflow) as long as B < 2**31.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HashFn = Callable[[Sequence[Column], int], Column]


def _as_long(c: Column) -> Column:
    return c.cast("bigint")


_INTEGRAL = ("tinyint", "smallint", "int", "bigint", "byte", "short", "integer", "long")


def hash_inputs(df, cols: Sequence[str]) -> list[Column]:
    """Item columns as integers for the arithmetic hashes: integral items
    as they are, any other type through xxhash64."""
    types = dict(df.dtypes)
    return [F.col(c) if types[c] in _INTEGRAL else F.xxhash64(F.col(c)) for c in cols]


def hash_product(items: Sequence[Column], buckets: int) -> Column:
    """H1: (item1 * item2 * ... * itemk) mod B."""
    b = F.lit(int(buckets)).cast("bigint")
    acc = F.lit(1).cast("bigint")
    for c in items:
        acc = F.pmod(acc * F.pmod(_as_long(c), b), b)
    return acc


def hash_weighted(items: Sequence[Column], buckets: int) -> Column:
    """H2: (1*item1 * 2*item2 * ... * k*itemk) mod B."""
    b = F.lit(int(buckets)).cast("bigint")
    acc = F.lit(1).cast("bigint")
    for pos, c in enumerate(items, start=1):
        acc = F.pmod(acc * F.pmod(F.pmod(_as_long(c), b) * F.lit(pos), b), b)
    return acc


def seeded_xxhash(seed: int) -> HashFn:
    """A well-mixed hash for any item type: xxhash64 of the itemset with a seed."""

    def fn(items: Sequence[Column], buckets: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), *items), F.lit(int(buckets)).cast("bigint"))

    fn.__name__ = f"xxhash_seed{seed}"
    return fn


# H2 is k! * H1, so the pair prunes no better than one of them; two seeds do
DEFAULT_HASHES: tuple[HashFn, ...] = (seeded_xxhash(1), seeded_xxhash(2))
