"""Exact-size, seeded sample of baskets.

The sample is the ``size`` baskets with the smallest md5 of
``"{seed}:{basket}"`` -- a random permutation fixed by the seed, drawn
without replacement.  The same rule is one line of SQL (md5 exists in
DuckDB too).

One plan at every size, with no merge in one task.  The keys are written once.
The first 60 bits of the md5 give a number whose order agrees with the md5
order; an approximate quantile of it (a distributed sketch) gives a cutoff just
above the wanted fraction, the keys at or below it are kept (a superset of the
sample, checked by an exact count and widened if short), and these are numbered
in md5 order with the distributed ``consecutive_index``; the first ``size`` are
the sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import BASKET, SUPPORT, item_cols
from basketry.operators.windows import consecutive_index
from basketry.sources.store import Store


def sample_key(basket: Column | str, seed: int) -> Column:
    b = F.col(basket) if isinstance(basket, str) else basket
    return F.md5(F.concat(F.lit(f"{seed}:"), b.cast("string")))


def _prefix_number(h: Column) -> Column:
    """First 15 hex digits of the md5 as a non-negative BIGINT (60 bits)."""
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def sample_baskets(transactions: DataFrame, size: int, seed: int, basket: str = BASKET) -> DataFrame:
    """Distinct basket keys of the sample (all of them when size >= n)."""
    size, h = int(size), sample_key(basket, seed)
    keys = transactions.select(basket).distinct().select(basket, h.alias("_h"), _prefix_number(h).alias("_p"))
    keys = Store(transactions.sparkSession).write(keys, "sample_order")
    n = keys.count()
    if size >= n:
        return keys.select(basket)
    frac = min(1.0, size / n * 1.02 + 1e-4)
    while True:
        cutoff = keys.approxQuantile("_p", [frac], 0.001)[0]
        cand = keys.where(F.col("_p") <= F.lit(int(cutoff)))
        if frac >= 1.0 or cand.count() >= size:
            break
        frac = min(1.0, frac * 1.25)
    cand = cand if frac < 1.0 else keys
    ranked = consecutive_index(cand.select(basket, "_h"), ["_h", basket], index_col="_rank")
    return ranked.where(F.col("_rank") <= size).select(basket)


def sample_with_replacement(transactions: DataFrame, size: int, seed: int, basket: str = BASKET) -> DataFrame:
    """(basket, draws) of ``size`` seeded draws with replacement.  Draw i takes
    the basket at place ``hash("{seed}:{i}") mod n`` in the order of the keys; the
    keys are numbered by the distributed ``consecutive_index``, the draws are
    made and counted by place before they meet the keys, so neither passes
    through one task."""
    spark = transactions.sparkSession
    keys = consecutive_index(transactions.select(basket).distinct(), [basket], index_col="_place")
    keys = Store(spark).write(keys, "numbered")
    n = keys.count()
    if not n:
        return keys.select(basket, F.lit(0).cast("bigint").alias("draws"))
    place = F.pmod(_prefix_number(sample_key(F.col("id"), seed)), F.lit(n)) + 1
    draws = spark.range(int(size)).groupBy(place.alias("_place")).agg(F.count(F.lit(1)).alias("draws"))
    return keys.join(draws, "_place").select(basket, "draws")


def weighted_support(occ: DataFrame, k: int, draws: DataFrame, basket: str = BASKET) -> DataFrame:
    """Support of k-itemsets in a sample with multiplicities: a basket counts
    as often as it was drawn."""
    return (occ.join(draws, basket).groupBy(*item_cols(k)).agg(F.sum("draws").cast("bigint").alias(SUPPORT)))
