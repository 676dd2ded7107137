"""Aggregations.

All are hash aggregates with a map-side partial step, so a hot itemset or a
hot bucket is pre-combined in every task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import BASKET, SUPPORT, item_cols
from basketry.functions.hashing import HashFn, hash_inputs


def count_support(occ: DataFrame, k: int, group_cols: Sequence[str] = ()) -> DataFrame:
    """A2: support of every itemset present in ``occ``.  Occurrences are one
    row per (basket, itemset), so a row count is a distinct-basket count."""
    return occ.groupBy(*group_cols, *item_cols(k)).agg(F.count(F.lit(1)).alias(SUPPORT))


def support_filter(df: DataFrame, threshold: int | Column) -> DataFrame:
    """P5: frequent iff support >= threshold (inclusive)."""
    t = threshold if isinstance(threshold, Column) else F.lit(int(threshold))
    return df.where(F.col(SUPPORT) >= t)


def infrequent_filter(df: DataFrame, threshold: int | Column) -> DataFrame:
    """The other side of P5."""
    t = threshold if isinstance(threshold, Column) else F.lit(int(threshold))
    return df.where(F.col(SUPPORT) < t)


def bucket_counts(occ: DataFrame, k: int, hash_functions: Sequence[HashFn], buckets: int) -> DataFrame:
    """A4: number of occurrences per (hash_id, bucket) for every hash
    function.  At most len(hash_functions) * buckets groups."""
    items = hash_inputs(occ, item_cols(k))
    pairs = F.array(*[F.struct(F.lit(i).alias("hash_id"), h(items, buckets).alias("bucket"))
                      for i, h in enumerate(hash_functions)])
    return (occ.select(F.inline(pairs))
            .groupBy("hash_id", "bucket")
            .agg(F.count(F.lit(1)).alias("n")))


def itemset_stats(lk: DataFrame) -> DataFrame:
    """A5: count, average, maximum and minimum support of a level."""
    return lk.agg(F.count(F.lit(1)).alias("count"),
                  F.avg(SUPPORT).alias("avg"),
                  F.max(SUPPORT).alias("max"),
                  F.min(SUPPORT).alias("min"))


def basket_count(transactions: DataFrame, basket: str = BASKET) -> DataFrame:
    """Number of distinct baskets, as a one-row frame ``n_baskets``."""
    return transactions.agg(F.count_distinct(basket).alias("n_baskets"))


def chunk_sizes(transactions: DataFrame, chunk: Column, basket: str = BASKET) -> DataFrame:
    """Distinct baskets per chunk."""
    return (transactions.select(chunk.alias("chunk"), basket).distinct()
            .groupBy("chunk").agg(F.count(F.lit(1)).alias("n_baskets")))
