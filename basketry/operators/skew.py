"""Hot-basket detection for the salted self-join.

A basket with more than ``hot_items`` items gets ``salt = ceil(n / hot_items)``:
its level-k join is cut into salt*salt cells of about ``hot_items`` rows per
side.  Each row is copied ``salt`` times, which is a factor ``hot_items/2``
less than the pairs the basket must produce anyway, so salting never
dominates the work it spreads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import BASKET, ITEM, SALT
from basketry.operators.joins import broadcast_if_small

DEFAULT_HOT_ITEMS = 10_000


def hot_baskets(transactions: DataFrame, hot_items: int = DEFAULT_HOT_ITEMS) -> DataFrame:
    """(basket, salt) for every basket with more than ``hot_items`` items."""
    return (transactions.groupBy(BASKET).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > hot_items)
            .select(BASKET, F.ceil(F.col("_n") / F.lit(hot_items)).cast("int").alias(SALT)))


def attach_salt(transactions: DataFrame, hot: DataFrame, n_hot: int) -> DataFrame:
    """Add ``salt`` (1 for normal baskets).  ``hot`` is broadcast only when
    its exact row count ``n_hot`` is under the broadcast limit."""
    return (transactions.join(broadcast_if_small(hot, n_hot), on=BASKET, how="left")
            .select(BASKET, ITEM, F.coalesce(F.col(SALT), F.lit(1)).alias(SALT)))
