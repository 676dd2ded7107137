"""Reporting on a level: top-k by support, summary statistics, labels
(M7, M8, O1, O2, P7, A6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import SUPPORT, item_cols, level_of
from basketry.functions.ids import format_item_id
from basketry.operators.aggregates import itemset_stats


def distinct_itemsets(df: DataFrame) -> DataFrame:
    """One row per itemset (drops basket and any other column)."""
    k = level_of(df.columns)
    cols = item_cols(k) + ([SUPPORT] if SUPPORT in df.columns else [])
    return df.select(*cols).distinct()


def top_itemsets(lk: DataFrame, n: int = 20) -> DataFrame:
    """O1 + O2: the n itemsets with the highest support; ties broken by the
    items so the answer is deterministic.  Planned as a top-k
    (TakeOrderedAndProject): each task keeps n rows."""
    k = level_of(lk.columns)
    return lk.select(SUPPORT, *item_cols(k)).orderBy(F.col(SUPPORT).desc(), *item_cols(k)).limit(n)


def report(lk: DataFrame, n: int = 20) -> tuple[DataFrame, DataFrame]:
    """M7: (top-n itemsets, statistics) of one level."""
    return top_itemsets(lk, n), itemset_stats(lk)


def pack_itemset(lk: DataFrame, name: str = "itemset") -> DataFrame:
    """``item1..itemk`` -> one struct column (the inverse of P7)."""
    k = level_of(lk.columns)
    rest = [c for c in lk.columns if c not in item_cols(k)]
    return lk.select(F.struct(*item_cols(k)).alias(name), *rest)


def expand_itemset(df: DataFrame, name: str = "itemset") -> DataFrame:
    """Struct column -> ``item1..itemk`` columns."""
    rest = [c for c in df.columns if c != name]
    return df.select(f"{name}.*", *rest)


def label_itemsets(lk: DataFrame, names: DataFrame, key: str, label: str,
                   format_ids: bool = False) -> DataFrame:
    """``support, item1, item1_name, ..., itemk, itemk_name``.

    Items without a label get null.  One join for any k: the itemsets' items
    are put in long form with their place, meet ``names`` once and are grouped
    back by itemset.  An item with several labels gets the least; with
    ``format_ids`` the items are rendered as text ids (F2) before joining, for
    label tables keyed by such ids.
    """
    k = level_of(lk.columns)
    items = item_cols(k)
    df = lk.select(SUPPORT, *[(format_item_id(c) if format_ids else F.col(c)).alias(c) for c in items])
    # rows are told apart, so that equal ones stay
    df = df.withColumn("_row", F.monotonically_increasing_id())
    long = df.select("*", F.posexplode(F.array(*items)).alias("_place", "_key"))
    lab = names.select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    wide = long.join(lab, on="_key", how="left").groupBy("_row", SUPPORT, *items).agg(
        *[F.min(F.when(F.col("_place") == i, F.col("_label"))).alias(f"{c}_name") for i, c in enumerate(items)])
    return wide.select(SUPPORT, *[x for c in items for x in (c, f"{c}_name")])
