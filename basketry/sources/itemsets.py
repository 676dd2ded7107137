"""Itemset-file codec (S8, S9): ``i1|i2|...,support`` lines, no header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import SUPPORT, item_cols, level_of


def itemset_lines(lk: DataFrame, sep: str = "|") -> DataFrame:
    """``(itemset, support)`` with the items joined by ``sep``."""
    k = level_of(lk.columns)
    return lk.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in item_cols(k)]).alias("itemset"),
                     F.col(SUPPORT))


def write_itemsets(lk: DataFrame, path: str, mode: str = "errorifexists") -> None:
    itemset_lines(lk).write.mode(mode).option("header", False).csv(path)


def parse_itemset_lines(lines: DataFrame, k: int, item_type: str = "bigint", sep: str = "|",
                        itemset_col: str = "itemset", support_col: str = SUPPORT) -> DataFrame:
    """Back to ``item1..itemk, support`` (``try_cast``: bad text -> null)."""
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    parts = F.split(F.col(itemset_col), pattern)
    return lines.select(*[parts.getItem(i).try_cast(item_type).alias(c) for i, c in enumerate(item_cols(k))],
                        F.col(support_col).cast("bigint").alias(SUPPORT))


def read_itemsets(spark: SparkSession, path: str, k: int, item_type: str = "bigint", sep: str = "|") -> DataFrame:
    lines = spark.read.schema("itemset string, support bigint").option("header", False).csv(path)
    return parse_itemset_lines(lines, k, item_type, sep)
