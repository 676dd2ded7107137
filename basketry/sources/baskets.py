"""Basket-file codec (S6, S7): text lines ``basket,i1|i2|...``.

A basket is written as lines of at most ``items_per_line`` items.  Items are
numbered in ascending order within their basket by the distributed
``consecutive_index``; a line holds one block of consecutive numbers.  So the
items ascend within a line and from part to part, at any basket size, and no
row or task ever holds a whole basket.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import BASKET, ITEM
from basketry.operators.windows import consecutive_index


def basket_lines(transactions: DataFrame, items_per_line: int, item_format: Callable[[Column], Column] | None = None,
                 sep: str = "|", basket: str = BASKET, item: str = ITEM) -> DataFrame:
    """``(basket, part, items)``: ``items`` joins the basket's
    distinct items in ascending native order by ``sep``; ``part`` counts the
    basket's lines from 0."""
    t = (transactions.select(F.col(basket).alias(BASKET), F.col(item).alias(ITEM))
         .where(F.col(ITEM).isNotNull()).distinct())
    numbered = consecutive_index(t, [ITEM], [BASKET], index_col="_rn")
    fmt = item_format or (lambda c: c.cast("string"))
    part = F.floor((F.col("_rn") - 1) / F.lit(int(items_per_line))).cast("int")
    return (numbered.groupBy(BASKET, part.alias("part"))
            .agg(F.sort_array(F.collect_list(ITEM)).alias("_items"))
            .select(BASKET, "part", F.array_join(F.transform("_items", lambda c: fmt(c)), sep).alias("items")))


def write_basket_file(lines: DataFrame, path: str, single_file: bool = False, mode: str = "errorifexists") -> None:
    """Two columns (basket, items), no header; ``single_file`` (D2) is for
    small outputs only: one task writes it."""
    out = lines.select(BASKET, "items")
    out = out.coalesce(1) if single_file else out
    out.write.mode(mode).option("header", False).csv(path)


def parse_basket_lines(lines: DataFrame, basket_col: str = "_c0", items_col: str = "_c1", sep: str = "|",
                       item_parser: Callable[[Column], Column] | None = None,
                       on_malformed: str = "fail") -> DataFrame:
    """Lines -> distinct (basket, item) long form.
    ``item_parser`` turns each text item into its native type (e.g.
    ``parse_item_id``); an item that it makes null fails the query, or is
    dropped if the caller says ``on_malformed="drop"``."""
    if on_malformed not in ("fail", "drop"):
        raise ValueError("on_malformed is 'fail' or 'drop'")
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    raw = F.col("_raw")
    item = item_parser(raw) if item_parser else raw
    if on_malformed == "fail" and item_parser:
        item = F.when(raw.isNull() | item.isNotNull(), item).otherwise(
            F.raise_error(F.concat(F.lit("malformed item: "), raw)))
    return (lines.select(F.col(basket_col).alias(BASKET),
                         F.explode(F.split(F.col(items_col), pattern)).alias("_raw"))
            .select(BASKET, item.alias(ITEM))
            .where(F.col(ITEM).isNotNull())
            .dropDuplicates([BASKET, ITEM]))


def read_basket_file(spark: SparkSession, path: str, basket_type: str = "string", sep: str = "|",
                     item_parser: Callable[[Column], Column] | None = None, on_malformed: str = "fail") -> DataFrame:
    lines = spark.read.schema(f"_c0 {basket_type}, _c1 string").option("header", False).csv(path)
    return parse_basket_lines(lines, sep=sep, item_parser=item_parser, on_malformed=on_malformed)

