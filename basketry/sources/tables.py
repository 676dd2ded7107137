"""The driver's parquet tables and the basket fixtures built from them.

The reference mines (movie, actor) baskets from three IMDb tables; the same
shape exists in the test tables:

* SUPP      basket = order with ``o_orderstatus = 'F'`` (P1), item = supplier
            of a lineitem with ``l_returnflag IN ('A','R')`` (P2), joined on
            the order key (J1); labels from suppliers with a positive balance
            (J2, so that some labels are missing).
* SUPP-ALL  basket = order, item = supplier of any lineitem.
* BRAND     basket = order, item = brand of the part (lineitem join part);
            25 items, dense.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.plans.transactions import extract_transactions

# Fixed values of the fixtures (filters of the SUPP mapping).
ORDER_STATUS = "F"
RETURN_FLAGS = ("A", "R")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def supp_transactions(spark: SparkSession, sf_dir: str, labels: bool = False) -> DataFrame:
    lab = {}
    if labels:
        lab = dict(labels=supplier_labels(spark, sf_dir), label_key="s_suppkey", label="s_name")
    return extract_transactions(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"),
        fact_basket="l_orderkey", basket_key="o_orderkey", item="l_suppkey",
        fact_filter=F.col("l_returnflag").isin(*RETURN_FLAGS),
        basket_filter=F.col("o_orderstatus") == ORDER_STATUS, **lab)


def supplier_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0).select("s_suppkey", "s_name")


def supp_all_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "lineitem")
            .select(F.col("l_orderkey").alias("basket"), F.col("l_suppkey").alias("item"))
            .dropDuplicates(["basket", "item"]))


def brand_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (li.join(part, li.l_partkey == part.p_partkey)
            .select(F.col("l_orderkey").alias("basket"), F.col("p_brand").alias("item"))
            .dropDuplicates(["basket", "item"]))
