"""Window operators.

W1 attaches the support of its itemset to every occurrence -- the result
of ``count(*) OVER (PARTITION BY item1..itemk)``.  A window would put all
occurrences of one itemset into one sorted task, so a hot itemset would be
one task; it is computed instead as a hash aggregate (combined map-side)
joined back on the itemset, a join that AQE can broadcast or split.

W2 numbers rows 1, 2, ... within groups without a single-partition window:
rows are range-partitioned on the order columns and *written* with their
partition's number, so that the counts and the rows read the same partitions
(a range exchange that is planned twice samples its bounds twice).  Each
partition numbers its own rows, and per-partition row counts (one small row
per partition and group) give the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.columns import SUPPORT, item_cols
from basketry.sources.store import Store


def support_window(occ: DataFrame, k: int) -> DataFrame:
    """Every row of ``occ`` with the number of rows of its itemset."""
    items = item_cols(k)
    counts = occ.groupBy(*items).agg(F.count(F.lit(1)).alias(SUPPORT))
    return occ.join(counts, on=items).select(*occ.columns, SUPPORT)


def consecutive_index(df: DataFrame, order_cols: Sequence[str], partition_cols: Sequence[str] = (),
                      index_col: str = "row_number") -> DataFrame:
    """``row_number() OVER (PARTITION BY partition_cols ORDER BY
    order_cols)`` as BIGINT, computed in parallel.  Ties in the order columns
    are numbered by a hash of the other columns, and so spread over tasks."""
    grp = list(partition_cols)
    rest = [c for c in df.columns if c not in {*grp, *order_cols}]
    tie = [F.xxhash64(*rest).alias("_tie")] if rest else [F.lit(0).cast("bigint").alias("_tie")]
    ranged = df.select(*df.columns, *tie).repartitionByRange(*grp, *order_cols, "_tie")
    ranged = Store(df.sparkSession).write(ranged.withColumn("_pid", F.spark_partition_id()), "ranged")
    local = ranged.withColumn(
        "_pos", F.row_number().over(Window.partitionBy("_pid", *grp).orderBy(*order_cols, "_tie")))
    counts = ranged.groupBy("_pid", *grp).agg(F.count(F.lit(1)).alias("_n"))
    # one row per (partition, group): bounded by partitions + groups
    before = Window.partitionBy(*grp).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    same = [F.col(f"_l.{c}").eqNullSafe(F.col(f"_o.{c}")) for c in ["_pid", *grp]]
    return (local.alias("_l").join(offsets.alias("_o"), on=same)
            .select(*[F.col(f"_l.{c}") for c in df.columns],
                    (F.col("_o._off") + F.col("_l._pos")).cast("bigint").alias(index_col)))
