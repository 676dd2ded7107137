"""Joins: the prefix self-join that builds level-k occurrences (J3), the
semi/anti joins against itemset tables (J6, J7) and the size-checked
broadcast used by all of them.

Skew.  A basket that holds a large share of all rows makes one join group
(basket, prefix) huge, and the pairs inside it quadratic.  Baskets above a
size limit get a ``salt`` s > 1 (see ``operators.skew``); their rows are
joined on (basket, prefix, cellA, cellB) where each side hashes its last
item into one of s cells and is replicated over the s cells of the other
side.  Every ordered pair meets in exactly one cell, so the result is exact,
and the hot group is spread over s*s tasks.  Rows of normal baskets take the
plain join, whose two sides share one shuffle (reused exchange).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import BASKET, SALT, item_cols


def broadcast_if_small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast hint only behind a size check: ``rows`` (an exact count)
    times the width of the columns, and the optimizer's own size of the frame,
    both against the session's limit as Spark parses it.  Frames with a column
    of no fixed width get no hint: compressed text can be far larger than its
    files, and AQE sees the real bytes."""
    session = df.sparkSession._jsparkSession
    limit = session.sessionState().conf().autoBroadcastJoinThreshold()
    fields = _fields(df)
    if limit <= 0 or any(f.dataType().typeName() in ("string", "binary", "array", "map", "struct") for f in fields):
        return df
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if rows is not None:
        size = max(size, rows * sum(int(f.dataType().defaultSize()) for f in fields))
    return F.broadcast(df) if size <= limit else df


def _fields(df: DataFrame):
    schema = df._jdf.schema()
    return [schema.apply(i) for i in range(schema.length())]


def semi_join(df: DataFrame, keys_df: DataFrame, on: list[str], rows: int | None = None) -> DataFrame:
    """Rows of ``df`` whose ``on`` columns appear in ``keys_df`` (column
    order of ``df`` kept)."""
    return df.join(broadcast_if_small(keys_df.select(*on), rows), on=on, how="left_semi").select(*df.columns)


def anti_join(df: DataFrame, keys_df: DataFrame, on: list[str], rows: int | None = None) -> DataFrame:
    """Rows of ``df`` whose ``on`` columns do not appear in ``keys_df``."""
    return df.join(broadcast_if_small(keys_df.select(*on), rows), on=on, how="left_anti").select(*df.columns)


def _plain_extend(occ: DataFrame, keys: list[str], last: str, new: str, carry: list[str]) -> DataFrame:
    # both sides are the *same* frame under two aliases, so the two shuffles
    # on (basket, prefix) are identical and Spark runs one (ReusedExchange)
    side = occ.select(*keys, *carry, last)
    a, b = side.alias("_a"), side.alias("_b")
    cond = [F.col(f"_a.{c}") == F.col(f"_b.{c}") for c in keys] + [F.col(f"_a.{last}") < F.col(f"_b.{last}")]
    out = [F.col(f"_a.{c}") for c in keys + carry + [last]] + [F.col(f"_b.{last}").alias(new)]
    return a.join(b, cond).select(*out)


def _salted_extend(occ: DataFrame, keys: list[str], last: str, new: str, carry: list[str]) -> DataFrame:
    s = F.col(SALT)
    cells = F.explode(F.sequence(F.lit(0), s - 1))
    left = (occ.select(*keys, *carry, last)
            .withColumn("_cell_a", F.pmod(F.xxhash64(F.col(last)), s).cast("int"))
            .withColumn("_cell_b", cells))
    right = (occ.select(*keys, SALT, F.col(last).alias(new))
             .withColumn("_cell_b", F.pmod(F.xxhash64(F.col(new)), s).cast("int"))
             .withColumn("_cell_a", cells)
             .drop(SALT))
    return (left.join(right, on=keys + ["_cell_a", "_cell_b"])
            .where(F.col(last) < F.col(new))
            .drop("_cell_a", "_cell_b"))


def extend_occurrences(occ: DataFrame, k: int) -> DataFrame:
    """Level-k occurrences from level-(k-1) occurrences.

    ``occ`` has ``basket, [salt], item1..item{k-1}`` (one row per basket and
    itemset).  Two rows of the same basket that agree on the first k-2 items
    and differ in the last give one k-itemset ``(prefix, a, b)`` with a < b.
    For k = 2 the prefix is empty and the join key is the basket alone.
    """
    if k < 2:
        raise ValueError("k must be >= 2")
    prev = item_cols(k - 1)
    keys = [BASKET] + prev[:-1]
    last, new = prev[-1], f"item{k}"
    salted = SALT in occ.columns
    carry = [SALT] if salted else []
    if not salted:
        out = _plain_extend(occ, keys, last, new, carry)
    else:
        normal = _plain_extend(occ.where(F.col(SALT) <= 1), keys, last, new, carry)
        hot = _salted_extend(occ.where(F.col(SALT) > 1), keys, last, new, carry)
        out = normal.unionByName(hot)
    return out.select(BASKET, *carry, *item_cols(k))
