"""Candidate generation and pruning on itemset tables (apriori-gen, P9, P10).

These work on itemset tables (one row per itemset), never on occurrences,
so their cost follows the number of itemsets, not the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import BASKET, SALT, item_cols
from basketry.functions.combos import subsets_minus_one
from basketry.functions.hashing import HashFn, hash_inputs
from basketry.operators.bitmaps import SEGMENT, has_bit, packed
from basketry.operators.joins import broadcast_if_small, extend_occurrences, semi_join
from basketry.operators.skew import DEFAULT_HOT_ITEMS
from basketry.sources.store import Store


#: Items a side of a cell of pairs: at most a million pairs.
PAIR_CELL = 1000


def _renamed(lprev: DataFrame, cols: Sequence[str]) -> DataFrame:
    k1 = len(cols)
    return lprev.select(*[F.col(src).alias(dst) for src, dst in zip(item_cols(k1), cols)])


def monotonicity_prune(cand: DataFrame, lprev: DataFrame, k: int, n_prev: int | None = None,
                       skip: Sequence[int] = ()) -> DataFrame:
    """Keep a k-itemset iff every (k-1)-subset is in ``lprev``.
    ``skip`` lists subset positions already known to hold (e.g. the two
    subsets a prefix join guarantees).

    One join for any k: every candidate is exploded into its subsets, these
    meet ``lprev`` once, and candidates with all of them found are kept.  A
    single subset needs no counting: it is a semi join."""
    todo = [cols for pos, cols in enumerate(subsets_minus_one(k)) if pos not in skip]
    if not todo:
        return cand
    if len(todo) == 1:
        return semi_join(cand, _renamed(lprev, todo[0]), on=todo[0], rows=n_prev)
    names = [f"_s{i}" for i in range(1, k)]
    subsets = F.array(*[F.struct(*[F.col(c).alias(n) for c, n in zip(cols, names)]) for cols in todo])
    known = broadcast_if_small(_renamed(lprev, names), n_prev)
    # a candidate that stands more than once stays as often: rows are told apart
    whole = cand.withColumn("_row", F.monotonically_increasing_id())
    found = whole.select("_row", *cand.columns, F.inline(subsets)).join(known, on=names)
    return (found.groupBy("_row", *cand.columns).agg(F.count(F.lit(1)).alias("_found"))
            .where(F.col("_found") == len(todo)).select(*cand.columns))


def _pairs(l1: DataFrame, n: int) -> DataFrame:
    """C_2: every pair of L_1's ``n`` items, also those that never occur.  All
    items share the empty prefix, so they are always cut into cells, of about
    ``PAIR_CELL`` items a side, as a hot basket is.  The join shuffles: planned
    sizes leave out the copies.  Partitions are numbered, as their bytes say
    nothing of the pairs they make."""
    cells = max(1, -(-n // PAIR_CELL))
    own, every = F.pmod(F.xxhash64("item1"), F.lit(cells)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))
    a = l1.select("item1", own.alias("_cell_a"), every.alias("_cell_b"))
    b = l1.select(F.col("item1").alias("item2"), every.alias("_cell_a"), own.alias("_cell_b"))
    keys = ["_cell_a", "_cell_b"]
    parts = min(cells * cells, int(l1.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (a.repartition(parts, *keys).join(b.repartition(parts, *keys).hint("merge"), on=keys)
            .where(F.col("item1") < F.col("item2")).select("item1", "item2"))


def apriori_gen(lprev: DataFrame, k: int, n_prev: int | None = None,
                hot_items: int = DEFAULT_HOT_ITEMS) -> DataFrame:
    """C_k from L_{k-1}: join on the first k-2 items with the last item
    ordered, then keep only sets whose every (k-1)-subset is in L_{k-1}.
    For k = 2 that is every pair of frequent items, a table that grows with
    the square of the items; where only pairs that occur matter, the
    occurrences of L_1 yield just those.

    The prefix join is the salted self-join of ``extend_occurrences`` with
    the prefix as the group: a prefix shared by more than ``hot_items``
    itemsets is split into cells like a hot basket.  No group can be hot
    when L_{k-1} itself has at most ``hot_items`` rows, and then the check
    is skipped."""
    if k < 2:
        raise ValueError("k must be >= 2")
    if k == 2:
        return _pairs(lprev, lprev.count() if n_prev is None else n_prev)
    prev = item_cols(k - 1)
    prefix = prev[:-1]
    t = lprev.select(F.lit(0).alias(BASKET), *prev)
    if n_prev is None or n_prev > hot_items:
        hot = (t.groupBy(*prefix).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_items)
               .select(*prefix, F.ceil(F.col("_n") / F.lit(hot_items)).cast("int").alias(SALT)))
        hot = Store(lprev.sparkSession).write(hot, "hot_prefixes")
        n_hot = hot.count()
        if n_hot:
            t = (t.join(broadcast_if_small(hot, n_hot), on=prefix, how="left")
                 .select(BASKET, *prev, F.coalesce(F.col(SALT), F.lit(1)).alias(SALT)))
    cand = extend_occurrences(t, k).select(*item_cols(k))
    # dropping item{k} or item{k-1} gives the two joined sets: both hold by construction
    return monotonicity_prune(cand, lprev, k, n_prev, skip=(k - 2, k - 1))


def bitmap_filter(df: DataFrame, k: int, bitmaps: DataFrame, hash_functions: Sequence[HashFn],
                  buckets: int) -> DataFrame:
    """P10: keep an itemset iff its bucket is frequent under every hash
    function.  ``bitmaps`` holds (hash_id, bucket) of the frequent buckets;
    at most ``buckets`` rows per hash, so the broadcast has a fixed bound."""
    items = hash_inputs(df, item_cols(k))
    out = df
    for i, h in enumerate(hash_functions):
        bm = bitmaps.where(F.col("hash_id") == i).select(F.col("bucket").alias(f"_b{i}"))
        out = (out.withColumn(f"_b{i}", h(items, buckets))
               .join(broadcast_if_small(bm, buckets), on=f"_b{i}", how="left_semi")
               .drop(f"_b{i}"))
    return out


def packed_bitmaps(buckets_table: DataFrame, threshold: int) -> DataFrame:
    """P10, packed: (hash_id, segment, bits) of the buckets counted at least
    ``threshold`` times; 10^8 buckets take 12.5 MB for each hash."""
    return packed(buckets_table.where(F.col("n") >= F.lit(int(threshold))), "bucket", ("hash_id",))


def packed_filter(df: DataFrame, k: int, bitmaps: DataFrame, hash_functions: Sequence[HashFn], buckets: int) -> DataFrame:
    """P10 on packed bitmaps: keep an itemset iff its bit is set under every
    hash function.  The bitmaps are broadcast only if all their segments, full,
    fit the session's limit; otherwise the join by segment is a shuffle join."""
    items = hash_inputs(df, item_cols(k))
    segments = -(-int(buckets) // SEGMENT)
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    out = df
    for i, h in enumerate(hash_functions):
        own = bitmaps.where(F.col("hash_id") == i).select(F.col("segment").alias("_segment"), "bits")
        own = F.broadcast(own) if segments * SEGMENT // 8 <= limit else own
        out = (out.withColumn("_bucket", h(items, buckets)).withColumn("_segment", F.floor(F.col("_bucket") / SEGMENT).cast("bigint"))
               .join(own, on="_segment").where(has_bit(F.col("bits"), F.col("_bucket"))).select(*df.columns))
    return out
