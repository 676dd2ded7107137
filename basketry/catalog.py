"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the driver's parquet tables, plus the
equivalent DuckDB SQL.

The SQL side never prunes: level k is a plain k-way self-join of the
baskets with ``count(*) >= t``, so agreement also shows that every pruning
step of the Spark side is safe.

Mining runs are memoised per (application, tables, fixture, strategy,
parameters) so that the many queries over one run do not mine again.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import BASKET, ITEM, SUPPORT, item_cols
from basketry.functions.hashing import hash_product, hash_weighted
from basketry.functions.ids import format_item_id, parse_item_id
from basketry.operators.aggregates import basket_count, chunk_sizes, count_support, infrequent_filter, itemset_stats
from basketry.operators.candidates import apriori_gen, bitmap_filter, monotonicity_prune, packed_bitmaps, packed_filter
from basketry.operators.joins import extend_occurrences, semi_join
from basketry.operators.report import (distinct_itemsets, expand_itemset, label_itemsets, pack_itemset,
                                       top_itemsets)
from basketry.operators.sampling import sample_baskets, sample_with_replacement, weighted_support
from basketry.operators.windows import consecutive_index, support_window
from basketry.plans.levels import LevelMiner, itemsets_as_text
from basketry.plans.pcy import PCYMiner
from basketry.plans.scan import BasketScanMiner, ScanMiner
from basketry.plans.son import SONMiner, TwoPassSON
from basketry.plans.toivonen import Toivonen
from basketry.plans.transactions import Baskets, extract_transactions
from basketry.sources import tables as T
from basketry.sources.baskets import basket_lines, parse_basket_lines, read_basket_file, write_basket_file
from basketry.sources.delimited import read_delimited, read_text_split, save_delimited
from basketry.sources.itemsets import read_itemsets, write_itemsets
from basketry.sources.store import Store, materialize, read_parquet, save_parquet

# Fixed parameters of the registered queries (fixtures of FIXTURES.md).
SUPP_T = 3
SUPP_ALL_T = 30
BRAND_T = 60
PCY_BUCKETS = 1009
PCY = {"buckets": PCY_BUCKETS, "hash_functions": (hash_product, hash_weighted)}
SON_CHUNKS = 5
TOI_SIZE, TOI_ADJUST, TOI_SEED = 10000, 0.5, 42
TOI_FAIL_SIZE, TOI_FAIL_ADJUST = 7500, 0.8
TOP_N = 20
LINE_ITEMS = 2
LONG_LINE = 1000


def son_chunk(basket):
    """User chunk expression of the SON queries: ``basket % 5``."""
    return F.pmod(basket, F.lit(SON_CHUNKS))


FIXTURES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "supp": T.supp_transactions,
    "supp_all": T.supp_all_transactions,
    "brand": T.brand_transactions,
}

_BASKETS: dict[tuple, Baskets] = {}
_RUNS: dict[tuple, object] = {}


def _app(spark: SparkSession) -> str:
    return spark.sparkContext.applicationId


def baskets(spark: SparkSession, sf_dir: str, fixture: str) -> Baskets:
    key = (_app(spark), sf_dir, fixture)
    if key not in _BASKETS:
        _BASKETS[key] = Baskets.prepare(FIXTURES[fixture](spark, sf_dir), Store(spark))
    return _BASKETS[key]


def run(spark: SparkSession, sf_dir: str, fixture: str, strategy: str, threshold: int, **opts):
    """A finished mining run (its ``history`` holds every level)."""
    key = (_app(spark), sf_dir, fixture, strategy, threshold, tuple(sorted(opts.items())))
    if key not in _RUNS:
        b = baskets(spark, sf_dir, fixture)
        if strategy == "apriori":
            m = LevelMiner(b, threshold, **opts)
        elif strategy == "apriori_scan":
            m = ScanMiner(b, threshold, **opts)
        elif strategy == "pcy":
            m = PCYMiner(b, threshold, **opts)
        elif strategy == "son":
            m = SONMiner(b, threshold, chunks=son_chunk, **opts)
        elif strategy == "apriori_basket_scan":
            m = BasketScanMiner(b, threshold, **opts)
        elif strategy == "son_two_pass":
            m = TwoPassSON(b, threshold, chunks=son_chunk, **opts)
        elif strategy == "toivonen":
            m = Toivonen(b, threshold, **opts)
            m.result = m.run()
            _RUNS[key] = m
            return m
        else:
            raise ValueError(strategy)
        for _ in m.levels():
            pass
        _RUNS[key] = m
    return _RUNS[key]


def level(spark, sf_dir, fixture, strategy, threshold, k, **opts) -> DataFrame:
    return run(spark, sf_dir, fixture, strategy, threshold, **opts).history[k - 1].itemsets


def all_levels_text(levels) -> DataFrame:
    out = None
    for lvl in levels:
        df = itemsets_as_text(lvl.itemsets, lvl.k)
        out = df if out is None else out.unionByName(df)
    return out


def level_counts_df(levels) -> DataFrame:
    out = None
    for lvl in levels:
        df = lvl.itemsets.agg(F.count(F.lit(1)).alias("n_itemsets")).select(
            F.lit(lvl.k).alias("k"), "n_itemsets")
        out = df if out is None else out.unionByName(df)
    return out


def _scratch(spark: SparkSession, name: str) -> str:
    return Store(spark).path(name)


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def q_filter_eq(spark, sf):
    return T.table(spark, sf, "orders").where(F.col("o_orderstatus") == T.ORDER_STATUS).select("o_orderkey")


def q_filter_in(spark, sf):
    return (T.table(spark, sf, "lineitem").where(F.col("l_returnflag").isin(*T.RETURN_FLAGS))
            .select("l_orderkey", "l_suppkey"))


def q_join_inner(spark, sf):
    return extract_transactions(
        T.table(spark, sf, "lineitem"), T.table(spark, sf, "orders"), fact_basket="l_orderkey",
        basket_key="o_orderkey", item="l_suppkey", fact_filter=F.col("l_returnflag").isin(*T.RETURN_FLAGS),
        basket_filter=F.col("o_orderstatus") == T.ORDER_STATUS, distinct=False)


def q_join_left(spark, sf):
    items = T.supp_transactions(spark, sf).select(ITEM).distinct()
    lab = T.supplier_labels(spark, sf).select(F.col("s_suppkey").alias(ITEM), F.col("s_name").alias("item_name"))
    return items.join(lab, on=ITEM, how="left")


def q_extract_transactions(spark, sf):
    return T.supp_transactions(spark, sf, labels=True)


def q_basket_count(spark, sf):
    return basket_count(baskets(spark, sf, "supp").df)


def q_chunk_sizes(spark, sf):
    return chunk_sizes(baskets(spark, sf, "supp").df, son_chunk(F.col(BASKET)))


def q_row_number_chunk(spark, sf):
    keys = baskets(spark, sf, "supp").df.select(BASKET).distinct().withColumn("chunk", son_chunk(F.col(BASKET)))
    keys = keys.withColumn("label", format_item_id(BASKET))  # a column that is no key rides along
    return consecutive_index(keys, [BASKET], ["chunk"]).select("chunk", BASKET, "label", "row_number")


def q_format_item_id(spark, sf):
    return baskets(spark, sf, "supp").df.select(ITEM).distinct().select(ITEM, format_item_id(ITEM).alias("item_id"))


def q_basket_lines(spark, sf):
    return basket_lines(baskets(spark, sf, "supp").df, LINE_ITEMS)


def q_basket_parse(spark, sf):
    path = _scratch(spark, "basket_file")
    write_basket_file(basket_lines(baskets(spark, sf, "supp").df, LINE_ITEMS, item_format=format_item_id), path,
                      single_file=True)
    return read_basket_file(spark, path, basket_type="bigint", item_parser=parse_item_id)


def q_src_text_split(spark, sf):
    path = _scratch(spark, "basket_text")
    lines = basket_lines(baskets(spark, sf, "supp").df, LONG_LINE)
    lines.select(F.concat_ws(",", F.col(BASKET).cast("string"), "items").alias("value")).write.text(path)
    f = read_text_split(spark, path, sep=",")
    return f.select(F.col("fields")[0].cast("bigint").alias(BASKET), F.col("fields")[1].alias("items"))


def q_src_csv_roundtrip(spark, sf):
    path = _scratch(spark, "transactions_csv")
    save_delimited(T.supp_transactions(spark, sf, labels=True), path, header=True)
    return read_delimited(spark, path, schema="basket bigint, item bigint, item_name string", header=True)


def q_src_parquet(spark, sf):
    path = _scratch(spark, "transactions_parquet")
    save_parquet(T.supp_transactions(spark, sf), path)
    return read_parquet(spark, path)


def q_src_tsv_gzip(spark, sf):
    path = _scratch(spark, "transactions_tsv")
    (T.supp_transactions(spark, sf, labels=True).write.option("header", True).option("sep", "\t")
     .option("compression", "gzip").option("nullValue", "\\N").csv(path))
    return read_delimited(spark, path, schema="basket bigint, item bigint, item_name string", header=True, sep="\t",
                          null_value="\\N")


def q_materialize_reuse(spark, sf):
    """The same plan is read, another one at the same path is computed anew."""
    path, lk = _scratch(spark, "l1_reuse"), level(spark, sf, "supp", "apriori", SUPP_T, 1)
    frames = [materialize(d, path) for d in (lk, lk)]
    kept = frames[0].count() if frames[0].inputFiles() == frames[1].inputFiles() else -1
    other = materialize(lk.where(F.col("item1") % 2 == 0), path)
    return other.select("item1", SUPPORT, F.lit(kept).cast("bigint").alias("n_read"))


def q_infrequent_filter(spark, sf):
    return infrequent_filter(count_support(baskets(spark, sf, "supp_all").df.withColumnRenamed(ITEM, "item1"), 1), 590)


def q_son_null_chunk(spark, sf):
    """Baskets with an odd key have no chunk of the caller's."""
    m = SONMiner(baskets(spark, sf, "supp"), SUPP_T, chunks=lambda b: F.when(b % 2 == 0, F.pmod(b, F.lit(4))), max_k=2)
    return [lvl.itemsets for lvl in m.levels()][1]


def q_son_hash_chunks(spark, sf):
    return [lvl.itemsets for lvl in SONMiner(baskets(spark, sf, "supp"), SUPP_T, chunks=4, max_k=2).levels()][1]


def even_items(cand, k):
    """A candidate filter: itemsets whose last item is even."""
    return cand.where(F.col(f"item{k}") % 2 == 0)


def q_candidate_filter(strategy):
    def q(spark, sf):
        m = strategy(baskets(spark, sf, "supp"), SUPP_T, max_k=2, candidate_filter=even_items)
        return [lvl.itemsets for lvl in m.levels()][1]
    return q


def q_pcy_xxhash(spark, sf):
    return level(spark, sf, "supp", "pcy", SUPP_T, 2, buckets=10007)


def q_support_k1(spark, sf):
    return count_support(baskets(spark, sf, "supp").df.withColumnRenamed(ITEM, "item1"), 1)


def q_support_k2(spark, sf):
    m = run(spark, sf, "supp", "apriori_scan", SUPP_T)
    return count_support(m.candidates(2, m.history[0]), 2)


def q_support_k3(spark, sf):
    m = run(spark, sf, "supp", "apriori_scan", SUPP_T)
    return count_support(m.candidates(3, m.history[1]), 3)


def q_support_filter(spark, sf):
    return level(spark, sf, "supp_all", "apriori", SUPP_ALL_T, 2)


def q_candidates_k2(spark, sf):
    m = run(spark, sf, "supp", "apriori", SUPP_T)
    return extend_occurrences(m.history[0].occurrences, 2).select(BASKET, *item_cols(2))


def q_candidates_k3(spark, sf):
    m = run(spark, sf, "supp", "apriori", SUPP_T)
    return extend_occurrences(m.history[1].occurrences, 3).select(BASKET, *item_cols(3))


def q_semi_join_frequent(spark, sf):
    m = run(spark, sf, "supp", "apriori", SUPP_T)
    return m.history[1].occurrences.select(BASKET, *item_cols(2))


def q_support_window(spark, sf):
    m = run(spark, sf, "supp", "apriori", SUPP_T)
    occ = extend_occurrences(m.history[0].occurrences, 2).select(BASKET, *item_cols(2))
    return support_window(occ, 2).where(F.col(SUPPORT) >= SUPP_T)


def q_distinct_itemsets(spark, sf):
    return distinct_itemsets(q_support_window(spark, sf))


def q_itemset_expand(spark, sf):
    return expand_itemset(pack_itemset(level(spark, sf, "supp", "apriori", SUPP_T, 2)))


def q_monotonicity_prune(spark, sf):
    m = run(spark, sf, "supp", "apriori", SUPP_T)
    l2 = m.history[1]
    return apriori_gen(l2.itemsets, 3, l2.n)


def q_combinations(k):
    def q(spark, sf):
        occ = baskets(spark, sf, "supp").df.withColumnRenamed(ITEM, "item1")
        for j in range(2, k + 1):
            occ = extend_occurrences(occ, j)
        return occ.select(BASKET, *item_cols(k))
    return q


def q_hash(fn):
    def q(spark, sf):
        l2 = level(spark, sf, "supp", "apriori", SUPP_T, 2)
        return l2.select(*item_cols(2), fn([F.col("item1"), F.col("item2")], PCY_BUCKETS).alias("bucket"))
    return q


def q_pcy_buckets(spark, sf):
    return run(spark, sf, "supp", "pcy", SUPP_T, **PCY).bucket_tables[2]


def q_pcy_bitmap_filter(spark, sf):
    m = run(spark, sf, "supp", "pcy", SUPP_T, **PCY)
    pairs = extend_occurrences(m.history[0].occurrences, 2).select(*item_cols(2)).distinct()
    return bitmap_filter(pairs, 2, m.bitmaps[2], m.hash_functions, m.buckets)


def q_pcy_bitmap_packed(spark, sf):
    m = run(spark, sf, "supp", "pcy", SUPP_T, **PCY)
    pairs = extend_occurrences(m.history[0].occurrences, 2).select(*item_cols(2)).distinct()
    return packed_filter(pairs, 2, packed_bitmaps(m.bucket_tables[2], SUPP_T), m.hash_functions, m.buckets)


def q_monotonicity_prune_k4(spark, sf):
    """Every 4-set that two frequent 3-sets of one prefix make, all subsets tested."""
    l3 = run(spark, sf, "brand", "apriori", BRAND_T).history[2]
    sets = l3.itemsets.select(F.lit(0).alias(BASKET), *item_cols(3))
    return monotonicity_prune(extend_occurrences(sets, 4).select(*item_cols(4)), l3.itemsets, 4, l3.n)


def q_sample_with_replacement(spark, sf):
    return sample_with_replacement(baskets(spark, sf, "brand").df, TOI_SIZE, TOI_SEED)


def q_weighted_support(spark, sf):
    b = baskets(spark, sf, "brand").df
    draws = sample_with_replacement(b, TOI_SIZE, TOI_SEED)
    return weighted_support(extend_occurrences(b.withColumnRenamed(ITEM, "item1"), 2), 2, draws)


def q_level(fixture, strategy, threshold, k, **opts):
    def q(spark, sf):
        return level(spark, sf, fixture, strategy, threshold, k, **opts)
    return q


def q_all_levels(fixture, strategy, threshold, **opts):
    def q(spark, sf):
        return all_levels_text(run(spark, sf, fixture, strategy, threshold, **opts).history)
    return q


def q_level_counts(spark, sf):
    return level_counts_df(run(spark, sf, "supp", "apriori", SUPP_T).history)


def q_son_candidates(k):
    def q(spark, sf):
        return run(spark, sf, "supp", "son", SUPP_T).son_candidates[k]
    return q


def q_son_global_count(spark, sf):
    m = run(spark, sf, "supp", "son", SUPP_T)
    return m.candidate_counts[2]


def q_itemset_stats(spark, sf):
    return itemset_stats(level(spark, sf, "supp", "apriori", SUPP_T, 2))


def q_topk_itemsets(spark, sf):
    return top_itemsets(level(spark, sf, "supp", "apriori", SUPP_T, 2), TOP_N)


def q_label_itemsets(spark, sf):
    return label_itemsets(level(spark, sf, "supp", "apriori", SUPP_T, 2), T.supplier_labels(spark, sf),
                          key="s_suppkey", label="s_name")


def q_itemset_codec_roundtrip(spark, sf):
    path = _scratch(spark, "itemsets_l2")
    write_itemsets(level(spark, sf, "supp", "apriori", SUPP_T, 2), path)
    return read_itemsets(spark, path, 2)


def q_sample_exact(spark, sf):
    return sample_baskets(baskets(spark, sf, "brand").df, TOI_SIZE, TOI_SEED)


def _toi(spark, sf, size=TOI_SIZE, adjust=TOI_ADJUST):
    return run(spark, sf, "brand", "toivonen", BRAND_T, size=size, adjust=adjust, seed=TOI_SEED,
               max_iterations=1)


def q_toivonen_level(k):
    def q(spark, sf):
        m = _toi(spark, sf)
        levels = m.result.levels
        if m.result.status != "success":
            # the attempt's counts are made whole, as far as they are asked for
            levels = list(islice(m.completed(m.result.last), k))
        return levels[k - 1].itemsets
    return q


def _border_text(attempt) -> DataFrame:
    out = None
    for k, b in sorted(attempt.border.items()):
        df = itemsets_as_text(b, k)
        out = df if out is None else out.unionByName(df)
    return out


def _full_text(attempt) -> DataFrame:
    out = None
    for k, f in sorted(attempt.full_counts.items()):
        df = f.select(F.lit(k).cast("int").alias("k"),
                      F.concat_ws("|", *[F.col(c).cast("string") for c in item_cols(k)]).alias("itemset"),
                      SUPPORT, "kind")
        out = df if out is None else out.unionByName(df)
    return out


def q_negative_border(spark, sf):
    return _border_text(_toi(spark, sf).result.last)


def q_toivonen_full_scan(spark, sf):
    return _full_text(_toi(spark, sf).result.last)


def _verdict(m) -> DataFrame:
    a = m.result.last
    full = _full_text(a)
    return full.agg(
        F.coalesce(F.sum(F.when((F.col("kind") == "border") & (F.col(SUPPORT) >= m.threshold), 1)),
                   F.lit(0)).cast("bigint").alias("n_border_frequent")).select(
        F.lit(m.result.status).alias("status"), F.lit(a.sample_n).cast("bigint").alias("sample_n"),
        F.lit(a.sample_threshold).cast("bigint").alias("sample_threshold"),
        F.lit(a.n_border).cast("bigint").alias("n_border"), "n_border_frequent")


def q_toivonen_verdict(spark, sf):
    return _verdict(_toi(spark, sf))


def q_toivonen_verdict_fail(spark, sf):
    return _verdict(_toi(spark, sf, TOI_FAIL_SIZE, TOI_FAIL_ADJUST))


SPARK_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources / sinks
    "src_csv_roundtrip": q_src_csv_roundtrip,
    "src_text_split": q_src_text_split,
    "src_parquet": q_src_parquet,
    "src_tsv_gzip": q_src_tsv_gzip,
    "infrequent_filter": q_infrequent_filter,
    "son_null_chunk": q_son_null_chunk,
    "son_hash_chunks": q_son_hash_chunks,
    "candidate_filter_apriori": q_candidate_filter(LevelMiner),
    "candidate_filter_pcy": q_candidate_filter(PCYMiner),
    "candidate_filter_son": q_candidate_filter(SONMiner),
    "pcy_xxhash_k2": q_pcy_xxhash,
    "basket_lines": q_basket_lines,
    "basket_parse": q_basket_parse,
    "itemset_codec_roundtrip": q_itemset_codec_roundtrip,
    "materialize_reuse": q_materialize_reuse,
    # filters / projections
    "filter_eq": q_filter_eq,
    "filter_in": q_filter_in,
    "extract_transactions": q_extract_transactions,
    "support_filter": q_support_filter,
    "itemset_expand": q_itemset_expand,
    "monotonicity_prune": q_monotonicity_prune,
    "pcy_bitmap_filter": q_pcy_bitmap_filter,
    "pcy_bitmap_packed": q_pcy_bitmap_packed,
    "monotonicity_prune_k4": q_monotonicity_prune_k4,
    # joins
    "join_inner": q_join_inner,
    "join_left": q_join_left,
    "candidates_k2": q_candidates_k2,
    "candidates_k3": q_candidates_k3,
    "label_itemsets": q_label_itemsets,
    "semi_join_frequent": q_semi_join_frequent,
    "negative_border": q_negative_border,
    # aggregations
    "support_k1": q_support_k1,
    "support_k2": q_support_k2,
    "support_k3": q_support_k3,
    "son_global_count": q_son_global_count,
    "pcy_buckets": q_pcy_buckets,
    "itemset_stats": q_itemset_stats,
    "distinct_itemsets": q_distinct_itemsets,
    "level_counts": q_level_counts,
    "basket_count": q_basket_count,
    "chunk_sizes": q_chunk_sizes,
    # windows
    "support_window": q_support_window,
    "row_number_chunk": q_row_number_chunk,
    # sort / limit / sampling
    "topk_itemsets": q_topk_itemsets,
    "sample_exact": q_sample_exact,
    "sample_with_replacement": q_sample_with_replacement,
    "weighted_support": q_weighted_support,
    # set operations
    "son_candidates_k2": q_son_candidates(2),
    "son_candidates_k3": q_son_candidates(3),
    "toivonen_verdict": q_toivonen_verdict,
    "toivonen_verdict_fail": q_toivonen_verdict_fail,
    "toivonen_full_scan": q_toivonen_full_scan,
    # scalar functions
    "format_item_id": q_format_item_id,
    "combinations_k2": q_combinations(2),
    "combinations_k3": q_combinations(3),
    "hash_product": q_hash(hash_product),
    "hash_weighted": q_hash(hash_weighted),
    # mining strategies
    "apriori_k1": q_level("supp", "apriori", SUPP_T, 1),
    "apriori_k2": q_level("supp", "apriori", SUPP_T, 2),
    "apriori_k3": q_level("supp", "apriori", SUPP_T, 3),
    "apriori_all": q_all_levels("supp", "apriori", SUPP_T),
    "apriori_brand_all": q_all_levels("brand", "apriori", BRAND_T),
    "apriori_supp_all": q_all_levels("supp_all", "apriori", SUPP_ALL_T),
    "apriori_scan_k2": q_level("supp", "apriori_scan", SUPP_T, 2),
    "apriori_scan_k3": q_level("supp", "apriori_scan", SUPP_T, 3),
    "pcy_k2": q_level("supp", "pcy", SUPP_T, 2, **PCY),
    "pcy_k3": q_level("supp", "pcy", SUPP_T, 3, **PCY),
    "son_k2": q_level("supp", "son", SUPP_T, 2),
    "son_k3": q_level("supp", "son", SUPP_T, 3),
    "apriori_basket_scan_k2": q_level("supp", "apriori_basket_scan", SUPP_T, 2),
    "apriori_basket_scan_k3": q_level("supp", "apriori_basket_scan", SUPP_T, 3),
    "son_two_pass_k2": q_level("supp", "son_two_pass", SUPP_T, 2),
    "son_two_pass_k3": q_level("supp", "son_two_pass", SUPP_T, 3),
    "toivonen_k2": q_toivonen_level(2),
    "toivonen_k3": q_toivonen_level(3),
}
