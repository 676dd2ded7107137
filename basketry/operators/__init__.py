"""DataFrame operators: joins, aggregations, windows, candidates, sampling,
skew handling and reports."""

from basketry.operators.aggregates import (basket_count, bucket_counts, chunk_sizes, count_support,
                                           infrequent_filter, itemset_stats, support_filter)
from basketry.operators.candidates import apriori_gen, bitmap_filter, monotonicity_prune
from basketry.operators.joins import anti_join, broadcast_if_small, extend_occurrences, semi_join
from basketry.operators.report import (distinct_itemsets, expand_itemset, label_itemsets, pack_itemset,
                                       report, top_itemsets)
from basketry.operators.sampling import sample_baskets, sample_key
from basketry.operators.skew import attach_salt, hot_baskets
from basketry.operators.windows import consecutive_index, support_window

__all__ = [
    "basket_count", "bucket_counts", "chunk_sizes", "count_support", "infrequent_filter", "itemset_stats",
    "support_filter", "apriori_gen", "bitmap_filter", "monotonicity_prune", "anti_join",
    "broadcast_if_small", "extend_occurrences", "semi_join", "distinct_itemsets", "expand_itemset",
    "label_itemsets", "pack_itemset", "report", "top_itemsets", "sample_baskets", "sample_key",
    "attach_salt", "hot_baskets", "consecutive_index", "support_window",
]
