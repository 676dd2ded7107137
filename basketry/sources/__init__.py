"""Sources and sinks: delimited text, parquet, basket and itemset files, and
materialisation of intermediate tables in the shared checkpoint folder."""

from basketry.sources.baskets import basket_lines, parse_basket_lines, read_basket_file, write_basket_file
from basketry.sources.delimited import read_delimited, read_text_split, save_delimited
from basketry.sources.itemsets import itemset_lines, parse_itemset_lines, read_itemsets, write_itemsets
from basketry.sources.store import Store, cache_key, materialize, read_parquet, save_parquet

__all__ = [
    "basket_lines", "parse_basket_lines", "read_basket_file", "write_basket_file",
    "read_delimited", "read_text_split", "save_delimited",
    "itemset_lines", "parse_itemset_lines", "read_itemsets", "write_itemsets",
    "Store", "cache_key", "materialize", "read_parquet", "save_parquet",
]
