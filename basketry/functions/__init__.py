"""Column functions: naming, id codecs, combinations and bucket hashes."""

from basketry.functions.columns import BASKET, CHUNK, ITEM, SALT, SUPPORT, item_cols, level_of, name_cols
from basketry.functions.combos import array_combinations, subsets_minus_one
from basketry.functions.hashing import DEFAULT_HASHES, hash_product, hash_weighted, seeded_xxhash
from basketry.functions.ids import format_item_id, parse_item_id

__all__ = [
    "BASKET", "CHUNK", "ITEM", "SALT", "SUPPORT", "item_cols", "level_of", "name_cols",
    "array_combinations", "subsets_minus_one",
    "DEFAULT_HASHES", "hash_product", "hash_weighted", "seeded_xxhash",
    "format_item_id", "parse_item_id",
]
