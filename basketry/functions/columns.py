"""Column-name conventions shared by every operator.

An itemset of size k is k typed columns ``item1 < item2 < ... < itemk``
(not an array, so results compare directly with SQL), plus ``support``.
Occurrences carry the basket key in front: ``basket, item1..itemk``.
"""

from __future__ import annotations

BASKET = "basket"
ITEM = "item"
SUPPORT = "support"
SALT = "salt"
CHUNK = "chunk"


def item_cols(k: int) -> list[str]:
    return [f"item{i}" for i in range(1, k + 1)]


def name_cols(k: int) -> list[str]:
    return [f"item{i}_name" for i in range(1, k + 1)]


def level_of(columns) -> int:
    """Size k of the itemsets held by a frame with ``item1..itemk`` columns."""
    k = 0
    while f"item{k + 1}" in columns:
        k += 1
    return k
