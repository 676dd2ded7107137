"""Top-level entry points."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

from basketry.plans.levels import Level, LevelMiner
from basketry.plans.pcy import PCYMiner
from basketry.plans.scan import BasketScanMiner, ScanMiner
from basketry.plans.son import SONMiner, TwoPassSON
from basketry.plans.toivonen import Toivonen
from basketry.plans.transactions import Baskets
from basketry.sources.store import Store

STRATEGIES = ("apriori", "apriori_scan", "apriori_basket_scan", "pcy", "son", "son_two_pass", "toivonen")


def _baskets(transactions: DataFrame | Baskets, basket: str, item: str, hot_items: int | None,
             store: Store | None, reuse: bool = False, force: bool = False) -> Baskets:
    if isinstance(transactions, Baskets):
        return transactions
    kw = {} if hot_items is None else {"hot_items": hot_items}
    return Baskets.prepare(transactions, store, basket, item, reuse=reuse, force=force, **kw)


def mine_levels(transactions: DataFrame | Baskets, threshold: int, strategy: str = "apriori", *,
                max_k: int | None = None, basket: str = "basket", item: str = "item",
                hot_items: int | None = None, store: Store | None = None, reuse: bool = False,
                force: bool = False, **options) -> Iterator[Level]:
    """M6: lazily yield L_1, L_2, ... (``Level`` objects; ``.itemsets`` is the
    DataFrame ``item1..itemk, support``), stopping after the first empty one.

    Options per strategy: pcy -- ``buckets``, ``hash_functions``;
    son -- ``chunks`` (int or Column -> Column over the basket key),
    ``prune``; toivonen -- ``size``, ``adjust``, ``seed``,
    ``max_iterations`` (raises RuntimeError when every attempt fails).
    With ``reuse`` finished levels of an earlier run over the same input
    and parameters are read back (S10); ``force`` recomputes them.
    """
    b = _baskets(transactions, basket, item, hot_items, store, reuse, force)
    if strategy == "apriori":
        return LevelMiner(b, threshold, max_k, **options).levels()
    if strategy == "apriori_scan":
        return ScanMiner(b, threshold, max_k, **options).levels()
    if strategy == "pcy":
        return PCYMiner(b, threshold, max_k=max_k, **options).levels()
    if strategy == "son":
        return SONMiner(b, threshold, max_k=max_k, **options).levels()
    if strategy == "apriori_basket_scan":
        return BasketScanMiner(b, threshold, max_k, **options).levels()
    if strategy == "son_two_pass":
        return TwoPassSON(b, threshold, max_k=max_k, **options).levels()
    if strategy == "toivonen":
        res = Toivonen(b, threshold, max_k=max_k, **options).run()
        if res.status != "success":
            raise RuntimeError(f"Toivonen failed after {len(res.attempts)} attempt(s)")
        return iter(res.levels)
    raise ValueError(f"unknown strategy {strategy!r}; one of {STRATEGIES}")


def mine(transactions: DataFrame | Baskets, threshold: int, strategy: str = "apriori", **kw) -> list[DataFrame]:
    """All levels as DataFrames (the last one is empty unless ``max_k`` cut the run)."""
    return [lvl.itemsets for lvl in mine_levels(transactions, threshold, strategy, **kw)]
