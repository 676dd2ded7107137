"""Basket-scan Apriori (M2): candidates first, then one counting pass.

C_k is generated from L_{k-1} alone (apriori-gen: prefix join on the
itemset table plus the full subset test, P9), and only occurrences of C_k
reach the counting shuffle.  For k = 2 every pair of frequent items is a
candidate, which the occurrences of L_1 already guarantee, so no pair table
is built.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

from basketry.functions.columns import ITEM, item_cols
from basketry.operators.aggregates import count_support, support_filter
from basketry.operators.candidates import apriori_gen
from basketry.operators.joins import extend_occurrences, semi_join
from basketry.plans.levels import Level, LevelMiner
from basketry.plans.transactions import Baskets
from basketry.plans.tree import Tree, count


class ScanMiner(LevelMiner):
    name = "apriori_scan"

    def candidate_table(self, k: int, prev: Level) -> tuple[DataFrame, int]:
        ck = self.store.write(apriori_gen(prev.itemsets, k, prev.n), f"C{k}")
        return ck, ck.count()

    def candidates(self, k: int, prev: Level) -> DataFrame:
        cand = extend_occurrences(prev.occ, k)
        if k == 2:
            return cand
        ck, n = self.candidate_table(k, prev)
        return semi_join(cand, ck, item_cols(k), n)


class BasketScanMiner(LevelMiner):
    """M2 on horizontal baskets: level k is one walk of the baskets (sorted
    arrays cut to frequent items) down the prefix tree of L_1, ..., L_{k-1} and
    C_k.  Occurrences are neither written nor joined by basket, so a level
    costs one read of the transactions whatever came before."""

    name = "apriori_basket_scan"

    def levels(self) -> Iterator[Level]:
        kept: dict[int, DataFrame] = {}
        k = 1
        while True:
            level = self._scanned(k, kept)
            self.history.append(level)
            yield level
            if not level.n or self._last(k):
                return
            kept[k] = level.itemsets
            k += 1

    def _scanned(self, k: int, kept: dict[int, DataFrame]) -> Level:
        if self.shared and self.store.complete(f"L{k}"):
            lk = self.store.read(f"L{k}")
            return Level(k, lk, lk.count(), None)
        if k == 1:
            counts = count_support(self.b.df.withColumnRenamed(ITEM, "item1"), 1)
        else:
            frames = dict(kept)
            if k > 2:
                frames[k] = apriori_gen(kept[k - 1], k, self.history[k - 2].n)
            tree = Tree.build(frames, self.store, f"tree{k}-")
            # pairs of frequent items are counted freely: no table of them is made
            counts = tree.by_items(count(self.b, tree, k, free=(2,) if k == 2 else ()), k)
        if self.candidate_filter is not None and k > 1:
            # without occurrences a filter sees the counted itemsets
            counts = self.candidate_filter(counts, k)
        lk = self.store.write(support_filter(counts, self.threshold), f"L{k}")
        return Level(k, lk, lk.count(), None)


def apriori_scan(baskets: Baskets, threshold: int, max_k: int | None = None) -> Iterator[Level]:
    return ScanMiner(baskets, threshold, max_k).levels()
