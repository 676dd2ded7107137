"""The level loop (M6) and the DataFrame Apriori strategy (M1).

Every strategy answers the same question -- all itemsets with
support >= threshold, level by level -- and differs only in how it prunes
before counting.  ``LevelMiner`` holds the loop; subclasses change the
candidate step (``candidates``) or the counting step (``frequent``).

Per level the loop:
  1. builds candidate occurrences from the previous level's occurrences by
     the prefix self-join (salted for hot baskets),
  2. counts them per itemset (hash aggregate with map-side combine),
  3. writes L_k (small) and takes its exact row count -- the only value
     that returns to the driver,
  4. keeps the occurrences of L_k (semi join; L_k is broadcast only under
     the size limit) and writes them: the next level starts from a short
     plan on a written table, so lineage never grows and a lost executor
     costs one level at most.
The loop stops after the first empty level, which is yielded once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import BASKET, ITEM, item_cols
from basketry.operators.aggregates import count_support, support_filter
from basketry.operators.joins import extend_occurrences, semi_join
from basketry.plans.transactions import Baskets


# X1 hook: (candidate occurrences, k) -> candidate occurrences.  Must only
# remove rows (e.g. a semi join against an allow-list); it runs before the
# count, so it can only shrink L_k.
CandidateFilter = Callable[[DataFrame, int], DataFrame]


@dataclass
class Level:
    k: int
    itemsets: DataFrame               # item1..itemk, support
    n: int                            # exact number of itemsets
    occ: DataFrame | None             # occurrences with the planner's own columns (salt)

    @property
    def occurrences(self) -> DataFrame | None:
        """basket, item1..itemk of the frequent itemsets."""
        return None if self.occ is None else self.occ.select(BASKET, *item_cols(self.k))


class LevelMiner:
    name = "apriori"

    def __init__(self, baskets: Baskets, threshold: int, max_k: int | None = None, tag: str | None = None,
                 candidate_filter: CandidateFilter | None = None):
        if int(threshold) < 1:
            raise ValueError("threshold must be >= 1 (only observed itemsets are counted)")
        self.b = baskets
        self.threshold = int(threshold)
        self.max_k = max_k
        # a run has a folder of its own; only runs that may reuse each other's
        # levels share one.  A user's filter has no identity, so it never does
        self.shared = baskets.reuse and candidate_filter is None
        name = tag or f"{self.name}-t{self.threshold}"
        self.store = baskets.store.child(name if self.shared else f"{name}-{uuid.uuid4().hex[:8]}")
        self.history: list[Level] = []
        self.candidate_filter = candidate_filter

    # -- steps that strategies override -------------------------------------
    def candidates(self, k: int, prev: Level) -> DataFrame:
        """Candidate occurrences of level k (basket, [salt], item1..itemk)."""
        return extend_occurrences(prev.occ, k)

    def frequent(self, k: int, cand: DataFrame) -> DataFrame:
        """L_k from candidate occurrences."""
        return support_filter(count_support(cand, k), self.threshold)

    def after_level(self, level: Level, cand: DataFrame) -> None:
        """Hook run while the candidate occurrences are still cached."""

    # -- the loop ---------------------------------------------------------
    def _last(self, k: int) -> bool:
        return self.max_k is not None and k >= self.max_k

    def reused(self, k: int) -> Level | None:
        """A finished level k of an earlier run over the same baskets and
        parameters (only when the baskets were prepared with ``reuse``)."""
        if not self.shared or not self.store.complete(f"L{k}"):
            return None
        lk = self.store.read(f"L{k}")
        n = lk.count()
        occ = None
        if n and not self._last(k):
            if k == 1:
                occ = semi_join(self.b.df.withColumnRenamed(ITEM, "item1"), lk, ["item1"], n)
            elif self.store.complete(f"occ{k}"):
                occ = self.store.read(f"occ{k}")
            else:
                return None
        level = Level(k, lk, n, occ)
        return level if self.after_reuse(level) else None

    def after_reuse(self, level: Level) -> bool:
        """Reload what a strategy made besides L_k and its occurrences for a
        reused level; False if it is missing (the level is then recomputed)."""
        return True

    def levels(self) -> Iterator[Level]:
        occ0 = self.b.df.withColumnRenamed(ITEM, "item1")
        k, prev = 1, None
        while True:
            level = self.reused(k)
            if level is None:
                if k == 1:
                    cand = occ0
                else:
                    cand = self.candidates(k, prev)
                    if self.candidate_filter is not None:
                        # A user's extra pruning; it may only drop candidates
                        cand = self.candidate_filter(cand, k)
                    cand = cand.persist(StorageLevel.MEMORY_AND_DISK)
                # L_k is written, not cached: a cache would keep the lineage
                # of the candidates and be dropped (recomputed later) once
                # they are unpersisted
                lk = self.frequent(k, cand)
                done = self.shared and self.store.complete(f"L{k}")  # another run may be reading it
                lk = self.store.read(f"L{k}") if done else self.store.write(lk, f"L{k}")
                n = lk.count()
                occ = None
                if n and not self._last(k):
                    if k == 1:
                        occ = semi_join(cand, lk, ["item1"], n)      # short plan on a written table
                    else:
                        occ = self.store.write(semi_join(cand, lk, item_cols(k), n), f"occ{k}")
                level = Level(k, lk, n, occ)
                if n and not self._last(k):
                    self.after_level(level, cand)
                if k > 1:
                    cand.unpersist()
            self.history.append(level)
            yield level
            if not level.n or self._last(k):
                return
            prev, k = level, k + 1


def prepare(transactions: DataFrame, store=None, basket: str = "basket", item: str = "item",
            hot_items: int | None = None) -> Baskets:
    kw = {} if hot_items is None else {"hot_items": hot_items}
    return Baskets.prepare(transactions, store, basket, item, **kw)


def apriori(baskets: Baskets, threshold: int, max_k: int | None = None) -> Iterator[Level]:
    """M1: DataFrame Apriori -- count every observed extension of a frequent
    (k-1)-itemset; no candidate table."""
    return LevelMiner(baskets, threshold, max_k).levels()


def itemsets_as_text(level_df: DataFrame, k: int, sep: str = "|") -> DataFrame:
    """One string per itemset (``a|b|c``) -- a fixed schema across levels."""
    return level_df.select(
        F.lit(k).cast("int").alias("k"),
        F.concat_ws(sep, *[F.col(c).cast("string") for c in item_cols(k)]).alias("itemset"),
        *([F.col("support")] if "support" in level_df.columns else []))
