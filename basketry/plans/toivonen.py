"""Toivonen (M5): mine a sample at a lowered threshold, count the sample's
frequent itemsets and their negative border in the full data, and accept
the result only if no border itemset is frequent; otherwise draw a new
sample (seed + 1), up to ``max_iterations`` attempts.

* Sample (T1): the ``size`` baskets with the smallest md5("{seed}:{basket}").
* Sample threshold: an itemset is sample-frequent when
  ``support * n >= adjust * sample_n * threshold``; the integer bound
  ceil(adjust * sample_n * threshold / n) is computed exactly.
* Negative border: level 1 = every item of the full data that is not
  sample-frequent; level k = apriori-gen(S_{k-1}) minus S_k, i.e. sets not
  sample-frequent whose every (k-1)-subset is -- including sets never seen
  in the sample, nor in the full data.  At level 2 that is every pair of
  sample-frequent items that is not sample-frequent, n(n-1)/2 - |S_2| in all:
  they are made when the border is read, no step of an attempt writes them.
* Full count: one pass over the full data counts all levels at once, by a walk
  of the baskets down the prefix tree of S_1, S_2 and apriori-gen(S_{k-1}),
  k >= 3 (``plans.tree``).  Sets that never occur cannot be frequent.
* Reuse (S10): over baskets prepared with ``reuse`` every step of an attempt
  (sample, sample levels, candidates, full counts) is picked up if it is there.
* Verdict: success iff no border set has support >= threshold.  Then L_k is
  the sample-frequent sets whose full support reaches the threshold.
* Failure: ``completed`` makes the attempt's counts whole, level by level.  All
  that is counted stays; a frequent set that was no candidate has only frequent
  subsets, so apriori-gen of L_{k-1} lists what was missed, and a further pass
  over the full data counts it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial, reduce
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import ITEM, SUPPORT, item_cols
from basketry.operators.aggregates import count_support
from basketry.operators.candidates import apriori_gen
from basketry.operators.joins import anti_join, extend_occurrences, semi_join
from basketry.operators.sampling import sample_baskets
from basketry.plans.levels import CandidateFilter, Level, LevelMiner
from basketry.plans.transactions import Baskets
from basketry.plans.tree import Tree, count
from basketry.sources.store import Store


def sample_threshold(threshold: int, adjust: float, sample_n: int, n: int) -> int:
    """Smallest integer support s with s * n >= adjust * sample_n * threshold."""
    if n == 0:
        return 1
    bound = Fraction(str(adjust)) * sample_n * threshold / n
    return max(1, -(-bound.numerator // bound.denominator))


@dataclass
class Attempt:
    seed: int
    sample_n: int
    sample_threshold: int
    sample_levels: list[Level]
    border: dict[int, DataFrame]          # k -> item1..itemk
    full_counts: dict[int, DataFrame]     # k -> item1..itemk, support, kind
    n_border: int
    n_border_frequent: int

    @property
    def success(self) -> bool:
        return self.n_border_frequent == 0


@dataclass
class ToivonenResult:
    status: str
    attempts: list[Attempt] = field(default_factory=list)
    levels: list[Level] = field(default_factory=list)

    @property
    def last(self) -> Attempt:
        return self.attempts[-1]


class Toivonen:
    def __init__(self, baskets: Baskets, threshold: int, size: int, adjust: float = 1.0,
                 seed: int = 0, max_iterations: int = 1, max_k: int | None = None,
                 candidate_filter: CandidateFilter | None = None):
        if int(threshold) < 1:
            raise ValueError("threshold must be >= 1")
        self.b = baskets
        self.threshold = int(threshold)
        self.size = int(size)
        self.adjust = adjust
        self.seed = int(seed)
        self.max_iterations = int(max_iterations)
        self.max_k = max_k
        self.candidate_filter = candidate_filter
        # An attempt's steps are keyed by all that determines them; a
        # user's filter has no identity, so such a run shares nothing
        self.shared = baskets.reuse and candidate_filter is None
        name = f"toivonen-t{threshold}-s{size}-a{adjust}-k{max_k}"
        self.store = baskets.store.child(name if self.shared else f"{name}-{uuid.uuid4().hex[:8]}")

    def _step(self, store: Store, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A written table of the attempt: picked up if an earlier run finished it."""
        return store.read(name) if self.shared and store.complete(name) else store.write(make(), name)

    def attempt(self, seed: int) -> Attempt:
        store = self.store.child(f"seed{seed}")
        n = self.b.n_baskets()
        keys = self._step(store, "sample_keys", lambda: sample_baskets(self.b.df, self.size, seed))
        sample_n = keys.count()
        tx = self._step(store, "sample_tx", lambda: semi_join(self.b.df, keys, ["basket"], sample_n))
        sample = Baskets(tx, store, self.b.hot_items, self.b.n_hot, reuse=self.shared)
        st = sample_threshold(self.threshold, self.adjust, sample_n, n)
        s_levels = list(LevelMiner(sample, st, self.max_k, tag="sample",
                                   candidate_filter=self.candidate_filter).levels())
        t = self.threshold

        count_all = self._count_once if self.candidate_filter is None else self._count_by_level
        counted, border = count_all(store, s_levels)
        full = {k: self._kinds(c, s_levels[k - 1], k) for k, c in counted.items()}
        s1 = s_levels[0]
        border[1] = anti_join(counted[1].select("item1"), s1.itemsets, ["item1"], s1.n)

        # one job each: the per-level frames are unioned before counting
        n_border = reduce(DataFrame.unionByName,
                          [b.select(F.lit(k).alias("k")) for k, b in border.items() if k != 2]).count()
        if 2 in border:
            n_border += s1.n * (s1.n - 1) // 2 - s_levels[1].n
        n_bad = reduce(DataFrame.unionByName,
                       [f.where((F.col("kind") == "border") & (F.col(SUPPORT) >= t)).select(F.lit(k).alias("k"))
                        for k, f in full.items()]).count()
        return Attempt(seed, sample_n, st, s_levels, border, full, n_border, n_bad)

    def _generated(self, store: Store, s_levels: list[Level]) -> Iterator[tuple[Level, DataFrame]]:
        """(sample level k, apriori-gen of sample level k - 1).  Pairs are not
        written: the full count takes every pair without their table."""
        for prev, cur in zip(s_levels, s_levels[1:]):
            if prev.n == 0:
                return
            k = cur.k
            make = partial(apriori_gen, prev.itemsets, k, prev.n)
            yield cur, make() if k == 2 else self._step(store, f"gen{k}", make)

    def _count_once(self, store: Store, s_levels: list[Level]) -> tuple[dict[int, DataFrame], dict[int, DataFrame]]:
        """Full counts of all levels in one pass over the full data: a walk
        down the prefix tree of all sample-frequent and border sets.  Every item
        and every pair of sample-frequent items is counted; from level 3 the
        candidates are the tree's level."""
        border: dict[int, DataFrame] = {}
        frames, depth = {1: s_levels[0].itemsets.select("item1")}, 1
        for cur, gen in self._generated(store, s_levels):
            depth = cur.k
            frames[depth] = cur.itemsets.select(*item_cols(depth)) if depth == 2 else gen
            border[depth] = anti_join(gen, cur.itemsets, item_cols(depth), cur.n)
        # ids of the tree's nodes stand in the counts, so both are made together
        done = self.shared and store.complete("full_counts")
        tree = Tree.reread(store, len(frames)) if done else Tree.build(frames, store)
        counts = self._step(store, "full_counts", lambda: count(self.b, tree, depth, free=(2,), all_items=True))
        return {k: tree.by_items(counts, k) for k in range(1, depth + 1)}, border

    def _count_by_level(self, store: Store, s_levels: list[Level]) -> tuple[dict[int, DataFrame], dict[int, DataFrame]]:
        """The same with a user's filter, which sees occurrences: level by level."""
        border: dict[int, DataFrame] = {}
        s1 = s_levels[0]
        occ = self.b.df.withColumnRenamed(ITEM, "item1")
        counted = {1: store.write(count_support(occ, 1), "full1")}
        occ = semi_join(occ, s1.itemsets, ["item1"], s1.n)
        for cur, gen in self._generated(store, s_levels):
            k = cur.k
            border[k] = anti_join(gen, cur.itemsets, item_cols(k), cur.n)
            cand = extend_occurrences(occ, k)
            if k > 2:
                cand = semi_join(cand, gen, item_cols(k), gen.count())
            cand = store.write(self.candidate_filter(cand, k), f"full_occ{k}")
            counted[k] = store.write(count_support(cand, k), f"full{k}")
            occ = semi_join(cand, cur.itemsets, item_cols(k), cur.n)
        return counted, border

    @staticmethod
    def _kinds(counts: DataFrame, sample_level: Level, k: int) -> DataFrame:
        tagged = sample_level.itemsets.select(*item_cols(k), F.lit("frequent").alias("kind"))
        return (counts.join(tagged, on=item_cols(k), how="left")
                .select(*item_cols(k), SUPPORT, F.coalesce("kind", F.lit("border")).alias("kind")))

    def run(self) -> ToivonenResult:
        result = ToivonenResult("failed")
        for i in range(self.max_iterations):
            a = self.attempt(self.seed + i)
            result.attempts.append(a)
            if a.success:
                result.status = "success"
                result.levels = self._final_levels(a)
                break
        return result

    def _final_levels(self, a: Attempt) -> list[Level]:
        # full counts are written tables: each L_k is a filter over them, and
        # all their sizes come back in one grouped count (one row per level)
        frames = {k: (a.full_counts[k].where((F.col("kind") == "frequent") & (F.col(SUPPORT) >= self.threshold))
                      .select(*item_cols(k), SUPPORT)) for k in sorted(a.full_counts)}
        sizes = reduce(DataFrame.unionByName, [f.select(F.lit(k).alias("k")) for k, f in frames.items()])
        n_by_k = {r["k"]: r["count"] for r in sizes.groupBy("k").count().collect()}
        out = []
        for k, lk in frames.items():
            n = int(n_by_k.get(k, 0))
            out.append(Level(k, lk, n, None))
            if n == 0:
                break
        return out

    def completed(self, a: Attempt) -> Iterator[Level]:
        """L_1, L_2, ..., to the first empty one, whatever the verdict; a level
        is made when it is asked for.  Level 1 is counted whole in any attempt."""
        if self.candidate_filter is not None:
            raise ValueError("completed counts every set; a candidate filter is not applied")
        store, lk, k = self.store.child(f"seed{a.seed}"), None, 1
        while True:
            found = [] if k not in a.full_counts else [a.full_counts[k].select(*item_cols(k), SUPPORT)]
            if k > 1:
                found += self._missed(store, a, lk, k)
            if not found:
                last = F.col(f"item{k - 1}").alias(f"item{k}")
                lk = Level(k, lk.itemsets.where("false").select(*item_cols(k - 1), last, SUPPORT), 0, None)
            else:
                frequent = reduce(DataFrame.unionByName, found).where(F.col(SUPPORT) >= self.threshold)
                frequent = store.write(frequent, f"complete{k}")
                lk = Level(k, frequent, frequent.count(), None)
            yield lk
            if not lk.n or self.max_k is not None and k >= self.max_k:
                return
            k += 1

    def _missed(self, store: Store, a: Attempt, prev: Level, k: int) -> list[DataFrame]:
        """Counts of the sets of size k whose subsets are all frequent and that
        the attempt has not counted; no frame if there are none."""
        if k == 2:
            # the attempt has all pairs of sample-frequent items
            s1 = a.sample_levels[0]
            if anti_join(prev.itemsets, s1.itemsets, ["item1"], s1.n).isEmpty():
                return []
            frames, free = {1: prev.itemsets.select("item1")}, (2,)
        else:
            new = apriori_gen(prev.itemsets, k, prev.n)
            if k in a.full_counts:
                new = anti_join(new, a.full_counts[k], item_cols(k))
            new = store.write(new, f"missed{k}")
            if new.isEmpty():
                return []
            # level 1 of a tree says which items are walked: all, not the first ones only
            items = new.select(F.explode(F.array(*item_cols(k))).alias("item1")).distinct()
            frames = {1: items} | {j: new.select(*item_cols(j)).distinct() for j in range(2, k)} | {k: new}
            free = ()
        tree = Tree.build(frames, store, f"missed_tree{k}_")
        counts = tree.by_items(store.write(count(self.b, tree, k, free), f"missed_counts{k}"), k)
        counts = counts.select(*item_cols(k), SUPPORT)
        return [anti_join(counts, a.full_counts[2], item_cols(2)) if k == 2 and 2 in a.full_counts else counts]


def toivonen(baskets: Baskets, threshold: int, size: int, adjust: float = 1.0, seed: int = 0,
             max_iterations: int = 1, max_k: int | None = None) -> ToivonenResult:
    return Toivonen(baskets, threshold, size, adjust, seed, max_iterations, max_k).run()
