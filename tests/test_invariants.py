"""Randomised checks (fixed seeds): every strategy equals a brute-force
count, and the strategies' intermediate sets obey their invariants."""

import itertools
import random
from collections import Counter

import pytest

from basketry.operators.candidates import bitmap_filter
from basketry.plans.levels import LevelMiner
from basketry.plans.pcy import PCYMiner
from basketry.plans.scan import ScanMiner
from basketry.plans.son import SONMiner
from basketry.plans.toivonen import Toivonen
from basketry.plans.transactions import Baskets
from tests.conftest import rows


def brute(baskets: dict, t: int) -> list:
    out = []
    k = 1
    while True:
        c = Counter(s for items in baskets.values() for s in itertools.combinations(sorted(items), k))
        level = sorted(s + (n,) for s, n in c.items() if n >= t)
        out.append(level)
        if not level:
            return out
        k += 1


def random_baskets(seed: int, n: int = 60, items: int = 12, max_size: int = 7) -> dict:
    rnd = random.Random(seed)
    weights = [1.0 / (i + 1) for i in range(items)]      # a few popular items
    return {b: set(rnd.choices(range(items), weights, k=rnd.randint(0, max_size))) for b in range(n)}


@pytest.mark.parametrize("seed,t", [(1, 4), (2, 6)])
def test_strategies_equal_brute_force(spark, store, seed, t):
    data = random_baskets(seed)
    want = brute(data, t)
    df = spark.createDataFrame([(b, i) for b, items in data.items() for i in items], "basket bigint, item bigint")
    b = Baskets.prepare(df, store.child(f"rand{seed}"), hot_items=4)      # some baskets are salted
    assert b.salted
    pcy = PCYMiner(b, t, buckets=3)                                      # many collisions
    son = SONMiner(b, t, chunks=3)
    for m in (LevelMiner(b, t), ScanMiner(b, t), pcy, son):
        assert [rows(lvl.itemsets) for lvl in m.levels()] == want, type(m).__name__
    # SON candidates and PCY survivors contain every frequent itemset
    for k in range(1, len(want)):
        freq = {r[:-1] for r in want[k - 1]}
        assert freq <= set(rows(son.son_candidates[k]))
    for k, bm in pcy.bitmaps.items():
        if k - 1 < len(pcy.history) and pcy.history[k - 1].n:
            lk = pcy.history[k - 1].itemsets
            kept = bitmap_filter(lk, k, bm, pcy.hash_functions, pcy.buckets)
            assert kept.count() == lk.count()           # no frequent itemset in an infrequent bucket
    # Toivonen on the whole data as sample: border and sample-frequent are disjoint
    res = Toivonen(b, t, size=len(data), adjust=1.0, seed=seed).run()
    a = res.last
    assert res.status == "success"
    assert [rows(lvl.itemsets) for lvl in res.levels] == want
    for k, border in a.border.items():
        sample_freq = set(rows(a.sample_levels[k - 1].itemsets.select(*[f"item{i}" for i in range(1, k + 1)])))
        assert not (set(rows(border)) & sample_freq)
