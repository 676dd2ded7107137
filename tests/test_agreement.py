"""All strategies return the same rows on the test tables; golden counts
from FIXTURES.md; the salted self-join equals the plain one."""

import pytest

from basketry.plans.levels import LevelMiner
from basketry.plans.pcy import PCYMiner
from basketry.plans.scan import ScanMiner
from basketry.plans.son import SONMiner
from basketry.plans.transactions import Baskets
from basketry.sources import tables as T
from tests.conftest import SF001, rows


def run_all(b, t):
    out = {}
    for name, m in [("apriori", LevelMiner(b, t)), ("apriori_scan", ScanMiner(b, t)),
                    ("pcy", PCYMiner(b, t, buckets=101)), ("son", SONMiner(b, t, chunks=4)),
                    ("son_prefix", SONMiner(b, t, chunks=3, prune="prefix"))]:
        out[name] = [rows(lvl.itemsets) for lvl in m.levels()]
    return out


@pytest.fixture(scope="module")
def supp(spark, store):
    return Baskets.prepare(T.supp_transactions(spark, SF001), store.child("supp001"))


def test_supp_golden_and_agreement(supp):
    res = run_all(supp, 2)
    first = res["apriori"]
    assert [len(x) for x in first] == [10, 45, 120, 70, 3, 0]
    for name, levels in res.items():
        assert levels == first, name


def test_brand_golden_and_agreement(spark, store):
    b = Baskets.prepare(T.brand_transactions(spark, SF001), store.child("brand001"))
    res = run_all(b, 10)
    assert [len(x) for x in res["apriori"]] == [25, 295, 154, 0]
    for name, levels in res.items():
        assert levels == res["apriori"], name


def test_salted_join_equals_plain(spark, store, supp):
    hot = Baskets.prepare(T.supp_transactions(spark, SF001), store.child("supp001-hot"), hot_items=2)
    assert hot.n_hot > 0 and hot.salted
    plain = [rows(lvl.itemsets) for lvl in LevelMiner(supp, 2).levels()]
    salted = [rows(lvl.itemsets) for lvl in LevelMiner(hot, 2).levels()]
    assert salted == plain
    salted_scan = [rows(lvl.itemsets) for lvl in ScanMiner(hot, 2).levels()]
    assert salted_scan == plain


def test_downward_closure_and_threshold(supp):
    levels = list(LevelMiner(supp, 3).levels())
    sets = [{tuple(r[:-1]) for r in rows(lvl.itemsets)} for lvl in levels]
    for k in range(1, len(sets)):
        for s in sets[k]:
            for i in range(len(s)):
                sub = s[:i] + s[i + 1:]
                assert sub in sets[k - 1]
    higher = [lvl.n for lvl in LevelMiner(supp, 4).levels()]
    lower = [lvl.n for lvl in levels]
    assert all(h <= lo for h, lo in zip(higher, lower))


def test_fpgrowth_second_oracle(spark, supp):
    from pyspark.ml.fpm import FPGrowth
    from pyspark.sql import functions as F
    wide = supp.df.groupBy("basket").agg(F.collect_set("item").alias("items"))
    n = wide.count()
    model = FPGrowth(itemsCol="items", minSupport=2 / n - 1e-12).fit(wide)
    fi = model.freqItemsets.where(F.col("freq") >= 2)
    by_k = fi.groupBy(F.size("items").alias("k")).count()
    got = {r["k"]: r["count"] for r in by_k.collect()}
    assert got == {1: 10, 2: 45, 3: 120, 4: 70, 5: 3}


def test_plans_stay_short_across_levels(supp):
    """Every level starts from written tables, so plan size does not grow
    with the level number (a cached table would carry all lineage)."""
    for miner in (PCYMiner(supp, 2, buckets=101), SONMiner(supp, 2, chunks=3), ScanMiner(supp, 2)):
        sizes = [len(lvl.itemsets._jdf.queryExecution().optimizedPlan().toString()) for lvl in miner.levels()]
        assert max(sizes) < 20000, (type(miner).__name__, sizes)


def test_hot_baskets_a_third_of_rows_each(spark, store):
    """basket = order status: three baskets, each about a third of all rows.
    The salted self-join (5 x 5 cells per basket) gives the brute-force
    pair supports."""
    import itertools
    from collections import Counter

    from pyspark.sql import functions as F
    from tests.conftest import SF01
    li = T.table(spark, SF01, "lineitem").select("l_orderkey", "l_suppkey")
    od = T.table(spark, SF01, "orders").select("o_orderkey", "o_orderstatus")
    tx = li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_orderstatus").alias("basket"), F.col("l_suppkey").alias("item"))
    b = Baskets.prepare(tx, store.child("hot-status"), hot_items=20)
    assert b.n_hot == 3
    got = [rows(lvl.itemsets) for lvl in LevelMiner(b, 2, max_k=2).levels()]
    baskets = {}
    for r in tx.distinct().collect():
        baskets.setdefault(r["basket"], set()).add(r["item"])
    pairs = Counter(p for items in baskets.values() for p in itertools.combinations(sorted(items), 2))
    assert got[1] == sorted((a, c, n) for (a, c), n in pairs.items() if n >= 2)
