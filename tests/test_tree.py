"""Counting all sizes in one walk down a prefix tree, and what is built on it:
basket scan, two-pass SON, one-pass Toivonen."""

import random
from collections import Counter
from itertools import combinations

import pytest

from basketry import catalog
from basketry.functions.columns import BASKET, item_cols
from basketry.operators.candidates import monotonicity_prune
from basketry.operators.report import label_itemsets
from basketry.plans.levels import LevelMiner
from basketry.plans.scan import BasketScanMiner
from basketry.plans.son import TwoPassSON, local_counts
from basketry.plans.toivonen import Toivonen
from basketry.plans.transactions import Baskets
from basketry.plans.tree import Tree, count
from tests.conftest import rows


def leaves(df, part):
    """How often the optimized plan reads a table whose path ends in ``part``."""
    found = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    n = 0
    for i in range(found.size()):
        try:
            n += found.apply(i).relation().location().rootPaths().apply(0).toString().endswith(part)
        except Exception:  # noqa: BLE001 -- py4j: the leaf is no file scan
            pass
    return n


def data(seed, n=60, items=9, hot=0):
    rng = random.Random(seed)
    out = [(b, i) for b in range(n) for i in rng.sample(range(items), rng.randint(0, items - 2))]
    return out + [(1000 + h, i) for h in range(hot) for i in range(items)]


@pytest.fixture(scope="module", params=[0, 3])
def mined(request, spark, store):
    """Baskets (with and without hot ones, which are cut into blocks) and the support of every set."""
    d = data(request.param, hot=request.param)
    b = Baskets.prepare(spark.createDataFrame(d, "basket long, item long"), store.child(f"tree{request.param}"),
                        hot_items=4 if request.param else 1000)
    assert b.salted == bool(request.param)
    held = {}
    for basket, i in sorted(d):
        held.setdefault(basket, []).append(i)
    return b, Counter(c for x in held.values() for k in range(1, 6) for c in combinations(x, k))


def levels_of(supports, t, depth=9):
    out = {}
    for s, n in supports.items():
        if n >= t and len(s) <= depth:
            out.setdefault(len(s), []).append((*s, n))
    return {k: sorted(v) for k, v in out.items()}


def test_walk_counts_every_level(mined, store):
    b, supports = mined
    want = levels_of(supports, 6, 4)
    frames = {k: b.df.sparkSession.createDataFrame([r[:-1] for r in v], ", ".join(f"{c} long" for c in item_cols(k)))
              for k, v in want.items()}
    tree = Tree.build(frames, store, f"t{b.n_hot}-")
    counts = count(b, tree, 4)
    for k in want:
        assert rows(tree.by_items(counts, k)) == want[k]
    if not b.salted:
        assert leaves(counts, "/transactions") == 1
    # free pairs: all that occur of frequent items; free items: all
    free = count(b, Tree.build({1: frames[1]}, store, f"f{b.n_hot}-"), 2, free=(2,), all_items=True)
    assert free.where("parent = -1").count() == len([s for s in supports if len(s) == 1])
    frequent = {r[0] for r in want[1]}
    assert free.where("parent <> -1").count() == len([s for s in supports if len(s) == 2 and set(s) <= frequent])


@pytest.mark.parametrize("t", [4, 12])
def test_miners_agree_with_brute_force(mined, t):
    b, supports = mined
    want = levels_of(supports, t, 5)
    for m in (BasketScanMiner(b, t, max_k=5), TwoPassSON(b, t, chunks=3, max_k=5),
              TwoPassSON(b, t, chunks=lambda x: x % 2, max_k=5)):
        got = {lvl.k: rows(lvl.itemsets) for lvl in m.levels()}
        assert {k: v for k, v in got.items() if v} == want, m.name


def test_basket_scan_joins_no_basket(spark, store):
    b = Baskets.prepare(spark.createDataFrame(data(5), "basket long, item long"), store.child("scanplan"))
    m = BasketScanMiner(b, 5, max_k=3)
    done = list(m.levels())
    frames = {k: done[k - 1].itemsets for k in (1, 2)}
    plan = count(b, Tree.build(frames, store, "plan"), 2)._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Join" in x and "basket" in x]


def test_two_pass_takes_a_local_miner(mined):
    """Any grouped miner that finds a superset of the local results will do."""
    b, supports = mined
    seen = []

    def generous(miner, k, cand):
        seen.append(k)
        d = cand.select(miner.chunk_fn(cand[BASKET]).alias("chunk"), *item_cols(k)).distinct()
        return d if k < 3 else local_counts(miner, k, cand)

    m = TwoPassSON(b, 12, chunks=3, max_k=4, local=generous)
    got = {lvl.k: rows(lvl.itemsets) for lvl in m.levels()}
    assert {k: v for k, v in got.items() if v} == levels_of(supports, 12, 4) and seen[0] == 1


def test_two_pass_recounts_what_may_be_frequent(mined):
    """Chunks are mined whole; only itemsets whose bound reaches the threshold are counted again."""
    b, supports = mined
    for t, chunks, depth in ((3, 5, 4), (12, 3, 3)):
        m = TwoPassSON(b, t, chunks=chunks, max_k=depth)
        got = {lvl.k: rows(lvl.itemsets) for lvl in m.levels()}
        assert {k: v for k, v in got.items() if v} == levels_of(supports, t, depth)
        held = {s for s in supports if len(s) <= depth}
        union = {s for k in m.son_candidates for s in rows(m.son_candidates[k])}
        again = {s for k in m.recounted for s in rows(m.recounted[k])}
        frequent = {s for s in held if supports[s] >= t}
        assert frequent <= again <= union
        if m.most <= 1:
            assert union == held and again == frequent
        kept = [k for k in range(2, depth + 1) if m.store.complete(f"occ{k}")]
        assert bool(kept) == (m.most > 1 or b.salted)


def test_failed_toivonen_is_completed(mined, monkeypatch):
    b, supports = mined
    m = Toivonen(b, 5, size=3, adjust=1.5, seed=2, max_k=4)
    res = m.run()
    assert res.status == "failed" and not res.levels
    got = {lvl.k: rows(lvl.itemsets) for lvl in m.completed(res.last)}
    assert {k: v for k, v in got.items() if v} == levels_of(supports, 5, 4)
    m.result = res
    monkeypatch.setattr(catalog, "_toi", lambda spark, sf: m)
    for k in (2, 3):
        assert rows(catalog.q_toivonen_level(k)(None, "")) == got[k]


def test_toivonen_without_sample_items_is_completed(mined):
    """No item is sample-frequent: all levels are missed and made."""
    b, supports = mined
    m = Toivonen(b, 10, size=3, adjust=500, seed=2, max_k=3)
    res = m.run()
    assert res.status == "failed" and not res.last.sample_levels[0].n
    got = {lvl.k: rows(lvl.itemsets) for lvl in m.completed(res.last)}
    assert {k: v for k, v in got.items() if v} == levels_of(supports, 10, 3)


def test_toivonen_counts_all_levels_at_once(mined):
    b, supports = mined
    res = Toivonen(b, 10, size=50, adjust=0.5, seed=3, max_iterations=5, max_k=4).run()
    assert res.status == "success"
    got = {lvl.k: rows(lvl.itemsets) for lvl in res.levels if lvl.n}
    assert got == levels_of(supports, 10, 4)
    kept = res.last.full_counts
    assert {leaves(d, "/full_counts") for d in kept.values()} == {1}
    filtered = Toivonen(b, 10, size=50, adjust=0.5, seed=3, max_iterations=5, max_k=4,
                        candidate_filter=lambda c, k: c).run()
    assert {lvl.k: rows(lvl.itemsets) for lvl in filtered.levels if lvl.n} == got


@pytest.mark.parametrize("candidate_filter", [None, lambda c, k: c])
def test_toivonen_border_has_pairs_that_never_occur(spark, store, candidate_filter):
    d = [(b, i) for b in range(20) for i in (1, 2, 3) if i != b % 2 + 1] + [(90, 7), (91, 9)]
    b = Baskets.prepare(spark.createDataFrame(d, "basket long, item long"), store.child(f"never{candidate_filter is None}"))
    a = Toivonen(b, 5, size=22, adjust=1.0, seed=1, candidate_filter=candidate_filter).run().last
    assert {k: rows(x) for k, x in a.border.items()} == {1: [(7,), (9,)], 2: [(1, 2)], 3: []}
    assert a.n_border == 3 and a.success
    assert rows(a.full_counts[2]) == [(1, 3, 10, "frequent"), (2, 3, 10, "frequent")]


def test_pairs_are_made_in_cells(spark, monkeypatch):
    from basketry.operators import candidates

    l1 = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "item1 long")
    want = list(combinations(range(0, 60, 2), 2))
    for cell in (7, 1000):
        monkeypatch.setattr(candidates, "PAIR_CELL", cell)
        assert rows(candidates.apriori_gen(l1, 2, 30)) == want == rows(candidates.apriori_gen(l1, 2))
    assert rows(candidates.apriori_gen(l1.where("false"), 2, 0)) == []


def test_toivonen_attempt_is_resumed(spark, tmp_path):
    path = str(tmp_path / "tx")
    spark.createDataFrame(data(8), "basket long, item long").write.parquet(path)

    def run(force=False):
        b = Baskets.prepare(spark.read.parquet(path), reuse=True, force=force)
        t = Toivonen(b, 8, size=50, adjust=0.5, seed=1, max_iterations=3, max_k=3)
        wrote = []
        for s in (t.store.child(f"seed{1 + i}") for i in range(3)):
            wrote += [n for n in ("sample_keys", "sample_tx", "full_counts") if s.complete(n)]
        return t, wrote, [rows(lvl.itemsets) for lvl in t.run().levels]

    first, none, want = run()
    assert not none
    again, there, got = run()
    assert "full_counts" in there and got == want
    # killed before the full count: the sample is picked up, the rest made again
    from basketry.sources.store import delete_path

    last = again.store.child(f"seed{1 + len(again.run().attempts) - 1}")
    delete_path(spark, last.path("full_counts"))
    assert run()[2] == want
    assert not run(force=True)[1]


def test_prune_and_labels_join_once(spark):
    l2 = spark.createDataFrame([(a, b, c) for a, b, c in combinations(range(6), 3) if a + b + c != 7],
                               "item1 long, item2 long, item3 long")
    cand = spark.createDataFrame(list(combinations(range(6), 4)) * 2, "item1 long, item2 long, item3 long, item4 long")
    out = monotonicity_prune(cand, l2, 4)
    want = [c for c in combinations(range(6), 4) if all(sum(s) != 7 for s in combinations(c, 3))]
    assert rows(out) == sorted(want * 2)
    lk = spark.createDataFrame([(1, 2, 3, 9), (1, 2, 5, 9), (1, 2, 5, 9)], "item1 long, item2 long, item3 long, support long")
    names = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, name string")
    got = label_itemsets(lk, names, "id", "name")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(9, 1, "a", 2, None, 3, "c"), (9, 1, "a", 2, None, 5, None), (9, 1, "a", 2, None, 5, None)], key=str)
    for d in (out, got):
        assert d._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
