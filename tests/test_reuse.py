"""Result reuse (S10): keyed by input identity and parameters."""

import pytest
from pyspark.sql import functions as F

from basketry.plans.levels import LevelMiner
from basketry.plans.pcy import PCYMiner
from basketry.plans.son import SONMiner
from basketry.plans.transactions import Baskets
from basketry.sources import tables as T
from basketry.sources.store import input_identity
from tests.conftest import SF001, rows


def test_identity_ignores_expression_ids_but_not_filters(spark):
    a = T.supp_transactions(spark, SF001)
    b = T.supp_transactions(spark, SF001)
    assert input_identity(a) == input_identity(b)
    assert input_identity(a) != input_identity(T.supp_all_transactions(spark, SF001))


def test_second_run_reads_finished_levels(spark):
    first = Baskets.prepare(T.supp_transactions(spark, SF001), reuse=True, force=True)
    again = Baskets.prepare(T.supp_transactions(spark, SF001), reuse=True)
    assert again.store.root == first.store.root
    for make in (lambda b: LevelMiner(b, 2), lambda b: PCYMiner(b, 2, buckets=101),
                 lambda b: SONMiner(b, 2, chunks=3)):
        done = [rows(lvl.itemsets) for lvl in make(first).levels()]
        m = make(again)
        assert all(m.reused(k) is not None for k in range(1, len(done) + 1))
        assert [rows(lvl.itemsets) for lvl in m.levels()] == done
    # other parameters do not collide with the finished run
    assert LevelMiner(again, 3).reused(1) is None


def test_force_recomputes(spark):
    Baskets.prepare(T.supp_transactions(spark, SF001), reuse=True)
    fresh = Baskets.prepare(T.supp_transactions(spark, SF001), reuse=True, force=True)
    assert LevelMiner(fresh, 2).reused(1) is None


MICRO = [(n, x) for n, items in enumerate(["mcb", "mpj", "mb", "cj", "mpb", "mcbj", "cbj", "bc"], 1) for x in items]


def micro(spark, store, name):
    path = store.path(name)
    spark.createDataFrame(MICRO, "basket int, item string").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def sizes(miner):
    return [lvl.n for lvl in miner.levels()]


def test_a_filtered_run_does_not_poison_an_unfiltered_one(spark, store):
    b = Baskets.prepare(micro(spark, store, "micro-filter"), reuse=True, force=True)
    assert sizes(LevelMiner(b, 3, candidate_filter=lambda c, k: c.where(F.col("item1") == "b").where("item2 = 'c'"))) == [4, 1, 0]
    assert sizes(LevelMiner(b, 3)) == [4, 3, 0]
    assert sizes(LevelMiner(b, 3)) == [4, 3, 0]


def test_identity_sees_content(spark, store):
    one, two = (spark.createDataFrame([(1, x)], "basket int, item string") for x in "qr")
    for d in (one, two):
        with pytest.raises(ValueError):
            input_identity(d)
    assert input_identity(one, "v1") != input_identity(one, "v2")
    path = store.path("identity")
    spark.range(200).select((F.col("id") % 9).alias("basket"), F.col("id").alias("item"),
                            *[F.lit(i).alias(f"c{i}") for i in range(40)]).write.mode("overwrite").parquet(path)
    d = spark.read.parquet(path)
    ids = [input_identity(d.where(F.col("item").isin(*range(0, 118, 2), x))) for x in (119, 199)]
    assert ids[0] != ids[1]
    wide = [f"c{i}" for i in range(39)]
    assert input_identity(d.select(*wide, F.col("c39").alias("item"))) != input_identity(d.select(*wide, (F.col("c39") + 5).alias("item")))
    before = input_identity(d)
    spark.range(3).select(F.col("id").alias("basket"), F.col("id").alias("item"),
                          *[F.lit(i).alias(f"c{i}") for i in range(40)]).write.mode("overwrite").parquet(path)
    assert input_identity(spark.read.parquet(path)) != before


def test_two_runs_stay_readable(spark, store):
    b = Baskets.prepare(micro(spark, store, "micro-two"))
    first = list(LevelMiner(b, 3).levels())
    second = list(LevelMiner(b, 3, max_k=2).levels())
    assert [rows(x.itemsets) for x in first[:2]] == [rows(x.itemsets) for x in second]


def test_hash_functions_are_known_by_what_they_compute(spark, store):
    b = Baskets.prepare(micro(spark, store, "micro-hash"), reuse=True, force=True)
    make = lambda s: (lambda items, n: F.pmod(F.xxhash64(F.lit(s), *items), F.lit(n)))
    assert PCYMiner(b, 3, 7, [make(1)]).store.root != PCYMiner(b, 3, 7, [make(2)]).store.root


def test_public_occurrences_have_one_schema(spark, store):
    tx = micro(spark, store, "micro-salt")
    plain, hot = (list(LevelMiner(Baskets.prepare(tx, hot_items=h), 3).levels()) for h in (100, 1))
    assert [x.occurrences.columns for x in plain[:2]] == [x.occurrences.columns for x in hot[:2]] == [
        ["basket", "item1"], ["basket", "item1", "item2"]]


def test_null_chunks_are_a_chunk(spark):
    df = spark.range(1000).select(F.col("id").alias("basket"), F.explode(F.array(F.lit(1), F.lit(2))).alias("item"))
    m = SONMiner(Baskets.prepare(df), 600, chunks=lambda b: F.when(b % 2 == 0, F.lit(1)))
    assert rows(next(iter(m.levels())).itemsets) == [(1, 1000), (2, 1000)]
