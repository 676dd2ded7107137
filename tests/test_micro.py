"""Hand-checked micro baskets (FIXTURES.md section 2), every strategy."""

import pytest

from basketry import mine
from basketry.plans.transactions import Baskets
from tests.conftest import rows

MICRO = {"B1": "mcb", "B2": "mpj", "B3": "mb", "B4": "cj", "B5": "mpb", "B6": "mcbj", "B7": "cbj", "B8": "bc"}
EXPECTED = [
    [("b", 6), ("c", 5), ("j", 4), ("m", 5)],
    [("b", "c", 4), ("b", "m", 4), ("c", "j", 3)],
    [],
]
STRATEGIES = [
    ("apriori", {}),
    ("apriori_scan", {}),
    ("pcy", {"buckets": 7}),
    ("son", {"chunks": 3}),
    ("toivonen", {"size": 8, "adjust": 1.0, "seed": 1}),
]


def micro_df(spark, extra=()):
    data = [(b, i) for b, items in MICRO.items() for i in items] + list(extra)
    return spark.createDataFrame(data, "basket string, item string")


def as_rows(levels):
    return [rows(lk) for lk in levels]


@pytest.mark.parametrize("strategy,opts", STRATEGIES)
def test_micro_levels(spark, store, strategy, opts):
    got = as_rows(mine(micro_df(spark), 3, strategy, store=store, **opts))
    assert got == EXPECTED


def test_duplicates_and_nulls_do_not_count(spark, store):
    df = micro_df(spark, extra=[("B1", "m"), ("B1", "m"), ("B2", None), (None, "m")])
    assert as_rows(mine(df, 3, store=store)) == EXPECTED


def test_empty_input_gives_one_empty_level(spark, store):
    df = spark.createDataFrame([], "basket string, item string")
    levels = mine(df, 3, store=store)
    assert len(levels) == 1 and levels[0].count() == 0
    assert levels[0].columns == ["item1", "support"]


def test_threshold_above_everything(spark, store):
    levels = mine(micro_df(spark), 9, store=store)
    assert len(levels) == 1 and levels[0].count() == 0


def test_threshold_must_be_positive(spark, store):
    with pytest.raises(ValueError):
        mine(micro_df(spark), 0, store=store)


def test_max_k_stops_early(spark, store):
    levels = mine(micro_df(spark), 3, max_k=1, store=store)
    assert as_rows(levels) == EXPECTED[:1]


def test_prepared_baskets_are_reused(spark, store):
    b = Baskets.prepare(micro_df(spark), store)
    assert as_rows(mine(b, 3)) == as_rows(mine(b, 3, "apriori_scan")) == EXPECTED


def test_candidate_filter_hook_only_prunes(spark, store):
    from pyspark.sql import functions as F
    no_j = lambda cand, k: cand.where(~F.array_contains(F.array(*[F.col(f"item{i}") for i in range(1, k + 1)]),
                                                      F.lit("j")))
    got = as_rows(mine(micro_df(spark), 3, store=store, candidate_filter=no_j))
    assert got == [EXPECTED[0], [("b", "c", 4), ("b", "m", 4)], []]


def test_pcy_without_buckets_is_plain_scan(spark, store):
    assert as_rows(mine(micro_df(spark), 3, "pcy", store=store, buckets=0)) == EXPECTED
