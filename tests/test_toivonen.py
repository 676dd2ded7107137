"""Toivonen fixtures (FIXTURES.md 3.4): one success, one failure, pinned."""

import pytest

from basketry.plans.toivonen import Toivonen
from basketry.plans.transactions import Baskets
from basketry.sources import tables as T
from tests.conftest import SF01


@pytest.fixture(scope="module")
def brand(spark, store):
    return Baskets.prepare(T.brand_transactions(spark, SF01), store.child("brand01"))


def test_success_case(brand):
    res = Toivonen(brand, 400, size=7500, adjust=0.8, seed=42).run()
    a = res.last
    assert res.status == "success"
    assert [lvl.n for lvl in a.sample_levels] == [25, 159, 0]
    assert a.n_border == 726 and a.n_border_frequent == 0
    assert [lvl.n for lvl in res.levels] == [25, 26, 0]


def test_failure_case_retries(brand):
    res = Toivonen(brand, 60, size=7500, adjust=0.8, seed=42, max_iterations=2).run()
    assert res.status == "failed"
    assert [a.seed for a in res.attempts] == [42, 43]
    assert [a.n_border for a in res.attempts] == [3004, 2613]
    assert [a.n_border_frequent for a in res.attempts] == [5, 9]
    assert res.levels == []
