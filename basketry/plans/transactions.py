"""From relational tables to transactions (M0, P1-P3, J1, J2) and the
prepared, mining-ready form of them.

Canonical model: one row per (basket, item), distinct, no nulls.  Duplicate
(basket, item) rows would otherwise count a basket twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import BASKET, ITEM, SALT
from basketry.operators.skew import DEFAULT_HOT_ITEMS, attach_salt, hot_baskets
from basketry.sources.store import Store, cache_key, input_identity


def _cond(c: Column | str | None) -> Column | None:
    if c is None:
        return None
    return F.expr(c) if isinstance(c, str) else c


def extract_transactions(facts: DataFrame, baskets: DataFrame, *, fact_basket: str, basket_key: str,
                         item: str, fact_filter: Column | str | None = None,
                         basket_filter: Column | str | None = None,
                         labels: DataFrame | None = None, label_key: str | None = None,
                         label: str | None = None, distinct: bool = True) -> DataFrame:
    """M0: ``facts`` (one row per basket member) inner-joined to the kept
    ``baskets`` (J1), optionally left-joined to a label table (J2), projected
    to ``basket, item[, item_name]`` (P3).  Filters (P1, P2) are applied to
    the scans, so they reach the parquet reader as pushed filters.

    The facts-baskets join is on the basket key, so after it the rows are
    hash-partitioned by basket and ``distinct`` adds no shuffle.
    """
    f = facts
    if _cond(fact_filter) is not None:
        f = f.where(_cond(fact_filter))
    b = baskets
    if _cond(basket_filter) is not None:
        b = b.where(_cond(basket_filter))
    t = (f.select(F.col(fact_basket).alias(BASKET), F.col(item).alias(ITEM))
         .join(b.select(F.col(basket_key).alias(BASKET)), on=BASKET))
    if distinct:
        t = t.dropDuplicates([BASKET, ITEM])
    if labels is None:
        return t
    lab = labels.select(F.col(label_key).alias(ITEM), F.col(label).alias("item_name"))
    return t.join(lab, on=ITEM, how="left").select(BASKET, ITEM, "item_name")


def to_transactions(df: DataFrame, basket: str = BASKET, item: str = ITEM) -> DataFrame:
    """Any (basket, item) frame -> canonical: renamed, nulls dropped, distinct."""
    return (df.select(F.col(basket).alias(BASKET), F.col(item).alias(ITEM))
            .where(F.col(BASKET).isNotNull() & F.col(ITEM).isNotNull())
            .dropDuplicates([BASKET, ITEM]))


@dataclass
class Baskets:
    """Prepared transactions, written once to the run's store.

    ``df`` has ``basket, item`` and, only when some basket is larger than
    ``hot_items``, a ``salt`` column used by the salted self-join.
    """

    df: DataFrame
    store: Store
    hot_items: int
    n_hot: int
    _n_baskets: int | None = None

    reuse: bool = False

    @classmethod
    def prepare(cls, df: DataFrame, store: Store | None = None, basket: str = BASKET, item: str = ITEM,
                hot_items: int = DEFAULT_HOT_ITEMS, reuse: bool = False, force: bool = False,
                input_version: str | None = None) -> "Baskets":
        """Write the canonical transactions once.  With ``reuse`` the store
        is keyed by the input's identity and parameters (S10): a finished
        earlier run is read instead of recomputed, and miners built on these
        baskets reuse their finished levels too; ``force`` recomputes.  Data
        that are not files need an ``input_version`` of the caller's."""
        spark = df.sparkSession
        if reuse:
            key = cache_key(input=input_identity(df, input_version), basket=basket, item=item, hot_items=hot_items)
            store = Store(spark, root=store.root if store else None, run=f"tx-{key}")
            if force:
                store.clear()
            if store.complete("hot_baskets") and store.complete("transactions"):
                n_hot = store.read("hot_baskets").count()
                name = "transactions_salted" if n_hot else "transactions"
                if store.complete(name):
                    return cls(store.read(name), store, hot_items, n_hot, reuse=True)
        store = store or Store(spark)
        t = store.write(to_transactions(df, basket, item), "transactions")
        hot = hot_baskets(t, hot_items)
        hot = store.write(hot, "hot_baskets")
        n_hot = hot.count()
        if n_hot:
            t = store.write(attach_salt(t, hot, n_hot), "transactions_salted")
        return cls(t, store, hot_items, n_hot, reuse=reuse)

    @property
    def salted(self) -> bool:
        return SALT in self.df.columns

    def close(self) -> None:
        """Delete every table of these baskets and of the runs over them."""
        self.store.clear()

    def spark_empty(self, columns: list[Column]) -> DataFrame:
        """No rows with these columns."""
        return self.df.sparkSession.range(0).select(*columns)

    def n_baskets(self) -> int:
        if self._n_baskets is None:
            self._n_baskets = self.df.select(BASKET).distinct().count()
        return self._n_baskets
