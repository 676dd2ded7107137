"""Connected components of a large graph, by alternating star operations.

``large star``: every node links its larger neighbours to the smallest node
it sees; ``small star``: the same for its smaller neighbours and itself.  Both
keep the components; the edges become stars around the smallest nodes in a
number of rounds that grows with the logarithm of the longest path.  Each
round aggregates before its shuffle and joins on the node, so a centre with
very many neighbours is split by the skew join like any hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Store


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` reaches.
    Nodes without an edge to another node are not listed."""
    store = Store(edges.sparkSession)
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e, n = _kept(store, e, 0)
    turn = 0
    while n:
        turn += 1
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u > v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        new, n = _kept(store, small.where("u > v").distinct(), turn)
        same = n == e.count() and new.join(e, ["u", "v"], "left_anti").isEmpty()
        e = new
        if same:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _kept(store: Store, e: DataFrame, turn: int) -> tuple[DataFrame, int]:
    e = store.write(e, f"edges{turn}")
    return e, e.count()
