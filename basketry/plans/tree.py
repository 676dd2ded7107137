"""Counting itemsets of all sizes in one pass over the baskets.

The itemsets to count form a prefix tree: a node is an itemset, its parent the
itemset without its last item.  ``Tree`` holds one table a level, (parent, item,
node), made from itemset tables by one join a level; node ids are unique over
all levels.  ``blocks`` are the baskets as sorted item arrays, each item with
its level-1 node.

``count`` walks all baskets down the tree in one linear plan: a row is a node
that the basket holds and the basket's items after its last one; a step emits
the row itself, for the count, and one row for each of these items whose child
the tree's next level has.  Nothing is written on the way, the transactions are
read once, and at the end all levels are counted in one aggregate with map-side
combine.  A level may be *free*: every extension is counted, also those without
a node (pairs of frequent items, say, of which no table is made).

Scale: levels are broadcast only if their exact size allows, otherwise a step is
a shuffle join.  Hot baskets are cut into blocks; a row of such a basket meets
the basket's other blocks through a join on (basket, block), so no task holds
the basket and no pair of blocks is one key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import BASKET, ITEM, SALT, SUPPORT, item_cols
from basketry.operators.joins import broadcast_if_small
from basketry.plans.transactions import Baskets
from basketry.sources.store import Store

ROOT = -1
#: Low bits of a node id that hold its level.
LEVEL_BITS = 6
#: Blocks of a hot basket for each ``hot_items`` items of it.
BLOCKS_PER_SALT = 40


@dataclass
class Tree:
    levels: dict[int, DataFrame]   # k -> parent, item, node
    sizes: dict[int, int]          # k -> rows of it, exact
    named: dict[int, DataFrame]    # k -> item1..itemk, node

    @classmethod
    def build(cls, itemsets: dict[int, DataFrame], store: Store, name: str = "tree") -> "Tree":
        """From tables item1..itemk for k = 1, 2, ...; every prefix of an
        itemset must be in the table one size below."""
        tree = cls({}, {}, {})
        for k in sorted(itemsets):
            cols = item_cols(k)
            d = itemsets[k].select(*cols)
            if k == 1:
                d = d.withColumn("parent", F.lit(ROOT).cast("bigint"))
            else:
                d = d.join(tree.named[k - 1].withColumnRenamed("node", "parent"), on=cols[:-1])
            node = F.shiftleft(F.monotonically_increasing_id(), LEVEL_BITS) + F.lit(k)
            tree._add(k, store.write(d.select(*cols, "parent", node.alias("node")), f"{name}{k}"))
        return tree

    @classmethod
    def reread(cls, store: Store, depth: int, name: str = "tree") -> "Tree":
        """A tree that was built before."""
        tree = cls({}, {}, {})
        for k in range(1, depth + 1):
            tree._add(k, store.read(f"{name}{k}"))
        return tree

    def _add(self, k: int, d: DataFrame) -> None:
        cols = item_cols(k)
        self.named[k] = d.select(*cols, "node")
        self.levels[k] = d.select("parent", F.col(cols[-1]).alias(ITEM), "node")
        self.sizes[k] = d.count()

    def by_items(self, counts: DataFrame, k: int) -> DataFrame:
        """Level k of ``counts`` (parent, item, ...) as item1..itemk, ...."""
        rest = [c for c in counts.columns if c not in ("parent", ITEM)]
        last = F.col(ITEM).alias(f"item{k}")
        if k == 1:
            return counts.where(F.col("parent") == ROOT).select(last, *rest)
        up = broadcast_if_small(self.named[k - 1].withColumnRenamed("node", "parent"), self.sizes[k - 1])
        return counts.join(up, on="parent").select(*item_cols(k - 1), last, *rest)


def blocks(b: Baskets, tree: Tree, all_items: bool = False) -> DataFrame:
    """(basket, block, blocks, items: array of (item, node) in order).  Items
    that are no node of level 1 are left out unless ``all_items``."""
    first = broadcast_if_small(tree.levels[1].select(ITEM, "node"), tree.sizes[1])
    d = b.df.join(first, on=ITEM, how="left" if all_items else "inner")
    n = F.when(F.col(SALT) > 1, F.col(SALT) * BLOCKS_PER_SALT).otherwise(1) if b.salted else F.lit(1)
    block = F.pmod(F.xxhash64(ITEM), n).cast("int")
    return (d.groupBy(BASKET, block.alias("block"), n.cast("int").alias("blocks"))
            .agg(F.sort_array(F.collect_list(F.struct(ITEM, "node"))).alias("items")))


def count(b: Baskets, tree: Tree, depth: int, free: tuple[int, ...] = (), all_items: bool = False,
          chunk=None) -> DataFrame:
    """(parent, item, support) of every node of the levels 1 to ``depth`` that
    some basket holds, and of every extension on ``free`` levels; ``chunk``, a
    function of the basket column, adds a column to group by."""
    whole = blocks(b, tree, all_items)
    hot = b.salted
    keys = [BASKET, "block", "blocks"] if hot else [BASKET] if chunk is not None else []
    none = F.array().cast(f"array<{dict(b.df.dtypes)[ITEM]}>")

    def grown(items, at):
        """The items behind place ``at`` that have a node."""
        rest = F.filter(F.slice(items, at + 2, F.greatest(F.size(items), F.lit(1))), lambda x: x["node"].isNotNull())
        return F.transform(rest, lambda x: x[ITEM])

    d = whole.select(*keys, "items", F.posexplode("items").alias("at", "x"))
    d = d.select(*keys, F.lit(ROOT).cast("bigint").alias("parent"), F.col(f"x.{ITEM}").alias(ITEM), F.col("x.node").alias("node"),
                 F.when(F.col("x.node").isNotNull(), grown(F.col("items"), F.col("at"))).otherwise(none).alias("rest"))
    d = d.withColumn("counted", F.lit(True))
    for k in range(2, depth + 1):
        if hot:
            # the basket's other blocks: rows that are extended but not counted again
            away = d.where((F.col("blocks") > 1) & F.col("node").isNotNull())
            away = away.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("_other <> block")
            other = whole.where("blocks > 1").select(F.col(BASKET), F.col("block").alias("_other"), F.col("items").alias("_items"))
            later = F.filter("_items", lambda x: x["node"].isNotNull() & (x[ITEM] > F.col(ITEM)))
            away = away.join(other, [BASKET, "_other"]).select(
                BASKET, F.col("_other").alias("block"), "blocks", "parent", ITEM, "node",
                F.transform(later, lambda x: x[ITEM]).alias("rest"), F.lit(False).alias("counted"))
            d = d.unionByName(away)
        # place 0 is the row itself, the others its extensions
        low, high = F.when(F.col("counted"), 0).otherwise(1), F.when(F.col("node").isNotNull(), F.size("rest")).otherwise(0)
        d = d.where(F.col("counted") | (F.size("rest") > 0)).withColumn("_at", F.explode(F.sequence(low, high)))
        own = F.col("_at") == 0
        d = d.select(*keys, F.when(own, F.col("parent")).otherwise(F.col("node")).alias("parent"),
                     F.when(own, F.col(ITEM)).otherwise(F.get("rest", F.col("_at") - 1)).alias(ITEM), own.alias("_own"),
                     F.when(own, none).otherwise(F.slice("rest", F.col("_at") + 1, F.greatest(F.size("rest"), F.lit(1)))).alias("rest"))
        # rows of lower levels have no node here: ids are unique over levels
        if k in tree.levels:
            d = d.join(broadcast_if_small(tree.levels[k], tree.sizes[k]), on=["parent", ITEM], how="left")
        else:
            d = d.withColumn("node", F.lit(None).cast("bigint"))
        if k not in free:
            d = d.where(F.col("_own") | F.col("node").isNotNull())
        d = d.select(*keys, "parent", ITEM, "node", "rest", F.lit(True).alias("counted"))
    by = ["parent", ITEM] if chunk is None else [chunk(F.col(BASKET)).alias("chunk"), "parent", ITEM]
    return d.groupBy(*by).agg(F.count(F.lit(1)).alias(SUPPORT))
