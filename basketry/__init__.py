"""basketry: market-basket analytics (frequent itemsets) on Spark.

One definition of support -- the number of distinct baskets that contain
every item of a set -- and five strategies that must return the same rows:
DataFrame Apriori, basket-scan Apriori, multihash PCY, SON and Toivonen.
"""

from basketry.api import STRATEGIES, mine, mine_levels

__all__ = ["STRATEGIES", "mine", "mine_levels"]
