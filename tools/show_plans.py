"""Print the physical plans of the main steps (``explain('formatted')``
trees only) for the SUPP fixture; used to write PLANS.md."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from basketry.functions.columns import item_cols  # noqa: E402
from basketry.operators.aggregates import bucket_counts, count_support, support_filter  # noqa: E402
from basketry.operators.joins import extend_occurrences, semi_join  # noqa: E402
from basketry.operators.sampling import sample_baskets  # noqa: E402
from basketry.plans.levels import LevelMiner  # noqa: E402
from basketry.plans.transactions import Baskets  # noqa: E402
from basketry.session import local_session  # noqa: E402
from basketry.sources import tables as T  # noqa: E402
from basketry.sources.store import Store  # noqa: E402


def tree(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    keep = []
    for line in text.splitlines():
        if line.startswith("(") and "Scan parquet" in line:
            keep.append(line)
        elif line.startswith(("PushedFilters", "ReadSchema", "Join condition", "Join type")):
            keep.append("    " + line)
        elif not line.startswith("(") and line.strip() and not line.startswith(
                ("Output", "Input", "Arguments", "Batched", "Location", "Keys", "Functions",
                 "Aggregate", "Results", "Condition", "Left keys", "Right keys", "Subquery",
                 "Join condition", "Join type", "Generator", "PartitionFilters", "Statistics")):
            keep.append(line)
    return "\n".join(keep)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    # show the plans a cluster would get: no broadcast chosen from tiny local files
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    tx = T.supp_transactions(spark, sf)
    b = Baskets.prepare(tx, Store(spark))
    hot = Baskets.prepare(tx, Store(spark), hot_items=3)
    m = LevelMiner(b, 2, max_k=2)
    levels = list(m.levels())
    occ1 = semi_join(b.df.withColumnRenamed("item", "item1"), levels[0].itemsets, ["item1"])
    cand2 = extend_occurrences(occ1, 2)
    hot_occ1 = hot.df.withColumnRenamed("item", "item1")
    steps = {
        "M0 extract_transactions (filters pushed to both scans, join on the order key)": tx,
        "A2+P5 level 1: count per item, partial + final aggregate": support_filter(
            count_support(b.df.withColumnRenamed("item", "item1"), 1), 2),
        "J3+A2 level 2: prefix self-join on basket (one shuffle, reused by both sides), count": support_filter(
            count_support(cand2, 2), 2),
        "J3 salted self-join (hot baskets split into cells; normal baskets plain)": extend_occurrences(hot_occ1, 2),
        "J6 occurrences of L2 (semi join; broadcast only below the checked size)": semi_join(
            cand2, levels[1].itemsets, item_cols(2)),
        "A4 PCY bucket counts (bounded groups, partial aggregate)": bucket_counts(
            cand2, 2, __import__("basketry.functions.hashing", fromlist=["x"]).DEFAULT_HASHES, 10007),
        "T1 Toivonen sample (top-k by md5: per-task top-k, one bounded merge)": sample_baskets(b.df, 1000, 42),
        "A9 chunk sizes": b.df.select((F.col("basket") % 5).alias("chunk"), "basket").distinct()
        .groupBy("chunk").count(),
    }
    for title, df in steps.items():
        print(f"## {title}\n\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main()
