"""Column functions and small operators against plain Python."""

import itertools
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from basketry.functions.combos import array_combinations, subsets_minus_one
from basketry.functions.hashing import hash_product, hash_weighted, seeded_xxhash
from basketry.functions.ids import format_item_id, parse_item_id
from basketry.operators.candidates import apriori_gen
from basketry.operators.windows import consecutive_index
from basketry.plans.toivonen import sample_threshold
from tests.conftest import rows


def test_array_combinations_match_itertools(spark):
    data = [([1, 2, 3, 4, 5],), ([7],), ([],), ([3, 1, 2],)]
    df = spark.createDataFrame(data, "a array<int>")
    for k in (1, 2, 3):
        got = [r[0] for r in df.select(array_combinations("a", k)).collect()]
        want = [[list(c) for c in itertools.combinations(a, k)] for (a,) in data]
        assert got == want


def test_subsets_minus_one():
    assert subsets_minus_one(3) == [["item2", "item3"], ["item1", "item3"], ["item1", "item2"]]


def test_hashes_match_python(spark):
    B = 1009
    pairs = [(0, 5), (3, 7), (999, 1000), (123456789, 987654321)]
    df = spark.createDataFrame(pairs, "item1 bigint, item2 bigint")
    items = [F.col("item1"), F.col("item2")]
    got = df.select(hash_product(items, B).alias("h1"), hash_weighted(items, B).alias("h2")).collect()
    for (x, y), r in zip(pairs, got):
        assert r["h1"] == (x * y) % B
        assert r["h2"] == (1 * x * 2 * y) % B
    xs = df.select(seeded_xxhash(7)(items, B).alias("h")).collect()
    assert all(0 <= r["h"] < B for r in xs)


def test_item_id_codec_keeps_long_ids(spark):
    df = spark.createDataFrame([(123,), (12345678,), (0,)], "x bigint")
    out = df.select(format_item_id("x").alias("s")).select("s", parse_item_id("s").alias("back")).collect()
    assert [r["s"] for r in out] == ["nm0000123", "nm12345678", "nm0000000"]
    assert [r["back"] for r in out] == [123, 12345678, 0]
    bad = spark.createDataFrame([("nmXYZ",)], "s string").select(parse_item_id("s").alias("v")).collect()
    assert bad[0]["v"] is None


def test_consecutive_index_equals_row_number(spark):
    from pyspark.sql import Window
    df = spark.range(0, 500).select((F.col("id") * 7 % 503).alias("basket"), (F.col("id") % 3).alias("chunk"))
    got = rows(consecutive_index(df, ["basket"], ["chunk"]), ["chunk", "basket", "row_number"])
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("chunk").orderBy("basket")))
    assert got == rows(ref, ["chunk", "basket", "rn"])


def test_apriori_gen(spark):
    l2_sets = [(1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 5)]
    l2 = spark.createDataFrame([(a, b, 3) for a, b in l2_sets], "item1 bigint, item2 bigint, support bigint")
    got = rows(apriori_gen(l2, 3, len(l2_sets)))
    items = sorted({i for s in l2_sets for i in s})
    want = sorted(c for c in itertools.combinations(items, 3)
                  if all(sub in l2_sets for sub in itertools.combinations(c, 2)))
    assert got == want == [(1, 2, 3), (1, 2, 4)]
    # hot prefixes (more than 1 itemset per prefix) take the salted join: same answer
    assert rows(apriori_gen(l2, 3, len(l2_sets), hot_items=1)) == want


def test_sample_threshold_is_exact_ceiling():
    assert sample_threshold(60, 0.5, 10000, 14743) == 21
    assert sample_threshold(10, 0.5, 100, 100) == 5          # exact, no float drift
    assert sample_threshold(3, 0.1, 10, 10) == 1
    v = Fraction("0.8") * 7500 * 60 / 14743
    assert sample_threshold(60, 0.8, 7500, 14743) == -(-v.numerator // v.denominator)


def test_sample_is_the_smallest_hashes(spark):
    from basketry.operators.sampling import sample_baskets, sample_key
    tx = spark.range(0, 5000).select((F.col("id") % 1777).alias("basket"), (F.col("id") % 13).alias("item"))
    ordered = [r["basket"] for r in tx.select("basket").distinct().orderBy(sample_key("basket", 7), "basket").collect()]
    for size in (0, 1, 250, 1000, 1776, 5000):
        assert rows(sample_baskets(tx, size, 7)) == sorted((b,) for b in ordered[:size])


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_consecutive_index_with_payload_has_no_gap(spark, aqe):
    """Many more rows than a range exchange samples, a column that is no key, ties."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        n = 3_000_000
        df = spark.range(0, n, numPartitions=8).select((F.xxhash64("id") % 1_000_000).alias("k"), F.md5(F.col("id").cast("string")).alias("pay"))
        r = consecutive_index(df, ["k"]).agg(F.count_distinct("row_number"), F.min("row_number"), F.max("row_number")).first()
        assert tuple(r) == (n, 1, n)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_wide_keys_are_not_broadcast(spark, store):
    from basketry.operators.joins import broadcast_if_small, semi_join
    keys = spark.range(30_000).select(F.repeat(F.md5(F.col("id").cast("string")), 32).alias("k"))  # packs well
    keys = store.write(keys, "wide-keys")     # 30 MB of text against the limit of 10 MB
    assert "ResolvedHint" not in broadcast_if_small(keys, 30_000)._jdf.queryExecution().analyzed().toString()
    small = store.write(spark.range(10).select(F.col("id").alias("k")), "small-keys")
    assert "ResolvedHint" in broadcast_if_small(small, 10)._jdf.queryExecution().analyzed().toString()
    assert semi_join(keys.limit(5), keys, ["k"]).count() == 5
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        assert "ResolvedHint" not in broadcast_if_small(small, 30_000)._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_support_window_equals_window_count(spark):
    from pyspark.sql import Window
    from basketry.operators.windows import support_window
    occ = spark.createDataFrame([(b, b % 3, (b * 7) % 5) for b in range(40)], "basket bigint, item1 bigint, item2 bigint")
    want = occ.withColumn("support", F.count(F.lit(1)).over(Window.partitionBy("item1", "item2")))
    got = support_window(occ, 2)
    assert got.columns == want.columns and rows(got) == rows(want)
