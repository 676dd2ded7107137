"""Sources and sinks: basket lines, itemset files, delimited text, reuse."""

import pytest
from pyspark.sql import functions as F

from basketry.functions.ids import format_item_id, parse_item_id
from basketry.plans.transactions import to_transactions
from basketry.sources import tables as T
from basketry.sources.baskets import basket_lines, read_basket_file, write_basket_file
from basketry.sources.delimited import read_delimited, read_text_split, save_delimited
from basketry.sources.itemsets import read_itemsets, write_itemsets
from basketry.sources.store import is_complete, materialize
from tests.conftest import SF001, rows


def test_basket_file_roundtrip_with_split_lines(spark, store):
    tx = to_transactions(T.supp_all_transactions(spark, SF001))
    lines = basket_lines(tx, 2, item_format=format_item_id)
    # baskets with more than 2 items are written as several lines
    assert lines.count() > tx.select("basket").distinct().count()
    path = store.path("test-basket-file")
    write_basket_file(lines, path)
    back = read_basket_file(spark, path, basket_type="bigint", item_parser=parse_item_id)
    assert rows(back, ["basket", "item"]) == rows(tx, ["basket", "item"])


def test_basket_lines_are_sorted_one_per_basket(spark):
    df = spark.createDataFrame([(1, 30), (1, 4), (1, 4), (2, 7)], "basket bigint, item bigint")
    assert rows(basket_lines(df, 10)) == [(1, 0, "4|30"), (2, 0, "7")]
    df = spark.createDataFrame([(1, i) for i in (9, 3, 5, 1, 7)] + [(2, 2)], "basket bigint, item bigint")
    assert rows(basket_lines(df, 2)) == [(1, 0, "1|3"), (1, 1, "5|7"), (1, 2, "9"), (2, 0, "2")]


def test_malformed_items_fail_unless_dropped(spark):
    from basketry.sources.baskets import parse_basket_lines
    lines = spark.createDataFrame([(1, "nm0000001|nmBAD")], "_c0 bigint, _c1 string")
    with pytest.raises(Exception, match="malformed item: nmBAD"):
        parse_basket_lines(lines, item_parser=parse_item_id).collect()
    assert rows(parse_basket_lines(lines, item_parser=parse_item_id, on_malformed="drop")) == [(1, 1)]


def test_itemset_file_roundtrip(spark, store):
    lk = spark.createDataFrame([(1, 2, 5), (3, 40, 7)], "item1 bigint, item2 bigint, support bigint")
    path = store.path("test-itemsets")
    write_itemsets(lk, path)
    assert rows(read_itemsets(spark, path, 2)) == rows(lk)


def test_delimited_roundtrip_and_missing_path(spark, store):
    df = spark.createDataFrame([(1, "a,b", None), (2, 'say "hi"', "x")], "id bigint, s string, t string")
    path = store.path("test-csv")
    save_delimited(df, path, header=True)
    back = read_delimited(spark, path, schema="id bigint, s string, t string")
    assert rows(back) == rows(df)
    with pytest.raises(FileNotFoundError):
        read_delimited(spark, store.path("nope"))
    txt = store.path("test-text")
    spark.createDataFrame([("a|b|c",)], "value string").write.text(txt)
    assert read_text_split(spark, txt, sep="|").collect()[0]["fields"] == ["a", "b", "c"]


def test_materialize_reads_the_same_plan_and_recomputes_another(spark, store):
    path = store.path("test-reuse")
    first = materialize(spark.range(5), path)
    assert is_complete(spark, path)
    files = first.inputFiles()
    assert materialize(spark.range(5), path).inputFiles() == files
    assert materialize(spark.range(5).where(F.lit(False)), path).count() == 0
    forced = materialize(spark.range(2), path, force=True)
    assert forced.count() == 2
    rows_in_memory = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError, match="input_version"):
        materialize(rows_in_memory, path)
    assert materialize(rows_in_memory, path, input_version="a").count() == 1
