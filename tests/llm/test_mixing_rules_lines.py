import re
from collections import Counter

import duckdb
import pytest
from helpers import KIND, documents, odd
from pyspark.sql import functions as F

from basketry.llm import line_dedup, mixing, quality_rules
from basketry.llm.queries import ORACLE_SQL, QUERIES, op7_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fill(sizes, weights, budget, cap):
    """Targets by sharing again and again what capped sources leave."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = budget * sum(sizes.values()), set(order), {}
    while open_:
        rate = left / sum(w[s] for s in open_)
        full = [s for s in open_ if cap * sizes[s] <= rate * w[s]]
        if not full:
            return out | {s: rate * w[s] for s in open_}
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


@pytest.mark.parametrize("which", ["odd", "small"])
def test_mix_meets_targets(spark, which):
    docs = odd(spark).drop("size") if which == "odd" else documents(spark)
    d = mixing.mix(mixing.sized(docs)).collect()
    assert len(d) == docs.count()
    sizes, taken = Counter(), Counter()
    for r in d:
        assert r["size"] == len(WORD.findall(r["text"] or ""))
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    want = fill(dict(sizes), (5, 2, 1), 1.5, 2)
    for r in d:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-9)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    got = [r["position"] for r in d if r["position"] is not None]
    assert got == sorted(got) and all(0 <= p <= 1 for p in got)
    again = mixing.mix(mixing.sized(docs.repartition(3))).collect()
    assert Counter((r["doc_id"], r["taken"], r["position"]) for r in again) == Counter((r["doc_id"], r["taken"], r["position"]) for r in d)


def test_positions_follow_the_curriculum(spark):
    """A source with a falling weight is through half its demand before half time."""
    docs = spark.createDataFrame([(i, s, 10) for i in range(2000) for s in "abc"], "doc_id long, source string, size long")
    order = mixing.training_order(mixing.mix(docs, weights=(1, 1, 1), budget=1.0))
    early = dict(order.where("position < 0.5").groupBy("source").agg(F.sum("words")).collect())
    total = dict(order.groupBy("source").agg(F.sum("words")).collect())
    share = {s: early[s] / total[s] for s in total}
    assert share["a"] == pytest.approx(0.625, abs=0.01)  # integral of 1.5 - t
    assert share["b"] == pytest.approx(0.5, abs=0.01)
    assert share["c"] == pytest.approx(0.375, abs=0.01)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql(spark, name, sf):
    got = QUERIES[name](spark, f"/root/testdata/{sf}")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/{sf}/documents.parquet'")
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL[name]}) ORDER BY doc_id").fetchall()
    assert sorted(map(tuple, got.collect())) == want


def test_null_ids_are_spread(spark):
    """A third of the ids null, a third equal: no bucket holds many rows."""
    docs = spark.range(30_000).selectExpr(
        "case id % 3 when 0 then null when 1 then 7 else id end as doc_id", "'s' as source", "concat('word ', id) as text")
    keyed = docs.withColumn("key", mixing.row_key())
    most = keyed.groupBy(F.substring("key", 1, mixing.BUCKET_DIGITS)).count().agg(F.max("count")).first()[0]
    assert most < 40
    rows = mixing.mix(mixing.sized(keyed), key_col="key")
    assert rows.columns == ["doc_id", "source", "text", "size", *mixing.RESULT]
    assert rows.agg(F.sum("taken")).first()[0] == 90_000


def rules_by_hand(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    wins = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = {j for i in range(len(w) - 7) if wins[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside))


def test_rules_against_plain_python(spark):
    texts = ["a b c d e f g h " * 3 + "x\ny\ny\n\n \n\n", "p q " * 30, "one two three four five six seven eight",
             "1 2 3 4 5 6 7 8 z 1 2 3 4 5 6 7 8 9 2 3 4 5 6 7 8 9 end", "#*$%&|<> \x0b\x0c\x1f  x"]
    docs = odd(spark).select("doc_id", "text", "n_words").unionByName(
        spark.createDataFrame([(100 + i, t, "") for i, t in enumerate(texts)], "doc_id long, text string, n_words string"))
    docs = docs.unionByName(documents(spark).select("doc_id", "text", F.lit("").alias("n_words")))
    for r in quality_rules.judge(docs).collect():
        q = r["quality"]
        got = (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"])
        want = rules_by_hand(r["text"])
        assert got == want, r["text"]
        base = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert base == bool({"n_words", "repeat_word_ratio"} & set(q["failed"]))
        assert q["kept"] == (not q["failed"])
    assert quality_rules.judge(spark.createDataFrame([], KIND)).count() == 0


@pytest.mark.parametrize("text, kept", [
    ("THE CAT SAT ON THE MAT AND THE DOG LAY IN THE SUN FOR A WHILE BEFORE IT WENT TO THE RIVER WITH A FRIEND OF MINE", True),
    ("'The' cat, (on) \"the\" mat; and-the dog! in. The sun: was warm, so they lay there until evening came over hills", True),
    # a language that no list knows
    ("kissa istui matolla ja koira makasi auringossa kunnes ilta tuli ja kaikki menivät kotiin syömään lämmintä keittoa "
     "jonka mummo keitti heille vanhassa padassa tuvan takana", True),
    (" ".join(f"shoes{c} cheap{c} buyer{c} store{c}" for c in "abcdefghijklmnopqrst") + " the of and", False),
    ("of the and to in is that for was on are with as be at by this from or an it not have he of", False),
])
def test_stop_words(spark, text, kept):
    row = quality_rules.judge(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["quality"]
    assert row["kept"] == kept, row["failed"]
    assert kept or any(f.startswith("stop_ratio") for f in row["failed"])


def test_rules_keep_good_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    d = op7_quality_rules(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("not base_failed")
    good, bad = (d.where(f"quality = {q}") for q in (1, 0))
    assert good.where("kept").count() == good.count()
    assert bad.where("kept").count() <= 0.2 * bad.count()


def lines_by_hand(docs, least):
    """docs: (order, text) in order; a line goes if a run of lines with
    ``least`` words or more that holds it stands earlier."""
    seen, out = set(), []
    for text in docs:
        rows = (text or "").split("\n")
        at = [i for i, x in enumerate(rows) if WORD.search(x)]
        own = [rows[i].strip(" \t\x0b\x0c\r") for i in at]
        n = [len(WORD.findall(x)) for x in own]
        drop = set()
        for i in range(len(own)):
            for j in range(i, len(own)):
                if sum(n[i:j + 1]) >= least:
                    run = tuple(own[i:j + 1])
                    if run in seen:
                        drop |= set(range(at[i], at[j] + 1))
                    seen.add(run)
        out.append((len(drop), "\n".join(x for i, x in enumerate(rows) if i not in drop) if text is not None else None))
    return out


def test_lines_against_brute_force(spark):
    import random

    rng = random.Random(3)
    lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 3, 5]))) for _ in range(8)] + ["", " \t"]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(0, 9)))) for i in range(60)]
    docs += [(100, "p q r s t\nu v w x y z"), (101, "n\np q r s t\nu v w x y z\nm"), (102, None), (103, ""), (104, "\n\n")]
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), min_words=7).orderBy("doc_id").collect()
    want = lines_by_hand([t for _, t in docs], 7)
    assert [(r["n_deleted"], r["text"]) for r in got] == want


def test_lines_of_odd_rows(spark):
    got = line_dedup.dedup_lines(odd(spark))
    assert got.count() == odd(spark).count()
    assert [tuple(r) for r in got.where("doc_id = 6").select("text", "n_deleted").collect()] == [("same text here", 0)] * 2
    assert line_dedup.dedup_lines(spark.createDataFrame([], KIND)).count() == 0


def test_passage_in_many_documents_stays_once(spark):
    passage = "\n".join(" ".join(f"w{i}_{j}" for j in range(20)) for i in range(4))
    docs = [(i, f"head of {i}\n{passage}\ntail of {i}") for i in range(300)]
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    for r in got:
        assert r["text"] == (docs[0][1] if r["doc_id"] == 0 else f"head of {r['doc_id']}\ntail of {r['doc_id']}")
