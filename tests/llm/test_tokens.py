import hashlib

import numpy as np
import pytest
from helpers import KIND, documents, odd
from pyspark.sql import functions as F

from basketry.llm import bpe, pretokens, token_counts
from basketry.llm.queries import op1_bpe, vocabulary


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    t.no_truncation()
    return t


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("most", [0, 50, pretokens.FREQUENT])
def test_encoding_is_the_librarys(spark, library, most):
    docs = odd(spark).unionByName(documents(spark).select("doc_id", "text", "source"), allowMissingColumns=True)
    got = bpe.decode(bpe.encode(docs, vocabulary(), keep_text=True, most=most), vocabulary()).collect()
    assert len(got) == docs.count()
    want = {}
    for r in docs.collect():
        want.setdefault((r["doc_id"], r["text"] or ""), []).append(expected(library, r["text"]))
    for r in got:
        ids, text = want[r["doc_id"], r["text"] or ""].pop()
        assert (list(r["ids"]), r["decoded"]) == (ids, text), r["text"][:80]
    assert got[0]["size"] in ("clash", None)


@pytest.mark.parametrize("most", [0, pretokens.FREQUENT])
def test_counts_are_the_librarys(spark, library, most):
    docs = odd(spark).unionByName(documents(spark).select("doc_id", "text", "source"), allowMissingColumns=True)
    got = sorted(map(tuple, token_counts.token_counts(docs, vocabulary(), most=most).collect()), key=str)
    want = []
    for r in docs.collect():
        n = len(expected(library, r["text"])[0])
        want.append((r["doc_id"], len((r["text"] or "").encode()), n, n > 1024))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("copies", [True, False])
def test_a_long_word_in_every_text(spark, library, copies):
    word = "https" + "x" * 200
    rows = [(i, f"{word} once more" + ("" if copies else f" {i}")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: list(r["ids"]) for r in bpe.encode(docs, vocabulary()).collect()}
    counts = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, vocabulary()).collect()}
    for i, t in rows:
        ids = expected(library, t)[0]
        assert got[i] == ids and counts[i] == len(ids)
    spread = pretokens.encode_rare(spark.createDataFrame([(i, word, "short") for i in range(400)], "d long, word string, s string"),
                                   pretokens.Vocabulary(spark, vocabulary()), "d")
    name = "spark.sql.adaptive.coalescePartitions.enabled"  # would put so few rows into one task
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        assert len({r["p"] for r in spread.select(F.spark_partition_id().alias("p")).collect()}) > 1
    finally:
        spark.conf.set(name, before)


def test_query_digests(spark, library):
    docs = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    got = op1_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for r in got:
        ids, text = expected(library, docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(text))


def test_decode_of_odd_ids(spark, library):
    rows = [(1, [0, 50256, 50256]), (2, []), (3, None), (4, [222, 223, 133])]
    got = {r["k"]: r["decoded"] for r in bpe.decode(spark.createDataFrame(rows, "k int, ids array<int>"), vocabulary()).collect()}
    assert got == {k: library.decode(ids or [], skip_special_tokens=False) for k, ids in rows}


def test_empty_tables(spark):
    none = spark.createDataFrame([], KIND)
    assert bpe.decode(bpe.encode(none, vocabulary()), vocabulary()).count() == 0
    assert token_counts.token_counts(none, vocabulary()).count() == 0


def test_split_of_random_texts(library):
    rng = np.random.default_rng(5)
    letters = list("ab's 'strelvdm\n\t 1é中!? 　<|>") + ["<|endoftext|>", "  ", "'ll", "'re"]
    texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(3000)]
    counts, words = pretokens.split(texts, ("<|endoftext|>",), pretokens.char_classes())
    words, at = words.to_pylist(), 0
    for t, n in zip(texts, counts.tolist(), strict=True):
        own, at = words[at:at + n], at + n
        assert "".join(own) == t
        want = library.encode(t, add_special_tokens=False).ids
        assert [i for w in own for i in library.encode(w, add_special_tokens=False).ids] == want
        plain = t.split("<|endoftext|>")
        pieces = [p for i, x in enumerate(plain) for p in ([] if i == 0 else ["<|endoftext|>"]) + [
            x[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(x)]]
        assert own == pieces


def test_text_of_many_segments(spark):
    """A text of 8 MB is split in segments; ids and decoded text are the library's."""
    from tokenizers import Tokenizer

    from basketry.llm import bpe, pretokens
    from basketry.llm.queries import vocabulary

    text = " ".join(f"word{i % 911} 's<|endoftext|>{'  ' * (i % 3)}thing é{i}\n" for i in range(230_000))
    assert len(text) > 20 * pretokens.SLICE
    got = bpe.encode(spark.createDataFrame([(1, text), (2, "short one")], "doc_id long, text string"), vocabulary(),
                     decoded_col="decoded").orderBy("doc_id").collect()
    t = Tokenizer.from_file(vocabulary())
    for r, x in zip(got, (text, "short one"), strict=True):
        ids = t.encode(x, add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == t.decode(ids, skip_special_tokens=False)
