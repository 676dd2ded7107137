import random
import re
from collections import defaultdict

import pytest
import xxhash
from helpers import KIND, documents, odd
from pyspark.sql import functions as F

from basketry.llm import simhash_dedup as s
from basketry.llm.components import components


def fingerprint(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def grouped(fps):
    """fp -> smallest fp that chains of links of at most 3 bits reach."""
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(fps)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in fps}


def check(docs, got):
    fps = [(r["doc_id"], fingerprint(r["text"])) for r in docs.collect()]
    groups = grouped({f for _, f in fps})
    least = {}
    for d, f in fps:
        if d is not None:
            least[groups[f]] = min(d, least.get(groups[f], d))
    want = sorted(((d, f"{f:016x}", least.get(groups[f])) for d, f in fps), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_documents_against_brute_force(spark):
    docs = documents(spark)
    check(docs, s.near_duplicates(docs))


def test_odd_rows(spark):
    check(odd(spark), s.near_duplicates(odd(spark)))
    assert s.near_duplicates(spark.createDataFrame([], KIND)).count() == 0


@pytest.mark.parametrize("block", [7, 2048])
def test_links_span_the_components_of_all_pairs(spark, block):
    rng = random.Random(block)
    fps = {rng.getrandbits(64) for _ in range(100)}
    for _ in range(25):  # chains and balls around some of them
        x = rng.choice(sorted(fps))
        for _ in range(rng.randrange(1, 12)):
            y = x
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                y ^= 1 << b
            fps.add(y)
            x = rng.choice((x, y))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    d = spark.createDataFrame([(signed(x),) for x in sorted(fps)], "fp long")
    links = s.links(d, block=block).collect()
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in links)
    got = defaultdict(set)
    for x in fps:
        got[signed(x)] = {signed(x)}
    for a, b in links:
        both = got[a] | got[b]
        for x in both:
            got[x] = both
    want = defaultdict(set)
    for x, r in grouped(fps).items():
        want[r].add(signed(x))
    assert {frozenset(x) for x in got.values()} == {frozenset(x) for x in want.values()}


def test_a_large_group_emits_a_forest_not_its_pairs(spark):
    x = 0x0123456789ABCDEF
    d = spark.range(1500).select((F.lit(x).bitwiseXOR(F.expr("shiftleft(1L, cast(id % 39 as int)) | shiftleft(1L, cast(id div 39 as int))"))).alias("fp")).distinct()
    n = d.count()
    e = s.links(d, block=256)
    assert e.count() < 40 * n < n * (n - 1) / 2
    root = components(e)
    assert root.select("root").distinct().count() == len(set(grouped({r[0] % (1 << 64) for r in d.collect()}).values()))


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    d = spark.createDataFrame(path + star + [(5000, 5000)], "a long, b long")
    got = dict(components(d).collect())
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
    assert components(d.limit(0)).count() == 0
