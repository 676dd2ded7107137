"""The grouped prefix join against a comparison of all pairs of sets."""

import random
import re

import pytest

from basketry.llm import jaccard_join as jj
from basketry.llm.queries import op13_jaccard_join
from helpers import KIND, ODD, SMALL, documents, odd

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def set_of(text, k=5):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))) if words else frozenset()


def plain(rows, percent=80):
    """[(id, n, least id reachable)] by comparing all sets that share a shingle."""
    sets = [set_of(t) for _, t in rows]
    where, root = {}, list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        near = {j for x in s for j in where.get(x, ())}
        for j in near:
            both = len(s & sets[j])
            if both * 100 >= percent * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
        for x in s:
            where.setdefault(x, []).append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def near_copies(rng, n=60, words=40):
    """Chains and stars of near copies, exact copies, shared passages, short texts."""
    names = [f"w{i}" for i in range(400)]
    passage = [rng.choice(names) for _ in range(60)]
    texts = []
    for _ in range(n):
        base = [rng.choice(names) for _ in range(rng.randint(1, 3 * words))]
        texts.append(base)
        for _ in range(rng.choice([0, 0, 1, 3, 12])):
            copy = list(rng.choice([base, texts[-1]]))
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                at = rng.randrange(len(copy))
                copy[at:at + rng.choice([0, 1])] = [rng.choice(names)] * rng.choice([0, 1])
                copy = copy or ["x"]
            texts.append(copy)
        if rng.random() < 0.3:
            texts.append(passage + base[:rng.randint(0, 30)])
    return [(i, rng.choice([" ", "\n", " \t"]).join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("hot,rounds,bloom", [(jj.HOT, 3, jj.BLOOM), (0, 0, 1 << 15), (40, 1, jj.BLOOM)])
def test_near_copies(spark, hot, rounds, bloom):
    rows = near_copies(random.Random(hot + rounds))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(jj.jaccard_join(df, hot=hot, rounds=rounds, bloom=bloom)) == plain(rows)


def test_odd_rows(spark):
    assert got(jj.jaccard_join(odd(spark))) == plain([(d, t) for d, t, _ in ODD])


def test_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    assert got(op13_jaccard_join(spark, SMALL)) == plain(rows)


def test_empty_and_alone(spark):
    assert jj.jaccard_join(spark.createDataFrame([], KIND)).count() == 0
    assert got(jj.jaccard_join(spark.createDataFrame([(3, "one two", "a")], KIND))) == [(3, 1, 3)]


def test_threshold_is_exact(spark):
    """Sets at 80 % link, those just under do not."""
    words = [f"a{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, *[f"b{i}" for i in range(24)]])),
            (3, " ".join([*words, *[f"c{i}" for i in range(25)]]))]
    assert got(jj.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows)
    assert plain(rows)[1][2] == 1 and plain(rows)[2][2] == 3


def test_long_text_in_pieces(monkeypatch):
    texts = [b" ".join(b"word%d" % (i % 5000) for i in range(60_000)) + b"\t" * 300 + b"end", b"", b" a", b"x" * 5000, b"A b"]
    whole = [s.tolist() for s in jj.sets_of(texts, 5)]
    monkeypatch.setattr(jj, "PIECE", 1000)
    assert [s.tolist() for s in jj.sets_of(texts, 5)] == whole
    assert [len(x) for x in whole] == [5001, 0, 1, 1, 1]


def test_pairs_are_verified_once(spark, monkeypatch):
    """No round verifies a pair again, in whatever order it names the two."""
    rng, seen = random.Random(5), []
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(words + [f"x{rng.randrange(8)}" for _ in range(8)])) for i in range(40)]
    real = jj.near_pairs

    def near_pairs(pairs, sets, percent):
        seen.extend((r["a"], r["b"]) for r in pairs.collect())
        return real(pairs, sets, percent)

    monkeypatch.setattr(jj, "near_pairs", near_pairs)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jj.jaccard_join(df)) == plain(rows)
    assert seen and len({frozenset(p) for p in seen}) == len(seen)


def test_near_pairs_keep_every_link(spark):
    """Marks that fall together in a set never hide a link; far pairs go before whole sets are fetched."""
    rng = random.Random(2)
    alike = [(7 << jj.MARK) + i for i in range(40)]  # one mark
    far = [[rng.randrange(-1 << 63, 1 << 63) for _ in range(60)] for _ in range(2)]
    sets = [(0, alike), (1, alike[:36]), (2, alike[:30] + far[0][:10]), (3, far[0]), (4, far[0][:55] + far[1][:3]), (5, far[1])]
    pairs = [(a, b) for a in range(6) for b in range(a + 1, 6)]
    sets_ = spark.createDataFrame(sets, "set long, shingles array<long>")
    pairs_ = spark.createDataFrame(pairs, "a long, b long")
    near = set(map(tuple, jj.near_pairs(pairs_, sets_, 80).collect()))
    link = set(map(tuple, jj.verified(pairs_, sets_, 80).collect()))
    assert link == {(0, 1), (3, 4)} and link <= near
    assert not near & {(0, 3), (0, 5), (3, 5), (4, 5), (2, 3)}
    untried = jj.untried(spark.createDataFrame([(3, 1), (1, 3), (2, 1), (5, 4)], "a long, b long"),
                         spark.createDataFrame([(1, 2)], "a long, b long"))
    assert got(untried) == [(1, 3), (4, 5)]
