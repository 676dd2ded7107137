import random
from collections import Counter

from test_simhash import fingerprint, grouped

import corpus_pipeline


def test_one_survivor_a_group_whatever_the_ids(spark):
    rng = random.Random(11)
    text = lambda: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(30))
    same, upper = text(), text()
    rows = [(None, text()) for _ in range(12)]  # groups of null ids only
    rows += [(7, text()), (7, text()), (7, same), (3, same)]  # a repeated id; one of its rows is in group 3
    rows += [(None, same), (8, upper), (8, upper), (8, upper.upper()), (None, None), (None, ""), (9, text())]
    rows += [(None, rows[0][1])] * 3
    docs = spark.createDataFrame([(i, t, "a", "en", 1) for i, t in rows], "doc_id long, text string, source string, lang string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(4), None).collect()]
    root = grouped({fingerprint(t) for _, t in rows})
    order = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    want = {}
    for r in rows:
        g = root[fingerprint(r[1])]
        want[g] = min(r, want.get(g, r), key=order)
    assert set(Counter(root[fingerprint(t)] for _, t in got).values()) == {1}
    assert sorted(got, key=order) == sorted(want.values(), key=order)
