"""Two tokenizers side by side, against a plain version that encodes whole texts."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from basketry.llm import token_alignment as ta
from basketry.llm.queries import op11_token_alignment, piece_model, vocabulary
from helpers import KIND, ODD, SMALL, documents, odd


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary())
    a.encode_special_tokens = True
    from basketry.llm.bpe import pieces

    return a, SentencePieceProcessor(model_file=piece_model()), pieces(vocabulary())


def byte_of(sp, i):
    x = sp.id_to_piece(i)
    return bytes([int(x[3:5], 16)]) if sp.is_byte(i) else x.replace("▁", " ").encode()


def plain(rows, libraries):
    """{row number: (n_a, n_b, n_groups, n_links, n_best, count_sum, sha, groups)}."""
    a, sp, table = libraries
    links, out = {}, {}
    for k, text in enumerate(rows):
        if not text:
            continue
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        pa_, pb = [table[i] for i in ia], [byte_of(sp, i) for i in ib]
        whole = (" " + text).encode()
        if b"".join(pa_) != whole or b"".join(pb) != whole:
            continue
        ea, eb = np.cumsum([len(x) for x in pa_]).tolist(), np.cumsum([len(x) for x in pb]).tolist()
        both = sorted(set(ea) & set(eb))
        groups, x, y = [], 0, 0
        for e in both:
            u, v = ea.index(e, x) + 1, eb.index(e, y) + 1
            groups.append(",".join(map(str, ia[x:u])) + "|" + ",".join(map(str, ib[y:v])))
            x, y = u, v
        held, i, j = Counter(), 0, 0
        while i < len(ia) and j < len(ib):  # ranges overlap: both go on at the lesser end
            held[ia[i], ib[j]] += 1
            i, j = i + (ea[i] <= eb[j]), j + (eb[j] <= ea[i])
        links[k] = held
        out[k] = [len(ia), len(ib), len(both), sum(held.values()), ";".join(groups)]
    n = Counter(p for h in links.values() for p in h)
    best = Counter()
    for (i, _), c in n.items():
        best[i] = max(best[i], c)
    return {k: (*x[:4], sum(t for p, t in links[k].items() if n[p] == best[p[0]]),
                sum(t * n[p] for p, t in links[k].items()), hashlib.sha256(x[4].encode()).hexdigest(), x[4])
            for k, x in out.items()}


NONE = (0, 0, 0, 0, 0, 0, "", "")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups")


@pytest.mark.parametrize("frequent", [ta.FREQUENT, 50, 0])
def test_odd_texts(spark, libraries, frequent):
    got, _ = ta.alignment(odd(spark), vocabulary(), piece_model(), groups=True, frequent=frequent)
    assert got.columns[0] == "doc_id"
    want = plain([t for _, t, _ in ODD], libraries)
    assert sorted((str(r["doc_id"]), *[r[c] for c in COLUMNS]) for r in got.collect()) == sorted(
        (str(ODD[k][0]), *want.get(k, NONE)) for k in range(len(ODD)))


def test_table_of_documents(spark, libraries):
    docs = documents(spark).collect()
    got = {r["doc_id"]: r for r in op11_token_alignment(spark, SMALL).collect()}
    want = plain([d["text"] for d in docs], libraries)
    assert len(got) == len(docs)
    for k, d in enumerate(docs):
        assert tuple(got[d["doc_id"]][c] for c in COLUMNS[:-1]) == want.get(k, NONE)[:-1]


def test_pair_table(spark, libraries):
    _, pairs = ta.alignment(spark.createDataFrame([(1, "a b", "s"), (2, "a", "s")], KIND), vocabulary(), piece_model())
    a, sp, _ = libraries
    x = a.encode(" a", add_special_tokens=False).ids[0], sp.encode("a")[0]
    assert [(r["n"], r["best"]) for r in pairs.where(f"a = {x[0]} and b = {x[1]}").collect()] == [(2, True)]


def test_empty_table(spark):
    rows, pairs = ta.alignment(spark.createDataFrame([], KIND), vocabulary(), piece_model())
    assert rows.count() == pairs.count() == 0


def test_long_text_in_segments(spark, libraries):
    """A text of 3 MB is cut into segments and gives what the whole gives."""
    text = " ".join(f"word{i % 977} and, {'  ' * (i % 3)}thing é{i}" for i in range(110_000))
    assert len(ta.segments(text.encode())) > 5 and b"".join(ta.segments(text.encode())) == text.encode()
    got = ta.alignment(spark.createDataFrame([(1, text, "s")], KIND), vocabulary(), piece_model(), groups=True)[0].first()
    assert tuple(got[c] for c in COLUMNS) == plain([text], libraries)[0]


def test_cuts_by_halving():
    rng = np.random.default_rng(7)
    for n in [1, 2, 3, 10, 400]:
        for share in (0.1, 0.5, 0.9):
            a = np.flatnonzero(rng.random(n) < share) + 1
            b = np.flatnonzero(rng.random(n) < share) + 1
            a, b = np.union1d(a, [n]), np.union1d(b, [n])
            x, y = ta.shared_cuts(a, b)
            assert a[x - 1].tolist() == b[y - 1].tolist() == np.intersect1d(a, b).tolist()


def test_worker_objects_need_no_package(spark, tmp_path):
    """What travels to tasks loads where this package is not installed."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from basketry.llm import pretokens

    path = tmp_path / "objects"
    path.write_bytes(cloudpickle.dumps([ta.Tokenizers, ta.align_segments, pretokens.Vocabulary, pretokens.char_classes,
                                        pretokens.KnownWords]))
    code = f"import pickle; x = pickle.load(open({str(path)!r}, 'rb')); assert len(x) == 5"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": ""})
