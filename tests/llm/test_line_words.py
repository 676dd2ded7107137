import random

import pytest
from test_mixing_rules_lines import WORD

from basketry.llm import line_dedup


def by_words(docs, least):
    """Texts in order; a line goes if a run of lines with ``least`` words or
    more that holds it stands earlier."""
    seen, out = set(), []
    for text in docs:
        rows = text.split("\n")
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
        out.append((len(drop), "\n".join(x for i, x in enumerate(rows) if i not in drop)))
    return out


@pytest.mark.parametrize("blanks", ["\t", " ", "\x0b\x0c\r", " \t"])
def test_words_between_any_blanks(spark, blanks):
    rng = random.Random(5)
    gap = lambda: "".join(rng.choice(blanks) for _ in range(rng.choice([1, 1, 2, 9])))
    lines = ["".join(gap() + rng.choice("abcdefgh") for _ in range(rng.choice([1, 3, 5]))) + gap() for _ in range(8)] + ["", " \t "]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(0, 9)))) for i in range(60)]
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), min_words=7)
    want = by_words([t for _, t in docs], 7)
    assert [(r["n_deleted"], r["text"]) for r in got.orderBy("doc_id").collect()] == want


def test_tabbed_passage_goes_and_padded_line_stays(spark):
    one = "\t".join(f"w{i}" for i in range(60))
    ten = "\n".join("\t".join(f"v{i}_{j}" for j in range(30)) for i in range(10))
    padded = "Chapter" + " " * 60 + "7"
    docs = [(i, f"head {i}\n{x}\ntail {i}") for i, x in enumerate([one, one, ten, ten, padded, padded])]
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    got = [(r["n_deleted"], r["text"]) for r in got.orderBy("doc_id").collect()]
    gone = {1: 1, 3: 10}
    assert got == [(gone.get(i, 0), f"head {i}\ntail {i}" if i in gone else t) for i, t in docs]


def test_document_of_many_lines(spark):
    """30,000 lines in one document: the runs are told apart in linear time."""
    from basketry.llm import line_dedup

    lines = [f"line {i} has a few words of its own" for i in range(30_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["new start of words", *lines[100:140], "and an end"]))]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["n_deleted"] == 0 and got[2]["n_deleted"] == 40 and got[2]["text"] == "new start of words\nand an end"
