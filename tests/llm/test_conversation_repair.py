"""Conversation repair against a plain version that searches all edits row by row."""

import hashlib
import re
import zlib
from itertools import product

import pytest

from basketry.llm import conversation_repair as cr
from basketry.llm.queries import op12_conversation_repair
from helpers import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]")


def plain_damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = (" " if v is None else v for v in (r, x))
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if d == 0:
            continue
        x = "" if d == 1 else re.sub("[.!?]", "", x) if d == 2 else x
        out += [(c, t, "user" if d == 4 else r, x)] * (1 + (d == 3))
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, r, x in rows:
        if not WORD.search(x):
            out.append("blank")
        elif (r, x) in seen:
            out.append("duplicate")
        else:
            out.append("" if WORD.findall(x)[-1] in ".!?" else "truncated")
        seen.add((r, x))
    return out


def cheapest(rows, bad):
    """(cost, audit, repaired rows), least first, over every edit of every row:
    from the end, the least (cost, audit) of each state."""
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", []), "a": (0, "", [])}

    def close(best):
        for _ in range(4):
            for q in step:
                n = best.get(step[q])
                if n:
                    new = (n[0] + 5, "I" + n[1], [("user" if step[q] == "u" else "assistant", ""), *n[2]])
                    best[q] = min(best.get(q, new), new, key=lambda z: z[:2])
        return best

    best = close(best)
    for (_, _, r, x), f in reversed(list(zip(rows, bad, strict=True))):
        now = {}
        for q in step:
            options = [(best[q][0] + 2, "D" + best[q][1], best[q][2])] if q in best else []
            if f not in ("blank", "duplicate"):
                more = 5 * (f == "truncated")
                if r[:1] == "s" and q == "" and "s" in best:
                    options.append((best["s"][0] + more, "K" + best["s"][1], [(r, x), *best["s"][2]]))
                n = best.get(step[q])
                if n:
                    if r[:1] == step[q]:
                        options.append((n[0] + more, "K" + n[1], [(r, x), *n[2]]))
                    options.append((n[0] + 1 + more, "R" + n[1], [({"u": "user", "a": "assistant"}[step[q]], x), *n[2]]))
            if options:
                now[q] = min(options, key=lambda z: z[:2])
        best = close(now)
    return best[""]


def plain(rows, damaged=None):
    damaged = plain_damage(rows) if damaged is None else damaged
    out = []
    for conv in {r[0] for r in rows}:
        own = [r for r in damaged if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).digest()))
        bad, turns = faults(own), [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(x[2][:1] + y[2][:1] not in ("su", "ua", "au") for x, y in zip(own, own[1:]))
        cost, audit, kept = cheapest(own, bad)
        text = "\n".join(f"{r}:{x}" for r, x in kept)
        out.append((conv, gaps, *[bad.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def query(spark, tmp_path, rows):
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", *[f"'clash' as {c}" for c in ("block", "conv", "cost", "kind", "h", "place", "at", "symbol")])
    d.write.parquet(str(tmp_path / "conversations.parquet"))
    got = op12_conversation_repair(spark, str(tmp_path))
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=str)


def test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    assert sorted(map(tuple, op12_conversation_repair(spark, SMALL).collect()), key=str) == plain(rows)


def test_odd_rows(spark, tmp_path):
    """Nulls everywhere, empty and long texts, ties, repeats, other roles."""
    roles = ["user", "assistant", "system", None, "", "tool", "umpire", "user", "assistant"]
    texts = ["Yes.", "no", "", None, " \t", "long. " * 20_000, "é?", "Yes.", "Done! \n", "\x0b", "Yes."]
    rows = [(c, t, roles[(i * 5 + j) % 9], texts[(i * 3 + j * 7) % 11])
            for i, c in enumerate([1, 2, 3, None, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14])
            for j, t in enumerate([None, 0, 1, 1, 2, 5, 5, 9][i % 5:])]
    rows += rows[:9] + [(99, None, "user", "Hi."), (98, None, None, None)]
    assert query(spark, tmp_path, rows) == plain(rows)


def test_empty_table(spark, tmp_path):
    assert query(spark, tmp_path, []) == []


@pytest.mark.parametrize("block", [2, 4, 4096])
def test_blocks(spark, block):
    """A conversation in many blocks, with long runs, gives the same edits."""
    import random

    rng = random.Random(block)
    rows = []
    for c in range(6):
        t = 0
        while t < 150:
            r, x = rng.choice(["user", "assistant", "system", "x"]), rng.choice(["{}.", "{}", "", "same."])
            for _ in range(rng.choice([1, 1, 2, 9])):
                rows.append((c, t, r, x.format(t)))
                t += 1
    summary, repaired = cr.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), block=block)
    sha = {r[0]: r[1] for r in cr.digests(repaired).collect()}
    got = sorted(((*r, sha.get(r[0], hashlib.sha256(b"").hexdigest())) for r in map(tuple, summary.collect())), key=str)
    assert got == plain(rows, rows)
    for r in repaired.groupBy("conv_id").agg({"place": "max", "role": "count"}).collect():
        assert r["max(place)"] + 1 == r["count(role)"]


def test_every_short_conversation():
    """All sequences of four symbols: cost and edits by powers and by search."""
    for symbols in product(range(12), repeat=3):
        rows = [(0, i, ["system", "user", "assistant", "x"][s // 3], "t") for i, s in enumerate(symbols)]
        bad = [["", "truncated", "blank"][s % 3] for s in symbols]
        want = cheapest(rows, bad)
        runs, sizes = cr.runs_of(list(symbols))
        v = cr.end_costs()
        for s, n in reversed(list(zip(runs, sizes, strict=True))):
            v = cr.before_run(s, n, v)
        out = []
        cr.unroll(runs, sizes, 0, cr.end_costs(), True, out)
        assert (v[0], "".join(out)) == want[:2]


def test_long_run():
    out = []
    q = cr.unroll([3], [10_001], 0, cr.end_costs(), True, out)  # user rows only
    want = cheapest([(0, i, "user", "t") for i in range(10_001)][:61], [""] * 61)
    assert q == 3 and "".join(out)[:40] == want[1][:40]


def test_one_hot_conversation(spark):
    """A conversation that holds most rows is split into blocks."""
    rows = spark.range(40_000).selectExpr("if(id % 3 < 2, 1, id) as conv_id", "id as turn",
                                          "if(id % 2 = 0, 'user', 'assistant') as role", "concat(id, '.') as text")
    summary, _ = cr.repair(rows)
    hot = summary.where("conv_id = 1").first()
    n = rows.where("conv_id = 1").count()
    assert len(hot["audit"].replace("I", "")) == n and hot["cost"] >= hot["audit"].count("R")
