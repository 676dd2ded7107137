"""Repair of conversation structure by cheapest edits: a run-length DP.

A conversation is repaired when the initials of its roles read
``(s?(ua)+)?``.  Every row may be kept (0), given the role that is missing,
user or assistant (1), or deleted (2); empty user or assistant rows may be
inserted anywhere (5).  Blank rows and rows that repeat an earlier one's role
and text must be deleted; truncated rows that stay cost 5 more.  Of the cheapest
ways the one whose edits (D, I, K, R in order) are least in ASCII is taken.

A row counts by its symbol only: initial (s, u, a, other) and fault (none,
truncated, deleted).  Its step is a min-plus matrix over the four states of the
pattern (start, after s, after u, after a), inserts before it included.  Equal
neighbours are collapsed into runs; a run of n rows advances a cost vector by
the binary powers of its matrix, which are cached.  Costs run from the end to
the start, then the choices are unrolled from the start: a run is halved by its
powers down to single rows, so that a long run needs memory for its depth only.

Scale: rows are numbered in the order of (conversation, turn, ...) by a range
sort and cut into blocks of at most ``BLOCK`` rows, so a conversation that holds
a third of all rows is many blocks.  Blocks collapse, multiply and unroll in
parallel; only one small row a block passes through a conversation's task, as a
stream that holds a vector of four numbers.  Texts are shuffled once, to the
stream that applies the edits; a conversation's rows pass through it one after
the other (a digest of a whole conversation cannot be made otherwise), and it
holds the edits, a byte a row, but no texts.

Cases: null roles and texts are one space; rows of null conversations are one
conversation; null turns come first; rows of one turn are ordered by a digest of
role and text, so equal ones are neighbours; a conversation of which nothing is
left has no rows.  Texts may be of any length; empty tables give empty ones;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Store, arrow_batches

BLANK_CHARACTERS = " \t\n\x0b\f\r"
#: Rows of a block, at most (a power of two).
BLOCK = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NEVER = 1 << 60

# States: 0 start, 1 after s, 2 after u, 3 after a.  Initials: 0 s, 1 u, 2 a, 3 other.
TURN = {0: 2, 1: 2, 2: 3, 3: 2}              # the state after a user or assistant row that fits
KEPT = [{0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {}]  # the same for a row that keeps its initial
ACCEPTED = (0, 3)
LEGAL = {(0, 1), (1, 2), (2, 1)}


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) of damaged rows, by the CRC-32 of
    ``conv_id:turn`` (nulls: one space) modulo 20: 0 drops a row, 1 empties its
    text, 2 removes its full stops, exclamation and question marks, 3 repeats
    it, 4 makes its role user."""
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in (conv_id, ":", turn)])
    r, t = (F.coalesce(F.col(c), F.lit(" ")) for c in (role, text))
    d = rows.select(F.col(conv_id), F.col(turn), r.alias(role), t.alias(text), F.pmod(F.crc32(key), F.lit(20)).alias("_d"))
    d = d.where("_d <> 0").select(
        conv_id, turn, F.when(F.col("_d") == 4, "user").otherwise(F.col(role)).alias(role),
        F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.regexp_replace(F.col(text), "[.!?]", ""))
        .otherwise(F.col(text)).alias(text),
        F.explode(F.when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
    return d.drop("_copy")


# -- min-plus steps over the four states ------------------------------------------

def times(x: tuple, y: tuple) -> tuple:
    """Min-plus product of two matrices (tuples of rows)."""
    return tuple(tuple(min(x[i][k] + y[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def before(x: tuple, v: tuple) -> tuple:
    """Cost vector before a step: min-plus product of a matrix and a vector."""
    return tuple(min(x[i][k] + v[k] for k in range(4)) for i in range(4))


def inserts() -> tuple:
    """Cost of getting from state to state by inserted rows alone."""
    out = [[NEVER] * 4 for _ in range(4)]
    for i in range(4):
        at, cost = i, 0
        for _ in range(4):
            out[i][at] = min(out[i][at], cost)
            at, cost = TURN[at], cost + INSERT
    return tuple(map(tuple, out))


def choices(symbol: int, state: int) -> dict[str, tuple[int, int]]:
    """letter -> (cost, next state) of a row of ``symbol`` (3 * initial + fault)."""
    initial, fault = divmod(symbol, 3)
    out = {"D": (DELETE, state)}
    if fault < 2:
        more = TRUNCATED * fault
        if state in KEPT[initial]:
            out["K"] = (KEEP + more, KEPT[initial][state])
        out["R"] = (REROLE + more, TURN[state])
    return out


def power(symbol: int, j: int, kept: dict = {}) -> tuple:  # noqa: B006
    """The step of 2^j rows of ``symbol``; every power is made once."""
    if (symbol, j) not in kept:
        if j:
            kept[symbol, j] = times(power(symbol, j - 1), power(symbol, j - 1))
        else:
            row = [[NEVER] * 4 for _ in range(4)]
            for q in range(4):
                for cost, to in choices(symbol, q).values():
                    row[q][to] = min(row[q][to], cost)
            kept[symbol, j] = times(inserts(), tuple(map(tuple, row)))
    return kept[symbol, j]


def end_costs() -> tuple:
    return tuple(min(row[q] for q in ACCEPTED) for row in inserts())


def bits(n: int) -> list[int]:
    return [j for j in range(n.bit_length()) if n >> j & 1]


def run_step(symbol: int, n: int) -> tuple:
    return reduce(times, [power(symbol, j) for j in bits(n)])


def before_run(symbol: int, n: int, v: tuple) -> tuple:
    for j in bits(n):
        v = before(power(symbol, j), v)
    return v


def unroll_row(symbol: int, q: int, after: tuple, out: list) -> int:
    """Append the least cheapest edits of one row; the state after it."""
    cost = before(power(symbol, 0), after)
    options = choices(symbol, q)
    while True:
        for letter in "DIKR":
            if letter == "I":
                if INSERT + cost[TURN[q]] == cost[q]:
                    out.append("I")
                    q = TURN[q]
                    options = choices(symbol, q)
                    break
            elif letter in options and options[letter][0] + after[options[letter][1]] == cost[q]:
                out.append(letter)
                return options[letter][1]


def unroll_power(symbol: int, j: int, q: int, after: tuple, out: list) -> int:
    if not j:
        return unroll_row(symbol, q, after, out)
    q = unroll_power(symbol, j - 1, q, before(power(symbol, j - 1), after), out)
    return unroll_power(symbol, j - 1, q, after, out)


def unroll(symbols: list[int], sizes: list[int], q: int, after: tuple, last: bool, out: list) -> int:
    """Append the edits of a block of runs that is entered in state ``q`` and
    left at the costs ``after``; the state after it.  The last block of a
    conversation also gets the inserts that end it."""
    steps = [(s, j) for s, n in zip(symbols, sizes, strict=True) for j in bits(n)]
    costs = [after]
    for s, j in reversed(steps):
        costs.append(before(power(s, j), costs[-1]))
    for i, (s, j) in enumerate(steps):
        q = unroll_power(s, j, q, costs[len(steps) - 1 - i], out)
    while last and q not in ACCEPTED:
        out.append("I")
        q = TURN[q]
    return q


def runs_of(symbols: list[int]) -> tuple[list[int], list[int]]:
    """Equal neighbours collapsed: (symbol of each run, rows of each run)."""
    out: list[int] = []
    sizes: list[int] = []
    for s in symbols:
        if out and out[-1] == s:
            sizes[-1] += 1
        else:
            out.append(s)
            sizes.append(1)
    return out, sizes


# -- the passes ----------------------------------------------------------------

def marked(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, h: digest of role and text, initial, blank, cut) of rows."""
    r, t = (F.coalesce(F.col(c), F.lit(" ")) for c in (role, text))
    left = F.rtrim(t, F.lit(BLANK_CHARACTERS))
    first = F.substring(r, 1, 1)
    return rows.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), digest_of(r, t).alias("h"),
        F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3).alias("initial"),
        (left == "").alias("blank"), (~F.substring(left, -1, 1).isin(".", "!", "?")).alias("cut"))


def digest_of(role, text):
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def blocks(marks: DataFrame, store: Store, block: int) -> DataFrame:
    """(conv, block, symbols in order, blank, duplicate, truncated) of at most
    ``block`` rows each."""
    # equal rows are told apart by their place, so that no range of the sort is one key
    d = store.write(marks.withColumn("source", F.monotonically_increasing_id()), "marks")
    order = ["conv", "turn", "h", "source"]
    d = d.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    d = store.write(d.drop("source"), "ordered")
    first = (d.where("not blank").groupBy(F.col("conv").alias("_conv"), F.col("h").alias("_h"))
             .agg(F.min("at").alias("_first")))
    d = d.join(first, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("h") == F.col("_h")), "left")
    twice = F.coalesce(F.col("_first") < F.col("at"), F.lit(False)) & ~F.col("blank")
    cut = F.col("cut") & ~F.col("blank") & ~twice
    fault = F.when(F.col("blank") | twice, 2).when(cut, 1).otherwise(0)
    d = d.select("conv", F.shiftright("at", block.bit_length() - 1).alias("block"), "at",
                 (F.col("initial") * 3 + fault).alias("symbol"), "blank", twice.alias("twice"), cut.alias("cut"))
    held = F.sort_array(F.collect_list(F.struct("at", "symbol")))
    return d.groupBy("conv", "block").agg(
        F.transform(held, lambda x: x["symbol"]).alias("symbols"),
        *[F.sum(F.col(c).cast("long")).alias(n) for c, n in (("blank", "blank"), ("twice", "duplicate"), ("cut", "truncated"))])


def edits(blocked: DataFrame, conv_type: str) -> DataFrame:
    """(conv, block, blank, duplicate, truncated, illegal, cost, audit): the
    edits of every block; a conversation's cost stands at its first block."""
    head = f"conv {conv_type}, block long, blank long, duplicate long, truncated long, "

    def mapped(df, rows, kind):
        """``rows`` (an iterator over dicts to one over dicts) over a partition."""
        names = [x.split()[0] for x in (head + kind).split(", ")]

        def run(batches):
            def each():
                for b in batches:
                    yield from b.to_pylist()
            held = []
            for r in rows(each()):
                held.append([r[n] for n in names])
                if len(held) >= 2000:
                    yield record(held)
                    held = []
            yield record(held)

        def record(held):
            cols = zip(*held, strict=True) if held else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import _parse_datatype_string

        types = [f.type for f in to_arrow_schema(_parse_datatype_string(head + kind))]
        return df.mapInArrow(run, head + kind)

    def collapse(rows) -> Iterator[dict]:
        for r in rows:
            symbols, sizes = runs_of(r["symbols"])
            step = reduce(times, [run_step(s, n) for s, n in zip(symbols, sizes, strict=True)])
            first = [s // 3 for s in symbols]
            # between runs, and inside them: an initial beside itself is never legal
            own = sum((x, y) not in LEGAL for x, y in zip(first, first[1:])) + sum(sizes) - len(sizes)
            yield r | {"runs": symbols, "sizes": sizes, "step": [x for row in step for x in row], "illegal": own}

    def costs(rows) -> Iterator[dict]:
        """From a conversation's last block to its first."""
        conv, v, started = None, end_costs(), False
        for r in rows:
            last = not started or r["conv"] != conv
            conv, v, started = r["conv"], end_costs() if last else v, True
            after, s = v, r["step"]
            v = before(tuple(tuple(s[i:i + 4]) for i in range(0, 16, 4)), v)
            yield r | {"after": list(after), "cost": v[0], "last": last}

    def exits(rows) -> Iterator[dict]:
        for r in rows:
            # where a conversation's last block leads is of no use
            yield r | {"exits": [] if r["last"] else [unroll(r["runs"], r["sizes"], q, tuple(r["after"]), False, []) for q in range(4)]}

    def entries(rows) -> Iterator[dict]:
        """From a conversation's first block to its last."""
        conv, q, tail, started = None, 0, None, False
        for r in rows:
            if not started or r["conv"] != conv:
                conv, q, started = r["conv"], 0, True
            else:
                r["illegal"] += (tail, r["runs"][0] // 3) not in LEGAL
                r["cost"] = 0
            tail = r["runs"][-1] // 3
            yield r | {"entry": q}
            q = q if r["last"] else r["exits"][q]

    def audits(rows) -> Iterator[dict]:
        for r in rows:
            out: list[str] = []
            unroll(r["runs"], r["sizes"], r["entry"], tuple(r["after"]), r["last"], out)
            yield r | {"audit": "".join(out)}

    held = "illegal long, runs array<int>, sizes array<int>"
    d = mapped(blocked, collapse, f"{held}, step array<long>")
    d = d.repartition("conv").sortWithinPartitions("conv", F.desc("block"))
    d = mapped(d, costs, f"{held}, after array<long>, cost long, last boolean").repartition("conv", "block")
    d = mapped(d, exits, f"{held}, after array<long>, cost long, last boolean, exits array<int>")
    d = d.repartition("conv").sortWithinPartitions("conv", "block")
    d = mapped(d, entries, f"{held}, after array<long>, cost long, last boolean, entry int").repartition("conv", "block")
    return mapped(d, audits, "illegal long, cost long, audit string")


def applied(rows: DataFrame, audits: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, place, role, text) of the repaired conversations, partitioned
    by conversation and in order inside partitions."""
    r, t = (F.coalesce(F.col(c), F.lit(" ")) for c in (role, text))
    conv_type, turn_type = (rows.schema[c].dataType.simpleString() for c in (conv_id, turn))
    a = audits.select("conv", F.lit(0).alias("kind"), "block", F.lit(None).cast(turn_type).alias("turn"),
                      F.lit(None).cast("binary").alias("h"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    b = rows.select(F.col(conv_id).alias("conv"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("block"),
                    F.col(turn).alias("turn"), digest_of(r, t).alias("h"), r.alias("role"), t.alias("text"))
    order = ["conv", "kind", "block", "turn", "h"]
    d = a.unionByName(b).repartition("conv").sortWithinPartitions(*order).select("conv", "kind", "role", "text")

    def run(batches):
        conv, started, out = None, False, []
        audit, at, q, place = "", 0, 0, 0

        def emit(name, words):
            nonlocal place
            out.append((conv, place, name, words))
            place += 1

        def inserted():
            nonlocal at, q
            while at < len(audit) and audit[at] == "I":
                emit("user" if q != 2 else "assistant", "")
                q, at = TURN[q], at + 1

        for b in batches:
            for c, kind, name, words in zip(*[b.column(i).to_pylist() for i in range(4)], strict=True):
                if not started or c != conv:
                    inserted()
                    conv, started, audit, at, q, place = c, True, "", 0, 0, 0
                if not kind:
                    audit += words
                    continue
                inserted()
                letter, at = audit[at], at + 1
                if letter == "K":
                    emit(name, words)
                    q = KEPT["sua".index(name[0])][q]
                elif letter == "R":
                    emit("user" if q != 2 else "assistant", words)
                    q = TURN[q]
            if out:
                yield record(out)
                out = []
        inserted()
        if out:
            yield record(out)

    def record(out):
        cols = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["conv", "place", "role", "text"])

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(rows.schema[conv_id].dataType), pa.int64(), pa.string(), pa.string()]
    out = d.mapInArrow(run, f"conv {conv_type}, place long, role string, text string")
    return out.select(F.col("conv").alias(conv_id), "place", F.col("role").alias(role), F.col("text").alias(text))


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): digest of ``role:text``, joined by newlines, of
    the rows that ``applied`` returned (their order inside partitions counts)."""
    def run(batches):
        import hashlib

        conv, digest = None, None
        for b in batches:
            done = []
            for c, _, name, words in zip(*[b.column(i).to_pylist() for i in range(4)], strict=True):
                if digest is None or c != conv:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = c, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{name}:{words}".encode())
            if done:
                yield record(done)
        if digest is not None:
            yield record([(conv, digest.hexdigest())])

    def record(done):
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], kind), pa.array([x[1] for x in done])],
                                          ["conv", "repaired_sha256"])

    from pyspark.sql.pandas.types import to_arrow_type

    field = repaired.schema[0].dataType
    kind = to_arrow_type(field)
    return repaired.mapInArrow(run, f"conv {field.simpleString()}, repaired_sha256 string")


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(one row a conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit; the repaired rows: conv_id, place, role, text)."""
    spark = rows.sparkSession
    store = Store(spark)
    arrow_batches(spark)
    marks = marked(rows, conv_id, turn, role, text)
    conv_type = rows.schema[conv_id].dataType.simpleString()
    done = store.write(edits(blocks(marks, store, block), conv_type), "edits")
    sums = done.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    turns = store.read("ordered").groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy(F.col("conv").alias("_conv"))
    turns = turns.agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    summary = sums.join(turns, F.col("conv").eqNullSafe(F.col("_conv")))
    summary = summary.select(F.col("conv").alias(conv_id), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return summary, applied(rows, done, conv_id, turn, role, text)
