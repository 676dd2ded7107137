"""SimHash near-duplicates by a byte-position inverted index.

A fingerprint has 8 positional bytes.  Two fingerprints that differ in at
most ``MAX_BITS`` = 3 bits differ in at most 3 bytes, so they share 5 of the 8
positional bytes at least.  Posting lists of single positional bytes hold one
fingerprint in 256 each and pairing up within them is quadratic.  The index
therefore has the intersections of three such lists: with the positions in two
halves of four, any 5 shared bytes have three in one half, so each linked pair
meets in one of the 8 triples within a half.  Pairs that meet have their
shared positional bytes tallied, pairs under the guaranteed 5 go, and the rest
is verified by the number of differing bits.

Scale: the index holds distinct fingerprints, so exact copies cost nothing.  A
posting list is cut into blocks of ``BLOCK`` fingerprints, and a task holds
two blocks at a time; a pair of blocks passes on a spanning forest of its links
(at most the number of its fingerprints), never all pairs, which leaves the
components as they are.  Components come from star operations on the forests.

Cases: null and empty texts have the zero fingerprint, which links like any
other; repeated rows are one group; a null id never names a group unless all
its ids are null; texts are read whole; an empty table gives an empty one;
other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import arrow_batches, keep, text_of
from basketry.llm.components import components

MAX_BITS = 3
SHINGLE = 3
BLOCK = 2048
#: Byte positions that are intersected: the triples within each half.
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of lower-cased ASCII-blank words, as a signed long."""
    from xxhash import xxh64_digest

    words = text.lower().split()  # bytes: A-Z only, the six ASCII blanks only
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = xxh64_digest(b" ".join(words), 42)
        n = 1
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        first = np.append(0, ends[:-1] + 1)
        n = len(words) - shingle + 1
        hashes = b"".join([xxh64_digest(line[a:b], 42) for a, b in
                           zip(first[:n].tolist(), ends[shingle - 1:].tolist(), strict=True)])
    ones = np.zeros(64, np.int64)
    each = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    for at in range(0, n, 4096):
        ones += np.unpackbits(each[at:at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def text_key(text_col: str = "text") -> Column:
    """128 bits that stand for a text; with the id, the identity of a row."""
    return F.unhex(F.md5(text_of(text_col)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """(id, fp) of every row, and its ``text_key`` if ``keyed``; fp is a signed long."""
    def run(batches):
        for b in batches:
            fps = [simhash(t, shingle) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64()), *b.columns[2:]],
                                             ["id", "fp", "key"][:b.num_columns])

    arrow_batches(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"),
                    *[text_key(text_col).alias("key")] * keyed)
    return d.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, fp long" + ", key binary" * keyed)


def positional_byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 56 - 8 * position).bitwiseAND(F.lit(255))


def posting_lists(fps: DataFrame) -> DataFrame:
    """(list, fp): the triple lists that hold two fingerprints or more.

    A list's name is its triple's number over its three bytes."""
    names = [F.lit(k).cast("long") * F.lit(1 << 24) + positional_byte(F.col("fp"), x) * 65536
             + positional_byte(F.col("fp"), y) * 256 + positional_byte(F.col("fp"), z)
             for k, (x, y, z) in enumerate(TRIPLES)]
    rows = fps.select("fp", F.explode(F.array(*names)).alias("list"))
    sizes = rows.groupBy("list").agg(F.count("*").alias("size")).where("size > 1")
    return rows.join(sizes, "list")


def block_pairs(lists: DataFrame, block: int = BLOCK) -> DataFrame:
    """(list, x, y, fp, side): each fingerprint with every pair of blocks of
    its list that its own block is in; a list of one block has one pair."""
    n = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), n).cast("int")
    d = lists.select("list", "fp", n.alias("n"), own.alias("own"))
    d = d.select("list", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    return d.select("list", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                    "fp", (F.col("own") > F.col("other")).alias("side"))


def forest(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the fingerprints."""
    fp = np.unique(fp)
    u = fp.view(np.uint64)
    as_bytes = u.view(np.uint8).reshape(-1, 8)
    left = np.arange(len(fp))
    out: list[tuple[int, int]] = []
    # breadth first: what a fingerprint reaches leaves the list
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            k = todo.pop()
            shared = (as_bytes[left] == as_bytes[k]).sum(axis=1) >= 8 - max_bits  # tally of positional bytes
            near = shared.copy()
            near[shared] = np.bitwise_count(u[left[shared]] ^ u[k]) <= max_bits
            out += [(int(fp[k]), int(fp[x])) for x in left[near]]
            todo += left[near].tolist()
            left = left[~near]
    return out


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that span the components of
    all pairs within ``max_bits`` bits."""
    d = block_pairs(posting_lists(fps), block)
    d = (d.repartition(F.col("list"), F.col("x"), F.col("y"))
         .sortWithinPartitions("list", "x", "y").select("list", "x", "y", "fp"))

    def run(batches):
        # rows come sorted by pair of blocks; the last pair of a batch may go on in the next
        held = [np.zeros(0, np.int64)] * 4
        for b in batches:
            held = [np.concatenate([h, b.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held)]
            ends = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0) | (np.diff(held[2]) != 0)) + 1
            yield from edges_of(held[3], ends)
            if len(ends):
                held = [h[ends[-1]:] for h in held]
        yield from edges_of(held[3], np.array([len(held[3])]))

    def edges_of(fp, ends):
        out = []
        for x, y in zip(np.append(0, ends[:-1]), ends, strict=True) if len(ends) else ():
            out += forest(fp[x:y].astype(np.int64), max_bits)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    return d.mapInArrow(run, "a long, b long")


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
            max_bits: int = MAX_BITS, block: int = BLOCK, keyed: bool = False) -> DataFrame:
    """(fp, id, component_id: the smallest id that the links reach, root: the
    group's own fingerprint, which names it whatever its ids are) of every
    row, and its ``text_key`` if ``keyed``."""
    if max_bits != MAX_BITS:
        raise ValueError("the triple lists guarantee links of up to 3 bits")
    d = keep(fingerprints(docs, id_col, text_col, shingle, keyed), "fingerprints")
    groups = keep(d.groupBy("fp").agg(F.min("id").alias("least")), "groups")
    roots = components(links(groups.select("fp"), max_bits, block)).withColumnRenamed("node", "fp")
    named = groups.join(roots, "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "root").select("fp", "component_id", "root")
    return d.join(named, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(id, fingerprint in hex, component_id: the smallest id that the links
    reach) of every row."""
    return grouped(docs, id_col, text_col, shingle, max_bits, block).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
