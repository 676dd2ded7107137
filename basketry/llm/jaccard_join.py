"""N-gram Jaccard self-join by grouped prefixes.

A document's set holds its distinct shingles of five words (64-bit hashes; with
fewer words the whole sequence is one).  Sets link when their intersection is
at least ``percent`` of their union.  All sets are put in one order: shingles
that many documents share last, by count, the others first, by hash.  Two sets
that link then share a shingle within the first n - ceil(percent n) + 1 of each,
their *prefixes*.  Documents with the same set are one set, and sets of the same
prefix and size are one *group*; groups that meet in a prefix shingle are
filtered by their sizes and by the shingle's places, and only then expanded to
member sets, whose whole sets are intersected.

Components instead of all pairs: linked sets need not be compared again.  First
every group is compared with few *pivots*, the sets of its shingles that have
fewest rare shingles before them, for some rounds; what is linked becomes a
class.  Then every pair of groups that meet and hold sets of different classes
is expanded and verified, whatever their number.  So a large group of near
copies costs a few comparisons a member, and no link between classes is missed.

Of a pair that meets in a short list sizes and places are looked at before
anything else is done with it.  A pair is verified once, whatever rounds it
comes up in, and whole sets are fetched only for pairs whose *marks* (the upper
16 bits of every hash, a bound of the intersection from above) may link.

Scale: which shingles are common is read from reports of every task over its
whole input (``HOT`` rows at most are broadcast); that orders the sets and never
changes a result.  Copies and equal groups are merged with map-side combine
before their shingles are shuffled.  Whole sets travel only for documents whose
prefix meets another: a Bloom filter of bounded size lets all of those through,
and an exact join follows.

Cases: null and empty texts and texts without words have the empty set, link
with nothing and are their own component; equal rows are linked; a component's
id is its least non-null id; texts are read whole and in pieces, so memory
holds eight bytes a word; an empty table gives an empty one; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Store, arrow_batches, text_of
from basketry.llm.components import components
from basketry.operators.bitmaps import SEGMENT, has_bit, packed
from basketry.sources.store import delete_path

SHINGLE = 5
PERCENT = 80
#: Common shingles that are broadcast, at most, and that a task reports.
HOT = 1 << 18
LOCAL = 1 << 16
#: Rounds of pivots before the exact one, and pivots a group is compared with in each.
ROUNDS = 3
PIVOTS = 2
#: Bits of the Bloom filter, at most.
BLOOM = 1 << 27
PIECE = 1 << 20
#: Bits of the shingles by which sets meet; what meets is compared by whole hashes.
MEET = (1 << 48) - 1
#: Longest list of sets that meet whose pairs are looked at one by one before the rounds.
SHORT = 32
#: Bits that a mark leaves out of a hash of 64.
MARK = 48
BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes with A-Z lower-cased and the six blanks as spaces.
LOWER = np.array([32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


class LeanStore(Store):
    """A store whose writes leave no shuffle files behind: what a table was
    shuffled by goes when it is written, not when the driver next collects its
    garbage."""

    FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        before = self.spark.conf.get(self.FREE, "false")
        self.spark.conf.set(self.FREE, "true")
        try:
            return super().write(df, name)
        finally:
            self.spark.conf.set(self.FREE, before)


def pieces_of(text: bytes) -> list[bytes]:
    """A text in pieces of about PIECE bytes, cut at blanks."""
    out, begin = [], 0
    while len(text) - begin > PIECE and (cut := BLANK.search(text, begin + PIECE)):
        out.append(text[begin:cut.start()])
        begin = cut.start()
    return [*out, text[begin:]]


def word_hashes(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of the pieces, number of words up to each piece's
    end).  Words stand between the six ASCII blanks and A-Z are lower-cased."""
    byte = LOWER[np.frombuffer(b" ".join(pieces) + b" ", np.uint8)]
    full = byte != 32
    edge = np.flatnonzero(np.diff(full, prepend=False))
    start, end = edge[::2], edge[1::2]
    ends = np.searchsorted(start, np.cumsum([len(x) + 1 for x in pieces]))
    if not len(start):
        return np.zeros(0, np.uint64), ends
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
    power = np.cumprod(np.full(size.max(), 0x9E3779B97F4A7C15, np.uint64))
    h = np.add.reduceat((byte[full].astype(np.uint64) + np.uint64(1)) * power[place], first)
    h ^= size.astype(np.uint64) << np.uint64(32)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32)), ends


def sets_of(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """The set of each text: sorted hashes of its shingles."""
    owner = [(i, x) for i, t in enumerate(texts) for x in pieces_of(t)]
    at, held = 0, []
    while at < len(owner):
        to, bytes_ = at, 0
        while to < len(owner) and (to == at or bytes_ + len(owner[to][1]) <= PIECE):
            bytes_ += len(owner[to][1])
            to += 1
        h, ends = word_hashes([x for _, x in owner[at:to]])
        begin = 0
        for k in range(at, to):
            held.append(h[begin:ends[k - at]])
            begin = ends[k - at]
            if k + 1 == len(owner) or owner[k + 1][0] != owner[k][0]:  # a text's last piece
                yield shingles(held[0] if len(held) == 1 else np.concatenate(held), size)
                held = []
        at = to


def shingles(word: np.ndarray, size: int) -> np.ndarray:
    if not len(word):
        return np.zeros(0, np.int64)
    k, n = min(size, len(word)), max(len(word) - size + 1, 1)
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = (h ^ word[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return np.unique(h.view(np.int64))


def needed(n, percent: int):
    """Least size of an intersection with a set of n that links: ceil(percent n)."""
    return (n * percent + 99) // 100


def common_shingles(docs: DataFrame, size: int, hot: int, local: int) -> np.ndarray:
    """The common shingles, rarest first: the most frequent of every task's
    report, cut between quarter powers of two of their counts."""
    def largest(keys, counts, most):
        if len(keys) <= most:
            return keys, counts
        keep = np.sort(np.argpartition(-counts, most)[:most])
        return keys[keep], counts[keep]

    def report(batches):
        new, n = [], 0
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def merged(keys, counts, new):
            k, c = np.unique(np.concatenate(new), return_counts=True)
            both, at = np.unique(np.concatenate([keys, k]), return_inverse=True)
            return largest(both, np.bincount(at, np.concatenate([counts, c])).astype(np.int64), 8 * local)

        for b in batches:
            for s in sets_of(b.column(0).cast(pa.binary()).to_pylist(), size):
                new.append(s)
                n += len(s)
                if n > 16 * local:
                    keys, counts = merged(keys, counts, new)
                    new, n = [], 0
        if new:
            keys, counts = merged(keys, counts, new)
        more = counts > 1
        keys, counts = largest(keys[more], counts[more], local)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["shingle", "n"])

    d = docs.select("text").mapInArrow(report, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    d = Store(docs.sparkSession).write(d, "reports")
    level = F.floor(F.log2(F.col("n").cast("double")) * 4).cast("int")
    left, least = hot, 1 << 20
    for r in d.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # <= 256 rows
        if r["count"] > left:
            break
        left, least = left - r["count"], r["level"]
    t = d.where(level >= least).toArrow().combine_chunks()
    keys, counts = (t.column(i).to_numpy() for i in (0, 1))
    return keys[np.lexsort((keys, counts))]


def prefixes(docs: DataFrame, size: int, percent: int, common: np.ndarray) -> DataFrame:
    """(id, n: size of the set, set_key, group_key, prefix in the common order)."""
    order = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[order].tobytes(), order.tobytes()))

    def run(batches):
        keys, rank = (np.frombuffer(x, np.int64) for x in shared.value)
        for b in batches:
            rows = []
            for s in sets_of(b.column(1).cast(pa.binary()).to_pylist(), size):
                if not len(s):
                    rows.append((0, None, None, None))
                    continue
                p = len(s) - needed(len(s), percent) + 1
                at = np.minimum(np.searchsorted(keys, s), max(len(keys) - 1, 0))
                hot = keys[at] == s if len(keys) else np.zeros(len(s), bool)
                first = s[~hot][:p]
                if len(first) < p:
                    first = np.concatenate([first, s[hot][np.argsort(rank[at[hot]])][:p - len(first)]])
                rows.append((len(s), hashlib.md5(s.tobytes()).digest(),
                             hashlib.md5(first.tobytes() + len(s).to_bytes(8, "little")).digest(), first & MEET))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary()),
                 pa.array(cols[3], pa.list_(pa.int64()))], ["id", "n", "set_key", "group_key", "prefix"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, n int, set_key binary, "
                                "group_key binary, prefix array<long>")


def whole_sets(docs: DataFrame, wanted: DataFrame, size: int, bloom: int) -> DataFrame:
    """(set, shingles) of the wanted (set, set_key).  Rows that the filter lets
    through carry their sets to the exact join."""
    n = wanted.count()
    bits = max(SEGMENT, min(bloom, 1 << (16 * n).bit_length()))
    places = wanted.select(F.explode(F.array(*[_place(F.col("set_key"), k, bits) for k in (0, 1)])).alias("place"))
    filled = np.zeros(bits // 8, np.uint8)
    for r in packed(places, "place").toLocalIterator():  # bits / 8 bytes in all
        filled[r["segment"] * (SEGMENT // 8):][:SEGMENT // 8] = np.frombuffer(r["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(filled.tobytes())

    def run(batches):
        filled = np.frombuffer(shared.value, np.uint8)
        for b in batches:
            rows = []
            for s in sets_of(b.column(0).cast(pa.binary()).to_pylist(), size):
                if not len(s):
                    continue
                key = hashlib.md5(s.tobytes()).digest()
                at = [int.from_bytes(key[4 * k:4 * k + 4], "big") % bits for k in (0, 1)]
                if all(filled[x >> 3] >> (x & 7) & 1 for x in at):
                    rows.append((key, s))
            cols = list(zip(*rows, strict=True)) or [()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.list_(pa.int64()))],
                                             ["set_key", "shingles"])

    d = docs.select("text").mapInArrow(run, "set_key binary, shingles array<long>")
    d = d.groupBy("set_key").agg(F.first("shingles").alias("shingles"))
    return wanted.join(d, "set_key").select("set", "shingles")


def _place(key: Column, k: int, bits: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring(key, 4 * k + 1, 4)), 16, 10).cast("long"), F.lit(bits))


def standing_in(pairs: DataFrame, sets: DataFrame, bloom: int) -> DataFrame:
    """The sets that stand in the pairs, and few others: a packed bitmap of
    hashed set numbers (bloom / 8 bytes at most, broadcast) is asked before
    anything of a set is shuffled; the joins after it are exact."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("set"))
    bits = max(SEGMENT, min(bloom, 1 << (32 * pairs.count()).bit_length()))
    place = F.pmod(F.xxhash64("set"), F.lit(bits))
    filled = packed(ends.select(place.alias("place")), "place")
    d = sets.select("*", place.alias("_at")).withColumn("segment", F.floor(F.col("_at") / SEGMENT))
    return d.join(F.broadcast(filled), "segment").where(has_bit(F.col("bits"), F.col("_at"))).select(*sets.columns)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) of sets, those that link."""
    x = sets.select(F.col("set").alias("a"), F.col("shingles").alias("_x"))
    y = sets.select(F.col("set").alias("b"), F.col("shingles").alias("_y"))
    d = pairs.join(y, "b").join(x, "a")
    both = F.size(F.array_intersect("_x", "_y"))
    return d.where(both * (100 + percent) >= (F.size("_x") + F.size("_y")) * percent).select("a", "b")


def untried(pairs: DataFrame, tried: DataFrame | None) -> DataFrame:
    """The pairs (a < b), each once, without those of earlier rounds: these are
    linked by now or never will be."""
    d = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return d if tried is None else d.join(tried, ["a", "b"], "left_anti")


def near_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) of sets, those that link and few others.  Hashes that
    two sets share have marks that they share; those of equal marks are at most
    the hashes that each set has more than marks."""
    d = sets.select("set", F.size("shingles").cast("long").alias("n"),
                    F.array_distinct(F.transform("shingles", lambda s: F.shiftright(s, MARK).cast("smallint"))).alias("marks"))
    x = d.select(F.col("set").alias("a"), F.col("n").alias("_nx"), F.col("marks").alias("_x"))
    y = d.select(F.col("set").alias("b"), F.col("n").alias("_ny"), F.col("marks").alias("_y"))
    d = pairs.join(y, "b").join(x, "a")
    most = F.size(F.array_intersect("_x", "_y")) + F.least(F.col("_nx") - F.size("_x"), F.col("_ny") - F.size("_y"))
    return d.where(most * (100 + percent) >= (F.col("_nx") + F.col("_ny")) * percent).select("a", "b")


def may_link(x: str, y: str, percent: int) -> Column:
    """Of two groups that meet at places px and py of their prefixes: whether
    their sizes and the shingles from there on leave room for a link."""
    nx, px, ny, py = (F.col(c) for c in (f"{x}.n", f"{x}.place", f"{y}.n", f"{y}.place"))
    sizes = F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent
    return sizes & (F.least(nx - px, ny - py) * (100 + percent) >= (nx + ny) * percent)


def classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, hot: int = HOT, local: int = LOCAL,
            rounds: int = ROUNDS, bloom: int = BLOOM) -> tuple[DataFrame, DataFrame]:
    """For ``docs`` (id, text without nulls): (rows (id, n, set_key), sets
    (set_key, root: least set that links reach, least: least id of the set))."""
    spark = docs.sparkSession
    store = LeanStore(spark)
    arrow_batches(spark)
    full = store.write(prefixes(docs, size, percent, common_shingles(docs, size, hot, local)), "prefixes")
    rows, full = store.write(full.select("id", "n", "set_key"), "rows"), full.where("n > 0")
    groups = full.groupBy("group_key").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    groups = store.write(groups.withColumn("group", F.monotonically_increasing_id()), "groups")
    sets = full.groupBy("set_key").agg(F.first("group_key").alias("group_key"), F.min("id").alias("least"))
    sets = sets.join(groups.select("group_key", "group", "n"), "group_key").select("set_key", "group", "n", "least")
    sets = store.write(sets.withColumn("set", F.monotonically_increasing_id()), "sets")

    # lists of prefix shingles in which two groups or more meet
    posted = groups.select("group", "n", F.posexplode("prefix").alias("place", "shingle"))
    shared = posted.groupBy("shingle").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    delete_path(spark, store.path("prefixes"))
    lists = store.write(posted.join(shared, "shingle"), "meeting")
    delete_path(spark, store.path("groups"))
    lists = store.write(_with_partner(lists, percent), "lists")
    delete_path(spark, store.path("meeting"))
    several = sets.groupBy("group").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("group")
    meeting = lists.select("group").unionByName(several).distinct()
    wanted = store.write(sets.join(meeting, "group").select("set", "set_key", "group"), "wanted")
    whole = store.write(whole_sets(docs, wanted, size, bloom), "whole")

    links, tried, k = None, None, 0
    roots = wanted.select(F.col("set").alias("node"), F.col("set").alias("root"))
    while k <= rounds:
        # (group, class, one of its sets): the sets of a group that are linked already are one
        held = wanted.join(roots, F.col("set") == F.col("node")).select("set", "group", F.col("root").alias("class"))
        held = store.write(held, f"held{k}")
        each = held.groupBy("group", "class").agg(F.min("set").alias("set"))
        placed = store.write(lists.join(each, "group"), f"placed{k}")
        pairs = _pivot_pairs(placed, each, percent) if k < rounds else _open_pairs(placed, each, held, percent)
        pairs = store.write(untried(pairs, tried), f"pairs{k}")
        tried = pairs if tried is None else tried.unionByName(pairs)
        for done in ("held", "placed"):
            delete_path(spark, store.path(f"{done}{k}"))
        near = store.write(near_pairs(pairs, standing_in(pairs, whole, bloom), percent), f"near{k}")
        new = store.write(verified(near, standing_in(near, whole, bloom), percent), f"links{k}")
        if not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            roots = store.write(_roots(wanted, links), f"roots{k}")
            k += 1
        else:
            k = rounds if k < rounds else rounds + 1  # pivots have no more to say: the exact round is next
    delete_path(spark, store.path("whole"))
    sets = sets.join(roots, F.col("set") == F.col("node"), "left")
    return rows, sets.select("set_key", F.coalesce("root", "set").alias("root"), "least")


def _with_partner(lists: DataFrame, percent: int) -> DataFrame:
    """The rows of the lists that have a partner they may link with.  Only
    short lists are looked at; rows of longer ones (in parts of about SHORT
    rows here) all stay."""
    cell = F.when(F.col("m") <= SHORT, 0).otherwise(F.pmod(F.xxhash64("group"), F.floor(F.col("m") / SHORT)).cast("int"))
    d = lists.groupBy("shingle", cell.alias("cell"), "m").agg(F.collect_list(F.struct("group", "n", "place")).alias("all"))

    def links(x, y):
        sizes = F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * percent
        room = F.least(x["n"] - x["place"], y["n"] - y["place"]) * (100 + percent) >= (x["n"] + y["n"]) * percent
        return (x["group"] != y["group"]) & sizes & room

    kept = F.when(F.col("m") > SHORT, F.col("all")).otherwise(
        F.filter("all", lambda x: F.exists("all", lambda y: links(x, y))))
    return d.select("shingle", F.inline(kept))


def _roots(wanted: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links)
    d = wanted.select(F.col("set")).join(found, F.col("set") == F.col("node"), "left")
    return d.select(F.col("set").alias("node"), F.coalesce("root", "set").alias("root"))


def _pivot_pairs(placed: DataFrame, each: DataFrame, percent: int) -> DataFrame:
    """(a, b): every group's class with few pivots of other classes: of each
    list the set that comes first, by its place and then by a hash."""
    pivot = placed.groupBy("shingle").agg(
        F.min(F.struct("place", F.xxhash64("set").alias("h"), "set", "class", "n")).alias("p"))
    pivot = pivot.select("shingle", *[F.col(f"p.{c}").alias(c) for c in ("place", "set", "class", "n")])
    d = placed.alias("x").join(pivot.alias("y"), F.col("x.shingle") == F.col("y.shingle"))
    d = d.where((F.col("x.class") != F.col("y.class")) & may_link("x", "y", percent))
    d = d.select(F.col("x.set").alias("a"), F.col("y.set").alias("b"))
    # inside a group: every class with the group's least set
    least = each.groupBy("group").agg(F.min("set").alias("b"))
    inside = each.join(least, "group").where("set <> b").select(F.col("set").alias("a"), "b")
    d = d.unionByName(inside).groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"))
    return d.select("a", F.explode(F.array_distinct(F.array("low", "high"))).alias("b"))


def _open_pairs(placed: DataFrame, each: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of sets of different classes whose groups meet and may
    link.  In a list the rows of its largest class meet only those of others."""
    counts = placed.groupBy("shingle", "class").agg(F.count(F.lit(1)).alias("_n"))
    major = counts.groupBy("shingle").agg(F.max(F.struct("_n", "class")).alias("m"), F.count(F.lit(1)).alias("_classes"))
    major = major.where("_classes > 1").select("shingle", F.col("m.class").alias("major"))
    mixed = placed.join(major, "shingle")
    minor = mixed.where(F.col("class") != F.col("major"))
    d = minor.alias("x").join(mixed.alias("y"), F.col("x.shingle") == F.col("y.shingle"))
    d = d.where((F.col("x.class") != F.col("y.class")) & may_link("x", "y", percent)
                & ((F.col("x.class") < F.col("y.class")) | (F.col("y.class") == F.col("y.major"))))
    ends = [F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "xy" for c in ("group", "class")]
    inside = each.alias("x").join(each.alias("y"), (F.col("x.group") == F.col("y.group")) & (F.col("x.class") < F.col("y.class")))
    d = d.select(*ends).unionByName(inside.select(*ends)).distinct()
    for s, out in (("x", "a"), ("y", "b")):
        own = held.select(F.col("set").alias(out), F.col("group").alias(f"{s}_group"), F.col("class").alias(f"{s}_class"))
        d = d.join(own, [f"{s}_group", f"{s}_class"]).drop(f"{s}_group", f"{s}_class")
    return d.select("a", "b")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                 percent: int = PERCENT, hot: int = HOT, local: int = LOCAL, rounds: int = ROUNDS,
                 bloom: int = BLOOM) -> DataFrame:
    """(id, n_shingles, component_id: the least id that links reach) of every row."""
    d = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows, sets = classes(d, size, percent, hot, local, rounds, bloom)
    least = sets.groupBy("root").agg(F.min("least").alias("component_id"))
    sets = sets.join(least, "root").select("set_key", "component_id")
    out = rows.join(sets, "set_key", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
