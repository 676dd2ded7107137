"""Alignment of two tokenizers over the same texts, and how often their ids meet.

A text is encoded by a byte-level BPE (A, over space + text) and by a
sentencepiece model (B, which puts that space itself).  Both token rows spell
the same bytes; an offset where tokens of both end is a *shared cut*.  Cuts are
found by divide and conquer: of an interval of A's tokens, the end nearest to
its middle that a bisect also finds among B's ends divides it, and both halves
go on; an interval without such an end is a leaf, one *group* of tokens that
stand for each other.  All intervals of one depth are halved together, as
arrays.  A and B tokens whose byte ranges overlap are *linked*; links never
cross a cut, and every stretch between two neighbouring ends of either side is
one link.

An id pair's count is the number of documents (rows) that hold it linked.
Tasks keep each document's distinct pairs with their multiplicity; pairs are
counted in one aggregation with map-side combine.  The counts come back in two
ways: the most frequent pairs (``FREQUENT`` rows at most) are broadcast, what
is left of the documents' pairs is joined by pair and summed by row.  Which way
a pair takes changes no result, and the hot pairs never enter a shuffle.

Scale: texts are aligned in slices of about ``SLICE`` bytes, and a task encodes
a word again only when its memo was full in between.  Longer texts are cut into segments where a space follows a character that is no white
space: neither tokenizer has a token across such a place (checked for B's
pieces), so it is a shared cut, and memory does not grow with the text.  Only a
stretch without any such place is held whole.

Cases: a text that is null, empty, or whose tokens do not spell space + text
(U+2581 in it, say) has no tokens: zeros and the empty string, no hash.
Repeated rows, also with null ids, are documents of their own.  Strings of
special tokens are plain text.  An empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.bpe import pieces
from basketry.llm.common import Store, arrow_batches, text_of
from basketry.llm.pretokens import SLICE, char_classes, file_bytes, segments, split

#: Pairs whose counts are broadcast, at most.
FREQUENT = 1 << 19
#: Ids that a task remembers for each tokenizer, about.
MEMO = 1 << 20
MARK = "▁"  # stands for a space in sentencepiece's pieces


def shared_cuts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of A tokens, number of B tokens) up to each group's end, by
    divide and conquer.  ``a`` and ``b`` are the rising ends of two rows of
    tokens over the same bytes."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, high = np.array([0]), np.array([len(a)])           # intervals of A's tokens
    b_low, b_high = np.array([0]), np.array([len(b)])       # and B's over the same bytes
    cuts, b_cuts = [high], [b_high]
    while True:
        inner = (high - low > 1) & (b_high - b_low > 1)     # others are leaves: no end inside
        low, high, b_low, b_high = low[inner], high[inner], b_low[inner], b_high[inner]
        if not len(low):
            break
        middle = (low + high - 2) // 2
        cut, b_cut = np.full(len(low), -1), np.full(len(low), -1)
        todo, step = np.arange(len(low)), 0
        while len(todo):
            for probe in ([middle[todo]] if not step else [middle[todo] - step, middle[todo] + step]):
                inside = (probe >= low[todo]) & (probe < high[todo] - 1) & (cut[todo] < 0)
                k, p = todo[inside], probe[inside]
                at = np.searchsorted(b, a[p])
                hit = b[at] == a[p]
                cut[k[hit]], b_cut[k[hit]] = p[hit] + 1, at[hit] + 1
            step += 1
            left = (middle[todo] - step >= low[todo]) | (middle[todo] + step < high[todo] - 1)
            todo = todo[left & (cut[todo] < 0)]
        two = cut >= 0
        cut, b_cut = cut[two], b_cut[two]
        cuts.append(cut)
        b_cuts.append(b_cut)
        low, high = np.concatenate([low[two], cut]), np.concatenate([cut, high[two]])
        b_low, b_high = np.concatenate([b_low[two], b_cut]), np.concatenate([b_cut, b_high[two]])
    return np.sort(np.concatenate(cuts)), np.sort(np.concatenate(b_cuts))


class Tokenizers:
    """Both tokenizers, for tasks: their files, broadcast (of fixed size)."""

    def __init__(self, spark: SparkSession, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path_b)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        if any(MARK in x.lstrip(MARK) for x in names):
            raise ValueError("pieces with a space after another character are not handled")
        spelled = [bytes([int(x[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i)
                   else x.replace(MARK, " ").encode() for i, x in enumerate(names)]
        table = pieces(path_a)
        self.size_a, self.size_b = len(table), len(spelled)
        share = spark.sparkContext.broadcast
        self._files = share((file_bytes(path_a), file_bytes(path_b)))
        self._pieces = share((table, spelled))
        self._classes = share(char_classes().tobytes())

    def open(self) -> "Tokenizers":
        """Ready for use in a task."""
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        pa.set_memory_pool(pa.system_memory_pool())  # gives back what it frees
        self.a = Tokenizer.from_str(self._files.value[0].decode())
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_proto=self._files.value[1])
        lone = [self.b.piece_to_id(MARK)]  # a space that nothing follows
        self.memo_a = Memo(lambda ws: [e.ids for e in self.a.encode_batch_fast(ws, add_special_tokens=False)])
        self.memo_b = Memo(lambda ws: [x or lone for x in self.b.encode([w[1:] for w in ws], num_threads=1)])
        self.classes = np.frombuffer(self._classes.value, np.uint8)
        self.spelled = [pa.array(x, pa.large_binary()) for x in self._pieces.value]
        self.lengths = [np.array([len(y) for y in x], np.int64) for x in self._pieces.value]
        most = max(self.size_a, self.size_b)
        self.written = pa.array([b"%d%s" % (i, s) for i in range(most) for s in (b",", b"|", b";", b"")], pa.large_binary())
        return self

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("size_a", "size_b", "_files", "_pieces", "_classes")}

    def encode_a(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids up to the end of each)."""
        counts, words = split([t.decode() for t in texts], (), self.classes)
        return self.memo_a(counts, words)

    def encode_b(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same; every text begins with the space that the model puts."""
        data = b"".join(texts)
        ends = np.cumsum([len(t) for t in texts])
        byte = np.frombuffer(data, np.uint8)
        start = byte == 32
        start[1:] &= byte[:-1] != 32
        start[0] = True
        start[ends[:-1]] = True
        at = np.append(np.flatnonzero(start), len(byte))
        words = pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
        counts = np.diff(np.searchsorted(at, np.append(0, ends)))
        return self.memo_b(counts, words)


class Memo:
    """Ids of the words that a task has met: a word is encoded once, until the
    memo holds ``MEMO`` ids and begins anew."""

    def __init__(self, encode):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.place, self.ids, self.ends = {}, np.zeros(0, np.int64), np.zeros(1, np.int64)

    def __call__(self, counts: np.ndarray, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words one after the other, number of ids up to the end
        of each text of ``counts`` words)."""
        if len(self.ids) > MEMO:
            self.clear()
        d = words.dictionary_encode()
        distinct = d.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = [self.place.get(w, -1) for w in distinct]
        new = [w for w, k in zip(distinct, at, strict=True) if k < 0]
        if new:
            lists, known = self.encode(new), len(self.place)
            self.place.update(zip(new, range(known, known + len(new)), strict=True))
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(lists), np.int64)])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.fromiter(map(len, lists), np.int64, len(new)))])
        at = np.array(at, np.int64)
        at[at < 0] = len(self.place) - len(new) + np.arange(len(new))
        at = at[d.indices.to_numpy(zero_copy_only=False)]
        begin = self.ends[at]
        size = self.ends[at + 1] - begin
        total = np.append(0, np.cumsum(size))
        return self.ids[np.arange(total[-1]) + np.repeat(begin - total[:-1], size)], total[np.cumsum(counts)]


def _joined(table: pa.Array, at: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Entries of ``table`` in a row, cut after each of ``ends`` entries."""
    if not len(at):
        return [b""] * len(ends)
    found = table.take(pa.array(at))
    place = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1, 8 * found.offset)
    data, cut = memoryview(found.buffers()[2]), place[np.append(0, ends)].tolist()
    return [bytes(data[x:y]) for x, y in zip(cut[:-1], cut[1:], strict=True)]


def _kept(ids: np.ndarray, ends: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(ends, prepend=0)
    return ids[np.repeat(good, n)], np.cumsum(np.where(good, n, 0))


def align_segments(tok: Tokenizers, texts: list[bytes]) -> Iterator[tuple | None]:
    """For each text (which begins with a space): None if its tokens do not
    spell it, else (n_a, n_b, n_groups, n_links, groups as text, distinct
    pairs in order, how often each is linked)."""
    (ids_a, ends_a), (ids_b, ends_b) = tok.encode_a(texts), tok.encode_b(texts)
    good = np.array([x == y == t for x, y, t in zip(
        _joined(tok.spelled[0], ids_a, ends_a), _joined(tok.spelled[1], ids_b, ends_b), texts, strict=True)], bool)
    (ids_a, ends_a), (ids_b, ends_b) = _kept(ids_a, ends_a, good), _kept(ids_b, ends_b, good)
    a, b = np.cumsum(tok.lengths[0][ids_a]), np.cumsum(tok.lengths[1][ids_b])
    text_ends = np.cumsum(np.where(good, [len(t) for t in texts], 0))
    cut_a, cut_b = shared_cuts(a, b)  # the ends of texts are shared
    cuts = np.searchsorted(cut_a, ends_a, "right")

    # groups as text: A's ids of a group, then B's
    group_a = np.searchsorted(cut_a, np.arange(len(a)), "right")
    group_b = np.searchsorted(cut_b, np.arange(len(b)), "right")
    mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    mark_a[cut_a - 1], mark_b[cut_b - 1] = 1, 2
    mark_b[ends_b[ends_b > 0] - 1] = 3
    row = np.empty(len(a) + len(b), np.int64)
    row[np.arange(len(a)) + np.append(0, cut_b)[group_a]] = ids_a * 4 + mark_a
    if len(b):
        row[np.arange(len(b)) + cut_a[group_b]] = ids_b * 4 + mark_b
    written = _joined(tok.written, row, ends_a + ends_b)

    # links: the stretches between neighbouring ends of either side
    ends = np.concatenate([a, b])
    ends.sort(kind="stable")
    ends = ends[np.append(True, ends[1:] != ends[:-1])] if len(ends) else ends
    pair = ids_a[np.searchsorted(a, ends)] * tok.size_b + ids_b[np.searchsorted(b, ends)]
    text = np.searchsorted(text_ends, ends)
    links = np.bincount(text, minlength=len(texts))
    held, times = np.unique(text * (tok.size_a * tok.size_b) + pair, return_counts=True)
    of = np.searchsorted(held, np.arange(len(texts) + 1) * (tok.size_a * tok.size_b))
    held %= tok.size_a * tok.size_b
    n_a, n_b, n_groups = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0), np.diff(cuts, prepend=0)
    for i, ok in enumerate(good.tolist()):
        yield (int(n_a[i]), int(n_b[i]), int(n_groups[i]), int(links[i]), written[i],
               held[of[i]:of[i + 1]], times[of[i]:of[i + 1]]) if ok else None


def _document(parts: list[tuple | None], whole: bool) -> tuple:
    """The parts of one text put together; its groups as text if ``whole``."""
    if not parts or None in parts:
        return 0, 0, 0, 0, "", *[""] * whole, np.zeros(0, np.int64), np.zeros(0, np.int64)
    sums = [sum(p[i] for p in parts) for i in range(4)]
    digest = hashlib.sha256()
    for i, p in enumerate(parts):
        digest.update(b";" * (i > 0) + p[4])
    pairs, times = parts[0][5:]
    if len(parts) > 1:
        pairs, at = np.unique(np.concatenate([p[5] for p in parts]), return_inverse=True)
        times = np.bincount(at, np.concatenate([p[6] for p in parts])).astype(np.int64)
    return *sums, digest.hexdigest(), *[b";".join(p[4] for p in parts).decode()] * whole, pairs, times


def align(docs: DataFrame, tok: Tokenizers, id_col: str = "doc_id", text_col: str = "text",
          groups: bool = False) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups_sha256, [groups: `a1,a2|b1;...`,]
    pairs: distinct linked id pairs as a * size of B + b, times: links of
    each) of every row."""
    def run(batches):
        own = tok.open()
        for batch in batches:
            held, size, done = [], 0, []

            def flush():
                nonlocal held, size
                rows = [t for _, t in held]
                found = list(align_segments(own, rows)) if rows else []
                for (i, _), x in zip(held, found, strict=True):
                    done[i].append(x)
                held, size = [], 0

            sent = 0
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                done.append([])
                for s in segments(b" " + text) if text else ():
                    held.append((i, s))
                    size += len(s)
                    if size >= SLICE:
                        flush()
                if len(done) - sent >= 500:
                    flush()
                    yield record(batch, done, sent)
                    sent = len(done)
            flush()
            yield record(batch, done, sent)

    def record(batch, done, sent):
        rows = [_document(x, groups) for x in done[sent:]]
        done[sent:] = [None] * len(rows)
        cols = list(zip(*rows, strict=True)) or [()] * (7 + groups)
        lists = []
        for x in cols[-2:]:
            ends = np.cumsum([0, *map(len, x)])
            flat = np.concatenate([*x, np.zeros(0, np.int64)]).astype(small)
            lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).slice(sent, len(rows)), *[pa.array(x, pa.int64()) for x in cols[:4]],
             *[pa.array(x, pa.string()) for x in cols[4:-2]], *lists],
            ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *["groups"] * groups, "pairs", "times"])

    fits = tok.size_a * tok.size_b < 1 << 31
    small, kind = (np.int32, "int") if fits else (np.int64, "bigint")
    arrow_batches(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return d.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, n_a long, n_b long, n_groups long, "
                             f"n_links long, groups_sha256 string, {'groups string, ' * groups}"
                             f"pairs array<{kind}>, times array<{kind}>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n: documents that hold it)."""
    pairs = aligned.select(F.explode("pairs").alias("pair"))
    return pairs.groupBy(F.col("pair").cast("long").alias("pair")).agg(F.count(F.lit(1)).alias("n"))


def with_best(counts: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best: no pair of its A id has more).  The best counts, one for
    each A id, are broadcast: the vocabulary bounds their number."""
    a = F.floor(F.col("pair") / F.lit(size_b)).cast("long").alias("a")
    best = counts.groupBy(a).agg(F.max("n").alias("most"))
    return (counts.select("*", a).join(F.broadcast(best), "a")
            .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
              groups: bool = False, frequent: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """(rows of ``align`` without pairs, with n_best: links whose count is
    their A id's highest, and count_sum over links; the table of id pairs
    (a, b, n, best))."""
    spark = docs.sparkSession
    tok, store = Tokenizers(spark, path_a, path_b), Store(spark)

    def kept(df, name):
        df.write.option("compression", "zstd").parquet(store.path(name))
        return store.read(name)

    rows = kept(align(docs, tok, id_col, text_col, groups).withColumn("row", F.monotonically_increasing_id()), "aligned")
    scored = kept(with_best(kept(pair_counts(rows), "counts"), tok.size_b), "scored")

    # the most frequent pairs, cut between quarter powers of two: at most 256 numbers come to the driver
    level = F.floor(F.log2(F.col("n").cast("double")) * 4).cast("int")
    left, least = frequent, 1 << 20
    for r in scored.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        if r["count"] > left:
            break
        left, least = left - r["count"], r["level"]
    known = scored.where(level >= least).orderBy("pair").toArrow()
    known = spark.sparkContext.broadcast([known.column(c).combine_chunks().cast(pa.int64() if c != "best" else pa.int8())
                                          .to_numpy(zero_copy_only=False).tobytes() for c in ("pair", "n", "best")])

    def sums(batches):
        pair, n, best = (np.frombuffer(x, t) for x, t in zip(known.value, (np.int64, np.int64, np.int8), strict=True))
        for b in batches:
            pairs = b.column(b.schema.get_field_index("pairs"))
            at_rows = pairs.offsets.to_numpy().astype(np.int64)
            at_rows = at_rows - at_rows[0]
            flat = pairs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            times = b.column(b.schema.get_field_index("times")).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.minimum(np.searchsorted(pair, flat), max(len(pair) - 1, 0))
            hit = pair[at] == flat if len(pair) else np.zeros(len(flat), bool)
            both = []
            for each in (best, n):
                run = np.zeros(len(flat) + 1, np.int64)
                if len(pair):
                    np.cumsum(np.where(hit, times * each[at], 0), out=run[1:])
                both.append(pa.array(np.diff(run[at_rows]), pa.int64()))
            rest = np.append(0, np.cumsum(~hit))[at_rows]
            entries = pa.StructArray.from_arrays([pa.array(flat[~hit]), pa.array(times[~hit])], ["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [*[b.column(b.schema.get_field_index(c)) for c in names], *both,
                 pa.ListArray.from_arrays(pa.array(rest, pa.int32()), entries)], [*names, "n_best", "count_sum", "rest"])

    names = [c for c in rows.columns if c not in ("pairs", "times")]
    plain = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    summed = kept(rows.mapInArrow(sums, f"{plain}, n_best long, count_sum long, rest array<struct<pair:long,times:long>>"), "sums")
    rest = (summed.select("row", F.inline("rest")).join(scored, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
                 F.sum(F.col("times") * F.col("n")).alias("_sum")))
    out = summed.drop("rest").join(rest, "row", "left")
    out = out.select(F.col("id").alias(id_col), *[c for c in names if c not in ("id", "row")],
                     (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
                     (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"))
    a = F.floor(F.col("pair") / F.lit(tok.size_b)).cast("long")
    return out, scored.select(a.alias("a"), (F.col("pair") - a * tok.size_b).alias("b"), "n", "best")
