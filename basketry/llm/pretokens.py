"""Pre-tokens of a byte-level BPE vocabulary and the table of distinct ones.

Texts are split by the public pattern of the vocabulary

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

inside Spark tasks, over the code points of a whole Arrow batch at once.  The
classes \\p{L}, \\p{N} and \\s are asked of the tokenizers library, so that both
know the same version of Unicode.

The table of distinct pre-tokens has two parts.  *Known words* are frequent:
every task that reads documents reports its ``LOCAL`` most frequent words, and of the
summed reports at most ``FREQUENT`` short words are taken, encoded once and
broadcast (a fixed number of rows of bounded size).  All other words are rare;
pairs of a document and a rare word are shuffled and sorted by word, where
each distinct word is encoded once, and go back to their documents.  So the
frequent words, which would be the hot keys of that shuffle, never enter it,
and which part a word is in changes nothing but its way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import arrow_batches, keep, text_of

#: Rows of the broadcast part of the word table, and bytes of its longest word.
FREQUENT = 1 << 19
FREQUENT_BYTES = 64
#: Words that a task reports as frequent; it holds 3 times as many at most.
LOCAL = 1 << 17
#: Tasks that share the rows of a word too long to be known.
LONG_SPLIT = 64
#: Code points that are split at a time.
SLICE = 1 << 18

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3


def char_classes(kept: list = []) -> np.ndarray:  # noqa: B006
    """Class of every code point, as the tokenizers library sees it.  The table
    is kept in the default argument: a plain function travels by value, a cache
    wrapper would travel by name and need this package on the executors."""
    if kept:
        return kept[0]
    from tokenizers import Regex, pre_tokenizers

    table = np.zeros(0x110000, np.uint8)
    for low in range(0, 0x110000, 0x4000):
        points = np.array([c for c in range(low, low + 0x4000) if not 0xD800 <= c < 0xE000], np.int64)
        text = "".join(map(chr, points.tolist()))
        for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
            inside = np.ones(len(points), bool)
            for _, (a, b) in pre_tokenizers.Split(Regex(pattern), "removed").pre_tokenize_str(text):
                inside[a:b] = False  # what is left stands between the matches
            table[points[inside]] = kind
    kept.append(table)
    return table


def _starts(cls: np.ndarray, cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a pre-token starts; ``first``: True where a text starts."""
    n = len(cp)
    prev = np.empty(n, np.uint8)
    prev[0] = SPACE
    prev[1:] = cls[:-1]
    space = cls == SPACE
    start = (cls != prev) | first
    # a blank before something else in the same text belongs to what follows
    blank = cp == 32
    joined = np.zeros(n, bool)
    joined[1:] = blank[:-1] & ~space[1:] & ~first[1:]
    # the last of several white-space characters stands alone, or goes with what follows
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~first[1:]
    start = (start & ~joined) | last
    # contractions, where a pre-token begins with an apostrophe
    quote = np.flatnonzero((cp == 39) & start)
    if len(quote):
        wide_cp = np.concatenate([cp, np.zeros(3, cp.dtype)])
        wide_first = np.concatenate([first, np.ones(3, bool)])
        a, b = wide_cp[quote + 1], wide_cp[quote + 2]
        one = ~wide_first[quote + 1]
        two = one & ~wide_first[quote + 2]
        short = one & np.isin(a, [ord(c) for c in "stmd"])
        long = two & (((a == 114) & (b == 101)) | ((a == 118) & (b == 101)) | ((a == 108) & (b == 108)))
        for hit, size in ((short, 2), (long, 3)):
            q = quote[hit]
            start[q + 1] = False
            q = q[q + size < n] + size
            # what follows begins anew, unless a blank already carries it
            start[q] = start[q] | (cls[q] != SPACE)
    return start


def _utf8_lengths(cp: np.ndarray) -> np.ndarray:
    return (1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF)).astype(np.int64)


def split(texts: list[str], special: tuple[str, ...], classes: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(words in each text, all words one after the other).

    Strings of the special tokens inside a text are words of their own and end
    the text before them, as the library has it."""
    pieces, owner, fixed = [], [], []
    for i, t in enumerate(texts):
        parts = [t]
        for s in special:
            if s in t:
                parts = [y for x in parts for y in (_between(x, s) if x not in special else [x])]
        for x in parts:
            if x:
                pieces.append(x)
                owner.append(i)
                fixed.append(x in special)
    if not pieces:
        return np.zeros(len(texts), np.int64), pa.array([], pa.large_string())
    raw = "".join(pieces)
    cp = np.frombuffer(raw.encode("utf-32-le"), np.uint32)
    begins = np.concatenate([[0], np.cumsum([len(x) for x in pieces])])
    first = np.zeros(len(cp), bool)
    first[begins[:-1]] = True
    start = _starts(classes[cp], cp, first)
    for k in np.flatnonzero(fixed):
        start[begins[k] + 1:begins[k + 1]] = False
    at = np.flatnonzero(start)
    if raw.isascii():
        offsets = np.append(at, len(cp)).astype(np.int64)
    else:
        ends = np.cumsum(_utf8_lengths(cp))
        offsets = np.append(np.where(at > 0, ends[at - 1], 0), ends[-1]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_string(), len(at), [
        None, pa.py_buffer(offsets), pa.py_buffer(raw.encode())])
    counts = np.zeros(len(texts), np.int64)
    np.add.at(counts, np.array(owner), np.diff(np.searchsorted(at, begins)))
    return counts, words


def _between(text: str, s: str) -> list[str]:
    parts = text.split(s)
    return [y for x in parts for y in (x, s)][:-1]


def slices(lengths: np.ndarray, most: int = SLICE) -> Iterator[slice]:
    """Runs of texts of about ``most`` characters, one text at least."""
    group = (np.cumsum(lengths) - lengths) // most
    edges = np.flatnonzero(np.diff(group, prepend=-1, append=-2))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield slice(int(a), int(b))


def segments(text: bytes, most: int = SLICE) -> list[bytes]:
    """``text`` in parts of about ``most`` bytes, cut where a space follows a
    character that is no white space; there a pre-token always ends."""
    out, begin = [], 0
    while len(text) - begin > most:
        at = text.find(b" ", begin + most)
        while at >= 0 and text[max(at - 4, begin):at].decode("utf-8", "ignore")[-1:].isspace():
            at = text.find(b" ", at + 1)
        if at < 0:
            break
        out.append(text[begin:at])
        begin = at
    return [*out, text[begin:]]


def special_tokens(path: str) -> tuple[str, ...]:
    import json

    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens", [])
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError("added tokens that look beyond their own string are not handled")
    return tuple(sorted((t["content"] for t in added), key=len, reverse=True))


def file_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Vocabulary:
    """What tasks need of a vocabulary file: its bytes, its special tokens and
    the classes of characters, broadcast (their size is fixed by the file)."""

    def __init__(self, spark: SparkSession, path: str):
        arrow_batches(spark)
        self.special = special_tokens(path)
        self._classes = spark.sparkContext.broadcast(char_classes().tobytes())
        self._file = spark.sparkContext.broadcast(file_bytes(path))

    def split(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """``split`` of a slice of texts; longer texts in segments, so that no
        array has more than about SLICE elements but the words' own."""
        classes = np.frombuffer(self._classes.value, np.uint8)
        rows = texts.to_pylist()
        if sum(map(len, rows)) <= 2 * SLICE or any(" " in s for s in self.special):
            return split(rows, self.special, classes)
        counts, words = [], []
        for t in rows:
            own = [split([x.decode()], self.special, classes) for x in segments(t.encode())]
            counts.append(sum(int(n[0]) for n, _ in own))
            words += [w for _, w in own]
        return np.array(counts, np.int64), pa.concat_arrays(words)

    def encoder(self):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(self._file.value.decode())
        t.no_truncation()
        t.no_padding()
        return lambda words: pa.array([e.ids for e in t.encode_batch_fast(words, add_special_tokens=False)],
                                      pa.list_(pa.int32()))


def text_slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about SLICE characters of text."""
    size = pc.utf8_length(batch.column(column)).to_numpy(zero_copy_only=False)
    for s in slices(size):
        yield batch.slice(s.start, s.stop - s.start)


def frequent_words(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", most: int = FREQUENT,
                   local: int = LOCAL) -> pa.Table:
    """(word, ids) of the words to broadcast: at most ``most``, none longer
    than FREQUENT_BYTES.  The cut is made between quarter powers of two of the
    counts, so at most 256 numbers come to the driver to find it."""
    def summed(parts):
        t = pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")])
        return t.select(["word", "n_sum"]).rename_columns(["word", "n"])

    def largest(t, n):
        return t.sort_by([("n", "descending")]).slice(0, n) if t.num_rows > n else t

    def report(batches):
        pa.set_memory_pool(pa.system_memory_pool())  # gives back what it frees
        schema = pa.schema([("word", pa.large_string()), ("n", pa.int64())])
        held, new = schema.empty_table(), []
        for b in batches:
            for own in text_slices(b, 0):
                vc = pc.value_counts(vocabulary.split(own.column(0))[1])
                t = pa.table([vc.field("values"), vc.field("counts")], schema=schema)
                new.append(t.filter(pc.less_equal(pc.binary_length(t.column("word")), FREQUENT_BYTES)))
                if sum(t.num_rows for t in new) > local:
                    held, new = largest(summed([held, *new]), 2 * local), []
        t = largest(summed([held, *new]), local)
        yield from t.cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches(1 << 16)

    def encode(batches):
        encoder = vocabulary.encoder()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), encoder(b.column(0).to_pylist())], ["word", "ids"])

    words = docs.select(text_of(text_col).alias("text")).mapInArrow(report, "word string, n long")
    words = keep(words.groupBy("word").agg(F.sum("n").alias("n")), "reports")
    level = F.floor(F.log2(F.col("n").cast("double")) * 4).cast("int")
    left, least = most, 1 << 20
    for r in words.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # <= 256 rows
        if r["count"] > left:
            break
        left, least = left - r["count"], r["level"]
    return words.where(level >= least).select("word").mapInArrow(encode, "word string, ids array<int>").toArrow()


def word_hashes(words: pa.Array) -> np.ndarray:
    """A hash of each word's bytes, as 64-bit polynomials."""
    words = words.cast(pa.large_binary())
    if not len(words):
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    size = np.diff(ends)
    data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]].astype(np.uint64) + np.uint64(1)
    powers = np.cumprod(np.full(size.max(), 0x9E3779B97F4A7C15, np.uint64))
    starts = ends[:-1] - ends[0]
    return np.add.reduceat(data * powers[np.arange(len(data)) - np.repeat(starts, size)], starts)


class KnownWords:
    """The broadcast part of the word table, found by hash and compared whole.
    Of words with one hash the others are simply not known."""

    def __init__(self, spark: SparkSession, table: pa.Table):
        table = table.combine_chunks().cast(pa.schema([("word", pa.string()), ("ids", pa.list_(pa.int32()))]))
        h = word_hashes(table.column("word").combine_chunks()) if table.num_rows else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        table = table.take(pa.array(order)).append_column("hash", pa.array(h[order], pa.uint64())).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as w:
            w.write_table(table)
        self._data = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())

    def read(self) -> "KnownWords":
        pa.set_memory_pool(pa.system_memory_pool())  # gives back what it frees
        t = pa.ipc.open_stream(self._data.value).read_all().combine_chunks()
        self.words, self.ids, self.hashes = (
            t.column(c).chunk(0) if t.num_rows else pa.array([], t.schema.field(c).type) for c in ("word", "ids", "hash"))
        self.hashes = self.hashes.to_numpy()
        return self

    def __getstate__(self):
        return {"_data": self._data}

    def places(self, words: pa.Array) -> np.ndarray:
        """The place of each word among the known ones, or -1."""
        if not len(self.hashes):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.hashes, word_hashes(words)), len(self.hashes) - 1)
        same = pc.equal(self.words.take(pa.array(at)), words).to_numpy(zero_copy_only=False)
        return np.where(same, at, -1)


def look_up(words: pa.Array, known: KnownWords) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code of each word, distinct words, place of each distinct word among
    the known ones or -1)."""
    d = words.dictionary_encode()
    distinct = d.dictionary.cast(pa.string())
    return d.indices.to_numpy(zero_copy_only=False), distinct, known.places(distinct)


def encode_rare(pairs: DataFrame, vocabulary: Vocabulary, split_by: str, count: bool = False) -> DataFrame:
    """``pairs`` (word, ...) with the word's ``ids``, or only their number
    ``n_ids`` with ``count``: shuffled and sorted by word,
    each distinct word of a batch is encoded once, and the last one's ids are
    held for the next batch.  A word longer than FREQUENT_BYTES is rare however
    often it stands, so its rows are split by the column ``split_by`` into at
    most LONG_SPLIT parts, each of which encodes it once."""
    names = [*pairs.columns, "n_ids" if count else "ids"]

    def run(batches):
        encoder, last, held = vocabulary.encoder(), None, None
        for b in batches:
            d = b.column(b.schema.get_field_index("word")).dictionary_encode()
            new = d.dictionary.to_pylist()
            known = bool(new) and new[0] == last
            ids = encoder(new[1:] if known else new)
            ids = pa.concat_arrays([held, ids]) if known else ids
            if new:
                last, held = new[-1], ids.slice(len(ids) - 1)
            out = pc.list_value_length(ids) if count else ids
            yield pa.RecordBatch.from_arrays([*b.columns, out.take(d.indices)], names)

    cell = F.when(F.octet_length("word") > FREQUENT_BYTES, F.pmod(F.xxhash64(split_by), F.lit(LONG_SPLIT))).otherwise(0)
    d = pairs.repartition(F.col("word"), cell).sortWithinPartitions("word")
    return d.mapInArrow(run, d.withColumn(names[-1], F.lit(0) if count else F.array(F.lit(0))).schema)
