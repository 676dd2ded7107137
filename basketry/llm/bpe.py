"""BPE encoding and decoding through a table of distinct words.

Encoding: each distinct pre-token of the corpus is encoded once (see
``pretokens``); a document's ids are its words' ids, joined back by position.
Known words come from the broadcast part of the table.  A document's rare
words are shuffled to their word, encoded and come back as one list; that list
and the text meet by the text's hash (texts that hash alike may share a list:
ids belong to words, not to texts).  Texts travel packed, so
that this one shuffle of the corpus is smaller than its files.

Decoding: ids are joined with the vocabulary's (id, piece) table, whose rows
are fixed by the vocabulary file, and a document's pieces are put together.

Cases: null is the empty text, which has no ids and decodes to the empty
text; a null list of ids decodes as an empty one; repeated rows give
repeated rows; texts of any length are taken whole; an empty table gives an
empty one; other columns pass through, columns named like a result's are
replaced.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import text_of
from basketry.llm.pretokens import (
    FREQUENT, FREQUENT_BYTES, LONG_SPLIT, KnownWords, Vocabulary, encode_rare, frequent_words, look_up, slices, text_slices)


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids",
           keep_text: bool = False, most: int = FREQUENT, decoded_col: str | None = None) -> DataFrame:
    """``docs`` with the ids of ``text_col``; the text itself only if asked
    for, and in ``decoded_col`` what the ids decode to.  Decoding in the same
    step spares a task a second Python worker."""
    spark = docs.sparkSession
    vocabulary = Vocabulary(spark, path)
    known = KnownWords(spark, frequent_words(docs, vocabulary, text_col, most))
    # a null text that is kept becomes the empty one
    names = [c for c in docs.columns if c not in (ids_col, text_col, decoded_col)]
    spelled = spark.sparkContext.broadcast(pieces(path)) if decoded_col else None  # (id, piece), fixed by the file

    def rare_words(batches):
        table = known.read()
        for b in batches:
            for own in text_slices(b, 1):
                counts, ws = vocabulary.split(own.column(1))
                code, distinct, place = look_up(ws, table)
                doc = np.repeat(np.arange(own.num_rows), counts)
                rare, n = place[code] < 0, max(len(distinct), 1)
                pair = np.unique(doc[rare] * n + code[rare])
                words, at = distinct.take(pa.array(pair % n)), pa.array(pair // n)
                long = pc.greater(pc.binary_length(words), FREQUENT_BYTES)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0).take(at), words, pc.if_else(long, own.column(2).take(at), pa.scalar(0, pa.int32()))],
                    ["key", "word", "cell"])

    def pack(batches):
        import zstandard

        z = zstandard.ZstdCompressor(level=6)
        for b in batches:
            yield b.set_column(b.num_columns - 1, "_bpe_text", pa.array(
                [z.compress(x) for x in b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()], pa.binary()))

    def join_ids(batches):
        import zstandard

        z, table = zstandard.ZstdDecompressor(), known.read()
        piece = pa.array(spelled.value, pa.large_binary()) if decoded_col else None
        for b in batches:
            at = b.schema.get_field_index("_bpe_text")
            for k in range(0, b.num_rows, 100):  # unpacked texts and their ids are held
                part = b.slice(k, 100)
                texts = pa.array([z.decompress(x) for x in part.column(at).to_pylist()], pa.binary()).cast(pa.string())
                for own in text_slices(part.set_column(at, "_bpe_text", texts), at):
                    out = _with_ids(own, vocabulary, table, ids_col, text_col if keep_text else None)
                    yield out.append_column(decoded_col, decoded(out.column(out.num_columns - 1), piece)) if decoded_col else out

    key = F.xxhash64(text_of(text_col)).alias("_bpe_key")
    # which of its cells a long word's row is in goes by the row's place: equal rows are spread too
    cell = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(LONG_SPLIT)).cast("int")
    rare = (docs.select(key.alias("key"), text_of(text_col).alias("text"), cell.alias("cell"))
            .mapInArrow(rare_words, "key long, word string, cell int"))
    # an entry is its ids, a blank and the word: half of what a struct of them takes in a shuffle
    entry = F.concat_ws(" ", F.array_join(F.col("ids").cast("array<string>"), ","), "word")
    rare = encode_rare(rare, vocabulary, "cell").groupBy("key").agg(F.collect_set(entry).alias("_bpe_rare"))
    d = docs.select(*names, key, text_of(text_col).alias("_bpe_text"))
    d = d.mapInArrow(pack, d.drop("_bpe_text").withColumn("_bpe_text", F.lit(b"")).schema)
    d = d.join(rare.withColumnRenamed("key", "_bpe_key"), "_bpe_key", "left")
    out = d.drop("_bpe_key", "_bpe_text", "_bpe_rare")
    if keep_text:
        out = out.withColumn(text_col, F.lit(""))
    out = out.withColumn(ids_col, F.array(F.lit(0)))
    return d.mapInArrow(join_ids, (out.withColumn(decoded_col, F.lit("")) if decoded_col else out).schema)


def _with_ids(own: pa.RecordBatch, vocabulary: Vocabulary, known: KnownWords, ids_col: str,
              text_col: str | None) -> pa.RecordBatch:
    """One batch with the ids of its words, gathered by position."""
    texts = own.column(own.schema.get_field_index("_bpe_text"))
    counts, ws = vocabulary.split(texts)
    code, distinct, place = look_up(ws, known)
    entries = own.column(own.schema.get_field_index("_bpe_rare")).flatten()
    entries = pc.split_pattern(entries, " ", max_splits=1).flatten()
    rare_ids = pc.split_pattern(_every_second(entries, 0), ",").cast(known.ids.type)
    at = pc.fill_null(pc.index_in(distinct, _every_second(entries, 1)), -1).to_numpy(zero_copy_only=False)
    if np.any((place < 0) & (at < 0)):
        raise RuntimeError("a rare word did not come back with its ids")
    # the ids of the slice's distinct words, then of all its words
    mine = pa.concat_arrays([known.ids.take(pa.array(place[place >= 0])),
                             rare_ids.take(pa.array(at[place < 0]))])
    order = np.empty(len(place), np.int64)
    order[np.append(np.flatnonzero(place >= 0), np.flatnonzero(place < 0))] = np.arange(len(place))
    per_word = mine.take(pa.array(order[code]))
    ends = np.append(0, np.cumsum(counts))
    offsets = per_word.offsets.to_numpy()[ends] if len(per_word) else np.zeros(len(counts) + 1, np.int32)
    out = {n: own.column(own.schema.get_field_index(n)) for n in own.schema.names
           if n not in ("_bpe_key", "_bpe_text", "_bpe_rare")}
    if text_col:
        out[text_col] = texts
    out[ids_col] = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), per_word.flatten())
    return pa.RecordBatch.from_pydict(out)


def _every_second(x: pa.Array, first: int) -> pa.Array:
    return x.take(pa.array(np.arange(first, len(x), 2)))


def pieces(path: str) -> list[bytes]:
    """The bytes of every id of the vocabulary, in order of the ids (missing
    ids: no bytes).  Pieces spell bytes as printable characters: the printable
    ones of Latin-1 stand for themselves, the others for 256, 257, ... in order."""
    with open(path, encoding="utf-8") as f:
        v = json.load(f)
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spelled = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    table = {i: bytes(spelled[c] for c in p) for p, i in v["model"]["vocab"].items()}
    table |= {t["id"]: t["content"].encode() for t in v.get("added_tokens", [])}
    return [table.get(i, b"") for i in range(max(table) + 1)]


def decoded(ids: pa.Array, piece: pa.Array) -> pa.Array:
    """The texts of lists of ids; bytes that are no UTF-8 become U+FFFD."""
    texts = []
    for s in slices(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)):
        own = ids.slice(s.start, s.stop - s.start)
        n = pc.fill_null(pc.list_value_length(own), 0).to_numpy(zero_copy_only=False)
        found = piece.take(own.flatten())
        place = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1, 8 * found.offset)
        data = memoryview(found.buffers()[2]) if len(found) else b""
        ends = place[np.append(0, np.cumsum(n))]
        texts += [str(data[x:y], "utf-8", "replace") for x, y in zip(ends[:-1], ends[1:], strict=True)]
    return pa.array(texts, pa.string())


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids; bytes that are no UTF-8 become U+FFFD."""
    spark = df.sparkSession
    vocabulary = spark.sparkContext.broadcast(pieces(path))  # (id, piece), fixed by the vocabulary file
    names = [c for c in df.columns if c != out_col]

    def join_pieces(batches):
        piece = pa.array(vocabulary.value, pa.large_binary())
        for b in batches:
            ids = b.column(b.schema.get_field_index(ids_col))
            yield pa.RecordBatch.from_pydict({c: b.column(b.schema.get_field_index(c)) for c in names}
                                             | {out_col: decoded(ids, piece)})

    d = df.select(*names)
    return d.mapInArrow(join_pieces, d.withColumn(out_col, F.lit("")).schema)
