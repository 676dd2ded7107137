"""Token counts without token ids.

Pieces are counted once for each distinct pre-token; a document's tokens are
the sum over its pre-tokens of frequency times pieces.  Frequencies of the
known pre-tokens are summed where the document is read; only the rest, one row
per document and distinct rare word, is shuffled to its word and back as one
sum per document.

Cases: null and empty texts have no bytes and no tokens; repeated rows are
counted one by one; a text of any length is read whole; an empty table gives
an empty table; other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import keep, text_of
from basketry.llm.pretokens import FREQUENT, KnownWords, Vocabulary, encode_rare, frequent_words, look_up, text_slices


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, most: int = FREQUENT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; ``path``: a
    byte-level BPE vocabulary in the tokenizers library's format."""
    spark = docs.sparkSession
    vocabulary = Vocabulary(spark, path)
    known = KnownWords(spark, frequent_words(docs, vocabulary, text_col, most))
    id_type = docs.schema[id_col].dataType

    def frequencies(batches):
        table = known.read()
        pieces = np.append(pc.list_value_length(table.ids).to_numpy(zero_copy_only=False), 0)  # at -1: not known
        for b in batches:
            for own in text_slices(b, 1):
                counts, ws = vocabulary.split(own.column(1))
                code, distinct, place = look_up(ws, table)
                doc = np.repeat(np.arange(own.num_rows), counts)
                sums = np.bincount(doc, pieces[place][code], own.num_rows).astype(np.int64)
                rare = place[code] < 0
                n = max(len(distinct), 1)
                pair, freq = np.unique(doc[rare] * n + code[rare], return_counts=True)
                per_doc = np.searchsorted(pair, np.arange(own.num_rows + 1) * n)
                entries = pa.StructArray.from_arrays(
                    [distinct.take(pa.array(pair % n)), pa.array(freq, pa.int64())], ["word", "freq"])
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), pc.binary_length(own.column(1)).cast(pa.int64()), pa.array(sums),
                     pa.ListArray.from_arrays(pa.array(per_doc, pa.int32()), entries)],
                    ["id", "n_bytes", "known", "rare"])

    d = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    d = d.mapInArrow(frequencies, f"id {id_type.simpleString()}, n_bytes long, known long, "
                                  "rare array<struct<word:string,freq:long>>")
    d = keep(d.withColumn("row", F.monotonically_increasing_id()), "frequencies")
    sums = (encode_rare(d.select("row", F.inline("rare")), vocabulary, "row", count=True)
            .groupBy("row").agg(F.sum(F.col("freq") * F.col("n_ids")).alias("rest")))
    n = F.col("known") + F.coalesce(F.col("rest"), F.lit(0))
    return (d.drop("rare").join(sums, "row", "left")
            .select(F.col("id").alias(id_col), "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit")))
