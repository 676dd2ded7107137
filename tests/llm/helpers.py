import os

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SMALL = "/root/testdata/sf0.001"

LONG = "lorem ipsum dolor. " * 4000
#: doc_id, text, source: nulls, empty and long texts, repeated rows, odd characters.
ODD = [
    (1, "It's  the dog's   'quoted' we'll\n\n they'Re 12ab34 éè 中文\t x", "a"),
    (2, "", "a"), (3, None, "b"), (4, "   \n\t ", None), (5, LONG, "b"), (6, "same text here", "b"),
    (6, "same text here", "b"), (7, "a<|endoftext|>b  <|endoftext|> 's", None), (None, "no id at all", "c"),
    (None, None, None), (8, "​﻿ emoji \U0001f600\U0001f600 a b　c\x85d''s'll'", "\U0001f600"),
    (9, "x" * 5000 + " " * 300 + "!" * 700, "Z"), (10, "'s't're've'm'll'd 's", ""), (11, "� \x00 \x7f", "a"),
]
KIND = "doc_id long, text string, source string"


def odd(spark):
    """ODD with extra columns whose names clash with those of results."""
    from pyspark.sql import functions as F

    extra = ("n_words", "size", "score", "id", "fp", "ids", "position", "key", "h", "n", "word", "line", "rule", "n_tokens")
    return spark.createDataFrame(ODD, KIND).select("*", *[F.lit("clash").alias(c) for c in extra])


def documents(spark, sf=SMALL):
    return spark.read.parquet(f"{sf}/documents.parquet")
