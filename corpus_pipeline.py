"""A corpus from raw documents: rules, line dedup, near-dedup, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one
before it kept.  ``run`` writes each stage to the shared checkpoint folder and
reads it back, so a lost executor costs a stage's own tasks at most.

ORACLE_SQL is None: fingerprints and token ids are not SQL's; the stages are
tested against brute force in tests/llm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm import bpe, line_dedup, mixing, quality_rules, simhash_dedup
from basketry.llm.common import Store, table
from basketry.llm.queries import vocabulary

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a quality rule go."""
    return quality_rules.judge(docs, out="_quality").where("_quality.kept").drop("_quality")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand earlier are deleted; a document of which no word is
    left goes.  ``n_chars`` follows the text."""
    d = line_dedup.dedup_lines(docs)
    d = d.withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long"))
    left = (F.col("n_deleted") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return d.where(left).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the least by
    id (null ids last), of rows that share that id the first by text.  Groups
    go by their root fingerprint and rows by id and text, never by id alone."""
    groups = simhash_dedup.grouped(docs, keyed=True)
    firsts = (groups.where(F.col("id").eqNullSafe(F.col("component_id")))
              .select(F.col("root").alias("_nd_root"), F.col("id").alias("_nd_id"), F.col("key").alias("_nd_key")).distinct())
    d = docs.withColumn("_nd_text", simhash_dedup.text_key())
    kept = d.join(firsts, (F.col("_nd_text") == F.col("_nd_key")) & F.col("doc_id").eqNullSafe(F.col("_nd_id")))
    order = [F.col(c).asc_nulls_last() for c in ("text", "source", "lang", "n_chars")]
    first = F.row_number().over(Window.partitionBy("_nd_root").orderBy(*order))
    return kept.withColumn("_nd_row", first).where("_nd_row = 1").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each copy that the mix takes, in order of training.  A copy
    that the end of its source's target falls into stays whole (one a source
    at most)."""
    d = mixing.sized(docs, size_col="_size").withColumn("_key", mixing.row_key())
    d = mixing.training_order(mixing.mix(d, size_col="_size", key_col="_key", ordered=False))
    return d.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and whether they decode to its text."""
    d = bpe.encode(docs, vocabulary(), keep_text=True, decoded_col="decoded")
    return d.select("doc_id", "source", "lang", "ids", F.size("ids").cast("long").alias("n_tokens"),
                    (F.col("decoded") == F.col("text")).alias("round_trip"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near-duplicates", near_duplicates),
          ("mixing", mixed), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    store = Store(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = store.write(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
