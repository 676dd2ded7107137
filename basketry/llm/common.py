"""What the operators share: word patterns, table access, scratch tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.sources.store import Store
from basketry.sources.tables import table

__all__ = ["BLANKS", "Store", "arrow_batches", "blank_words", "keep", "let", "table", "text_of"]

#: The six ASCII white-space characters; everything between them is a word.
BLANKS = r"[\x20\x09-\x0D]+"


def text_of(name: str) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def blank_words(text: Column) -> Column:
    """The words between white space, in order."""
    return F.array_remove(F.split(text, BLANKS), "")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a frame into a fresh shared folder and read it back (cuts lineage)."""
    return Store(df.sparkSession).write(df, name)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with the value computed once a row.

    A column that a lambda refers to may be inlined into the lambda by the
    optimizer, and so be computed anew for each element; a lambda's variable
    never is."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def arrow_batches(spark: SparkSession, rows: int = 2000, megabytes: int = 8) -> None:
    """Bound the Arrow batches that this session sends to Python workers, so
    that whole texts (10,000 rows a batch by default) fit beside the heap.
    Smaller bounds that the session has stay."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", megabytes << 20)):
        now = str(spark.conf.get(f"spark.sql.execution.arrow.{name}")).lower()
        if not (now.rstrip("b").isdigit() and 0 < int(now.rstrip("b")) <= most):
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))
