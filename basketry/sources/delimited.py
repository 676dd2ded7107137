"""Delimited text sources and sinks.

Reads take an explicit schema (no ``inferSchema`` pass over the data).  A
missing path raises instead of returning None.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketry.sources.store import path_exists


def read_delimited(spark: SparkSession, path: str, schema: StructType | str | None = None,
                   header: bool = True, sep: str = ",", multiline: bool = False,
                   escape: str = '"', quote: str = '"', null_value: str | None = None) -> DataFrame:
    """S1.  ``multiline`` makes every file one task (a record may span lines),
    so it is off unless asked for.  Gzip files are read by extension (also
    one task per file).  Without a schema every column is a string, as in
    the reference; IMDb-style ``\\N`` nulls can be mapped with ``null_value``."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    r = (spark.read.option("header", header).option("sep", sep).option("multiLine", multiline)
         .option("escape", escape).option("quote", quote))
    if null_value is not None:
        r = r.option("nullValue", null_value)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_text_split(spark: SparkSession, path: str, sep: str = ",", column: str = "fields") -> DataFrame:
    """One array of fields per text line, split on ``sep`` literally
    (no quoting rules)."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return spark.read.text(path).select(F.split(F.col("value"), pattern, -1).alias(column))


def save_delimited(df: DataFrame, path: str, header: bool = True, sep: str = ",",
                   mode: str = "errorifexists", single_file: bool = False, escape: str = '"') -> None:
    """S4 (+ D2).  Quotes are escaped by doubling (as ``read_delimited``
    expects).  ``single_file`` funnels the output through one task: for
    small outputs only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", header).option("sep", sep).option("escape", escape).csv(path)
