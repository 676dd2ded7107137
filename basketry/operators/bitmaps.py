"""Sets of small numbers as packed bitmaps: one binary of 4 KB for every
segment of 32,768 numbers (Spark's bitmap functions), 32 numbers a word instead
of a row for each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers of one segment, fixed by Spark's bitmap functions.
SEGMENT = 32_768


def packed(df: DataFrame, number: Column | str, keys: tuple[str, ...] = ()) -> DataFrame:
    """([keys], segment, bits) of the non-negative numbers of ``df``: a bit is
    1 if its number occurs.  Tasks build the bitmaps of their own rows, which
    are then or-ed."""
    n = F.col(number) if isinstance(number, str) else number
    # bitmap functions count from 1: bucket 1 holds the numbers 1 to 32,768
    d = df.select(*keys, F.bitmap_bucket_number(n + 1).alias("segment"), F.bitmap_bit_position(n + 1).alias("_bit"))
    return (d.groupBy(*keys, "segment").agg(F.bitmap_construct_agg("_bit").alias("bits"))
            .select(*keys, (F.col("segment") - 1).alias("segment"), "bits"))


def has_bit(bits: Column, number: Column) -> Column:
    """Whether ``number`` is in its segment's ``bits`` (null bits: no)."""
    place = F.pmod(number, F.lit(SEGMENT)).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3) + 1, 1)), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, F.pmod(place, F.lit(8))) == 1, F.lit(False))
