"""Item-id codecs.

Items are kept in their native type everywhere.  These two functions only
translate between a numeric key and a prefixed, zero-padded text id such as
``nm0000123`` for files that use that form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the text id format: prefix and minimum digit count.
ID_PREFIX = "nm"
ID_DIGITS = 7


def format_item_id(c: Column | str, prefix: str = ID_PREFIX, digits: int = ID_DIGITS) -> Column:
    """``prefix || lpad(id, digits, '0')``.

    ``lpad`` cuts strings longer than the pad width, so the width is
    ``greatest(digits, length(id))``: an 8-digit id stays whole.
    """
    s = F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    return F.concat(F.lit(prefix), F.lpad(s, F.greatest(F.lit(digits), F.length(s)), F.lit("0")))


def parse_item_id(c: Column | str, prefix_len: int = len(ID_PREFIX), to: str = "bigint") -> Column:
    """drop the text prefix and cast; malformed ids become null
    (``try_cast``: ANSI mode would otherwise fail the whole job)."""
    s = F.col(c) if isinstance(c, str) else c
    return F.substring(s, prefix_len + 1, 1 << 30).try_cast(to)
