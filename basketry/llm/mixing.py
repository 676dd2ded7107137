"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight and a tilt: its weight at training time t in [0, 1]
is ``w * (1 + tilt * (1 - 2t))``, whose integral over the run is ``w``.  The
integrals share the word budget; a source stops at ``max_repeats`` times its
size and what it leaves is shared among the others by weight.  A source's
documents are laid end to end in hash order, as often as its target asks for.
The word offset at which a copy starts is a point of the source's cumulative
demand; inverting that demand gives the copy's training position, and the
result is range-sorted by position.

Scale: sizes are summed per (source, hash bucket) before anything is shuffled
by source; running sums go over buckets (at most 16 ** ``BUCKET_DIGITS`` rows
a source) and then inside one bucket, so a source that holds most rows is
spread over all tasks.  With ``row_key`` buckets and order come from id and
text, so that null or repeated ids are spread too; only rows equal in both
share a bucket.  The weights are solved over one row per source in one task:
sources are names of collections, thousands at most, never a key that grows
with the documents.

Cases: null and empty texts have size 0 and take no words; a null source is a
source of its own, ranked last; equal rows are copies like any others; a
source without words has target 0; an empty table gives an empty one; other
columns pass through, columns named like the result's are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import blank_words, text_of

#: Hash buckets per source; a multiple of 16 hex digits' powers.
BUCKET_DIGITS = 3
RESULT = ("source_size", "target", "taken", "copies", "position")


def sized(docs: DataFrame, text_col: str = "text", size_col: str = "size") -> DataFrame:
    """``docs`` with the number of words of the text."""
    return docs.withColumn(size_col, F.size(blank_words(text_of(text_col))).cast("long"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A key that orders the documents of a source whether or not ids are null
    or repeated: a digest of the id and the text."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text_of(text_col))))


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), tilts: Sequence[float] = (0.5, 0.0, -0.5),
            budget: float = 1.5, max_repeats: float = 2.0) -> DataFrame:
    """(source, source_size) -> weight, tilt and target, one row a source.

    Sorted by cap over weight, the sources that end at their cap come first:
    a source is capped when sharing what the ones before it left would give it
    its cap or more.  The first that is not capped fixes the common rate."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    cycle = lambda xs: F.element_at(F.array(*[F.lit(float(x)) for x in xs]),
                                    (F.col("_rank") % len(xs) + 1).cast("int"))
    s = sizes.withColumn("_rank", F.row_number().over(order) - 1)
    s = s.withColumn("weight", cycle(weights)).withColumn("tilt", cycle(tilts))
    s = s.withColumn("_cap", F.col("source_size") * F.lit(float(max_repeats)))
    fill = Window.orderBy(F.col("_cap") / F.col("weight"), "_rank")
    before = F.coalesce(F.sum("_cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything)
    s = s.withColumn("_rate", (total * F.lit(float(budget)) - before) / rest)
    free = F.col("_rate") < F.col("_cap") / F.col("weight")
    s = s.withColumn("_rate", F.max(F.when(free, F.struct(-F.col("_cap") / F.col("weight"), -F.col("_rank"),
                                                          F.col("_rate")))).over(everything)["_rate"])
    target = F.least(F.col("_cap"), F.coalesce(F.col("_rate") * F.col("weight"), F.col("_cap")))
    return s.select("source", "source_size", "weight", "tilt", target.alias("target"))


def position(offset: Column, target: Column, tilt: Column) -> Column:
    """Time at which a source's cumulative demand reaches ``offset`` words:
    the root in [0, 1] of (1 + tilt) t - tilt t^2 = offset / target."""
    x = F.least(offset / target, F.lit(1.0))
    start = F.lit(1.0) + tilt
    return F.when(tilt == 0, x).otherwise(
        (start - F.sqrt(F.greatest(start * start - F.lit(4.0) * tilt * x, F.lit(0.0)))) / (F.lit(2.0) * tilt))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size",
        key_col: str | None = None, weights: Sequence[float] = (5, 2, 1),
        tilts: Sequence[float] = (0.5, 0.0, -0.5), budget: float = 1.5, max_repeats: int = 2,
        ordered: bool = True) -> DataFrame:
    """``docs`` (with their sizes) and, per row: ``source_size``, ``target``,
    ``taken`` words, ``copies`` (copy, words, position) and the first copy's
    ``position``, range-sorted by that (rows that are not taken last) unless
    ``ordered`` is off, for callers that sort the copies (``training_order``).

    ``key_col`` names a column that orders the documents of a source, spread
    evenly over hex strings, such as ``row_key``; by default the md5 of the id
    and the size, which does for ids that are mostly set and different."""
    names = [c for c in docs.columns if c not in RESULT and c != key_col]
    key = F.col(key_col) if key_col else F.md5(
        F.concat_ws(":", F.col(id_col).cast("string"), F.col(size_col).cast("string")))
    d = docs.select(*names, F.col(source_col).alias("_mx_source"), F.col(size_col).alias("_mx_size"),
                    key.alias("_mx_key"), F.col(id_col).alias("_mx_id"))
    d = d.withColumn("_mx_bucket", F.conv(F.substring("_mx_key", 1, BUCKET_DIGITS), 16, 10).cast("int"))
    sums = d.groupBy("_mx_source", "_mx_bucket").agg(F.sum("_mx_size").alias("_mx_sum"))
    plan = targets(sums.groupBy(F.col("_mx_source").alias("source")).agg(F.sum("_mx_sum").alias("source_size")),
                   weights, tilts, budget, max_repeats)
    buckets = Window.partitionBy("_mx_source").orderBy("_mx_bucket")
    sums = sums.select("_mx_source", "_mx_bucket", (F.sum("_mx_sum").over(buckets) - F.col("_mx_sum")).alias("_mx_base"))
    sums = (sums.join(plan.withColumnRenamed("source", "_mx_s"), F.col("_mx_source").eqNullSafe(F.col("_mx_s")))
            .select(F.col("_mx_source").alias("_mx_s"), F.col("_mx_bucket").alias("_mx_b"), "_mx_base",
                    "source_size", "target", "tilt"))
    within = Window.partitionBy("_mx_source", "_mx_bucket").orderBy("_mx_key", "_mx_id", "_mx_size")
    d = d.withColumn("_mx_in", F.sum("_mx_size").over(within.rowsBetween(Window.unboundedPreceding, -1)))
    d = d.join(sums, F.col("_mx_source").eqNullSafe(F.col("_mx_s")) & (F.col("_mx_bucket") == F.col("_mx_b")))
    # a copy takes its words up to where the (whole) target ends
    start = F.col("_mx_base") + F.coalesce(F.col("_mx_in"), F.lit(0))
    end = F.round(F.col("target")).cast("long")
    d = d.withColumn("copies", F.filter(F.transform(
        F.sequence(F.lit(0), F.lit(max_repeats - 1)),
        lambda c: F.struct(
            c.alias("copy"),
            F.greatest(F.least(F.col("_mx_size"), end - start - c * F.col("source_size")), F.lit(0)).alias("words"),
            position((start + c * F.col("source_size")).cast("double"), F.col("target"), F.col("tilt")).alias("position"))),
        lambda c: c["words"] > 0))
    d = d.withColumn("taken", F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"]))
    d = d.withColumn("position", F.get("copies", F.lit(0))["position"])
    # rows without a position would be one tie; the key spreads them
    d = d.orderBy(F.col("position").asc_nulls_last(), "_mx_key") if ordered else d
    return d.select(*names, *RESULT)


def training_order(mixed: DataFrame) -> DataFrame:
    """One row for each copy that the mix takes, in order of training."""
    names = [c for c in mixed.columns if c not in RESULT]
    return mixed.select(*names, F.inline("copies")).orderBy("position")
