"""Line dedup by winnowing over line hashes.

A document is the sequence of its lines with a word (edges trimmed).  A
*window* grows from a line to the right, or to the left, until it has
``min_words`` words.

1. Every window selects its least line hash (the first of equal ones) as its
   fingerprint, at that line's *position*.  Equal windows select it at the same
   line, so every passage of ``min_words`` words or more that stands twice is
   guaranteed to leave one fingerprint at two positions.
2. Positions are joined by fingerprint: those whose fingerprint stands at no
   other position go, with all windows that selected them.  This tells most
   text from repeated text.
3. A match at a position is extended both ways: the windows that selected it
   reach as far to its left and right as it takes for ``min_words`` words.  They
   are compared by a 128-bit hash, each with the first equal one in the order of
   documents (id, then text hash) and lines, not with every other, so the work
   follows the lines however often a line repeats.  Windows one line apart match
   on as long as a passage does: the matched ones of a longer passage add up to
   all of it.
4. The lines of every later window are deleted, with the wordless lines
   inside: a line goes exactly if some run of consecutive lines with
   ``min_words`` words or more that holds it stands earlier.

Words are what stands between blanks of any of the six kinds, however many.

Cases: null texts stay null, empty ones empty; rows equal in id and text count
as one document and are treated alike; null ids come last; texts are read
whole; an empty table gives an empty one; other columns pass through, and a
column named like a result's (``n_lines``, ``n_deleted``) is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import keep, let

MIN_WORDS = 50
RESULT = ("n_lines", "n_deleted")
WORDY = r"[^\x20\x09-\x0D]"
EDGES = " \t\n\x0b\x0c\r"


def _grown(words: Column, min_words: int) -> Column:
    """How many of the first elements it takes to reach ``min_words``.  A line's
    words stand as words * 2^32 + 1, so one number sums words and lines."""
    done = F.aggregate(words, F.lit(0).cast("long"), lambda a, w: F.when(a < min_words << 32, a + w).otherwise(a))
    return F.when(done >= min_words << 32, done.bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, text_key, fp, place, run, first, last): every window of every
    document, with its fingerprint and a hash of the fingerprint's position.
    first and last are line numbers in the text, from 0."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    d = d.where(F.col("text").rlike(WORDY))
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(
        F.trim(x, F.lit(EDGES)).alias("x"), i.alias("at"))), lambda x: x["x"] != "")
    words = lambda y: F.regexp_count(y, F.lit(WORDY + "+")).cast("long")
    parts = let(lines, lambda x: F.struct(
        x["at"].alias("at"), F.transform(x["x"], lambda y: F.xxhash64(y)).alias("hash"),
        F.transform(x["x"], lambda y: F.xxhash64(F.lit(1), y)).alias("other"),
        F.transform(x["x"], lambda y: F.shiftleft(words(y), 32) + 1).alias("words")))
    d = d.select("id", F.xxhash64("text").alias("text_key"),
                 F.explode(let(parts, lambda p: _windows_of(p, min_words))).alias("w"))
    place = F.xxhash64("id", "text_key", "w.at")
    return d.select("id", "text_key", "w.fp", place.alias("place"), "w.run", "w.first", "w.last")


def _windows_of(p: Column, min_words: int) -> Column:
    """The windows of one document's lines."""
    # a line counts one word at least, so min_words lines always suffice
    right = F.transform(p["words"], lambda _, i: F.struct(
        (i + 1).alias("from"), _grown(F.slice(p["words"], i + 1, min_words), min_words).alias("n")))
    left = F.transform(p["words"], lambda _, i: let(
        _grown(F.reverse(F.slice(p["words"], F.greatest(i + 2 - min_words, F.lit(1)), F.least(i + 1, F.lit(min_words)))),
               min_words), lambda n: F.struct((i + 2 - n).alias("from"), n.alias("n"))))
    # as one long each: array_distinct hashes longs, but compares all pairs of structs
    coded = F.transform(F.concat(right, left), lambda r: F.shiftleft(r["from"].cast("long"), 32) + r["n"])
    grown = F.array_distinct(F.filter(coded, lambda r: r.isNotNull()))

    def window(r: Column) -> Column:
        begin, size = F.shiftright(r, 32).cast("int"), r.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
        return let(F.slice(p["hash"], begin, size), lambda h: let(F.array_min(h), lambda least: F.struct(
            least.alias("fp"), (begin + F.array_position(h, least).cast("int") - 1).alias("at"),
            F.struct(F.xxhash64(h).alias("a"), F.xxhash64(F.slice(p["other"], begin, size)).alias("b")).alias("run"),
            F.get(p["at"], begin - 1).alias("first"), F.get(p["at"], begin + size - 2).alias("last"))))

    return F.transform(grown, window)


def repeated(w: DataFrame) -> DataFrame:
    """The rows of ``windows`` whose window stands earlier."""
    shared = w.groupBy("fp").agg(F.min("place").alias("p"), F.max("place").alias("q")).where("p <> q").select("fp")
    r = keep(w.join(shared, "fp", "left_semi").drop("fp", "place"), "matched")
    # order of documents and lines, as one value that sorts like its parts
    place = F.struct(F.col("id").isNull().alias("o"), F.col("id").alias("id"), F.col("text_key").alias("t"),
                     F.col("first").alias("f"))
    least = r.groupBy("run").agg(F.min(place).alias("least"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return r.join(least, "run").where(~place.eqNullSafe(F.col("least"))).drop("least")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated passages deleted from the text, ``n_lines`` (as it
    was) and ``n_deleted``."""
    names = [c for c in docs.columns if c not in RESULT]
    # read twice: for the positions of fingerprints and for the windows themselves
    marks = repeated(keep(windows(docs, id_col, text_col, min_words), "windows"))
    marks = (marks.select(F.col("id").alias("_ld_id"), F.col("text_key").alias("_ld_key"),
                          F.explode(F.sequence("first", "last")).alias("line"))
             .groupBy("_ld_id", "_ld_key").agg(F.collect_set("line").alias("_ld_lines")))
    d = docs.select(*names, F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("_ld_text"))
    d = d.join(marks, F.col(id_col).eqNullSafe(F.col("_ld_id")) & (F.col("_ld_text") == F.col("_ld_key")), "left")
    lines = F.split(text_col, "\n")
    text = F.when(F.col("_ld_lines").isNull(), F.col(text_col)).otherwise(let(lines, lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("_ld_lines")), lambda i: F.get(x, i)), "\n")))
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines))
    return d.select(*[text.alias(c) if c == text_col else F.col(c) for c in names],
                    n_lines.cast("long").alias("n_lines"),
                    F.coalesce(F.size("_ld_lines"), F.lit(0)).cast("long").alias("n_deleted"))
