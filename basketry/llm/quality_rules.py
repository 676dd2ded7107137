"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is an expression over the text alone, so scoring is a scan with
no shuffle, and every rule is a row of ``RULES``: measure, lowest and highest
value allowed.  A document is kept when no rule fails.

Stop words are counted among the letter runs of the lower-cased text, for each
language; the language with the most different ones (then the most) is the
text's own if there are ``PLAUSIBLE`` or more, and its ratio has bounds.  A
text that none of the languages is plausible for gets no verdict from them.

Cases: a null text counts as no text and an empty text fails ``n_words``;
repeated rows are judged one by one and alike; a text of any length is read
whole; an empty table gives an empty table; other columns pass through, and a
column that has the name of the result column (``quality``) is replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import blank_words, let, text_of

SYMBOLS = r"[#*$%&|<>]"
#: Words of a window; its hash is doubled up from one, two and four words.
WINDOW = 8

#: Different stop words that make a language plausible.
PLAUSIBLE = 3

#: Frequent function words of the languages in the corpus.
STOP_WORDS = {
    "en": "the of and to in is that for was on are with as be at by this from or an it not have he",
    "de": "der die das und in zu den von mit sich des auf ist nicht ein eine als auch es an dem im",
    "fr": "le la les de des et un une du en que est pour dans qui sur pas au par ce il ne se plus",
    "es": "el la los las de que y en un una por con para del se no su al es lo como más",
}

#: (measure, least, most); None leaves that side open.
RULES: tuple[tuple[str, float | None, float | None], ...] = (
    ("n_words", 20, None),
    ("mean_word_chars", 3.0, 10.0),
    ("symbol_ratio", None, 0.1),
    ("stop_ratio_en", 0.06, 0.7),
    ("stop_ratio_de", 0.04, 0.7),
    ("stop_ratio_fr", 0.05, 0.7),
    ("stop_ratio_es", 0.05, 0.7),
    ("dup_line_ratio", None, 0.4),
    ("repeat_word_ratio", None, 0.3),
)


def _covered(same: Column) -> Column:
    """Words in windows that stand twice or more; ``same``: sorted (window,
    start).  Equal windows are neighbours; the union of the spans of those is
    added up from their sorted starts."""
    def repeats(e: Column, i: Column) -> Column:
        return (((i > 0) & F.coalesce(F.get(same, i - 1)["k"] == e["k"], F.lit(False)))
                | F.coalesce(F.get(same, i + 1)["k"] == e["k"], F.lit(False)))

    starts = F.sort_array(F.transform(F.filter(same, repeats), lambda e: e["i"]))
    return F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct((a["n"] + s + WINDOW - F.greatest(a["end"], s)).cast("int").alias("n"),
                              (s + WINDOW).cast("int").alias("end")),
        lambda a: a["n"])


def _doubled(hashes: Column, step: int) -> Column:
    """Hash of twice the words from every place: a place's own and that of the
    place ``step`` words on (none past the end)."""
    return F.zip_with(hashes, F.slice(hashes, step + 1, F.greatest(F.size(hashes) - step, F.lit(0))),
                      lambda a, b: F.xxhash64(a, b))


def _repeated_words(words: Column) -> Column:
    """Hashes find the documents that may repeat a window; the words decide."""
    n = F.size(words)
    texts = lambda wins: F.sort_array(F.transform(wins, lambda _, i: F.struct(
        F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("k"), i.alias("i"))))
    found = let(F.transform(words, lambda w: F.xxhash64(w)), lambda one: let(
        _doubled(one, 1), lambda two: let(_doubled(two, 2), lambda four: let(
            F.slice(_doubled(four, 4), 1, n - (WINDOW - 1)),
            lambda wins: F.when(F.size(F.array_distinct(wins)) < F.size(wins), let(texts(wins), _covered)).otherwise(0)))))
    return F.when(n > WINDOW, found).otherwise(0)


def _own_stops(text: Column, stop_words: dict[str, str]) -> Column:
    """The text's own language and its share of stop words; null without one."""
    def found(words: Column, lang: str) -> Column:
        hits = F.filter(words, lambda w: w.isin(*sorted(set(stop_words[lang].split()))))
        return let(hits, lambda h: F.struct(F.size(F.array_distinct(h)).alias("n_different"), F.size(h).alias("n"),
                                            F.lit(lang).alias("lang")))

    return let(F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), ""), lambda words: let(
        F.array_max(F.array(*[found(words, lang) for lang in stop_words])), lambda most: F.when(
            most["n_different"] >= PLAUSIBLE, F.struct(most["lang"].alias("lang"), (most["n"] / F.size(words)).alias("ratio")))))


def measures(docs: DataFrame, text_col: str = "text", out: str = "quality",
             stop_words: dict[str, str] = STOP_WORDS) -> DataFrame:
    """``docs`` with a struct ``out`` of the measures."""
    names = [c for c in docs.columns if c != out]
    text = text_of(text_col)
    worded = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n_symbols = F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))
    long = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    counts = let(blank_words(text), lambda words: F.struct(
        long(F.size(words)).alias("n_words"), long(F.length(F.array_join(words, ""))).alias("word_chars"),
        long(_repeated_words(words)).alias("n_repeat_words")))
    lines = let(worded, lambda x: F.struct(long(F.size(x)).alias("n"), long(F.size(F.array_distinct(x))).alias("n_distinct")))

    def all_of(c: Column) -> Column:
        w, x, s = c["w"], c["x"], c["s"]
        words = F.greatest(w["n_words"], F.lit(1))
        dup = x["n"] - x["n_distinct"]
        return F.struct(
            w["n_words"].alias("n_words"), w["word_chars"].alias("word_chars"), s.alias("n_symbols"),
            dup.alias("n_dup_lines"), w["n_repeat_words"].alias("n_repeat_words"),
            (w["word_chars"] / words).alias("mean_word_chars"), (s / words).alias("symbol_ratio"),
            (dup / F.greatest(x["n"], F.lit(1))).alias("dup_line_ratio"),
            (w["n_repeat_words"] / words).alias("repeat_word_ratio"),
            *[F.when(c["own"]["lang"] == lang, c["own"]["ratio"]).alias(f"stop_ratio_{lang}") for lang in stop_words])

    parts = F.struct(counts.alias("w"), lines.alias("x"), long(n_symbols).alias("s"), _own_stops(text, stop_words).alias("own"))
    return docs.select(*names, let(parts, all_of).alias(out))


def failed_rules(measured: Column, rules=RULES) -> Column:
    """The names of the rules of a threshold table that a struct of measures fails."""
    def fails(name: str, least, most) -> Column:
        v = measured[name]
        parts = [v < least] * (least is not None) + [v > most] * (most is not None)
        return reduce(lambda a, b: a | b, parts, F.lit(False))

    return F.array_compact(F.array(*[F.when(fails(*r), F.lit(r[0])) for r in rules]))


def judge(docs: DataFrame, text_col: str = "text", out: str = "quality", rules=RULES,
          stop_words: dict[str, str] = STOP_WORDS) -> DataFrame:
    """``docs`` with ``out``: the measures, ``kept`` and the ``failed`` rules."""
    def verdict(q: Column) -> Column:
        failed = failed_rules(q, rules)
        return q.withField("kept", F.size(failed) == 0).withField("failed", failed)

    d = measures(docs, text_col, out, stop_words)
    return d.withColumn(out, let(F.col(out), verdict))
