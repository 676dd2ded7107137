"""The registered queries of the operators, and the SQL of those that SQL can
express.  A query derives its columns from its operator's output."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (
    ann, bpe, conversation_repair, jaccard_join, line_dedup, license_scan, mixing, quality_classifier, quality_rules, simhash_dedup, token_alignment, token_counts,
    url_filter)
from basketry.llm.common import Store, table

#: Overrides the vocabulary file.
VOCABULARY_VARIABLE = "BASKETRY_BPE_VOCABULARY"
#: Overrides the sentencepiece model.
PIECE_VARIABLE = "BASKETRY_PIECE_MODEL"


def vocabulary() -> str:
    """The byte-level BPE vocabulary: the file that the environment names, or
    the one that the public tokenizers package has."""
    if path := os.environ.get(VOCABULARY_VARIABLE):
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model() -> str:
    """The sentencepiece model: the file that the environment names, or the
    one that the public tokenizers package has."""
    if path := os.environ.get(PIECE_VARIABLE):
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary(), decoded_col="decoded")
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.sized(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    docs = Store(spark).write(docs.withColumn("key", mixing.row_key()).drop("text"), "sizes")
    return mixing.mix(docs, key_col="key").select("doc_id", "size", "source_size", "target", "taken", "position")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    q = F.col("quality")
    return d.select(
        "doc_id", q["n_words"].alias("n_words"), q["word_chars"].alias("word_chars"), q["n_symbols"].alias("n_symbols"),
        q["n_dup_lines"].alias("n_dup_lines"), q["n_repeat_words"].alias("n_repeat_words"),
        F.arrays_overlap(q["failed"], F.array(F.lit("n_words"), F.lit("repeat_word_ratio"))).alias("base_failed"),
        q["kept"].alias("kept"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary())


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = token_alignment.alignment(table(spark, sf_dir, "documents"), vocabulary(), piece_model())
    return rows


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    summary, repaired = conversation_repair.repair(conversation_repair.damage(rows))
    out = rows.select("conv_id").distinct()
    for d in (summary, conversation_repair.digests(repaired)):
        own = d.withColumnRenamed(d.columns[0], "_conv")
        out = out.join(own, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in summary.columns[1:-1]]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_mixing, op3_license_scan, op4_line_dedup, op5_simhash, op6_url_filter, op7_quality_rules,
    op8_neighbours, op9_token_counts, op10_quality_classifier, op11_token_alignment,
    op12_conversation_repair, op13_jaccard_join)}

#: The targets: capped sources first by cap over weight; the first that is not
#: capped fixes the rate.  Copies are cut where the (whole) target ends.
MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
  FROM d GROUP BY source),
w AS (
  SELECT *, CAST([5, 2, 1][r % 3 + 1] AS DOUBLE) AS weight, [0.5, 0.0, -0.5][r % 3 + 1]::DOUBLE AS tilt,
         source_size * 2.0::DOUBLE AS cap FROM s),
f AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM w),
t AS (
  SELECT f.*, least(cap, coalesce(x.rate * weight, cap)) AS target
  FROM f LEFT JOIN (SELECT rate FROM f WHERE rate < cap / weight ORDER BY cap / weight, r LIMIT 1) x ON true),
o AS (
  SELECT d.doc_id, size, source_size, target, tilt,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off,
         CAST(round(target) AS BIGINT) AS fin
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, greatest(least(size, fin - off), 0) AS one, greatest(least(size, fin - off - source_size), 0) AS two,
         1 + tilt AS a FROM o),
p AS (
  SELECT *, CASE WHEN one > 0 THEN off::DOUBLE WHEN two > 0 THEN (off + source_size)::DOUBLE END AS beg FROM c)
SELECT doc_id, size, source_size, target, CAST(one + two AS BIGINT) AS taken,
       CASE WHEN beg IS NULL THEN NULL WHEN tilt = 0 THEN least(beg / target, 1.0::DOUBLE)
            ELSE (a - sqrt(greatest(a * a - 4.0::DOUBLE * tilt * least(beg / target, 1.0::DOUBLE), 0.0::DOUBLE))) / (2.0::DOUBLE * tilt) END AS position
FROM p
"""

#: A line goes if a run of lines with 50 words or more that holds it stands
#: earlier; every such run is made of ones that end where the words suffice.
LINES_SQL = r"""
WITH d AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id NULLS LAST) AS rid FROM documents),
l AS (
  SELECT rid, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM d WHERE text IS NOT NULL),
n AS (
  SELECT rid, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM l),
o AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY pos) AS i, sum(words) OVER (PARTITION BY rid ORDER BY pos) AS upto
  FROM n WHERE words > 0),
enough AS (
  SELECT a.rid, a.i, b.i AS j FROM o a JOIN o b
    ON a.rid = b.rid AND b.i BETWEEN a.i AND a.i + 49 AND b.upto - a.upto + a.words >= 50),
r AS (
  SELECT rid, i, min(j) AS j FROM enough GROUP BY rid, i
  UNION SELECT rid, max(i) AS i, j FROM enough GROUP BY rid, j),
k AS (
  SELECT r.rid, r.i, r.j, min(o.pos) AS a, max(o.pos) AS b, string_agg(o.x, chr(10) ORDER BY o.i) AS run
  FROM r JOIN o ON o.rid = r.rid AND o.i BETWEEN r.i AND r.j GROUP BY r.rid, r.i, r.j),
later AS (
  SELECT rid, a, b FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY rid, a) AS nth FROM k) WHERE nth > 1),
gone AS (SELECT DISTINCT l.rid, l.pos FROM l JOIN later ON l.rid = later.rid AND l.pos BETWEEN later.a AND later.b),
kept AS (
  SELECT l.rid, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE gone.pos IS NULL) AS text,
         count(*) AS n_lines, count(gone.pos) AS n_deleted
  FROM l LEFT JOIN gone ON l.rid = gone.rid AND l.pos = gone.pos GROUP BY l.rid)
SELECT doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted
FROM d LEFT JOIN kept ON d.rid = kept.rid
"""


def rules_sql() -> str:
    """The threshold table in SQL, with the fixed word lists of the operator."""
    words = " UNION ALL ".join(
        f"SELECT '{lang}' AS lang, unnest(string_split('{w}', ' ')) AS word" for lang, w in quality_rules.STOP_WORDS.items())
    fails = [f"coalesce({name} {sign} {bound}::DOUBLE, false)" for name, least, most in quality_rules.RULES
             for sign, bound in (("<", least), (">", most)) if bound is not None]
    ratios = ", ".join(f"CASE WHEN lang = '{lang}' THEN ratio END AS stop_ratio_{lang}" for lang in quality_rules.STOP_WORDS)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, regexp_extract_all(lower(t), '\p{{L}}+') AS letters,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (
  SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS k
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
twice AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, k) AS n FROM win) WHERE n > 1),
inside AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY rid),
stops AS (SELECT DISTINCT lang, word FROM ({words})),
hits AS (
  SELECT rid, lang, count(DISTINCT word) AS n_different, count(*) AS n
  FROM (SELECT rid, unnest(letters) AS word FROM w) JOIN stops USING (word) GROUP BY rid, lang),
own AS (
  SELECT rid, lang, n FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY n_different DESC, n DESC, lang DESC) AS r
                            FROM hits) WHERE r = 1 AND n_different >= {quality_rules.PLAUSIBLE}),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '{quality_rules.SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(inside.n, 0) AS n_repeat_words,
         len(l) AS n_lines, own.lang, own.n::DOUBLE / len(letters) AS ratio
  FROM w LEFT JOIN inside USING (rid) LEFT JOIN own USING (rid)),
q AS (
  SELECT *, word_chars::DOUBLE / greatest(n_words, 1) AS mean_word_chars, n_symbols::DOUBLE / greatest(n_words, 1) AS symbol_ratio,
         n_dup_lines::DOUBLE / greatest(n_lines, 1) AS dup_line_ratio,
         n_repeat_words::DOUBLE / greatest(n_words, 1) AS repeat_word_ratio, {ratios} FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT ({" OR ".join(fails)}) AS kept
FROM q
"""


ORACLE_SQL = {"op2_mixing": MIXING_SQL, "op4_line_dedup": LINES_SQL, "op7_quality_rules": rules_sql()}
