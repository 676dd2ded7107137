"""URL filters: host and path rules, and a character language-model ratio for
the URLs that no rule decides.

Two smoothed variable-order Markov models, one of the URLs that the rules
accept and one of those they reject, give each character its probability after
the characters before it.  Orders are interpolated (Witten-Bell): an order
that has seen its context n times with t different characters gets the weight
n / (n + t), the rest goes to the order below, and below order 0 all
code points are alike.  A URL's score is the mean over its characters of the
log-probability under the accepted model less that under the rejected one.
The threshold is calibrated on a fifth of the ruled URLs, which the models
don't see: of all cuts between bins of scores it is the one with the highest
balanced accuracy.

Scale: URLs become grams (a character with its ``ORDER`` predecessors);
everything is computed once per distinct gram, counted before the shuffle.
Lower orders are sums over the table of distinct grams.  Scores join back on
the gram; a gram that all URLs share is split by the skew join.  Tables of grams
and URLs are joined by shuffles (the merge hints): planned sizes are those of
compressed files and leave out that a URL explodes into its characters, so a
broadcast of 10 MB by plan would be gigabytes in the driver.

Cases: a null URL or one without ``://`` has an empty host and path, fits no
rule, and scores over the characters it has (none: 0); repeated rows are
judged alike; long URLs are read whole; if the rules accept or reject
nothing, the models are equal and every score is 0, which allows; an empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from basketry.llm.common import Store

#: (action, host and path prefix); the longest that fits wins.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
ORDER = 5
#: Stands before the first character of a URL.
PAD = "\x02"
#: Characters of a URL that are cut off at a time.
PIECE = 1024
ALPHABET = 0x110000
FOLDS = 5
BIN = 0.02
LARGEST = 10.0


def _low(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = _low(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, its action) of the longest rule that fits, else nulls."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, r in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        h, p = r.split("/", 1)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, action = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(action)
    return rule, action


def grams(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """``urls`` (key, url, ...) exploded: one row per character, with the
    ``order`` characters before it.  URLs are first cut into overlapping pieces,
    as reading a character of a string walks the string from its start."""
    names = [c for c in urls.columns if c != "url"]
    padded = F.concat(F.lit(PAD * order), "url")
    n = F.length("url")
    d = urls.where(n > 0).select(*names, padded.alias("p"), F.explode(F.sequence(F.lit(1), n, F.lit(PIECE))).alias("i"))
    d = d.select(*names, F.substring("p", F.col("i"), PIECE + order).alias("p"))
    d = d.select(*names, "p", F.explode(F.sequence(F.lit(1), F.length("p") - order)).alias("i"))
    return d.select(*names, F.substring("p", F.col("i"), order + 1).alias("gram"))


def log_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ratio) from (gram, yes, no): how often the accepted and the
    rejected URLs have each gram (0 in both: grams of other URLs only).

    ``tables[k]`` has the strings of k + 1 characters: a context of k and the
    character after it.  A context has at most one row for each character, so
    no key of these joins is hot."""
    store = Store(counts.sparkSession)
    tables = [counts.withColumnRenamed("gram", "own")]
    for k in range(order, 0, -1):
        shorter = tables[0].groupBy(F.substring("own", 2, k).alias("own")).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        tables.insert(0, store.write(shorter, f"order{k - 1}"))
    below = None
    for k, t in enumerate(tables):
        context = F.substring("own", 1, k).alias("context")
        total = t.groupBy(context).agg(
            *[F.sum(c).alias(f"n_{c}") for c in ("yes", "no")],
            *[F.count_if(F.col(c) > 0).alias(f"t_{c}") for c in ("yes", "no")])
        d = t.withColumn("context", context).join(total.hint("merge"), "context")
        if below is None:
            d = d.withColumns({f"q_{c}": F.lit(1.0 / ALPHABET) for c in ("yes", "no")})
        else:
            d = d.withColumn("suffix", F.substring("own", 2, k)).join(
                below.select(F.col("own").alias("suffix"), *[F.col(f"p_{c}").alias(f"q_{c}") for c in ("yes", "no")]).hint("merge"),
                "suffix")
        p = {c: F.when(F.col(f"n_{c}") > 0, (F.col(c) + F.col(f"t_{c}") * F.col(f"q_{c}"))
                       / (F.col(f"n_{c}") + F.col(f"t_{c}"))).otherwise(F.col(f"q_{c}")) for c in ("yes", "no")}
        below = store.write(d.select("own", *[x.alias(f"p_{c}") for c, x in p.items()]), f"model{k}")
    return below.select(F.col("own").alias("gram"), (F.log("p_yes") - F.log("p_no")).alias("ratio"))


def best_cut(scored: DataFrame) -> float:
    """The cut with the highest balanced accuracy over (score, yes, no), where
    yes and no count accepted and rejected rows; 0 unless there are both.
    At most 2 * LARGEST / BIN + 1 bins are compared."""
    bins = scored.groupBy(F.floor(F.least(F.greatest("score", F.lit(-LARGEST)), F.lit(LARGEST)) / BIN).alias("bin")).agg(
        F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    up = Window.orderBy("bin")
    d = bins.select(
        "bin", F.sum("yes").over(Window.partitionBy()).alias("all_yes"), F.sum("no").over(Window.partitionBy()).alias("all_no"),
        (F.sum("yes").over(up) - F.col("yes")).alias("lost"), (F.sum("no").over(up) - F.col("no")).alias("caught"))
    best = (d.where("all_yes > 0 and all_no > 0")
            .orderBy(F.desc((F.col("all_yes") - F.col("lost")) / F.col("all_yes") + F.col("caught") / F.col("all_no")),
                     F.abs("bin"), "bin").first())
    return best["bin"] * BIN if best else 0.0


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                rules: Sequence[tuple[str, str]] = RULES, order: int = ORDER) -> DataFrame:
    """(id, host, path, rule, verdict, score) of every row."""
    spark = pages.sparkSession
    store = Store(spark)
    url = F.coalesce(F.col(url_col), F.lit(""))
    urls = pages.groupBy(url.alias("url")).agg(F.count("*").alias("rows"))
    host, path = host_and_path(F.col("url"))
    urls = urls.withColumns({"host": host, "path": path})
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    fold = F.pmod(F.xxhash64("url"), F.lit(FOLDS))
    urls = store.write(urls.withColumns({"rule": rule, "action": action, "fold": fold,
                                         "uid": F.monotonically_increasing_id()}), "urls")
    learn = lambda a: F.when((F.col("action") == a) & (F.col("fold") > 0), F.col("rows")).otherwise(0)
    occurrences = grams(urls.select("uid", "url", learn("allow").alias("yes"), learn("block").alias("no")), order)
    counts = store.write(occurrences.groupBy("gram").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")), "counts")
    sums = (occurrences.select("uid", "gram").join(log_ratios(counts, order).hint("merge"), "gram")
            .groupBy("uid").agg(F.sum("ratio").alias("sum")))
    scored = urls.join(sums, "uid", "left").withColumn(
        "score", F.round(F.coalesce(F.col("sum") / F.length("url"), F.lit(0.0)), 9))
    scored = store.write(scored.select("url", "host", "path", "rule", "action", "fold", "rows", "score"), "scored")
    held = lambda a: F.when(F.col("action") == a, F.col("rows")).otherwise(0)
    cut = best_cut(scored.where("fold = 0 and action is not null").select("score", held("allow").alias("yes"), held("block").alias("no")))
    verdict = F.coalesce("action", F.when(F.col("score") >= cut, "allow").otherwise("block"))
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"))
    return rows.join(scored.hint("merge"), "url").select(F.col("id").alias(id_col), "host", "path", "rule",
                                           verdict.alias("verdict"), "score")
