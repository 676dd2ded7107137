import math
import re
from collections import Counter, defaultdict

import pytest
from helpers import KIND, documents, odd

from basketry.llm import license_scan, url_filter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def by_hand(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(t)
    at, labels = [], set()
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        own = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        at += own
        labels |= {label} if own else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_labels_against_plain_python(spark):
    texts = ["GNU General Public License, gnu--general\npublic  license", "MIT Licenseé", "the MIT license mit licensed mit license",
             "cc by cc by", "CC-BY-SA; xcc by", "gnu general public gnu general public license", "ßmit license apache\x00license"]
    docs = odd(spark).select("doc_id", "text").unionByName(documents(spark).select("doc_id", "text")).unionByName(
        spark.createDataFrame([(900 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    rows = license_scan.scan(docs).collect()
    want = Counter((r["doc_id"], *by_hand(r["text"])) for r in docs.collect())
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows) == want
    for r in rows:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1 or not r["n_base"])
    assert license_scan.scan(spark.createDataFrame([], KIND)).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i, *row[1:]], row
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


@pytest.mark.parametrize("notice,label,edits", license_scan.NOTICES)
def test_notices_within_their_edits_are_found(notice, label, edits):
    import random

    rng = random.Random(notice)
    scanner = license_scan.Scanner(license_scan.PHRASES, license_scan.NOTICES)
    for k in range(edits + 1):
        for _ in range(6):
            t = list(notice)
            for _ in range(k):
                at = rng.randrange(len(t))
                how = rng.randrange(3)
                t[at:at + 1] = [] if how == 0 else ["q"] if how == 1 else [t[at], "q"]
            text = "some words before. " * 3 + "".join(t) + " and after."
            spans = [s for s in scanner.scan(text)[2] if s[0] == label]
            assert spans, (k, "".join(t))
            first, last, found = spans[0][1:]
            assert found <= edits and distance(text[first:last], min(
                (n for n, x, _ in license_scan.NOTICES if x == label), key=lambda n: distance(text[first:last], n))) <= found


def test_plain_text_has_no_notice(spark):
    got = license_scan.scan(documents(spark, "/root/testdata/sf0.01")).collect()
    texts = {r["doc_id"]: r["text"].lower() for r in documents(spark, "/root/testdata/sf0.01").collect()}
    assert any(r["labels"] for r in got)
    assert all("licen" in texts[r["doc_id"]] for r in got if r["labels"])


def host_path(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = re.match(r"[^?#]*", url.split("://", 1)[1])[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def rule(host, path):
    fits = [(r, a) for a, r in url_filter.RULES
            if (host == (h := r.split("/", 1)[0]) or host.endswith("." + h)) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1", "https://example.com/EN/1", "x://net/es/?a=://b/c",
        "http://xnet/es/", "https://a.net/fr/#x", "https://com", "https://a.com?x/", "http://www.example.com/en/1",
        "http://m.www.example.com/en/", "é://ü.com/ß", "http://b.org/" + "z" * 3000]


def pages(spark):
    rows = [(i, u, "clash", 1) for i, u in enumerate(URLS)] + [(3, "http://", "clash", 1)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, score int")


def test_rules_against_plain_python(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    for p in (pages(spark), d):
        urls = Counter((r["page_id"], *host_path(r["url"])) for r in p.collect())
        got = url_filter.filter_urls(p).collect()
        assert Counter((r["page_id"], r["host"], r["path"]) for r in got) == urls
        for r in got:
            name, action = rule(r["host"], r["path"])
            assert r["rule"] == name and r["verdict"] == (action or r["verdict"]) and r["verdict"] in ("allow", "block")


def test_scores_against_plain_python(spark):
    """The two models, with counts and Witten-Bell weights, by dictionaries."""
    d = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url").collect()
    frame = spark.createDataFrame(d)
    fold = {r["url"]: r["f"] for r in frame.selectExpr("url", "pmod(xxhash64(url), 5) f").collect()}
    order, counts = url_filter.ORDER, {"allow": defaultdict(Counter), "block": defaultdict(Counter)}

    def grams(u):
        p = url_filter.PAD * order + u
        return [(p[i:i + order], p[i + order]) for i in range(len(u))]

    for r in d:
        action = rule(*host_path(r["url"]))[1]
        if action and fold[r["url"]]:
            for context, c in grams(r["url"]):
                for k in range(order + 1):
                    counts[action][context[order - k:]][c] += 1

    def p(action, context, c):
        if len(context) == 0 or context is None:
            below = 1 / url_filter.ALPHABET
        else:
            below = p(action, context[1:], c)
        seen = counts[action][context]
        n = sum(seen.values())
        return (seen[c] + len(seen) * below) / (n + len(seen)) if n else below

    got = {r["page_id"]: r["score"] for r in url_filter.filter_urls(frame).collect()}
    for r in d:
        g = grams(r["url"])
        want = sum(math.log(p("allow", *x)) - math.log(p("block", *x)) for x in g) / max(1, len(g))
        assert got[r["page_id"]] == pytest.approx(want, abs=1e-7)


def test_no_pages(spark):
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_grams_of_a_long_url(spark):
    """A URL of 300,000 characters: one gram a character, in linear time."""
    from collections import Counter

    from basketry.llm import url_filter

    url = "http://" + "".join(chr(97 + i * i % 23) for i in range(300_000))
    d = url_filter.grams(spark.createDataFrame([(1, url)], "key long, url string"), 5)
    padded = url_filter.PAD * 5 + url
    want = Counter(padded[i:i + 6] for i in range(len(url)))
    assert {r["gram"]: r["count"] for r in d.groupBy("gram").count().collect()} == want


def test_exploded_urls_are_not_broadcast(spark):
    """900,000 characters in files of a few MB: their grams are far larger than the plan says."""
    import random

    rng, name = random.Random(6), "spark.sql.maxBroadcastTableSize"
    urls = [f"http://{i}.{'com' if i % 2 else 'net'}/es/" + "".join(rng.choices("abcdefgh", k=30_000)) for i in range(30)]
    d = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    before = spark.conf.get(name)
    spark.conf.set(name, "40m")
    try:
        got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(d).collect()}
    finally:
        spark.conf.set(name, before)
    assert got == {i: "allow" if i % 2 else "block" for i in range(30)}
