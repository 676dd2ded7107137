"""DuckDB SQL for the registered queries (the correctness oracle).

Written independently of the Spark plans: no pruning, every level is a
k-way self-join of the distinct (basket, item) rows.
"""

from __future__ import annotations

from basketry.catalog import (BRAND_T, LINE_ITEMS, PCY_BUCKETS, SON_CHUNKS, SUPP_ALL_T, SUPP_T, TOI_ADJUST, TOI_FAIL_ADJUST,
                              TOI_FAIL_SIZE, TOI_SEED, TOI_SIZE, TOP_N)

SUPP_B = ("SELECT DISTINCT l_orderkey AS basket, l_suppkey AS item FROM lineitem "
          "JOIN orders ON l_orderkey = o_orderkey "
          "WHERE o_orderstatus = 'F' AND l_returnflag IN ('A', 'R')")
SUPP_ALL_B = "SELECT DISTINCT l_orderkey AS basket, l_suppkey AS item FROM lineitem"
BRAND_B = ("SELECT DISTINCT l_orderkey AS basket, p_brand AS item FROM lineitem "
           "JOIN part ON l_partkey = p_partkey")
LABELS = "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0"


def items(k: int, prefix: str = "") -> str:
    return ", ".join(f"{prefix}item{i}" for i in range(1, k + 1))


def occ(k: int, src: str = "b") -> str:
    """All k-combinations of every basket of ``src``: (basket, item1..itemk)."""
    sel = ", ".join(f"x{i}.item AS item{i}" for i in range(1, k + 1))
    joins = "".join(f" JOIN {src} x{i} ON x{i}.basket = x1.basket AND x{i}.item > x{i - 1}.item"
                    for i in range(2, k + 1))
    return f"SELECT x1.basket, {sel} FROM {src} x1{joins}"


def counts(k: int, src: str = "b") -> str:
    return f"SELECT {items(k)}, count(*) AS support FROM ({occ(k, src)}) GROUP BY {items(k)}"


def lvl(k: int, t, src: str = "b") -> str:
    return f"{counts(k, src)} HAVING count(*) >= {t}"


def text(k: int, rel: str, extra: str = ", support") -> str:
    parts = ", ".join(f"CAST(item{i} AS VARCHAR)" for i in range(1, k + 1))
    return f"SELECT {k} AS k, concat_ws('|', {parts}) AS itemset{extra} FROM {rel}"


def all_levels(base: str, t: int, max_k: int) -> str:
    ctes = ", ".join(f"l{k} AS ({lvl(k, t)})" for k in range(1, max_k + 1))
    body = " UNION ALL ".join(text(k, f"l{k}") for k in range(1, max_k + 1))
    return f"WITH b AS ({base}), {ctes} {body}"


def level_sql(base: str, t: int, k: int) -> str:
    return f"WITH b AS ({base}) {lvl(k, t)}"


# -- SON ----------------------------------------------------------------------

def _son_ctes() -> str:
    return (f"WITH b AS ({SUPP_B}), n AS (SELECT count(DISTINCT basket) AS n FROM b), "
            f"cs AS (SELECT basket % {SON_CHUNKS} AS chunk, count(DISTINCT basket) AS cn FROM b GROUP BY 1), "
            f"l1 AS ({lvl(1, SUPP_T)}), l2 AS ({lvl(2, SUPP_T)}), "
            f"o2 AS (SELECT * FROM ({occ(2)}) WHERE item1 IN (SELECT item1 FROM l1) "
            f"AND item2 IN (SELECT item1 FROM l1)), "
            f"o3 AS (SELECT o.* FROM ({occ(3)}) o "
            f"JOIN l2 a ON a.item1 = o.item1 AND a.item2 = o.item2 "
            f"JOIN l2 c ON c.item1 = o.item1 AND c.item2 = o.item3 "
            f"JOIN l2 d ON d.item1 = o.item2 AND d.item2 = o.item3)")


def son_candidates(k: int) -> str:
    return (f"{_son_ctes()}, cc AS (SELECT basket % {SON_CHUNKS} AS chunk, {items(k)}, count(*) AS support "
            f"FROM o{k} GROUP BY ALL) "
            f"SELECT DISTINCT {items(k, 'cc.')} FROM cc JOIN cs ON cs.chunk = cc.chunk CROSS JOIN n "
            f"WHERE cc.support * n.n >= {SUPP_T} * cs.cn")


def son_global_count() -> str:
    return (f"{_son_ctes()}, cc AS (SELECT basket % {SON_CHUNKS} AS chunk, item1, item2, count(*) AS support "
            f"FROM o2 GROUP BY ALL), "
            f"cand AS (SELECT DISTINCT cc.item1, cc.item2 FROM cc JOIN cs ON cs.chunk = cc.chunk CROSS JOIN n "
            f"WHERE cc.support * n.n >= {SUPP_T} * cs.cn) "
            f"SELECT o2.item1, o2.item2, count(*) AS support FROM o2 JOIN cand "
            f"ON cand.item1 = o2.item1 AND cand.item2 = o2.item2 GROUP BY ALL")


# -- PCY ----------------------------------------------------------------------

def _h1(a: str, b: str) -> str:
    B = PCY_BUCKETS
    return f"((({a}) % {B}) * (({b}) % {B})) % {B}"


def _h2(a: str, b: str) -> str:
    B = PCY_BUCKETS
    return f"((({a}) % {B}) * (((({b}) % {B}) * 2) % {B})) % {B}"


def pcy_buckets() -> str:
    return (f"WITH b AS ({SUPP_B}), l1 AS ({lvl(1, SUPP_T)}), p AS (SELECT * FROM ({occ(2)}) "
            f"WHERE item1 IN (SELECT item1 FROM l1) AND item2 IN (SELECT item1 FROM l1)) "
            f"SELECT 0 AS hash_id, {_h1('item1', 'item2')} AS bucket, count(*) AS n FROM p GROUP BY 1, 2 "
            f"UNION ALL "
            f"SELECT 1 AS hash_id, {_h2('item1', 'item2')} AS bucket, count(*) AS n FROM p GROUP BY 1, 2")


def pcy_bitmap_filter() -> str:
    return (f"WITH bk AS ({pcy_buckets()}), fb AS (SELECT hash_id, bucket FROM bk WHERE n >= {SUPP_T}), "
            f"b AS ({SUPP_B}), l1 AS ({lvl(1, SUPP_T)}), "
            f"pairs AS (SELECT DISTINCT item1, item2 FROM ({occ(2)}) "
            f"WHERE item1 IN (SELECT item1 FROM l1) AND item2 IN (SELECT item1 FROM l1)) "
            f"SELECT item1, item2 FROM pairs p WHERE "
            f"EXISTS (SELECT 1 FROM fb WHERE fb.hash_id = 0 AND fb.bucket = {_h1('p.item1', 'p.item2')}) AND "
            f"EXISTS (SELECT 1 FROM fb WHERE fb.hash_id = 1 AND fb.bucket = {_h2('p.item1', 'p.item2')})")


# -- Toivonen ---------------------------------------------------------------------

def _toi_ctes(size: int, adjust: float, max_k: int = 4) -> str:
    """Sample levels s1..s{max_k}, candidate tables g2..g{max_k}
    (apriori-gen of the previous sample level) and full counts f1..f{max_k}."""
    t = BRAND_T
    parts = [
        f"b AS ({BRAND_B})",
        "n AS (SELECT count(DISTINCT basket) AS n FROM b)",
        f"sk AS (SELECT basket FROM (SELECT DISTINCT basket FROM b) "
        f"ORDER BY md5('{TOI_SEED}:' || CAST(basket AS VARCHAR)), basket LIMIT {size})",
        "sn AS (SELECT count(*) AS sn FROM sk)",
        f"st AS (SELECT greatest(1, CAST(ceil({adjust} * sn * {t} / n) AS BIGINT)) AS st FROM n CROSS JOIN sn)",
        "sb AS (SELECT b.* FROM b JOIN sk ON sk.basket = b.basket)",
    ]
    for k in range(1, max_k + 1):
        parts.append(f"s{k} AS ({counts(k, 'sb')} HAVING count(*) >= (SELECT st FROM st))")
        parts.append(f"f{k} AS ({counts(k, 'b')})")
    parts.append("g1 AS (SELECT DISTINCT item AS item1 FROM b)")
    parts.append("g2 AS (SELECT a.item1 AS item1, c.item1 AS item2 FROM s1 a JOIN s1 c ON a.item1 < c.item1)")
    for k in range(3, max_k + 1):
        pre = " AND ".join(f"c.item{i} = a.item{i}" for i in range(1, k - 1))
        sel = ", ".join([f"a.item{i} AS item{i}" for i in range(1, k)] + [f"c.item{k - 1} AS item{k}"])
        # remaining (k-1)-subsets: drop item j for j = 1..k-2
        checks = []
        for j in range(1, k - 1):
            cols = [f"item{i}" for i in range(1, k + 1) if i != j]
            cond = " AND ".join(f"z.item{p} = g.{c}" for p, c in enumerate(cols, start=1))
            checks.append(f"EXISTS (SELECT 1 FROM s{k - 1} z WHERE {cond})")
        parts.append(f"g{k}_raw AS (SELECT {sel} FROM s{k - 1} a JOIN s{k - 1} c ON {pre} "
                     f"AND a.item{k - 1} < c.item{k - 1})")
        parts.append(f"g{k} AS (SELECT * FROM g{k}_raw g WHERE {' AND '.join(checks)})")
    for k in range(1, max_k + 1):
        key = " AND ".join(f"x.item{i} = y.item{i}" for i in range(1, k + 1))
        parts.append(f"nb{k} AS (SELECT * FROM g{k} x WHERE NOT EXISTS (SELECT 1 FROM s{k} y WHERE {key}))")
        parts.append(
            f"fc{k} AS (SELECT f.*, CASE WHEN EXISTS (SELECT 1 FROM s{k} y WHERE "
            f"{key.replace('x.', 'f.')}) THEN 'frequent' ELSE 'border' END AS kind "
            f"FROM f{k} f WHERE EXISTS (SELECT 1 FROM g{k} x WHERE {key.replace('y.', 'f.')}))")
    return "WITH " + ", ".join(parts)


def negative_border(size: int = TOI_SIZE, adjust: float = TOI_ADJUST, max_k: int = 4) -> str:
    body = " UNION ALL ".join(text(k, f"nb{k}", extra="") for k in range(1, max_k + 1))
    return f"{_toi_ctes(size, adjust, max_k)} {body}"


def full_scan(size: int = TOI_SIZE, adjust: float = TOI_ADJUST, max_k: int = 4) -> str:
    body = " UNION ALL ".join(text(k, f"fc{k}", extra=", support, kind") for k in range(1, max_k + 1))
    return f"{_toi_ctes(size, adjust, max_k)} {body}"


def verdict(size: int, adjust: float, max_k: int = 4) -> str:
    nb = " + ".join(f"(SELECT count(*) FROM nb{k})" for k in range(1, max_k + 1))
    bad = " + ".join(f"(SELECT count(*) FROM fc{k} WHERE kind = 'border' AND support >= {BRAND_T})"
                     for k in range(1, max_k + 1))
    return (f"{_toi_ctes(size, adjust, max_k)} SELECT CASE WHEN ({bad}) = 0 THEN 'success' ELSE 'failed' END "
            f"AS status, (SELECT sn FROM sn) AS sample_n, (SELECT st FROM st) AS sample_threshold, "
            f"CAST({nb} AS BIGINT) AS n_border, CAST({bad} AS BIGINT) AS n_border_frequent")


def monotonicity_k4() -> str:
    """4-sets of two frequent 3-sets that share two items, with all four 3-subsets frequent."""
    subs = [[f"g.item{i}" for i in range(1, 5) if i != j] for j in range(1, 5)]
    tests = " AND ".join("EXISTS (SELECT 1 FROM l3 z WHERE " + " AND ".join(f"z.item{p} = {c}" for p, c in enumerate(cols, 1)) + ")"
                         for cols in subs)
    return (f"WITH b AS ({BRAND_B}), l3 AS ({lvl(3, BRAND_T)}), g AS (SELECT a.item1, a.item2, a.item3, c.item3 AS item4 "
            f"FROM l3 a JOIN l3 c ON a.item1 = c.item1 AND a.item2 = c.item2 AND a.item3 < c.item3) "
            f"SELECT * FROM g WHERE {tests}")


def drawn() -> str:
    """CTEs: b, and d (basket, draws) of seeded draws with replacement."""
    return (f"WITH b AS ({BRAND_B}), p AS (SELECT basket, row_number() OVER (ORDER BY basket) AS place "
            f"FROM (SELECT DISTINCT basket FROM b)), n AS (SELECT count(*) AS n FROM p), "
            f"w AS (SELECT CAST('0x' || substr(md5('{TOI_SEED}:' || CAST(i AS VARCHAR)), 1, 15) AS BIGINT) % n + 1 AS place "
            f"FROM range({TOI_SIZE}) t(i) CROSS JOIN n), "
            f"d AS (SELECT basket, count(*) AS draws FROM w JOIN p ON p.place = w.place GROUP BY basket)")


# -- everything ---------------------------------------------------------------------

def build() -> dict[str, str]:
    s = SUPP_B
    l1 = f"WITH b AS ({s}) {lvl(1, SUPP_T)}"
    l2 = f"WITH b AS ({s}) {lvl(2, SUPP_T)}"
    l3 = f"WITH b AS ({s}) {lvl(3, SUPP_T)}"
    extract = (f"SELECT t.basket, t.item, s.s_name AS item_name FROM ({s}) t "
               f"LEFT JOIN ({LABELS}) s ON s.s_suppkey = t.item")
    lines = (f"WITH b AS ({s}) SELECT basket, string_agg(CAST(item AS VARCHAR), '|' ORDER BY item) AS items "
             f"FROM b GROUP BY basket")
    l1w = f"l1 AS ({lvl(1, SUPP_T)})"
    l2w = f"l2 AS ({lvl(2, SUPP_T)})"
    o2_freq_items = (f"SELECT * FROM ({occ(2)}) WHERE item1 IN (SELECT item1 FROM l1) "
                     f"AND item2 IN (SELECT item1 FROM l1)")
    win = (f"WITH b AS ({s}), {l1w}, o2 AS ({o2_freq_items}) SELECT * FROM (SELECT basket, item1, item2, "
           f"count(*) OVER (PARTITION BY item1, item2) AS support FROM o2) WHERE support >= {SUPP_T}")
    q = {
        "src_csv_roundtrip": extract,
        "src_text_split": lines,
        "src_parquet": s,
        "src_tsv_gzip": extract,
        "basket_lines": (f"WITH b AS ({s}) SELECT basket, part, string_agg(CAST(item AS VARCHAR), '|' ORDER BY item) "
                         f"AS items FROM (SELECT *, CAST((row_number() OVER (PARTITION BY basket ORDER BY item) - 1) "
                         f"// {LINE_ITEMS} AS INTEGER) AS part FROM b) GROUP BY basket, part"),
        "infrequent_filter": (f"WITH b AS ({SUPP_ALL_B}) SELECT item AS item1, count(*) AS support FROM b GROUP BY item "
                              f"HAVING count(*) < 590"),
        "son_null_chunk": l2,
        "son_hash_chunks": l2,
        **{f"candidate_filter_{x}": (f"WITH b AS ({s}), {l1w}, o2 AS ({o2_freq_items}) SELECT item1, item2, "
                                     f"count(*) AS support FROM o2 WHERE item2 % 2 = 0 GROUP BY ALL "
                                     f"HAVING count(*) >= {SUPP_T}") for x in ("apriori", "pcy", "son")},
        "pcy_xxhash_k2": l2,
        "basket_parse": s,
        "itemset_codec_roundtrip": l2,
        "materialize_reuse": (f"WITH b AS ({s}), {l1w} SELECT item1, support, (SELECT count(*) FROM l1) AS n_read "
                              f"FROM l1 WHERE item1 % 2 = 0"),
        "filter_eq": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'",
        "filter_in": "SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag IN ('A', 'R')",
        "extract_transactions": extract,
        "support_filter": level_sql(SUPP_ALL_B, SUPP_ALL_T, 2),
        "itemset_expand": l2,
        "monotonicity_prune": (f"WITH b AS ({s}), {l2w} SELECT a.item1, a.item2, c.item2 AS item3 FROM l2 a "
                               f"JOIN l2 c ON c.item1 = a.item1 AND a.item2 < c.item2 "
                               f"JOIN l2 d ON d.item1 = a.item2 AND d.item2 = c.item2"),
        "pcy_bitmap_filter": pcy_bitmap_filter(),
        "pcy_bitmap_packed": pcy_bitmap_filter(),
        "monotonicity_prune_k4": monotonicity_k4(),
        "join_inner": ("SELECT l_orderkey AS basket, l_suppkey AS item FROM lineitem "
                       "JOIN orders ON l_orderkey = o_orderkey "
                       "WHERE o_orderstatus = 'F' AND l_returnflag IN ('A', 'R')"),
        "join_left": (f"SELECT t.item, s.s_name AS item_name FROM (SELECT DISTINCT item FROM ({s})) t "
                      f"LEFT JOIN ({LABELS}) s ON s.s_suppkey = t.item"),
        "candidates_k2": f"WITH b AS ({s}), {l1w} {o2_freq_items}",
        "candidates_k3": (f"WITH b AS ({s}), {l2w} SELECT o.* FROM ({occ(3)}) o "
                          f"JOIN l2 a ON a.item1 = o.item1 AND a.item2 = o.item2 "
                          f"JOIN l2 c ON c.item1 = o.item1 AND c.item2 = o.item3"),
        "label_itemsets": (f"WITH b AS ({s}), {l2w}, s AS ({LABELS}) SELECT l2.support, l2.item1, "
                           f"s1.s_name AS item1_name, l2.item2, s2.s_name AS item2_name FROM l2 "
                           f"LEFT JOIN s s1 ON s1.s_suppkey = l2.item1 LEFT JOIN s s2 ON s2.s_suppkey = l2.item2"),
        "semi_join_frequent": (f"WITH b AS ({s}), {l2w} SELECT o.* FROM ({occ(2)}) o "
                               f"JOIN l2 ON l2.item1 = o.item1 AND l2.item2 = o.item2"),
        "negative_border": negative_border(),
        "support_k1": f"WITH b AS ({s}) {counts(1)}",
        "support_k2": (f"WITH b AS ({s}), {l1w}, o2 AS ({o2_freq_items}) "
                       f"SELECT item1, item2, count(*) AS support FROM o2 GROUP BY ALL"),
        "support_k3": (f"WITH b AS ({s}), {l2w} SELECT o.item1, o.item2, o.item3, count(*) AS support "
                       f"FROM ({occ(3)}) o JOIN l2 a ON a.item1 = o.item1 AND a.item2 = o.item2 "
                       f"JOIN l2 c ON c.item1 = o.item1 AND c.item2 = o.item3 "
                       f"JOIN l2 d ON d.item1 = o.item2 AND d.item2 = o.item3 GROUP BY ALL"),
        "son_global_count": son_global_count(),
        "pcy_buckets": pcy_buckets(),
        "itemset_stats": (f"WITH b AS ({s}), {l2w} SELECT count(*) AS count, avg(support) AS avg, "
                          f"max(support) AS max, min(support) AS min FROM l2"),
        "distinct_itemsets": l2,
        "level_counts": (f"WITH b AS ({s}), " + ", ".join(f"l{k} AS ({lvl(k, SUPP_T)})" for k in range(1, 5))
                         + " " + " UNION ALL ".join(f"SELECT {k} AS k, count(*) AS n_itemsets FROM l{k}"
                                                    for k in range(1, 5))),
        "basket_count": f"WITH b AS ({s}) SELECT count(DISTINCT basket) AS n_baskets FROM b",
        "chunk_sizes": (f"WITH b AS ({s}) SELECT basket % {SON_CHUNKS} AS chunk, count(DISTINCT basket) "
                        f"AS n_baskets FROM b GROUP BY 1"),
        "support_window": win,
        "row_number_chunk": (f"WITH b AS ({s}) SELECT basket % {SON_CHUNKS} AS chunk, basket, "
                             f"'nm' || lpad(CAST(basket AS VARCHAR), CAST(greatest(7, length(CAST(basket AS VARCHAR))) AS INTEGER), '0') AS label, "
                             f"CAST(row_number() OVER (PARTITION BY basket % {SON_CHUNKS} ORDER BY basket) "
                             f"AS BIGINT) AS row_number FROM (SELECT DISTINCT basket FROM b)"),
        "topk_itemsets": (f"WITH b AS ({s}), {l2w} SELECT support, item1, item2 FROM l2 "
                          f"ORDER BY support DESC, item1, item2 LIMIT {TOP_N}"),
        "sample_exact": (f"WITH b AS ({BRAND_B}) SELECT basket FROM (SELECT DISTINCT basket FROM b) "
                         f"ORDER BY md5('{TOI_SEED}:' || CAST(basket AS VARCHAR)), basket LIMIT {TOI_SIZE}"),
        "sample_with_replacement": f"{drawn()} SELECT basket, draws FROM d",
        "weighted_support": (f"{drawn()} SELECT item1, item2, CAST(sum(draws) AS BIGINT) AS support "
                             f"FROM ({occ(2)}) o JOIN d ON d.basket = o.basket GROUP BY item1, item2"),
        "son_candidates_k2": son_candidates(2),
        "son_candidates_k3": son_candidates(3),
        "toivonen_verdict": verdict(TOI_SIZE, TOI_ADJUST),
        "toivonen_verdict_fail": verdict(TOI_FAIL_SIZE, TOI_FAIL_ADJUST),
        "toivonen_full_scan": full_scan(),
        "format_item_id": (f"SELECT DISTINCT item, 'nm' || lpad(CAST(item AS VARCHAR), "
                           f"CAST(greatest(7, length(CAST(item AS VARCHAR))) AS INTEGER), '0') AS item_id "
                           f"FROM ({s})"),
        "combinations_k2": f"WITH b AS ({s}) {occ(2)}",
        "combinations_k3": f"WITH b AS ({s}) {occ(3)}",
        "hash_product": f"WITH b AS ({s}), {l2w} SELECT item1, item2, {_h1('item1', 'item2')} AS bucket FROM l2",
        "hash_weighted": f"WITH b AS ({s}), {l2w} SELECT item1, item2, {_h2('item1', 'item2')} AS bucket FROM l2",
        "apriori_k1": l1,
        "apriori_k2": l2,
        "apriori_k3": l3,
        "apriori_all": all_levels(s, SUPP_T, 4),
        "apriori_brand_all": all_levels(BRAND_B, BRAND_T, 4),
        "apriori_supp_all": all_levels(SUPP_ALL_B, SUPP_ALL_T, 3),
        "apriori_scan_k2": l2,
        "apriori_scan_k3": l3,
        "pcy_k2": l2,
        "pcy_k3": l3,
        "son_k2": l2,
        "son_k3": l3,
        "apriori_basket_scan_k2": l2,
        "apriori_basket_scan_k3": l3,
        "son_two_pass_k2": l2,
        "son_two_pass_k3": l3,
        "toivonen_k2": level_sql(BRAND_B, BRAND_T, 2),
        "toivonen_k3": level_sql(BRAND_B, BRAND_T, 3),
    }
    return q
