"""SON (M4): chunk-local mining, union of local results, exact global count.

Each basket belongs to one chunk (``pmod(xxhash64(basket), n_chunks)`` by
default, or a user expression over the basket key; baskets whose expression
is null are a chunk of their own).  At each level the
candidate occurrences -- extensions of the *global* L_{k-1}, pruned by all
subsets (P9) like the reference's local miner, or by the prefix only --
are counted per (chunk, itemset) in one hash aggregate.  An itemset is a
local candidate when its chunk count reaches the chunk's share of the
threshold, ``count * n >= threshold * chunk_n`` (exact decimals; no
floating-point edge).  The distinct local candidates (U1) are the SON
candidates; their global support is the sum of their chunk counts (A3), exact
because it is summed before the others are dropped.  Only the candidates are
written: their number is bounded by the chunks' own results.
Nothing is collected: the per-chunk basket counts stay a table joined to
the counts; only their row count and the total n reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import BASKET, CHUNK, ITEM, SUPPORT, item_cols
from basketry.operators.aggregates import chunk_sizes, count_support, support_filter
from basketry.operators.joins import broadcast_if_small, extend_occurrences
from basketry.plans.levels import CandidateFilter, Level
from basketry.plans.scan import ScanMiner
from basketry.plans.transactions import Baskets
from basketry.plans.tree import Tree, count

ChunkFn = Callable[[Column], Column]


def hash_chunks(n_chunks: int) -> ChunkFn:
    """Split baskets into n chunks by a hash of the key."""
    def fn(basket: Column) -> Column:
        return F.pmod(F.xxhash64(basket), F.lit(int(n_chunks))).cast("int")
    return fn


class SONMiner(ScanMiner):
    name = "son"

    def __init__(self, baskets: Baskets, threshold: int, chunks: int | ChunkFn = 5,
                 prune: str = "full", max_k: int | None = None, tag: str | None = None,
                 candidate_filter: CandidateFilter | None = None):
        if prune not in ("full", "prefix"):
            raise ValueError("prune is 'full' or 'prefix'")
        self.chunk_fn = hash_chunks(chunks) if isinstance(chunks, int) else chunks
        # the chunk expression's text identifies it in the store path
        label = chunks if isinstance(chunks, int) else hashlib.sha1(
            str(self.chunk_fn(F.col(BASKET))).encode()).hexdigest()[:8]
        super().__init__(baskets, threshold, max_k, tag or f"son-t{threshold}-c{label}-{prune}",
                         candidate_filter)
        self.prune = prune
        # Baskets per chunk, kept as a table (one row per chunk); only
        # its row count and the total n come back to the driver
        self.sizes = self.store.write(chunk_sizes(baskets.df, self.chunk_fn(F.col(BASKET))), "chunk_sizes")
        self.n_chunks = self.sizes.count()
        self.n = int(self.sizes.agg(F.sum("n_baskets")).first()[0] or 0)
        self.son_candidates: dict[int, DataFrame] = {}
        self.candidate_counts: dict[int, DataFrame] = {}   # candidates with their global support

    def flag_local(self, per_chunk: DataFrame) -> DataFrame:
        """(chunk, itemset, support, local) where ``local`` is
        support * n >= threshold * chunk_n, in exact decimal arithmetic (no
        float edge, no long overflow)."""
        dec = "decimal(38,0)"
        sizes = broadcast_if_small(self.sizes.withColumnRenamed(CHUNK, "_chunk"), self.n_chunks)
        return (per_chunk.join(sizes, F.col(CHUNK).eqNullSafe(F.col("_chunk"))).drop("_chunk")
                .withColumn("_local", F.col(SUPPORT).cast(dec) * F.lit(self.n).cast(dec)
                            >= F.lit(self.threshold).cast(dec) * F.col("n_baskets").cast(dec))
                .drop("n_baskets"))

    def after_reuse(self, level: Level) -> bool:
        name = f"son_candidates{level.k}"
        if not self.store.complete(name):
            return False
        self._keep(level.k, self.store.read(name))
        return True

    def _keep(self, k: int, counted: DataFrame) -> None:
        self.candidate_counts[k] = counted
        self.son_candidates[k] = counted.select(*item_cols(k))

    def candidates(self, k: int, prev: Level) -> DataFrame:
        if self.prune == "prefix":
            return extend_occurrences(prev.occ, k)
        return super().candidates(k, prev)

    def frequent(self, k: int, cand: DataFrame) -> DataFrame:
        """Both SON passes in one aggregate over the per-chunk counts:
        ``max(local)`` is the union of the chunks' local results (U1) and
        ``sum(support)`` their exact global count (A3)."""
        items = item_cols(k)
        per_chunk = count_support(cand.withColumn(CHUNK, self.chunk_fn(F.col(BASKET))), k, [CHUNK])
        total = self.flag_local(per_chunk).groupBy(*items).agg(F.sum(SUPPORT).cast("bigint").alias(SUPPORT),
                                            F.max("_local").alias("_candidate"))
        self._keep(k, self.store.write(total.where("_candidate").select(*items, SUPPORT), f"son_candidates{k}"))
        return support_filter(self.candidate_counts[k], self.threshold)


class TwoPassSON(SONMiner):
    """SON in two passes over the transactions, whatever the depth.

    Pass 1 mines every chunk for itself, all chunks in one level loop: the
    state is keyed by chunk, L_{k-1} of a chunk being the itemsets that are
    frequent *in that chunk*, and its own occurrences are extended.  Pass 2
    counts the union of all chunks' itemsets, of all sizes, in one walk of the
    full data down their prefix tree.  ``local`` is the grouped miner (X4):
    (miner, k, candidate occurrences) -> (chunk, item1..itemk) of the itemsets
    that are frequent in their chunk; any other must return a superset of them
    for k = 1, 2, ... and keep every prefix.

    Pass 1's counts bound the support from above: a chunk that does not list an
    itemset holds it less often than the chunk's least count.  Itemsets whose
    bound is below the threshold are not counted again (``recounted``); the
    bound never grows with the itemset, so every subset of the others stays.

    Where the least count of every chunk is one, each itemset that occurs is
    frequent in its chunk: occurrences then carry the items behind their last
    one and are extended by these, with no self-join and no semi join."""

    name = "son_two_pass"

    def __init__(self, baskets: Baskets, threshold: int, chunks: int | ChunkFn = 5, max_k: int | None = None,
                 tag: str | None = None, local: Callable[["TwoPassSON", int, DataFrame], DataFrame] | None = None):
        label = f"{chunks}" if isinstance(chunks, int) else hashlib.sha1(str(chunks(F.col(BASKET))).encode()).hexdigest()[:8]
        super().__init__(baskets, threshold, chunks, "prefix", max_k, tag or f"son_two_pass-t{threshold}-c{label}-k{max_k}")
        self.own_local, self.local = local is None, local or local_counts
        # a user's miner has no identity, so its results are not reused
        self.keeps = self.shared and local is None
        # highest least count of a chunk, and the most that all chunks together may hold unlisted
        r = self.sizes.agg(F.max(self.least()).alias("most"), F.sum(self.least() - 1).alias("unlisted")).first()
        self.most, self.unlisted = int(r["most"] or 0), int(r["unlisted"] or 0)
        self.recounted: dict[int, DataFrame] = {}

    def _step(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return self.store.read(name) if self.keeps and self.store.complete(name) else self.store.write(make(), name)

    def least(self) -> Column:
        """Of a row with ``n_baskets``: the least support that is frequent in
        its chunk, ceil(threshold * chunk_n / n), exact."""
        dec = "decimal(38,0)"
        share = F.lit(self.threshold).cast(dec) * F.col("n_baskets").cast(dec) + F.lit(max(self.n, 1) - 1)
        return F.call_function("div", share, F.lit(max(self.n, 1)).cast(dec))

    def mine_chunks(self) -> dict[int, DataFrame]:
        """Pass 1: {k: (chunk, item1..itemk, ...)} of every chunk."""
        out: dict[int, DataFrame] = {}
        all_held = self.own_local and self.most <= 1 and not self.b.salted
        occ, k = self._step("rests", self._rests) if all_held else self.b.df.withColumnRenamed(ITEM, "item1"), 1
        while True:
            cand = _grown(occ, k) if all_held else occ if k == 1 else extend_occurrences(occ, k)
            found = self._step(f"mined{k}", lambda: self.local(self, k, cand))
            n = found.count()
            if not n:
                return out
            out[k] = found
            if self._last(k):
                return out
            if all_held:
                occ = cand
            else:
                held = self._held(cand, found, k, n)
                # level 1 is a filter of the transactions; deeper occurrences are kept
                occ = held if k == 1 else self._step(f"occ{k}", lambda: held)
            k += 1

    def _held(self, cand: DataFrame, found: DataFrame, k: int, n: int) -> DataFrame:
        """The occurrences of the itemsets that are found in their chunk."""
        key = found.withColumnRenamed(CHUNK, "_chunk")
        same = [F.col(c) == F.col(f"_{c}") for c in item_cols(k)]
        key = broadcast_if_small(key.select("_chunk", *[F.col(c).alias(f"_{c}") for c in item_cols(k)]), n)
        chunk = self.chunk_fn(F.col(BASKET)).eqNullSafe(F.col("_chunk"))
        return cand.join(key, [chunk, *same], "left_semi").select(*cand.columns)

    def _rests(self) -> DataFrame:
        """(basket, rest: its items in order)."""
        return self.b.df.groupBy(BASKET).agg(F.sort_array(F.collect_list(ITEM)).alias("rest"))

    def _union(self, k: int, found: DataFrame) -> DataFrame:
        """The itemsets of level k that pass 2 counts."""
        if not self.own_local:
            return found.select(*item_cols(k)).distinct()
        sizes = broadcast_if_small(self.sizes.select(F.col(CHUNK).alias("_chunk"), self.least().alias("_least")), self.n_chunks)
        d = found.join(sizes, F.col(CHUNK).eqNullSafe(F.col("_chunk")))
        d = d.groupBy(*item_cols(k)).agg(F.sum(F.col(SUPPORT) - F.col("_least") + 1).alias("_above"))
        return d.where(F.col("_above") + self.unlisted >= self.threshold).select(*item_cols(k))

    def levels(self) -> Iterator[Level]:
        mined = self.mine_chunks()
        self.son_candidates = {k: d.select(*item_cols(k)).distinct() for k, d in mined.items()}
        union = {}
        for k, d in mined.items():
            union[k] = self._step(f"recounted{k}", lambda: self._union(k, d))
            if union[k].isEmpty():  # nor is there any above it
                del union[k]
                break
        self.recounted = union
        if union:
            tree = Tree.build(union, self.store, "union")
            counts = self._step("counts", lambda: count(self.b, tree, max(union)))
        for k in [*sorted(union), max(union, default=0) + 1]:
            if k in union:
                lk = support_filter(tree.by_items(counts, k), self.threshold)
            else:
                if self.max_k is not None and k > self.max_k:
                    return
                lk = self._empty(k)
            lk = self._step(f"L{k}", lambda: lk)
            level = Level(k, lk, lk.count(), None)
            self.history.append(level)
            yield level
            if not level.n:
                return

    def _empty(self, k: int) -> DataFrame:
        item = dict(self.b.df.dtypes)[ITEM]
        cols = [F.lit(None).cast(item).alias(c) for c in item_cols(k)]
        return self.b.spark_empty(cols + [F.lit(0).cast("bigint").alias(SUPPORT)])


def local_counts(miner: TwoPassSON, k: int, cand: DataFrame) -> DataFrame:
    """The itemsets that are frequent in their chunk, with their support there:
    one aggregate a level."""
    per_chunk = count_support(cand.withColumn(CHUNK, miner.chunk_fn(F.col(BASKET))), k, [CHUNK])
    return miner.flag_local(per_chunk).where("_local").select(CHUNK, *item_cols(k), SUPPORT)


def _grown(occ: DataFrame, k: int) -> DataFrame:
    """(basket, item1..itemk, rest: the basket's items behind itemk)."""
    d = occ.select(*[c for c in occ.columns if c != "rest"], "rest", F.posexplode("rest").alias("_at", f"item{k}"))
    rest = F.slice("rest", F.col("_at") + 2, F.greatest(F.size("rest"), F.lit(1)))
    return d.select(BASKET, *item_cols(k), rest.alias("rest"))


def son(baskets: Baskets, threshold: int, chunks: int | ChunkFn = 5, prune: str = "full",
        max_k: int | None = None) -> Iterator[Level]:
    return SONMiner(baskets, threshold, chunks, prune, max_k).levels()
