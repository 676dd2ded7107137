"""Multihash PCY (M3).

After level k is counted, its occurrences are extended to (k+1)-sets, once:
the extensions are written, and the next level's candidates are read from
them.  They are hashed into ``buckets`` buckets by each hash function and
the buckets are counted (A4: at most #hashes * buckets groups, combined
map-side).  A bucket is frequent when its count reaches the threshold.
Level k+1 then keeps a candidate only if all its k-subsets are frequent
(P9, as in the basket scan) and its bucket is frequent under every hash
(P10).  No frequent itemset is lost: its occurrences are all among the
hashed extensions (each extends an occurrence of a frequent k-set), so its
bucket count is at least its support.

Parameters are explicit (``buckets``, ``hash_functions``); the bitmaps are
packed, an eighth of a byte a bucket and hash, a fixed broadcast bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.hashing import DEFAULT_HASHES, HashFn
from basketry.operators.aggregates import bucket_counts
from basketry.operators.candidates import packed_bitmaps, packed_filter
from basketry.functions.columns import item_cols
from basketry.operators.joins import extend_occurrences, semi_join
from basketry.plans.levels import CandidateFilter, Level
from basketry.plans.scan import ScanMiner
from basketry.plans.transactions import Baskets


class PCYMiner(ScanMiner):
    name = "pcy"

    def __init__(self, baskets: Baskets, threshold: int, buckets: int | None = 10007,
                 hash_functions: Sequence[HashFn] = DEFAULT_HASHES, max_k: int | None = None,
                 tag: str | None = None, candidate_filter: CandidateFilter | None = None):
        if buckets is not None and int(buckets) < 0:
            raise ValueError("buckets must be >= 0")
        # a hash function is known by the expression it builds, not by its name
        n = int(buckets or 1)
        names = "-".join(str(h([F.col("a"), F.col("b"), F.col("c")], n)) for h in hash_functions)
        super().__init__(baskets, threshold, max_k,
                         tag or f"pcy-t{threshold}-b{buckets}-{hashlib.sha1(names.encode()).hexdigest()[:8]}",
                         candidate_filter)
        # 0 or None buckets: no bitmap at all, i.e. the basket-scan strategy
        self.buckets = int(buckets or 0)
        self.hash_functions = tuple(hash_functions) if self.buckets else ()
        self.bucket_tables: dict[int, DataFrame] = {}   # k -> (hash_id, bucket, n) of (k)-sets
        self.bitmaps: dict[int, DataFrame] = {}          # k -> frequent (hash_id, bucket)
        self.packed: dict[int, DataFrame] = {}           # the same as packed bitmaps
        self.extensions: dict[int, DataFrame] = {}       # k -> occurrences of k-sets, unpruned

    def after_level(self, level: Level, cand: DataFrame) -> None:
        if not self.hash_functions:
            return
        k = level.k
        ext = self.store.write(extend_occurrences(level.occ, k + 1), f"ext{k + 1}")
        self.extensions[k + 1] = ext
        counts = self.store.write(bucket_counts(ext, k + 1, self.hash_functions, self.buckets),
                                  f"buckets{k + 1}")
        self._keep_buckets(k + 1, counts)

    def after_reuse(self, level: Level) -> bool:
        if not self.hash_functions or not level.n or self._last(level.k):
            return True
        name, ext = f"buckets{level.k + 1}", f"ext{level.k + 1}"
        if not self.store.complete(name) or not self.store.complete(ext):
            return False
        self.extensions[level.k + 1] = self.store.read(ext)
        counts = self.store.read(name)
        self._keep_buckets(level.k + 1, counts)
        return True

    def _keep_buckets(self, k: int, counts: DataFrame) -> None:
        self.bucket_tables[k] = counts
        self.bitmaps[k] = counts.where(F.col("n") >= self.threshold).select("hash_id", "bucket")
        self.packed[k] = packed_bitmaps(counts, self.threshold)

    def candidates(self, k: int, prev: Level) -> DataFrame:
        """P9 (via the basket-scan candidate table) then P10 on the
        occurrence rows: the bitmap join is a broadcast of a bounded table,
        so it adds no shuffle."""
        if not self.hash_functions:
            return super().candidates(k, prev)
        cand = self.extensions[k]
        if k > 2:
            ck, n = self.candidate_table(k, prev)
            cand = semi_join(cand, ck, item_cols(k), n)
        return packed_filter(cand, k, self.packed[k], self.hash_functions, self.buckets)


def pcy(baskets: Baskets, threshold: int, buckets: int = 10007,
        hash_functions: Sequence[HashFn] = DEFAULT_HASHES, max_k: int | None = None) -> Iterator[Level]:
    return PCYMiner(baskets, threshold, buckets, hash_functions, max_k).levels()
