"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves and each half is quantised by a codebook of
its own; a cell is a pair of centroids.  A query sorts the centroids of each
half by distance and walks the pairs in order of the summed distance with a
heap (multi-sequence traversal) until the cells it passed hold ``budget``
entries; those entries are reranked by the exact inner product.  Nearness is
the inner product, so the distance of halves is the negated inner product,
which adds up over halves like the score itself.

Codebooks are fitted on at most ``SAMPLE`` vectors; every vector is indexed.
The budget is not a constant: for at most ``TUNE`` queries the true neighbours
are found by brute force, and the budget is the one that reaches ``recall``
of them.  So recall is measured on each table that is searched.

Scale: equal vectors are one entry with the smallest ids that any query can
need (k + 1), and equal queries are searched once.  Entries meet queries by
first centroid in blocks of at most ``BLOCK`` by ``BLOCK``, so that neither a
crowded cell nor a popular one grows a task; what stays is a block's k + 1
best of each query.  Codebooks, cell sizes (at most K * K) and the tuning
queries are broadcast; their sizes are parameters.

Cases: vectors that are null, zero, or hold null or non-finite components take
no part, nor do vectors whose length is not the table's most frequent one: no
inner product joins two lengths; rows equal in id and vector count
once; null ids take no part; ties go to the smaller id; with fewer candidates
than k all are returned; an empty table gives an empty one; other columns are
not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import Store

CENTROIDS = 128
SAMPLE = 16_384
TUNE = 128
RECALL = 0.95
BLOCK = 4096
QUERY_EVERY = 20


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Centroids by Lloyd's rounds from k sampled points."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=k)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1) - 2 * (x @ c.T), axis=1)


def traverse(d1: np.ndarray, d2: np.ndarray, sizes: np.ndarray, budget: int) -> list[tuple[int, int]]:
    """Cells in order of summed distance until they hold ``budget`` entries."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    a, b, n = d1[o1].tolist(), d2[o2].tolist(), sizes[np.ix_(o1, o2)].tolist()
    o1, o2 = o1.tolist(), o2.tolist()
    heap, passed = [(a[0] + b[0], 0, 0)], 0
    reached = [0] * len(a)  # pairs taken from each row of the grid
    out = []
    while heap and passed < budget:
        _, i, j = heapq.heappop(heap)
        reached[i] = j + 1
        if n[i][j]:
            passed += n[i][j]
            out.append((o1[i], o2[j]))
        # a pair is due once the pairs above and left of it are taken
        if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
    return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def by_hash(vectors: DataFrame, rows: int, most: int) -> DataFrame:
    """``most`` of the ``rows`` vectors by their hash.  The hash first keeps
    little more than that, so that no task gets many rows to sort."""
    share = min(1.0, 1.2 * most / max(rows, 1) + 1e-4) if rows > most else 1.0
    h = F.pmod(F.xxhash64("v"), F.lit(1 << 30))
    return vectors.where(h < int(share * (1 << 30)) + 1).orderBy(h, "v").limit(most).select("v")


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best finite scores of each row, ties at the end kept."""
    if scores.shape[1] > k:
        floor = np.partition(scores, -k, axis=1)[:, -k][:, None]
        # equal scores may differ in the last bits here; they are kept
        keep = scores >= floor - 1e-9 * np.maximum(1.0, np.abs(floor))
    else:
        keep = np.ones(scores.shape, bool)
    return np.nonzero(keep & np.isfinite(scores))


class MultiIndex:
    """Codebooks, entries and cell sizes of one table of vectors."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
                 centroids: int = CENTROIDS, sample: int = SAMPLE):
        self.spark, self.k = vectors.sparkSession, k
        self.store = Store(self.spark)
        v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
        usual = (v.where(F.size("v") > 0).groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first())
        self.width = usual["n"] if usual else 0
        fits = (F.size("v") == self.width) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        v = v.where("id is not null").where(F.coalesce(fits, F.lit(False)) & F.exists("v", lambda x: x != 0))
        self.rows = self.store.write(v.dropDuplicates(["id", "v"]), "rows")
        # of equal vectors the k + 1 smallest ids are all that a result can name
        rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
        entries = (self.rows.withColumn("r", rank).where(F.col("r") <= k + 1)
                   .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
        entries = self.store.write(entries, "distinct")
        points = by_hash(entries.select("v"), entries.count(), sample).toArrow()
        half = self.width // 2
        self.parts = ((slice(0, half), slice(half, self.width)))
        x = np.concatenate([matrix(c, self.width) for c in points.column("v").chunks]) if points.num_rows else np.zeros((0, 0))
        self.books = [kmeans(x[:, p], max(1, min(centroids, len(x) // 4))) for p in self.parts] if len(x) else []
        self.entries = self.store.write(self._assigned(entries), "entries") if self.books else None
        if self.books:
            cells = self.entries.groupBy("c1", "c2").count().collect()  # at most centroids ** 2 rows
            self.sizes = np.zeros([len(b) for b in self.books], np.int64)
            for r in cells:
                self.sizes[r["c1"], r["c2"]] = r["count"]

    def _assigned(self, entries: DataFrame) -> DataFrame:
        books, parts, width = self.spark.sparkContext.broadcast(self.books), self.parts, self.width

        def run(batches):
            for b in batches:
                x = matrix(b.column(0), width)
                yield pa.RecordBatch.from_arrays([*b.columns, *[
                    pa.array(nearest(x[:, p], c), pa.int32()) for p, c in zip(parts, books.value, strict=True)]],
                    ["v", "ids", "c1", "c2"])

        return entries.mapInArrow(run, "v array<double>, ids array<long>, c1 int, c2 int")

    def tuned(self, queries: DataFrame, recall: float, most: int) -> int:
        """The budget that finds ``recall`` of the true neighbours of at most
        ``most`` of the queries."""
        own = by_hash(queries.select("v"), queries.count(), most).toArrow()
        if not own.num_rows:
            return self.k + 1
        q = np.concatenate([matrix(c, self.width) for c in own.column("v").chunks])
        held, width, k = self.spark.sparkContext.broadcast(q), self.width, self.k

        def run(batches):
            for b in batches:
                s = held.value @ matrix(b.column(0), width).T
                r, c = best(s, k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int32()), pa.array(s[r, c]), b.column(1).take(pa.array(c)),
                                                  b.column(2).take(pa.array(c))], ["q", "s", "c1", "c2"])

        top = Window.partitionBy("q").orderBy(F.desc("s"), "c1", "c2")
        true = (self.entries.select("v", "c1", "c2").mapInArrow(run, "q int, s double, c1 int, c2 int")
                .withColumn("r", F.row_number().over(top)).where(F.col("r") <= k + 1).collect())  # <= most * (k + 1) rows
        need = []
        for i in range(len(q)):
            d = -(self.books[0] @ q[i, self.parts[0]])[:, None] - (self.books[1] @ q[i, self.parts[1]])[None, :]
            for r in (r for r in true if r["q"] == i):
                need.append(int(self.sizes[d < d[r["c1"], r["c2"]]].sum()) + 1)
        return max(int(np.quantile(need, recall)) + 1, self.k + 1)

    def probes(self, queries: DataFrame, budget: int) -> DataFrame:
        """(q, v, c1, cells): the second centroids that a query visits beside
        each first one."""
        state = self.spark.sparkContext.broadcast((self.books, self.sizes))
        parts, width = self.parts, self.width

        def run(batches):
            books, sizes = state.value
            for b in batches:
                x = matrix(b.column(1), width)
                row, c1, cells = [], [], []
                for i in range(len(x)):
                    seen: dict[int, list[int]] = {}
                    for a, c in traverse(-(books[0] @ x[i, parts[0]]), -(books[1] @ x[i, parts[1]]), sizes, budget):
                        seen.setdefault(a, []).append(c)
                    row += [i] * len(seen)
                    c1 += seen
                    cells += seen.values()
                at = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(c1, pa.int32()),
                                                  pa.array(cells, pa.list_(pa.int32()))], ["q", "v", "c1", "cells"])

        # a walk costs time, not bytes: as many tasks as a shuffle has, however small the table
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return queries.select("q", "v").repartition(tasks, "q").mapInArrow(run, "q long, v array<double>, c1 int, cells array<int>")

    def search(self, is_query: Column, recall: float = RECALL, tune: int = TUNE, block: int = BLOCK,
               budget: int | None = None) -> DataFrame:
        """(query_id, rank, vec_id, score) of the rows that ``is_query`` (over
        the column id) picks, against all other rows."""
        if not self.books:
            return self.spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        asked = self.rows.where(is_query)
        queries = self.store.write(asked.select("v").distinct().withColumn("q", F.monotonically_increasing_id()), "queries")
        budget = budget if budget is not None else self.tuned(queries, recall, tune)
        n = dict(self.entries.groupBy("c1").count().collect())  # at most ``centroids`` rows
        probes = self.store.write(self.probes(queries, budget), "probes")
        m = dict(probes.groupBy("c1").count().collect())
        blocks = lambda sizes: F.element_at(F.create_map(*[
            F.lit(x) for c, s in sorted(sizes.items()) for x in (c, -(-s // block))]), F.col("c1"))
        nothing = F.lit(None)
        e = self.entries.where(F.col("c1").isin(list(m))) if m else self.entries
        e = e.select("c1", F.pmod(F.xxhash64("v"), blocks(n)).alias("eb"), F.explode(F.sequence(
            F.lit(0), (blocks(m) - 1).cast("long"))).alias("qb"), F.lit(0).alias("kind"), nothing.cast("long").alias("q"),
            "v", "ids", "c2", nothing.cast("array<int>").alias("cells"))
        p = probes.select("c1", F.explode(F.sequence(F.lit(0), (blocks(n) - 1).cast("long"))).alias("eb"),
                          F.pmod(F.xxhash64("q"), blocks(m)).alias("qb"), F.lit(1).alias("kind"), "q", "v",
                          nothing.cast("array<long>").alias("ids"), nothing.cast("int").alias("c2"), "cells")
        found = (e.unionByName(p).groupBy("c1", "eb", "qb")
                 .applyInArrow(_ranked(self.width, self.k + 1, max(len(b) for b in self.books)),
                               "q long, score double, ids array<long>"))
        # ids of equal vectors: each query's k + 1 best
        found = found.select("q", "score", F.explode("ids").alias("id"))
        top = Window.partitionBy("q").orderBy(F.desc("score"), "id")
        found = found.withColumn("r", F.row_number().over(top)).where(F.col("r") <= self.k + 1)
        lists = found.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("r", "id", "score"))).alias("found"))
        lists = lists.join(queries, "q").select("v", "found")
        others = F.filter("found", lambda x: x["id"] != F.col("id"))
        return (asked.join(lists, "v").select("id", F.slice(others, 1, self.k).alias("found"))
                .select(F.col("id").alias("query_id"), F.posexplode("found").alias("p", "x"))
                .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"),
                        F.col("x.score").alias("score")))


def _ranked(width: int, k: int, centroids: int):
    def run(table: pa.Table) -> pa.Table:
        schema = pa.schema([("q", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])
        kind = table.column("kind").to_numpy()
        e, p = table.take(np.flatnonzero(kind == 0)), table.take(np.flatnonzero(kind == 1))
        if not e.num_rows or not p.num_rows:
            return schema.empty_table()
        e, p = e.combine_chunks(), p.combine_chunks()
        flat = lambda t, c: t.column(c).combine_chunks()
        x, y = matrix(flat(e, "v"), width), matrix(flat(p, "v"), width)
        cells = flat(p, "cells")
        visited = np.zeros((p.num_rows, centroids), bool)
        n = np.diff(cells.offsets.to_numpy())
        visited[np.repeat(np.arange(p.num_rows), n), cells.flatten().to_numpy()] = True
        rows, cols = [], []
        for at in range(0, len(y), 512):
            s = y[at:at + 512] @ x.T
            s[~visited[at:at + 512][:, flat(e, "c2").to_numpy()]] = -np.inf
            r, c = best(s, k)
            rows.append(r + at)
            cols.append(c)
        r, c = np.concatenate(rows), np.concatenate(cols)
        # the score itself does not depend on the place in a matrix product
        score = (y[r] * x[c]).sum(axis=1)
        return pa.table([flat(p, "q").take(pa.array(r)), pa.array(score), flat(e, "ids").take(pa.array(c))], schema=schema)

    return run


def neighbours(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
               every: int = QUERY_EVERY, **options) -> DataFrame:
    """The k nearest others of every row whose id is divisible by ``every``."""
    return MultiIndex(vectors, id_col, vec_col, k).search(F.col("id") % every == 0, **options)
