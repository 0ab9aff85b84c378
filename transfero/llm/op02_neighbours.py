"""Approximate nearest neighbours by learned partitions.

A neighbour graph of a bounded sample is split into equal parts by recursive spectral bisection. A small
network learns the part of a vector (its targets are the parts of its graph neighbours). It puts every
row into its most probable part and routes a query to the parts it finds most probable, as many as reach
``RECALL`` on neighbours held out from the sample; rows of those parts are reranked by exact inner
products in double precision.

Parts of one subtree of the bisection form a bin, ``BINS`` at most: a task searches the parts of a bin that
a query is routed to and keeps its best ``k`` of them all, so that what is shuffled does not grow with the
number of parts. A bin's rows are split into blocks of about ``ROWS`` by a hash of the id, its queries
likewise, so that a frequent vector or a large part is many groups of bounded size; only per-part counts
(at most 256) come to the driver.

Defined results: null ids, and vectors that are null, empty, zero, of another length than most, or hold
null or non-finite components take no part; an id that occurs several times counts once, with its best
score; ties go to the smaller id; fewer than ``k`` candidates are all returned (a query goes on to
further parts until enough rows are seen); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_sample, map_arrow, store, table

SAMPLE, NEAR, HIDDEN = 8192, 12, 128
ROWS, QUERIES, PER_PART = 16_000, 4_000, 800
RECALL, BINS = 0.95, 16


def valid(embedding: Column) -> Column:
    inf = F.lit(float("inf"))
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return F.coalesce((F.size(embedding) > 0) & fine & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length as a two-dimensional double array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    near = np.empty((len(x), k), np.int64)
    for lo in range(0, len(x), 512):
        s = x[lo:lo + 512] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        near[lo:lo + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return near


def bisect(near: np.ndarray, depth: int) -> np.ndarray:
    """Parts of equal size (2 ** depth of them): halves at the median of the graph's second eigenvector."""
    part = np.zeros(len(near), np.int64)
    src, dst = np.repeat(np.arange(len(near)), near.shape[1]), near.ravel()
    a, b = np.concatenate([src, dst]), np.concatenate([dst, src])
    rng = np.random.default_rng(5)
    for level in range(depth):
        inside = part[a] == part[b]
        u, v = a[inside], b[inside]
        degree = np.maximum(np.bincount(u, minlength=len(near)), 1)
        size = np.bincount(part, minlength=1 << level)
        x = rng.standard_normal(len(near))
        for _ in range(60):
            mean = np.bincount(part, x * degree, 1 << level) / np.bincount(part, degree, 1 << level)
            x = x - mean[part]
            x = 0.5 * x + 0.5 * np.bincount(u, x[v], len(near)) / degree
            norm = np.sqrt(np.bincount(part, x * x, 1 << level) / size)
            x = x / np.maximum(norm, 1e-12)[part]
        order = np.lexsort((x, part))
        rank = np.empty(len(near), np.int64)
        rank[order] = np.arange(len(near))
        first = np.cumsum(size) - size
        part = 2 * part + (rank - first[part] >= (size // 2)[part])
    return part


class Router:
    """One hidden layer; trained by Adam on the parts of each sample row's graph neighbours."""

    def __init__(self, x: np.ndarray, near: np.ndarray, part: np.ndarray, parts: int, epochs: int = 25):
        rng = np.random.default_rng(3)
        target = np.full((len(x), parts), 0.0)
        np.add.at(target, (np.arange(len(x)), part), 2.0)
        for j in range(near.shape[1]):
            np.add.at(target, (np.arange(len(x)), part[near[:, j]]), 1.0)
        target /= target.sum(1, keepdims=True)
        self.scale = 1 / max(1e-12, float(np.sqrt((x ** 2).mean())))
        x = x * self.scale
        w = [rng.standard_normal((x.shape[1], HIDDEN)) * np.sqrt(2 / x.shape[1]), np.zeros(HIDDEN),
             rng.standard_normal((HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts)]
        m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), 128):
                i = order[lo:lo + 128]
                h = np.maximum(x[i] @ w[0] + w[1], 0)
                z = h @ w[2] + w[3]
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                d = (p - target[i]) / len(i)
                dh = (d @ w[2].T) * (h > 0)
                step += 1
                for k, g in enumerate((x[i].T @ dh, dh.sum(0), h.T @ d, d.sum(0))):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    w[k] -= 2e-3 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        self.w = w

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x * self.scale) @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]


def learn(vectors: DataFrame, rows: int, k: int, sample: int = SAMPLE, recall: float = RECALL) -> tuple[Router | None, int, int]:
    """(router, parts, probes); None and one part for tables too small to split."""
    depth = min(8, max(0, int(np.ceil(np.log2(max(1, rows / PER_PART))))))
    if depth == 0:
        return None, 1, 1
    got = sorted((r["vec_id"], r["embedding"]) for r in bounded_sample(vectors, sample, "vec_id").collect())
    x = np.array([g[1] for g in got], np.float64)
    parts = 1 << depth
    if len(x) < 4 * parts:
        return None, 1, 1
    # a tenth of the sample stays out of the graph to measure how many parts a query needs
    test = np.arange(len(x)) % 10 == 0
    fit = x[~test]
    near = neighbour_graph(fit, min(NEAR, len(fit) - 1))
    router = Router(fit, near, bisect(near, depth), parts)
    home = router.scores(x).argmax(1)
    s = x[test] @ x.T
    s[np.arange(len(s)), np.flatnonzero(test)] = -np.inf
    true = np.argpartition(-s, min(k, len(x) - 1) - 1, axis=1)[:, :k]
    order = np.argsort(-router.scores(x[test]), axis=1)
    place = np.argsort(order, axis=1)
    at = np.take_along_axis(place, home[true], axis=1)
    probes = next((t for t in range(1, parts + 1) if (at < t).mean() >= recall), parts)
    return router, parts, probes


def best(queries: pa.Table, members: pa.Table, k: int) -> pa.Table:
    """Top ``k`` members of each query: one matrix product per block, then exact sums for what may qualify."""
    ids, x = np.asarray(members.column("vec_id")), matrix(members.column("embedding"))
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    most = k * int(np.unique(ids, return_counts=True)[1].max(initial=1))  # rows that hold k different ids, even if ids repeat
    q_ids, q = np.asarray(queries.column("query_id")), matrix(queries.column("embedding"))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for lo in range(0, len(q), 256):
        rough = q[lo:lo + 256] @ x.T
        for row, query in zip(rough, range(lo, lo + len(rough))):
            row[ids == q_ids[query]] = -np.inf
            kth = np.partition(row, -most)[-most] if len(row) > most else -np.inf
            near = np.flatnonzero((row >= kth - 1e-9 * (1 + abs(kth))) & (row > -np.inf)) if np.isfinite(kth) else np.flatnonzero(row > -np.inf)
            exact = (x[near] * q[query]).sum(1)
            ranked = np.lexsort((ids[near], -exact))
            seen, keep = set(), []
            for r in ranked.tolist():
                if ids[near[r]] not in seen:
                    seen.add(ids[near[r]])
                    keep.append(r)
                    if len(keep) == k:
                        break
            out.append((np.full(len(keep), q_ids[query]), ids[near[keep]], exact[keep]))
    cols = [np.concatenate([o[i] for o in out]) if out else [] for i in range(3)]
    return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})


def best_of_parts(queries: pa.Table, members: pa.Table, k: int) -> pa.Table:
    """Top ``k`` over the members' parts that each query lists, one part after the other."""
    found = [pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})]
    if queries.num_rows and members.num_rows:
        part = members.column("part").to_numpy()
        lists = queries.column("parts").combine_chunks()
        asked = np.asarray(lists.flatten())
        row = np.repeat(np.arange(len(lists)), np.asarray(pc.list_value_length(lists)))
        for p in np.unique(part).tolist():
            asking = row[asked == p]
            if len(asking):
                found.append(best(queries.take(pa.array(asking)), members.take(pa.array(np.flatnonzero(part == p))), k))
    t = pa.concat_tables(found)
    q, v, s = (t.column(c).to_numpy() for c in ("query_id", "vec_id", "score"))
    order = np.lexsort((-s, v, q))  # an id that comes in several parts counts once, with its best score
    order = order[np.append(True, (q[order][1:] != q[order][:-1]) | (v[order][1:] != v[order][:-1]))[:len(order)]]
    order = order[np.lexsort((v[order], -s[order], q[order]))]
    rank = np.arange(len(order)) - np.searchsorted(q[order], q[order])
    return t.take(pa.array(order[rank < k]))


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for every row of ``vectors`` (vec_id, embedding) chosen by ``is_query``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("q")).filter(F.col("vec_id").isNotNull() & valid(F.col("embedding")))
    widths = rows.groupBy(F.size("embedding").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    width, n = (widths[0]["w"], widths[0]["count"]) if widths else (0, 0)
    rows = rows.filter(F.size("embedding") == width)
    router, parts, probes = learn(rows.select("vec_id", "embedding"), n, k)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home = router.scores(matrix(b.column(1))).argmax(1) if router and b.num_rows else np.zeros(b.num_rows, int)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(home, pa.int32())], names=["vec_id", "embedding", "q", "part"])

    kind = dict(rows.dtypes)["embedding"]
    placed = store(spark, map_arrow(rows, place, f"vec_id long, embedding {kind}, q boolean, part int"), "ann-rows")
    counts = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    size = np.array([counts.get(p, 0) for p in range(parts)])
    bins = min(BINS, parts)
    bin_of = np.arange(parts) * bins // parts

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            s = router.scores(matrix(b.column(1))) if router else np.zeros((b.num_rows, 1))
            order = np.argsort(-s, axis=1, kind="stable")
            enough = (np.cumsum(size[order], axis=1) >= 4 * k).argmax(1) + 1
            enough = np.where(size.sum() >= 4 * k, enough, parts)
            take = np.maximum(probes, enough)
            chosen = np.zeros((b.num_rows, parts), bool)
            for i, t in enumerate(take.tolist()):
                chosen[i, order[i, :t]] = True
            row, where = np.nonzero(np.stack([chosen[:, bin_of == g].any(1) for g in range(bins)], 1))
            listed = [np.flatnonzero(chosen[i] & (bin_of == g)).tolist() for i, g in zip(row.tolist(), where.tolist())]
            some = b.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(where, pa.int32()), pa.array(listed, pa.list_(pa.int32()))],
                                             names=["query_id", "embedding", "bin", "parts"])

    asked = placed.filter("q").select("vec_id", "embedding").dropDuplicates(["vec_id"])
    routed = store(spark, map_arrow(asked, route, f"query_id long, embedding {kind}, bin int, parts array<int>"), "ann-queries")
    q_counts = {r["bin"]: r["count"] for r in routed.groupBy("bin").count().collect()}
    m_counts = {g: int(size[bin_of == g].sum()) for g in range(bins)}
    blocks = lambda of, each: F.element_at(F.array(*[F.lit(max(1, -(-of.get(g, 0) // each))) for g in range(bins)]), F.col("bin") + 1)
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    own = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    m_blocks, q_blocks = blocks(m_counts, ROWS), blocks(q_counts, QUERIES)
    members = placed.withColumn("bin", F.expr(f"cast(part * {bins} div {parts} as int)")).select("bin", own("vec_id", m_blocks).alias("mb"), spread(q_blocks).alias("qb"), "vec_id", "embedding", "part")
    queries = routed.select("bin", spread(m_blocks).alias("mb"), own("query_id", q_blocks).alias("qb"), "query_id", "embedding", "parts")
    keys = ["bin", "mb", "qb"]

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        return best_of_parts(left, right, k)

    found = queries.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInArrow(rerank, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
