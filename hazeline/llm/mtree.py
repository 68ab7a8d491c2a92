"""Exact top-k inner product search with M-trees.

Vectors become integers, floor(scale * x). With M the largest norm, the map
x -> (x, sqrt(M^2 - |x|^2)), q -> (q, 0) turns the order of inner products into the
order of Euclidean distances, which a metric tree can search. Candidates are split
into blocks of bounded size; each block becomes a paged M-tree whose nodes hold a
routing object, a covering radius and the distance to their parent. A query walks
the pages best first and skips every page and every object that the stored distances
already rule out by the triangle inequality; scores are exact integers. Many queries walk
a tree together: a page is skipped for those that its distances rule out and scored for
the others by one matrix product, in single precision with its error bound, so that only
what may be among the best is scored again in integers. Blocks of queries meet blocks of
candidates, and the best of each block are merged.

Vectors that are null, or hold null or non-finite components, take no part; only
vectors of one length are compared. Equal rows are one object with a multiplicity, so
any number of repetitions fits a block; a repeated query returns its list as often as
it occurs, its other copies being candidates. Candidates without vec_id rank last
among ties. Extra columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

PAGE, FANOUT = 64, 16
CANDIDATES, QUERIES = 65_536, 65_536  #: rows of a block
TOGETHER = 2_048  #: queries that walk a tree at once


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id, v (array of long) and n, how many rows are so."""
    x = F.col("embedding")
    good = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    ints = vectors.where(F.coalesce(good, F.lit(False))).select("vec_id", F.transform(x, lambda c: F.floor(scale * c.cast("double")).cast("long")).alias("v"))
    return ints.groupBy("vec_id", "v").agg(F.count("*").alias("n"))


def scores_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where all sums stay below 2^53, else in integers."""
    big = (float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))) * a.shape[-1]
    if big < 2**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b if big < 2**62 else (a.astype(object) @ b.astype(object))


class MTree:
    """A bulk-loaded M-tree over rows of ``x``; ``height`` is the added coordinate."""

    def __init__(self, x: np.ndarray, top: float):
        self.x, self.top = x, top
        self.f = x.astype(np.float64)
        self.sq = np.einsum("ij,ij->i", self.f, self.f)
        self.height = np.sqrt(np.maximum(0.0, top**2 - self.sq))
        #: page -> (is leaf, members or child pages, routing rows, distances to this page's routing object, radii)
        self.pages: list[tuple] = []
        self.root_object = 0
        self.root = self._load(np.arange(len(x)), 0)

    def _between(self, i: int, rows: np.ndarray) -> np.ndarray:
        d = self.sq[i] + self.sq[rows] - 2 * (self.f[rows] @ self.f[i]) + (self.height[i] - self.height[rows]) ** 2
        return np.sqrt(np.maximum(0.0, d))

    def _load(self, rows: np.ndarray, route: int) -> int:
        if len(rows) <= PAGE:
            self.pages.append((True, rows, rows, self._between(route, rows), None))
            return len(self.pages) - 1
        # farthest-first routing objects; each row goes to the nearest
        f, sq, height = self.f[rows], self.sq[rows], self.height[rows]
        between = lambda i: np.sqrt(np.maximum(0.0, self.sq[i] + sq - 2 * (f @ self.f[i]) + (self.height[i] - height) ** 2))
        pivots, nearest = [int(rows[0])], between(int(rows[0]))
        owner = np.zeros(len(rows), dtype=np.int64)
        while len(pivots) < FANOUT and nearest.max() > 0:
            p = int(rows[int(nearest.argmax())])
            d = between(p)
            closer = d < nearest
            owner[closer], nearest = len(pivots), np.minimum(nearest, d)
            pivots.append(p)
        if len(pivots) == 1:  # all rows alike: pages of equal objects
            owner, pivots = np.arange(len(rows)) // max(PAGE, -(-len(rows) // FANOUT)), None
            pivots = [int(rows[np.flatnonzero(owner == k)[0]]) for k in range(int(owner.max()) + 1)]
        children, routes, radii = [], [], []
        for k, p in enumerate(pivots):
            own = rows[owner == k]
            if len(own):
                children.append(self._load(own, p))
                routes.append(p)
                radii.append(float(self._between(p, own).max()))
        routes = np.array(routes)
        self.pages.append((False, children, routes, self._between(route, routes), np.array(radii)))
        return len(self.pages) - 1

    def search(self, q: np.ndarray, k: int, own: int, ids: np.ndarray, copies: np.ndarray) -> tuple[list[tuple[int, int]], int]:
        """The best (score, row) of ``k`` objects but one copy of row ``own``; and how many scores were computed."""
        sq = float(q.astype(np.float64) @ q.astype(np.float64))
        slack = 1e-7 * (1 + self.top + sq**0.5)

        def apart(score: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(0.0, self.top**2 + sq - 2 * score.astype(np.float64)))

        best_s, best_i = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        limit, computed = np.inf, 1
        at = float(apart(scores_of(self.x[self.root_object : 1], q))[0])
        heap = [(0.0, self.root, at)]
        while heap:
            bound, page, d_route = heapq.heappop(heap)
            if bound > limit + slack:
                break
            leaf, children, routes, to_route, radii = self.pages[page]
            can = np.abs(d_route - to_route) - (0 if leaf else radii) <= limit + slack
            rows = routes[can]
            if not len(rows):
                continue
            computed += len(rows)
            scores = scores_of(self.x[rows], q)
            if leaf:
                mask = (rows != own) | (copies[rows] > 1)
                best_s, best_i = np.concatenate((best_s, scores[mask])), np.concatenate((best_i, rows[mask]))
                keep = np.lexsort((ids[best_i], -best_s))[:k]
                best_s, best_i = best_s[keep], best_i[keep]
                if len(best_s) == k:
                    limit = float(apart(best_s[-1:])[0])
            else:
                d = apart(scores)
                low = np.maximum(0.0, d - radii[can])
                for i in np.flatnonzero(low <= limit + slack).tolist():
                    heapq.heappush(heap, (float(low[i]), children[int(np.flatnonzero(can)[i])], float(d[i])))
        return list(zip(best_s.tolist(), best_i.tolist())), computed


    def search_all(self, q: np.ndarray, k: int, own: np.ndarray, ids: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """As ``search`` for every row of ``q``: number of the query, score and row of the best; and how many scores were computed."""
        big = float(np.abs(q).max(initial=0)) * float(np.abs(self.x).max(initial=0)) * max(1, q.shape[1])
        if big >= 2**53:
            each = [self.search(v, k, int(own[i]), ids, copies) for i, v in enumerate(q)]
            found = [(i, score, row) for i, (best, _) in enumerate(each) for score, row in best]
            n, score, row = zip(*found) if found else ((), (), ())
            return np.array(n, dtype=np.int64), np.array(score, dtype=object), np.array(row, dtype=np.int64), sum(c for _, c in each)
        f, f32, q32 = q.astype(np.float64), self.f.astype(np.float32), q.astype(np.float32)
        sq = np.einsum("ij,ij->i", f, f)
        slack = 1e-7 * (1 + self.top + np.sqrt(sq))
        wrong = (q.shape[1] + 4) * 2.0**-23 * np.sqrt(sq) * self.top + 1e-3  # of a product in single precision, at most
        least = np.full(len(q), -np.inf)  # score of the k-th best so far
        best = [np.empty(0, dtype=np.int64)] * 3
        fresh: list[list[np.ndarray]] = []
        held = computed = 0

        def merge() -> None:
            nonlocal best, fresh, held
            n, score, row = (np.concatenate([b, *(x[i] for x in fresh)]) for i, b in enumerate(best))
            order = np.lexsort((ids[row], -score, n))
            n, score, row = n[order], score[order], row[order]
            nth = np.arange(len(n)) - np.searchsorted(n, n)
            least[n[nth == k - 1]] = score[nth == k - 1]
            best, fresh, held = [x[nth < k] for x in (n, score, row)], [], 0

        def far(who: np.ndarray) -> np.ndarray:
            with np.errstate(invalid="ignore"):
                return np.where(np.isinf(least[who]), np.inf, np.sqrt(np.maximum(0.0, self.top**2 + sq[who] - 2 * least[who])) + slack[who])

        todo = [(self.root, np.arange(len(q)), np.zeros(len(q)))]
        while todo:
            page, who, bound = todo.pop()
            leaf, children, routes, _, radii = self.pages[page]
            who = who[bound <= far(who)]
            if not len(who):
                continue
            computed += len(who) * len(routes)
            if leaf:
                hit, at = np.nonzero(q32[who] @ f32[routes].T >= (least[who] - wrong[who])[:, None])
                n, row = who[hit], routes[at]
                use = (row != own[n]) | (copies[row] > 1)
                n, row = n[use], row[use]
                score = np.rint(np.einsum("ij,ij->i", f[n], self.f[row])).astype(np.int64)
                use = score >= least[n]
                fresh.append([n[use], score[use], row[use]])
                held += int(use.sum())
                if held >= k * len(q):
                    merge()
            else:
                d = np.sqrt(np.maximum(0.0, self.top**2 + sq[who][:, None] - 2 * (f[who] @ self.f[routes].T)))
                low = np.maximum(0.0, d - radii)
                for i in np.argsort(-low.mean(axis=0), kind="stable").tolist():  # the nearest last, to be next
                    todo.append((children[i], who, low[:, i]))
        merge()
        return *best, computed


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best for each row whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = written(quantised(vectors, scale).withColumn("dims", F.size("v")), "vectors")
    facts = rows.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0), F.max(F.aggregate(F.transform("v", lambda c: c.cast("double") * c), F.lit(0.0), lambda a, b: a + b))).first()
    cores = spark.sparkContext.defaultParallelism
    blocks = max(-(-facts[0] // CANDIDATES), min(3 * cores, -(-facts[0] // 1024)), 1)
    q_blocks = max(-(-facts[1] // QUERIES), 1)
    top = float(facts[2] or 0.0) ** 0.5 * (1 + 1e-12)
    mark = F.xxhash64("vec_id", "v")
    cands = rows.select(F.lit(False).alias("is_query"), "vec_id", "v", "n", "dims", mark.alias("mark"), F.pmod(mark, F.lit(blocks)).cast("int").alias("blk"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q_blk"))
    wanted = rows.where(F.col("vec_id") % every == 0)
    queries = wanted.select(F.lit(True).alias("is_query"), "vec_id", "v", "n", "dims", mark.alias("mark"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("blk"), F.pmod(mark, F.lit(q_blocks)).cast("int").alias("q_blk"))
    last = np.iinfo(np.int64).max

    def run(group: pa.Table) -> pa.Table:
        is_query = group.column("is_query").to_numpy()
        asks, own = group.filter(pa.array(is_query)), group.filter(pa.array(~is_query))
        out: list[list[pa.Array]] = []
        if asks.num_rows and own.num_rows:
            x, q = (t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1) for t in (own, asks))
            tree = MTree(x, top)
            ids, copies, marks = own.column("vec_id").fill_null(last).to_numpy(), own.column("n").to_numpy(), own.column("mark").to_numpy()
            order = np.argsort(marks)
            at = order[np.minimum(np.searchsorted(marks, asks.column("mark").to_numpy(), sorter=order), len(marks) - 1)]
            me = np.where(marks[at] == asks.column("mark").to_numpy(), at, -1)
            for i in range(0, len(q), TOGETHER):
                n, score, row, _ = tree.search_all(q[i : i + TOGETHER], k, me[i : i + TOGETHER], ids, copies)
                asked = asks.select(["vec_id", "mark", "n"]).take(pa.array(n + i))
                many = np.minimum(k, copies[row] - (me[n + i] == row)).astype(np.int32)
                out.append([*asked.columns, own.column("vec_id").take(pa.array(row)), pa.array(score.tolist() if score.dtype == object else score, pa.int64()), pa.array(many, pa.int32())])
        return pa.concat_tables([pa.table(c, schema=schema) for c in out]) if out else schema.empty_table()

    schema = pa.schema([("query_id", pa.int64()), ("mark", pa.int64()), ("times", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("many", pa.int32())])
    found = cands.unionByName(queries).groupBy("dims", "blk", "q_blk").applyInArrow(run, "query_id long, mark long, times long, vec_id long, score long, many int")
    each = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("many"))))
    order = Window.partitionBy("query_id", "mark").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    best = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("query_id", "rank", "vec_id", "score")


def op5_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""
