"""Operator 13: nearest neighbours by a permutation index.

A vector is represented by its nearest pivots, nearest first. Each block of the index posts its
vectors in one inverted file for each pivot, with the pivot's place. A query reads the files of its
own pivots; what it finds there adds up to the footrule distance of the two orders. The first few by
that distance are compared exactly, which bounds the score that the k-th must reach; then all
vectors within a radius of the distance are, so that many equal or nearly equal ones are not cut
off. The radius is learnt: at each angle, it is what few pairs of vectors at that angle exceed.

Inner products become angles by one more component, which brings all vectors to one length.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.llm.common import kept, table

#: Pivots, and how many of them represent a vector.
PIVOTS, PREFIX = 128, 32
#: Rows that the index is learnt from, at most: those of the least hashes.
SAMPLE = 4096
#: The share of pairs at an angle that the radius takes in.
WITHIN = 0.98
#: Cosines that radii are learnt for, and pairs made for each.
COSINES = np.linspace(-1.0, 1.0, 81)
PAIRS = 512
#: Vectors compared exactly before there is a radius, for each neighbour asked for.
FIRST = 3
#: Rows of one block of the index, and queries of one that meets it, at most.
BLOCK_ROWS, BLOCK_QUERIES = 131_072, 16_384
#: Few queries are dealt over so many blocks, if each gets FEW of them.
SPREAD, FEW = 8, 64
#: Rows of a block that are posted together.
POSTED = 8192


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.exists(vector, lambda x: x != 0) & ~bad, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


class Pivots:
    """The pivots, the length all vectors are brought to, and the radius for each cosine."""

    def __init__(self, sample: np.ndarray, longest: float, pivots: int = PIVOTS, prefix: int = PREFIX):
        self.longest = longest
        points = self.lifted(sample)
        self.pivots = self._spread(points, pivots)
        self.prefix = min(prefix, len(self.pivots))
        self.radii = self._radii(points)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """The vectors as unit vectors of one more dimension, which keeps the order of products."""
        # divided first, so that no square leaves the range of numbers
        short = vectors / self.longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", short, short)))
        return np.hstack([short, rest[:, None]])

    def asked(self, vectors: np.ndarray) -> np.ndarray:
        """Queries as unit vectors of that space; their own length does not matter."""
        largest = np.abs(vectors).max(axis=1, keepdims=True)
        scaled = vectors / largest
        unit = scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]
        return np.hstack([unit, np.zeros((len(unit), 1))])

    @staticmethod
    def _spread(points: np.ndarray, pivots: int) -> np.ndarray:
        """Points far from each other: each next one has the greatest distance from those before.

        So many nearly equal vectors give one pivot and not most of them.
        """
        chosen = [0] if len(points) else []
        near = points @ points[0] if len(points) else np.empty(0)
        while len(chosen) < min(pivots, len(points)):
            nxt = int(near.argmin())
            if near[nxt] > 1 - 1e-9:
                break
            chosen.append(nxt)
            near = np.maximum(near, points @ points[nxt])
        return points[chosen]

    def orders(self, points: np.ndarray) -> np.ndarray:
        """The nearest pivots of each unit vector, nearest first, equal ones by number."""
        near = points @ self.pivots.T
        return np.argsort(-near, axis=1, kind="stable")[:, : self.prefix].astype(np.int16)

    def _radii(self, points: np.ndarray) -> np.ndarray:
        """For each of COSINES the footrule distance that holds a share WITHIN of pairs at that angle.

        Pairs are made from two vectors of the sample: the first, and it turned towards the other.
        """
        random = np.random.default_rng(13)
        if len(points) < 2:
            return np.full(len(COSINES), self.prefix * (self.prefix + 1))
        one, other = (points[random.integers(0, len(points), PAIRS)] for _ in range(2))
        away = other - np.einsum("ij,ij->i", one, other)[:, None] * one
        size = np.linalg.norm(away, axis=1, keepdims=True)
        one, away, size = (x[size[:, 0] > 1e-6] for x in (one, away, size))
        if not len(one):
            return np.full(len(COSINES), self.prefix * (self.prefix + 1))
        away = away / size
        radii = []
        for cosine in COSINES:
            turned = cosine * one + math.sqrt(max(0.0, 1 - cosine * cosine)) * away
            far = footrules(self.orders(one), self.orders(turned), len(self.pivots))
            radii.append(np.quantile(far, WITHIN, method="higher"))
        # a greater cosine never has a greater radius
        return np.maximum.accumulate(np.array(radii)[::-1])[::-1].astype(np.int64)

    def radius(self, cosines: np.ndarray) -> np.ndarray:
        """The distance to search in for vectors at these cosines or greater ones."""
        at = np.searchsorted(COSINES, cosines, "right") - 1
        # the last grid point holds exact copies only
        return self.radii[np.clip(at, 0, len(COSINES) - 1)]


def footrules(a: np.ndarray, b: np.ndarray, pivots: int) -> np.ndarray:
    """The footrule distance of rows of orders; a pivot that is in none of the places is one behind them."""
    size = a.shape[1]
    places = np.full((2, len(a), pivots), size, np.int64)
    rows = np.arange(len(a))[:, None]
    places[0][rows, a] = places[1][rows, b] = np.arange(size)[None, :]
    return np.abs(places[0] - places[1]).sum(axis=1)


class Posted:
    """Vectors of a block, posted: for each pivot, who has it among the nearest, and at which place."""

    def __init__(self, orders: np.ndarray, pivots: int):
        rows, prefix = orders.shape
        flat = orders.ravel()
        by = np.argsort(flat, kind="stable")
        self.rows = (by // prefix).astype(np.int64)
        self.places = by % prefix
        self.begins = np.searchsorted(flat[by], np.arange(pivots + 1))
        self.count, self.prefix = rows, prefix

    def distances(self, order: np.ndarray) -> np.ndarray:
        """The footrule distance of one query's order from all vectors of the block.

        Without a common pivot it is prefix * (prefix + 1); each common one takes off twice what
        the later of its two places leaves.
        """
        runs = [slice(self.begins[p], self.begins[p + 1]) for p in order]
        rows = np.concatenate([self.rows[run] for run in runs])
        left = np.concatenate([self.prefix - np.maximum(self.places[run], k) for k, run in enumerate(runs)])
        common = np.bincount(rows, left, minlength=self.count).astype(np.int64)
        return self.prefix * (self.prefix + 1) - 2 * common


def products(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each computed alike, so equal vectors tie."""
    return np.einsum("ij,ij->i", np.broadcast_to(query, rows.shape), rows)


class Nearest:
    """The k best of each query over the blocks seen so far: by score, then by id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, fitted: Pivots, k: int):
        self.ids, self.vectors, self.fitted, self.k = ids, vectors, fitted, k
        self.asked = fitted.orders(fitted.asked(vectors))
        self.norms = np.linalg.norm(vectors, axis=1)
        self.found: list = [(np.empty(0), np.empty(0, np.int64))] * len(ids)

    def add(self, ids: np.ndarray, vectors: np.ndarray, orders: np.ndarray) -> None:
        posted = Posted(orders, len(self.fitted.pivots))
        for q in range(len(self.ids)):
            far = posted.distances(self.asked[q])
            other = ids != self.ids[q]
            score, found = self.found[q]
            if len(score) < self.k:
                first = np.flatnonzero(other)
                few = FIRST * self.k
                if len(first) > few:
                    first = first[np.argpartition(far[first], few)[:few]]
                seen = products(self.vectors[q], vectors[first])
                reach = np.concatenate([score, seen])
                score_k = np.partition(reach, len(reach) - self.k)[len(reach) - self.k] if len(reach) >= self.k else None
            else:
                score_k = score[-1]
            if score_k is not None:
                cosine = score_k / self.norms[q] / self.fitted.longest
                other &= far <= self.fitted.radius(np.array([cosine]))[0]
            near = np.flatnonzero(other)
            exact = products(self.vectors[q], vectors[near])
            if score_k is not None:
                good = exact >= score_k
                near, exact = near[good], exact[good]
            if score_k is not None and len(score) < self.k:
                # those compared first count as well, wherever they lie
                more = np.setdiff1d(first[seen >= score_k], near, assume_unique=True)
                near, exact = np.concatenate([near, more]), np.concatenate([exact, products(self.vectors[q], vectors[more])])
            score, found = np.concatenate([score, exact]), np.concatenate([found, ids[near]])
            order = np.lexsort((found, -score))[: self.k]
            self.found[q] = score[order], found[order]

    def table(self) -> pa.Table:
        sizes = [len(s) for s, _ in self.found]
        scores = np.concatenate([s for s, _ in self.found]) if sizes else np.empty(0)
        ids = np.concatenate([i for _, i in self.found]) if sizes else np.empty(0, np.int64)
        return pa.table(
            {"query_id": pa.array(np.repeat(self.ids, sizes), pa.int64()), "vec_id": pa.array(ids, pa.int64()),
             "score": pa.array(scores, pa.float64())}
        )


class Index:
    """Vectors (`vec_id`, `embedding`) with the orders of their nearest pivots.

    Null ids and vectors that are not `usable` take no part; a row that comes twice is one, while
    different vectors under one id are all there (queries of one id share their ranks). Shorter vectors count as ending in zeros. Other
    columns are not looked at. An empty table gives an empty index. Pivots and radii are learnt from
    at most SAMPLE rows; every row is posted.
    """

    def __init__(self, vectors: DataFrame):
        rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
        rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).distinct()
        # the greatest component taken out, so that no square leaves the range of numbers
        largest = F.array_max(F.transform("v", lambda x: F.abs(x).cast("double")))
        part = F.col("largest")
        square = F.aggregate("v", F.lit(0.0), lambda t, x: t + (x / part) * (x / part))
        rows = rows.withColumn("largest", largest)
        norm = F.col("largest") * F.sqrt(square)
        facts = rows.agg(F.count("*"), F.max(F.size("v")), F.max(norm)).first()
        self.count, self.width, longest = facts[0], facts[1] or 1, facts[2] or 1.0
        self.rows = rows.drop("largest")
        least = self.rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).select("v").toArrow()
        # a little more than the longest, whatever rounding does
        self.fitted = Pivots(matrix(least["v"], self.width), longest * (1 + 1e-12))
        self.posted = kept(self._ordered(self.rows), "permutation-index") if self.count else self._ordered(self.rows)

    def _ordered(self, rows: DataFrame) -> DataFrame:
        fitted, width = self.fitted, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                orders = fitted.orders(fitted.lifted(matrix(batch.column("v"), width)))
                flat = pa.array(orders.ravel(), pa.int16())
                ends = pa.array(np.arange(len(orders) + 1) * orders.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.ListArray.from_arrays(ends, flat)], names=["vec_id", "v", "pivots"]
                )

        schema = T.StructType([*rows.schema.fields, T.StructField("pivots", T.ArrayType(T.ShortType()))])
        return rows.mapInArrow(run, schema)

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """The k nearest (`query_id`, `rank`, `vec_id`, `score`) of the queries (`vec_id`, `v`).

        A row with the query's id is its own and no candidate. Queries and index are cut into
        blocks by hash; each two blocks meet in one task, which gives k rows a query.
        """
        fitted, width = self.fitted, self.width
        asked = queries.count()
        n_q = max(1, math.ceil(asked / BLOCK_QUERIES), min(SPREAD, math.ceil(asked / FEW)))
        n_i = max(1, math.ceil(self.count / BLOCK_ROWS))

        def cut(rows: DataFrame, own: str, n_own: int, other: str, n_other: int):
            block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_own).cast("long")).alias(own)
            copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))).alias(other)
            return rows.select("*", block, copies).groupBy("qb", "ib")

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            best = Nearest(left["vec_id"].to_numpy(), matrix(left["v"], width), fitted, k)
            if left.num_rows:
                for first in range(0, right.num_rows, POSTED):
                    part = right.slice(first, POSTED).combine_chunks()
                    orders = part["pivots"].combine_chunks()
                    if isinstance(orders, pa.ChunkedArray):
                        orders = pa.concat_arrays(orders.chunks)
                    orders = orders.flatten().to_numpy().reshape(part.num_rows, -1)
                    best.add(part["vec_id"].to_numpy(), matrix(part["v"], width), orders)
            return best.table()

        left = cut(queries.select("vec_id", "v"), "qb", n_q, "ib", n_i)
        right = cut(self.posted, "ib", n_i, "qb", n_q)
        hits = left.cogroup(right).applyInArrow(meet, "query_id long, vec_id long, score double")
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = Index(table(spark, sf_dir, "embeddings"))
    return index.search(index.rows.where(F.col("vec_id") % 20 == 0), k=20)
