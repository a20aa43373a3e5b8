"""Approximate nearest neighbours by inner product with an inverted multi-index.

The two halves of a vector are quantised separately, with codebooks of `WORDS` centroids each, fitted on a bounded
sample (`SAMPLE` vectors with the smallest hash of the id). Every vector is entered in the cell of its pair of centroids.
A query walks the pairs in the order of the summed inner products of its halves with the centroids, with a
heap over the two sorted lists, until the cells it has visited hold `PROBE` of the distinct vectors; the entries of
those cells are reranked by their exact inner product in double precision.

Cells are cut into blocks of about `BLOCK` entries and the queries of a cell into blocks of as many, by a hash of the
id, so a hot cell is many tasks' work; each block pair hands on at most `k` candidates per query. Equal vectors are
entered together, with their `k + 1` smallest ids: no more of them can be among the k nearest of any query.

Defined cases: vectors that are null, zero, hold null or non-finite components, or have another length than
most of the sample take no part, neither as query nor as candidate; ties go to the smaller id; an id that
is repeated is one candidate for each of its vectors, and not for a query of the same id; null ids take no
part; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import lean, small, stored

WORDS, SAMPLE, ROUNDS = 16, 20_000, 12
PROBE = 0.7
BLOCK = 4096


def usable(embedding: Column) -> Column:
    """Vectors that take part, whatever their length."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(embedding, lambda x: x != 0), F.lit(False))


def lloyd(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of a small sample; the same for the same sample."""
    distinct = np.unique(points, axis=0)
    k = min(k, len(distinct))
    centroids = distinct[np.random.default_rng(7).choice(len(distinct), k, replace=False)].copy()
    for _ in range(rounds):
        nearest = assign(points, centroids)
        for c in range(k):
            own = points[nearest == c]
            if len(own):
                centroids[c] = own.mean(axis=0)
    return centroids


def assign(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmax(points @ centroids.T - 0.5 * (centroids**2).sum(axis=1), axis=1)


class Index:
    """Codebooks of both halves, and how many distinct vectors each cell holds."""

    def __init__(self, sample: np.ndarray, words: int = WORDS):
        self.dim = sample.shape[1]
        self.half = max(1, self.dim // 2)
        self.books = [lloyd(part, words) if part.shape[1] else np.zeros((1, 0)) for part in self.halves(sample)]
        self.sizes: dict[int, int] = {}

    def halves(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [vectors[:, : self.half], vectors[:, self.half :]]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        a, b = (assign(part, book) for part, book in zip(self.halves(vectors), self.books, strict=True))
        return a * len(self.books[1]) + b

    def walk(self, query: np.ndarray, wanted: float) -> list[int]:
        """Cells by falling summed inner product, until they hold `wanted` vectors."""
        ranked = []
        for part, book in zip(self.halves(query[None, :]), self.books, strict=True):
            products = (book @ part[0]) if book.shape[1] else np.zeros(len(book))
            order = np.argsort(-products, kind="stable")
            ranked.append((order, products[order]))
        (first, p), (second, q) = ranked
        heap, seen = [(-(p[0] + q[0]), 0, 0)], {(0, 0)}
        found, held = [], 0
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            cell = int(first[i]) * len(self.books[1]) + int(second[j])
            if cell in self.sizes:
                found.append(cell)
                held += self.sizes[cell]
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(first) and b < len(second) and (a, b) not in seen:
                    seen.add((a, b))
                    heapq.heappush(heap, (-(p[a] + q[b]), a, b))
        return found


def matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, dim))


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products; equal vectors get equal ones, which matrix products do not promise."""
    return (vectors * query).sum(axis=1)


def fit(vectors: DataFrame, id_col: str, vector_col: str, words: int = WORDS) -> Index | None:
    """Codebooks from the bounded sample, the only vectors the driver sees."""
    rows = (
        vectors.select(F.col(vector_col).alias("v"), F.xxhash64(id_col).alias("draw"), id_col)
        .orderBy("draw", id_col)
        .limit(SAMPLE)
        .select("v")
        .collect()
    )
    if not rows:
        return None
    dim = Counter(len(r["v"]) for r in rows).most_common(1)[0][0]
    return Index(np.array([r["v"] for r in rows if len(r["v"]) == dim], dtype=np.float64), words)


def classes(vectors: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector (`v`) with its k + 1 smallest ids.

    Copies are cut down within parts of their own first, so a vector that most rows share is never in one group.
    """
    key = F.xxhash64("v")
    salted = vectors.withColumns({"key": key, "salt": F.pmod(F.xxhash64("id"), F.lit(64))})
    least = F.slice(F.array_sort(F.collect_set("id")), 1, k + 1)
    parts = salted.withColumn("part", F.pmod(F.xxhash64("id", "salt"), F.lit(4096))).groupBy("v", "key", "salt", "part")
    first = parts.agg(least.alias("ids"))
    second = first.groupBy("v", "key", "salt").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids")
    )
    return second.groupBy("v", "key").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids")
    )


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    probe: float = PROBE,
    words: int = WORDS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row of which `queries` is true."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    fine = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    fine = fine.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), queries.alias("asks"))
    index = fit(fine, "id", "v", words)
    if index is None:
        return spark.createDataFrame([], schema)
    fine = fine.filter(F.size("v") == index.dim)

    def enter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            rows["cell"] = index.cells(matrix(rows["v"], index.dim)).astype(np.int32)
            yield rows[["ids", "v", "key", "cell"]]

    kind = fine.schema["v"].dataType.simpleString()
    entries = stored(
        classes(fine.select("id", "v"), k).mapInPandas(lean(enter), f"ids array<long>, v {kind}, key long, cell int"), "ann-entries"
    )
    # One row per pair of centroids at most.
    index.sizes = {r["cell"]: r["count"] for r in entries.groupBy("cell").count().collect()}
    wanted = max(probe * sum(index.sizes.values()), min(4 * k, sum(index.sizes.values())))

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            walks = [index.walk(q, wanted) for q in matrix(rows["v"], index.dim)]
            rows["cell"] = walks
            yield rows.explode("cell").astype({"cell": "int32"})[["id", "v", "cell"]]

    visits = stored(
        fine.filter("asks").select("id", "v").distinct().mapInPandas(lean(ask), f"id long, v {kind}, cell int"), "ann-visits"
    )
    asked = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}
    cuts = spark.createDataFrame(
        [
            (c, math.ceil(n / BLOCK), math.ceil(asked[c] / BLOCK))
            for c, n in index.sizes.items()
            if c in asked
        ],
        "cell int, entry_blocks int, query_blocks int",
    )
    # Every entry block of a cell meets every query block of it; each side goes along once per block of the other.
    e = entries.join(small(cuts), "cell").select(
        "cell",
        F.pmod(F.col("key"), F.col("entry_blocks")).cast("int").alias("entry_block"),
        F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("query_block"),
        "ids",
        "v",
    )
    q = visits.join(small(cuts), "cell").select(
        "cell",
        F.explode(F.sequence(F.lit(0), F.col("entry_blocks") - 1)).alias("entry_block"),
        F.pmod(F.xxhash64("id"), F.col("query_blocks")).cast("int").alias("query_block"),
        "id",
        "v",
    )

    def meet(asking: pd.DataFrame, entered: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(entered):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        candidates = matrix(entered["v"], index.dim)
        out = []
        for query, vector in zip(asking["id"], matrix(asking["v"], index.dim), strict=True):
            products = exact(vector, candidates)
            best = np.arange(len(products))
            if len(products) > k + 1:
                # The k + 1 best classes and all that tie with the last: one may hold the query alone.
                least = np.partition(products, len(products) - k - 1)[len(products) - k - 1]
                best = np.flatnonzero(products >= least)
            found = [(-products[c], int(i)) for c in best for i in entered["ids"].iat[c] if i != query]
            out += [(query, i, -s) for s, i in heapq.nsmallest(k, found)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["cell", "entry_block", "query_block"]
    found = q.groupBy(*keys).cogroup(e.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score double")
    # At most k rows per query, cell and block pair; the best of them are one aggregate with partial results.
    ranked = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("vec_id")))), 1, k)
    parts = found.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(8))).groupBy("query_id", "part").agg(ranked.alias("top"))
    best = parts.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
    return best.select("query_id", F.posexplode("top").alias("at", "one")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("one.vec_id").alias("vec_id"),
        (-F.col("one.s")).alias("score"),
    )
