"""Exact k best inner products by no-random-access aggregation of sorted lists.

Every component of the candidates in a block is one list, sorted by what it adds
to the score. For a query the lists are read from their good ends, step by step.
A candidate's score lies between what has been read of it plus the worst that
each unread list holds, and what has been read plus the best that each unread
list can still give. Reading stops when too few candidates are left above the
k-th best lower bound to matter; their scores are then completed. All queries of
a block read a list to the same depths, so what a depth shows of it is a column of two
tables, one to the upper and one to the lower end, and bounds of many queries are one product.

Queries and candidates meet in blocks of bounded size, each pair of blocks in a
group of its own, and the k best of every block are merged. Equal vectors are
one candidate, and one query: of their copies only the k + 1 smallest ids can
appear in an answer, so a vector with any number of copies costs as much as
one.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codays.session import staged

SCALE = 256
QUERY_STEP = 50
K = 5
QUERIES_PER_BLOCK = 2048
CANDIDATES_PER_BLOCK = 4096
#: Queries of a block whose bounds are computed together.
QUERIES_AT_ONCE = 256
#: Reading stops when no more candidates than this, or a sixteenth of the block, are left.
FEW = 64


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and q = floor(scale * x) of every usable vector.

    Null vectors, vectors with null or non-finite components and rows without
    an id take no part.
    """
    x = F.col("embedding")
    usable = x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf"))
    )
    q = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & usable).select("vec_id", q.alias("q"))


class SortedLists:
    """The components of a block of candidates as sorted lists."""

    def __init__(self, vectors: np.ndarray):
        rows, width = vectors.shape
        self.integers, self.vectors = vectors, vectors.astype(np.float64)
        self.sorted = np.sort(self.vectors, axis=0)
        largest = float(np.abs(self.vectors).max(initial=0))
        self.exact_below = 2.0**53 / max(1.0, largest * width)

    def _shown(self, depth: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """The least and the most that each entry can be when lists are read to a depth.

        Rising lists, read from the large end, come before falling ones, read from the small end.
        """
        x, lists = self.vectors.astype(kind), self.sorted.astype(kind)
        above, below = lists[len(x) - depth], lists[depth - 1]
        least = np.hstack((np.where(x >= above, x, lists[0]), np.where(x <= below, x, lists[-1])))
        return least.T, np.hstack((np.maximum(x, above), np.minimum(x, below))).T

    def best(self, query: np.ndarray, k: int, few: int = FEW) -> tuple[np.ndarray, np.ndarray]:
        """Candidates that may be among the k best, ties included, with their scores."""
        return self.best_of_each(query[None], k, few)[0]

    def best_of_each(self, queries: np.ndarray, k: int, few: int = FEW) -> list[tuple[np.ndarray, np.ndarray]]:
        """``best`` for each query."""
        rows, width = self.vectors.shape
        few = max(few, k, rows // 16)
        survivors = [np.arange(rows)] * len(queries)
        asking, depth = np.arange(len(queries)) if rows > few else np.arange(0), 0
        extent = np.abs(self.sorted[[0, -1]]).max(axis=0) if rows else np.zeros(width)
        largest = max(float(extent.max(initial=0)), float(np.abs(queries).max(initial=0)))
        kind = np.float32 if largest < 2**24 else np.float64
        while len(asking) and depth < rows:
            depth = min(depth + rows // (8 if depth else 4), rows)
            least, most = self._shown(depth, kind)
            for own in np.array_split(asking, -(-len(asking) // QUERIES_AT_ONCE)):
                # A rising list is read from its large end, a falling one from its small end.
                asked = queries[own].astype(kind)
                weights = np.hstack((np.maximum(asked, 0), np.minimum(asked, 0)))
                floor = np.partition(weights @ least, rows - k, axis=1)[:, rows - k]
                # Sums are off by a little, so nothing that near is given up.
                slack = (2 * width + 8) * np.finfo(kind).eps * (np.abs(asked) @ extent.astype(kind))
                left = weights @ most >= (floor - slack)[:, None]
                for number, row in zip(own, left):
                    survivors[number] = np.flatnonzero(row)
            asking = asking[[len(survivors[number]) > few for number in asking]]
        return [(own, self._scores(own, query)) for own, query in zip(survivors, queries)]

    def _scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        if float(np.abs(query).max(initial=0)) < self.exact_below:
            return (self.vectors[rows] @ query.astype(np.float64)).astype(np.int64)
        return self.integers[rows] @ query


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.int64).reshape(len(column), -1)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    queries_per_block: int = QUERIES_PER_BLOCK,
    candidates_per_block: int = CANDIDATES_PER_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every query.

    Both tables hold vec_id and an integer array q. Only vectors of a query's
    length are its candidates. A query's own row is known by its id, and so are
    repeated rows of it. Ties go to the smaller vec_id. Queries without
    candidates give no rows, and empty tables give an empty result.
    """
    first = Window.partitionBy("q").orderBy("vec_id")
    distinct = (
        vectors.select("vec_id", "q").distinct()
        .withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= k + 1)
        .groupBy("q")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    candidates = staged(distinct, "candidates")
    asked = staged(queries.select(F.col("vec_id").alias("query_id"), "q").distinct(), "queries")
    asked_vectors = asked.groupBy("q").agg(F.min("query_id").alias("asked"))
    query_blocks = max(1, -(-asked_vectors.count() // queries_per_block))
    candidate_blocks = max(1, -(-candidates.count() // candidates_per_block))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def block(n: int):
        return F.pmod(F.xxhash64("q"), F.lit(n)).cast("int")

    length, at = F.size("q").alias("length"), (F.col("i") * candidate_blocks + F.col("j")).alias("at")
    left = asked_vectors.select(block(query_blocks).alias("i"), every(candidate_blocks).alias("j"), "asked", "q")
    right = candidates.select(every(query_blocks).alias("i"), block(candidate_blocks).alias("j"), "ids", "q")

    def best_of_block(asking: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asking) and len(offered):
            lists, ids = SortedLists(_matrix(offered["q"])), offered["ids"].tolist()
            enough = min(k + 1, len(offered))
            answers = lists.best_of_each(_matrix(asking["q"]), enough)
            for asked_id, (found, scores) in zip(asking["asked"], answers):
                best = np.flatnonzero(scores >= np.partition(scores, len(scores) - enough)[len(scores) - enough])
                rows = sorted((-int(scores[n]), int(x)) for n in best for x in ids[found[n]])
                out += [(asked_id, x, -s) for s, x in rows[: k + 1]]
        return pd.DataFrame(out, columns=["asked", "vec_id", "score"]).astype("int64")

    width = query_blocks * candidate_blocks
    keys = ["at", "length"]
    offers = (
        left.select(length, at, "asked", "q").repartitionById(width, "at")
        .groupBy(*keys)
        .cogroup(right.select(length, at, "ids", "q").repartitionById(width, "at").groupBy(*keys))
        .applyInPandas(best_of_block, "asked bigint, vec_id bigint, score bigint")
    )
    by_vector = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    merged = offers.withColumn("n", F.row_number().over(by_vector)).where(F.col("n") <= k + 1)
    named = asked.join(asked_vectors, "q").select("query_id", "asked")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        named.join(merged, "asked")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest_rows(embeddings: DataFrame) -> DataFrame:
    """What the registered query returns: every 50th id asks all other rows."""
    vectors = staged(quantised(embeddings), "quantised")
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))


def nearest_rows_sql() -> str:
    """The same in DuckDB SQL."""
    return f"""
    WITH usable AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
        CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
      FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
      WHERE a.vec_id % {QUERY_STEP} = 0)
    SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored)
    WHERE n <= {K}"""
