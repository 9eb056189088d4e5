"""Exact top-k by inner product over norm buckets.

Vectors are cut into buckets of similar length, longest first.  A first pass
over the longest bucket gives every query a lower bound of its k-th score.
A bucket then takes part for a query only if its longest vector could reach
the bound; inside, the query's local cosine threshold decides whether vectors
are pruned by length (the local order is by length) or by coordinates (the
feasible interval of the query's largest coordinates), and the inner products
of what is left are computed exactly.

Query blocks meet vector buckets as (bucket, block) groups of bounded size; a
bucket of more rows is split by id hash: one of many equal lengths, and all of
them in a table of more than ``MOST_BUCKETS`` buckets.

A vector is sent only to query blocks that hold a query its bucket can serve.
Products that a double holds exactly are multiplied as doubles, larger ones as
Python integers.

Defined results: vectors that are NULL, or hold NULL or non-finite components,
take no part, all others do, however long; scores beyond 38 digits count as
the largest number of 38 digits, and ``score`` is the largest (smallest) long
where the score is beyond a long; vectors are compared with vectors of the
same dimension only; ties go to the smaller ``vec_id``; of the vectors of a
repeated query id the smallest is the query; an empty table gives no rows.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplens.llm.common import MAX_LONG, bucket_of, ship_package, splitters, stored

FOCUS = 3  # coordinates used in coordinate pruning
HITS = "query_id long, vec_id long, score decimal(38,0)"
EXACT = 2.0**53  # whole numbers below this are exact as doubles, and so are sums that stay below
MOST = 10**38 - 1
MOST_BUCKETS = 4096  # cut points on the driver; larger buckets are split by id hash
LONGEST = 9e18  # norms beyond share the first bucket's key


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """``vec_id, v, dim, norm``: components times ``scale``, rounded down (whole numbers as doubles)."""
    # floor() of a double gives a long; a double of 2**53 and more is whole already
    whole = F.transform(
        F.transform(vector_col, lambda x: F.lit(float(scale)) * x.cast("double")),
        lambda y: F.when(F.abs(y) < F.lit(EXACT), F.floor(y).cast("double")).otherwise(y),
    )
    finite = F.forall(
        vector_col, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x)
    )
    return (
        rows.filter(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & finite)
        .select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))
        .withColumn("dim", F.size("v"))
        .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
    )


def products(whole: np.ndarray, q: np.ndarray, longest: float) -> np.ndarray:
    """Exact inner products; ``longest`` bounds the product of the lengths."""
    if longest * (1 + 1e-9) < EXACT:  # then every partial sum is exact
        return (whole @ q).astype(np.int64)
    numbers = [int(x) for x in q]
    exact = [sum(int(a) * b for a, b in zip(row, numbers)) for row in whole.tolist()]
    return np.array([max(-MOST, min(MOST, x)) for x in exact], dtype=object)


def bucket_hits(queries: pd.DataFrame, vectors: pd.DataFrame, k: int) -> pd.DataFrame:
    """Best ``k`` of a bucket for each query that it can still serve (equal dimension)."""
    out_q, out_v, out_s = [], [], []
    vectors = vectors.sort_values("norm", ascending=False, kind="stable")
    ids, norms = vectors["vec_id"].to_numpy(), vectors["norm"].to_numpy()
    whole = np.array(vectors["v"].to_list(), dtype=np.float64).reshape(len(vectors), -1)
    unit = whole / np.maximum(norms, 1e-300)[:, None]
    for q_id, q, q_norm, bound in zip(queries["vec_id"], queries["v"], queries["norm"], queries["bound"]):
        q = np.asarray(q, dtype=np.float64)
        keep = slice(0, len(ids))
        if bound > 0 and q_norm > 0:
            # length pruning: shorter vectors cannot reach the bound (rounding slack below it)
            reach = bound / q_norm * (1 - 1e-9)
            keep = slice(0, int(np.searchsorted(-norms, -reach, side="right")))
            if keep.stop == 0:
                continue
            local = min(1.0, bound / (q_norm * norms[0]) * (1 - 1e-9))
            if local > 0.5:
                # coordinate pruning: cosine of at least ``local`` bounds each coordinate
                direction, good = q / q_norm, np.ones(keep.stop, bool)
                for f in np.argsort(-np.abs(direction))[:FOCUS]:
                    centre = direction[f] * local
                    spread = np.sqrt(max(0.0, (1 - direction[f] ** 2) * (1 - local**2)))
                    low, high = centre - spread, centre + spread
                    low = -1.0 if direction[f] <= -local else low
                    high = 1.0 if direction[f] >= local else high
                    column = unit[: keep.stop, f]
                    good &= (column >= low - 1e-9) & (column <= high + 1e-9)
                keep = np.flatnonzero(good)
        chosen = ids[keep]
        scores = products(whole[keep], q, q_norm * (norms[0] if len(norms) else 0.0))
        other = chosen != q_id
        chosen, scores = chosen[other], scores[other]
        if len(chosen) > k:
            at = len(scores) - k
            edge = sorted(scores)[at] if scores.dtype == object else np.partition(scores, at)[at]
            near = scores >= edge
            chosen, scores = chosen[near], scores[near]
        best = sorted(range(len(chosen)), key=lambda i: (-scores[i], chosen[i]))[:k]
        out_q += [q_id] * len(best)
        out_v += chosen[best].tolist()
        out_s += [Decimal(int(scores[i])) for i in best]
    return _hits(out_q, out_v, out_s)


def _hits(query_ids, vec_ids, scores) -> pd.DataFrame:
    ids = {"query_id": pd.Series(query_ids, dtype="int64"), "vec_id": pd.Series(vec_ids, dtype="int64")}
    return pd.DataFrame(ids | {"score": pd.Series(scores, dtype=object)})


def _meet(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    keys = ["dim", "bucket", "part", "block"]

    def run(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return _hits([], [], [])
        return bucket_hits(q, v, k)

    # fresh column ids: both sides come from the same table
    queries = queries.select("vec_id", "v", "norm", "bound", *keys).toDF("vec_id", "v", "norm", "bound", *keys)
    return queries.groupBy(*keys).cogroup(vectors.groupBy(*keys)).applyInPandas(run, HITS)


def top_k(
    rows: DataFrame,
    is_query,
    k: int = 10,
    rows_per_bucket: int = 2048,
    queries_per_block: int = 1024,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best other vectors."""
    ship_package(rows.sparkSession)
    vectors = stored(integer_vectors(rows, id_col, vector_col, scale), "vectors")
    spark = rows.sparkSession
    # bucket 0 holds the longest; one number per bucket, at most MOST_BUCKETS, comes to the driver
    key = F.greatest(-F.col("norm"), F.lit(-LONGEST)).cast("long")
    cuts = splitters(vectors.select(key.alias("key")), "key", rows_per_bucket, most=MOST_BUCKETS)
    vectors = vectors.withColumn("bucket", bucket_of(key, cuts))
    stats = vectors.groupBy("dim", "bucket").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest"))
    stats = stats.withColumn("parts", F.ceil(F.col("n") / rows_per_bucket).cast("int"))
    one = F.min(F.struct("v", "dim", "norm")).alias("q")
    queries = vectors.filter(is_query).groupBy("vec_id").agg(one).select("vec_id", "q.v", "q.dim", "q.norm")
    blocks = max(1, -(-queries.count() // queries_per_block))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    dealt = (
        vectors.join(stats.select("dim", "bucket", "parts"), ["dim", "bucket"])
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
        .select("vec_id", "v", "dim", "norm", "bucket", "part")
    )

    def sent_to(asked: DataFrame) -> DataFrame:
        """The vectors, for each block that has a query for their bucket."""
        needed = asked.select("dim", "bucket", "part", "block").distinct()
        return dealt.join(needed, ["dim", "bucket", "part"])

    served = stats.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "dim", "bucket", "part", "longest"
    )
    first = served.groupBy("dim").agg(F.min("bucket").alias("bucket"))
    served_first = served.join(first, ["dim", "bucket"], "left_semi")
    served_rest = served.join(first, ["dim", "bucket"], "left_anti")

    seed_queries = queries.withColumn("bound", F.lit(-1.0)).join(served_first.drop("longest"), "dim")
    seeds = stored(_ranked(_meet(seed_queries, sent_to(seed_queries), k), k), "seeds")
    bounds = seeds.filter(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("bound")
    )
    # a bucket serves a query if its longest vector could reach the k-th score so far
    rest_queries = (
        queries.join(bounds, "vec_id", "left")
        .withColumn("bound", F.coalesce("bound", F.lit(-1.0)))
        .join(served_rest, "dim")
        .filter((F.col("bound") <= 0) | (F.col("norm") * F.col("longest") * (1 + 1e-9) >= F.col("bound")))
        .drop("longest")
    )
    rest = _meet(rest_queries, sent_to(rest_queries), k)
    hits = seeds.select("query_id", "vec_id", "score").unionByName(rest)
    score = F.greatest(F.least("score", F.lit(Decimal(MAX_LONG))), F.lit(Decimal(-MAX_LONG - 1))).cast("long")
    return _ranked(hits, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
