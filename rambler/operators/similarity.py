"""Vector lookup, pair similarity and top-N over a ``(key, vector)`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rambler.functions.vectors import cosine, dot, norm


def vector_lookup(vectors: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """E6 for many keys: ``(key, vector)`` of the requested keys (a join, not a driver collect)."""
    return vectors.join(keys.select(key).distinct(), key)


def missing_keys(vectors: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """E6's error case for many keys: requested keys with no vector (anti join)."""
    return keys.select(key).distinct().join(vectors.select(key), key, "left_anti")


def vector_of(vectors: DataFrame, k: str, key: str = "key"):
    """E6 for one key as a scalar-subquery column; evaluation fails when the key is missing."""
    v = vectors.where(F.col(key) == F.lit(k)).select("vector").scalar()
    return F.coalesce(v, F.raise_error(F.lit(f"{k} cannot be found in the vectors")).cast("array<double>"))


def pair_similarity(vectors: DataFrame, pairs: DataFrame, key: str = "key") -> DataFrame:
    """``(k1, k2, cos)`` for a table of key pairs (two equi-joins, then P9)."""
    a = vectors.select(F.col(key).alias("k1"), F.col("vector").alias("_v1"))
    b = vectors.select(F.col(key).alias("k2"), F.col("vector").alias("_v2"))
    return (pairs.select("k1", "k2").join(a, "k1").join(b, "k2")
            .select("k1", "k2", cosine("_v1", "_v2").alias("cos")))


def top_n_similar(vectors: DataFrame, k: str, n: int, key: str = "key", digits: int | None = None) -> DataFrame:
    """The ``n + 1`` most similar rows to key ``k`` (``k`` itself included).

    The query vector is a scalar subquery (one value, whatever the table size);
    ``orderBy().limit()`` plans as a per-partition top-k merge, never a total sort.
    A zero vector's NaN cosine sorts above every number, as ``Double.compare`` orders it.
    """
    q = vector_of(vectors, k, key)
    # the query's norm is part of a one-row subquery, not folded again for every row
    one = vectors.where(F.col(key) == F.lit(k)).select(norm("vector").alias("n")).scalar()
    withq = vectors.select(F.col(key), "vector", q.alias("_q"), one.alias("_n"))
    den = F.col("_n") * norm("vector")
    c = F.when(den == 0, F.lit(float("nan"))).otherwise(dot("_q", "vector") / den)
    if digits is not None:
        c = F.round(c, digits)
    return (withq.select(F.col(key), c.alias("cos"), "vector")
            .orderBy(F.col("cos").desc(), F.col(key)).limit(n + 1))
