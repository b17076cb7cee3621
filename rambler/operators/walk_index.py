"""Buckets of a vertex's running weights: how a draw finds its edge by an equi-join."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BUCKET_RUN = 1024         # buckets of an edge that are listed at once
BUCKET_EDGES = 4          # edges of a vertex to one of its buckets: an edge is listed 1.25 times, about, and a draw meets 5


def spread(df: DataFrame) -> DataFrame:
    """A side of a join that is shuffled and never sent through the driver, whatever its size."""
    return df.hint("merge")


def bucket_of(t, n, tot):
    """g(t) = floor(t·n/tot): monotone in ``t``, so an edge listed in buckets g(cb)..g(ca)
    is always found from the bucket of any draw that selects it."""
    return F.when(tot > 0, F.floor(t.cast("double") * n / tot)).otherwise(F.lit(0)).cast("bigint")


def bucket_count(n):
    """The buckets of a vertex with ``n`` edges; the ``n`` that ``bucket_of`` takes in the walk's index."""
    return F.ceil(n / BUCKET_EDGES)


def explode_buckets(e: DataFrame) -> DataFrame:
    """A row per bucket from ``lo`` to ``hi``, through runs, so that no row holds a hub-sized array."""
    runs = e.withColumn("_run", F.explode(F.sequence(F.floor(F.col("lo") / BUCKET_RUN), F.floor(F.col("hi") / BUCKET_RUN))))
    first, last = F.col("_run") * BUCKET_RUN, F.col("_run") * BUCKET_RUN + (BUCKET_RUN - 1)
    return runs.withColumn("bucket", F.explode(F.sequence(F.greatest("lo", first), F.least("hi", last)))).drop("_run", "lo", "hi")
