"""Samplers over candidate tables (one row per walker × neighbour).

These are the modelled system's inverse-CDF samplers: for a draw ``u`` the pick is the
first neighbour (in ``dst`` order) whose running weight reaches ``u × total``; if none
does, the first neighbour.  They take any table of candidates and read every row of it; walks
make the same picks from sums that are built once (``prefix_step``), or sample the same
distribution through ``rambler.operators.walk``'s bucketed index.

Weights are summed as whole units of 1e-8, so sums are exact and don't depend on the
order or the partitions they are added in; they are compared as ``units / 1e8``.  The
running weight is a range-partitioned segmented scan over ``(walker, dst)``, followed by
partial aggregations: a walker standing on a hub has its candidate rows spread over as
many tasks as their size needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rambler.functions.weights import from_units, weight_units
from rambler.operators.ordering import segmented_cumsum
from rambler.session import materialize


def weighted_sample(cands: DataFrame, keys: list[str], u: str = "u", weight: str = "w",
                    out: str = "next") -> DataFrame:
    """``keys + [out]``; ``cands`` has ``keys``, ``dst``, ``weight`` and the walker's draw ``u``.

    Keys must not be null.
    """
    rows = materialize(cands.select(*keys, "dst", weight_units(weight).alias("_w"), F.col(u).alias("_u")), "candidates")
    cum = segmented_cumsum(rows, keys, ["dst"], "_w", before="_cb", after="_acc", written=True)
    tot = rows.groupBy(*keys).agg(F.sum("_w").alias("_tot"))     # exact, so equal to the last running sum
    reached = from_units("_acc") >= F.col("_u") * from_units("_tot")
    return (cum.join(tot, keys).groupBy(*keys)
            .agg(F.coalesce(F.min(F.when(reached, F.col("dst"))), F.min("dst")).alias(out)))


def second_order_weights(cands: DataFrame, edge_keys: DataFrame, p: float, q: float,
                         weight: str = "w", out: str = "w2") -> DataFrame:
    """``w/p`` if ``dst = prev``; else ``w`` if ``dst`` is a neighbour of ``prev``; else ``w/q``.

    ``cands`` has ``prev`` and ``dst``; ``edge_keys`` is the distinct ``(src, dst)`` set.
    A walker with no ``prev`` (its first step) keeps ``w``.
    """
    k = edge_keys.select(F.col("src").alias("_ps"), F.col("dst").alias("_pd"), F.lit(True).alias("_in"))
    j = cands.join(k, (cands.prev == k._ps) & (cands.dst == k._pd), "left")
    w = F.col(weight)
    wm = (F.when(F.col("prev").isNull(), w)
          .when(F.col("dst") == F.col("prev"), w / F.lit(float(p)))
          .when(F.col("_in").isNotNull(), w)
          .otherwise(w / F.lit(float(q))))
    return j.select(*cands.columns, wm.alias(out))


def second_order_sample(cands: DataFrame, edge_keys: DataFrame, keys: list[str], p: float, q: float,
                        u: str = "u", out: str = "next") -> DataFrame:
    """W2 then W1."""
    return weighted_sample(second_order_weights(cands, edge_keys, p, q), keys, u=u, weight="w2", out=out)
