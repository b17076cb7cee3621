"""Running sums in order, in DataFrame operations only, without one task per key.

The rows are dealt by ranges of (key, order), so that a hot key spreads over as many partitions as it
needs, and written with their partition's number (ranges are sampled anew by every execution).  A window
sums within a partition; what a partition takes over from the ones before is a table with at most one row
a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rambler.session import materialize


def running_sums(rows: DataFrame, key: list[str], order: list[str | Column], values: dict[str, str | Column]) -> DataFrame:
    """``rows`` with a column for each of ``values``: the sum over the earlier rows of the same key.

    ``rows`` should be a written table (it is read twice).  Keys must not be null; a value is a whole
    number.  Rows equal in key and order come in any order; give a tie breaker where that matters.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    values = {name: F.col(v) if isinstance(v, str) else v for name, v in values.items()}
    dealt = materialize(rows.repartitionByRange(*key, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy("_part", *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumns({name: F.coalesce(F.sum(v).over(earlier), F.lit(0)) for name, v in values.items()})
    parts_before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (dealt.groupBy("_part", *key).agg(*[F.sum(v).alias(f"_{name}") for name, v in values.items()])
               .withColumns({f"_{name}": F.sum(f"_{name}").over(parts_before) for name in values})
               .filter(F.col(f"_{next(iter(values))}").isNotNull()))       # only a partition's first key has parts before it
    return (inside.join(F.broadcast(carried), ["_part", *key], "left")
            .withColumns({name: F.col(name) + F.coalesce(f"_{name}", F.lit(0)) for name in values})
            .drop("_part", *[f"_{name}" for name in values]))
