"""Units that fit a graph's weights."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rambler.functions.weights import unit_exponent
from rambler.operators.ordering import segmented_cumsum
from rambler.operators.walk import build_graph, random_walk
from rambler.params import WalkParams


def test_exponents():
    assert unit_exponent(1.0, 1e6) == unit_exponent(0.01, 1e9) == unit_exponent(None, None) == 8
    assert unit_exponent(1e-12, 1e-7) == 18
    assert unit_exponent(1e11, 1e13) == 5
    assert unit_exponent(1e-3, 1e10) == 8        # five digits: the sums leave no room for more
    with pytest.raises(ValueError, match="units of one size"):
        unit_exponent(1e-12, 1e9)


@pytest.mark.parametrize("scale", [1e-12, 1e11])
def test_walks_follow_shares_at_any_scale(spark, scale):
    """A star whose arms weigh 1, 3 and 2: the first step goes to each by its share."""
    edges = spark.createDataFrame([(0, 1, scale), (0, 2, 3 * scale), (0, 3, 2 * scale), (1, 2, scale)], "src long, dst long, w double")
    g = build_graph(edges)
    seen = Counter()
    for u in (0.15, 0.18, 0.65, 0.69):
        walked = random_walk(g, WalkParams(walk_length=0, num_walks=1, p=0.5, q=2.0), u1=u)
        seen[walked.paths.filter("v0 = 0").first().path[1]] += 1
    g.unpersist()
    assert seen == {1: 1, 2: 2, 3: 1}


def test_cdf_steps_at_any_scale_are_the_same(spark, karate):
    found = []
    for scale in (1e-10, 1.0, 2.0**37):
        g = build_graph(karate.withColumn("w", (F.col("src") + F.col("dst")) * F.lit(scale)))
        found.append(sorted(map(repr, random_walk(g, WalkParams(walk_length=4, num_walks=1, p=0.25, q=4.0, sampler="cdf", seed=3)).paths.collect())))
        g.unpersist()
    assert found[0] == found[1] == found[2]


def test_sums_near_the_limit(spark):
    """Only a key's own sum has to fit, not a partition's."""
    rows = spark.range(40).select((F.col("id") % 4).alias("k"), "id", F.lit(2**59).alias("w"))
    done = segmented_cumsum(rows, "k", ["id"], "w", partitions=3)
    assert {r.cum_after for r in done.collect()} == {2**59 * i for i in range(1, 11)}
    with pytest.raises(OverflowError):
        segmented_cumsum(rows.withColumn("k", F.lit(0)), "k", ["id"], "w", partitions=3)
