"""The modelled system's sampler tests (fixed draws), on the DataFrame samplers."""

from pyspark.sql import functions as F

from rambler.operators.sampling import second_order_sample, second_order_weights, weighted_sample


def _pick(spark, nbrs, u):
    c = spark.createDataFrame([(0, d, float(w), float(u)) for d, w in nbrs], "k int, dst long, w double, u double")
    return weighted_sample(c, ["k"]).collect()[0]["next"]


def test_weighted_sample_equal_weights(spark):
    nbrs = [(1, 1), (2, 1), (3, 1)]
    assert [_pick(spark, nbrs, u) for u in (0.1, 0.4, 0.7)] == [1, 2, 3]


def _second(spark, prev_nbrs, p, q, u=None):
    keys = spark.createDataFrame([(1, d) for d in prev_nbrs], "src long, dst long")
    cands = spark.createDataFrame([(0, 1, 6, d, 1.0) for d in (1, 3, 4)],
                                  "k int, prev long, cur long, dst long, w double")
    if u is None:
        return {r.dst: r.w2 for r in second_order_weights(cands, keys, p, q).collect()}
    return second_order_sample(cands.withColumn("u", F.lit(u)), keys, ["k"], p, q).collect()[0]["next"]


def test_second_order_weights_p_q_one(spark):
    assert _second(spark, [2, 4, 5], 1.0, 1.0) == {1: 1.0, 3: 1.0, 4: 1.0}
    assert [_second(spark, [2, 4, 5], 1.0, 1.0, u) for u in (0.1, 0.4, 0.7)] == [1, 3, 4]


def test_second_order_weights_p_q_two(spark):
    assert _second(spark, [2, 4, 5], 2.0, 2.0) == {1: 0.5, 3: 0.5, 4: 1.0}
    assert [_second(spark, [2, 4, 5], 2.0, 2.0, u) for u in (0.24, 0.26, 0.51, 0.99)] == [1, 3, 4, 4]


def test_second_order_no_common_neighbour(spark):
    assert _second(spark, [2, 5], 2.0, 2.0) == {1: 0.5, 3: 0.5, 4: 0.5}


def test_input_weights_unchanged(spark):
    keys = spark.createDataFrame([(1, 2)], "src long, dst long")
    cands = spark.createDataFrame([(0, 1, 6, 3, 1.0)], "k int, prev long, cur long, dst long, w double")
    r = second_order_weights(cands, keys, 2.0, 2.0).collect()[0]
    assert r.w == 1.0 and r.w2 == 0.5


def _by_window(c):
    """One window per walker, in whole units."""
    from pyspark.sql import Window
    by = Window.partitionBy("k")
    units = F.round(F.col("w") * 10**8).cast("long")
    acc = c.select("k", "dst", "u", (F.sum(units).over(by.orderBy("dst")) / 1e8).alias("a"), (F.sum(units).over(by) / 1e8).alias("t"))
    return acc.groupBy("k").agg(F.coalesce(F.min(F.when(F.col("a") >= F.col("u") * F.col("t"), F.col("dst"))), F.min("dst")).alias("next"))


def test_scan_agrees_with_window_with_hot_walker(spark):
    import random
    rnd = random.Random(3)
    for weight in (lambda: float(rnd.randint(1, 4)), lambda: rnd.choice([0.1, 0.7, 1 / 3, 2.5e-7, 12.34])):
        rows = []
        for k in range(30):
            size = 2500 if k == 4 else rnd.randint(1, 40)       # walker 4 stands on a hub
            u = rnd.random()
            rows += [(k, d, weight(), u) for d in rnd.sample(range(100000), size)]
        c = spark.createDataFrame(rows, "k int, dst long, w double, u double")
        a = sorted(map(tuple, weighted_sample(c, ["k"]).collect()))
        assert a == sorted(map(tuple, _by_window(c).collect())) and len(a) == 30
