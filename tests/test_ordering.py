"""Range-partitioned ordering primitives against single-task windows, with a hot key."""

import random

from pyspark.sql import Window, functions as F

from rambler.operators.ordering import global_rank, ordered_lead, segmented_cumsum


def _data(spark):
    rnd = random.Random(5)
    rows, i = [], 0
    for k in range(40):
        size = 3000 if k == 7 else rnd.randint(1, 60)      # key 7 holds most rows
        for _ in range(size):
            rows.append((k, i, float(rnd.randint(0, 5))))
            i += 1
    return spark.createDataFrame(rows, "k long, o long, v double")


def test_segmented_cumsum_matches_window(spark):
    df = _data(spark)
    got = segmented_cumsum(df, "k", ["o"], "v", partitions=7)
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("k", "o", F.sum("v").over(w).alias("ca"), (F.sum("v").over(w) - F.col("v")).alias("cb"))
    bad = got.join(exp, ["k", "o"]).where((F.col("cum_after") != F.col("ca")) | (F.col("cum_before") != F.col("cb")))
    assert got.count() == df.count() and bad.count() == 0


def test_global_rank_matches_row_number(spark):
    df = _data(spark)
    got = global_rank(df, ["k", "o"], "r", partitions=5)
    exp = df.select("k", "o", (F.row_number().over(Window.orderBy("k", "o")) - 1).alias("rn"))
    assert got.join(exp, ["k", "o"]).where("r != rn").count() == 0
    assert got.count() == df.count()


def test_ordered_lead_matches_window(spark):
    df = _data(spark)
    got = ordered_lead(df, ["k"], ["o"], "o", "nx", partitions=6)
    exp = df.select("k", "o", F.lead("o").over(Window.partitionBy("k").orderBy("o")).alias("ex"))
    assert got.join(exp, ["k", "o"]).where(~F.col("nx").eqNullSafe(F.col("ex"))).count() == 0
    # the union branches (different task indexes) see the same borders
    u = got.unionByName(got)
    assert u.where(F.col("nx").isNull()).count() == 2 * df.select("k").distinct().count()


def test_decimal_sums_are_exact_and_independent_of_partitions(spark):
    rnd = random.Random(8)
    rows = [(k, i, rnd.choice([0.1, 0.7, 0.3, 1.23])) for k in range(3) for i in range(3000 if k == 1 else 50)]
    df = spark.createDataFrame(rows, "k long, o long, v double")
    runs = [sorted(map(tuple, segmented_cumsum(df, "k", ["o"], "v", partitions=n).collect())) for n in (1, 4, 8)]
    assert runs[0] == runs[1] == runs[2]
    for x, y in zip(runs[0], runs[0][1:]):
        if x[0] == y[0]:
            assert y[3] == x[4]             # no gap and no overlap
    assert max(r[4] for r in runs[0] if r[0] == 1) == round(sum(round(v * 100) for k, _, v in rows if k == 1) / 100, 8)


def test_several_keys_and_null_keys(spark):
    import pytest
    df = spark.createDataFrame([(1, "a", 1, 2), (1, "a", 2, 3), (1, "b", 1, 5), (2, "a", 1, 7)], "k long, s string, o long, v long")
    got = {tuple(r)[:3]: (r.cum_before, r.cum_after) for r in segmented_cumsum(df, ["k", "s"], ["o"], "v").collect()}
    assert got == {(1, "a", 1): (0, 2), (1, "a", 2): (2, 5), (1, "b", 1): (0, 5), (2, "a", 1): (0, 7)}
    with pytest.raises(Exception, match="null key"):
        segmented_cumsum(spark.createDataFrame([(None, 1, 1)], "k long, o long, v long"), "k", ["o"], "v").collect()


def test_running_sums_leave_spark_once(spark):
    df = _data(spark)
    got = segmented_cumsum(df, "k", ["o"], "v", partitions=7)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan and "MapIn" not in plan and "Exchange" not in plan
    negative = df.select("k", "o", (F.lit(3) - F.col("v").cast("int")).alias("v"))     # carries of either sign
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    exp = negative.withColumn("ca", F.sum("v").over(w))
    assert segmented_cumsum(negative, "k", ["o"], "v", partitions=5).join(exp, ["k", "o"]).where("cum_after = ca").count() == df.count()
