"""E8 for a table of keys: equal to the single-key operator, without scoring all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rambler.operators.similarity import top_n_similar
from rambler.operators.similarity_batch import BlockSettings, _round, top_n_similar_batch

SCHEMA = "key string, vector array<double>"


def found(batch):
    out = {}
    for r in batch.rows.orderBy("query", "rank").collect():
        assert r["rank"] == len(out.setdefault(r.query, [])) + 1
        out[r.query].append((r.key, "nan" if math.isnan(r.cos) else r.cos))
    return out


def by_hand(rows, keys, n, digits):
    def cos(a, b):
        la, lb = (math.sqrt(sum_(x * x for x in v)) for v in (a, b))
        if la * lb == 0:
            return math.inf
        c = sum_(x * y for x, y in zip(a, b)) / (la * lb)
        return c if digits is None else float(_round(np.array([c]), digits)[0])

    def sum_(it):
        total = 0.0
        for x in it:
            total += x
        return total

    out = {}
    vectors = dict(rows)
    for k in {k for k in keys if vectors.get(k) is not None}:
        best = sorted((-cos(vectors[k], v), key) for key, v in rows if v is not None)[: n + 1]
        out[k] = [(key, "nan" if c == -math.inf else -c) for c, key in best]
    return out


def clustered(n, dim, clusters, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    return [(f"k{i}", (centres[i % clusters] * rng.uniform(0.1, 9) + rng.normal(size=dim) * 0.05).tolist()) for i in range(n)]


@pytest.mark.parametrize("digits", [None, 3])
def test_equal_to_brute_force(spark, digits):
    rnd = random.Random(4)
    rows = clustered(300, 6, 9, 1) + [(f"r{i}", [rnd.gauss(0, 1) for _ in range(6)]) for i in range(120)]
    rows += [(f"c{i:03}", [1.0, 2.0, 0.0, 0.0, 0.0, 0.5]) for i in range(150)]                       # copies: ties go by key
    rows += [(f"z{i}", [0.0] * 6) for i in range(3)] + [("null", None), ("one", [1.0] + [0.0] * 5), ("far", [-1.0] + [0.0] * 5)]
    keys = ["k0", "k17", "r3", "c007", "z1", "one", "far", "missing", "null", "k0"]
    v, k = spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame([(x,) for x in keys], "key string")
    small = BlockSettings(pivots=12, block_rows=16, broadcast_bytes=1500)     # several chunks of queries
    for settings in (BlockSettings(), small):
        assert found(top_n_similar_batch(v, k, 4, digits=digits, settings=settings)) == by_hand(rows, keys, 4, digits)
    assert found(top_n_similar_batch(v, k.filter("key = 'k17'"), 1000, digits=digits)) == by_hand(rows, ["k17"], 1000, digits)
    single = [(r.key, "nan" if math.isnan(r.cos) else r.cos) for r in top_n_similar(v.filter("vector IS NOT NULL"), "r3", 4, digits=digits).collect()]
    assert single == by_hand(rows, ["r3"], 4, digits)["r3"]


def test_blocks_are_skipped(spark):
    n = 20_000
    v = spark.createDataFrame(clustered(n, 8, 40, 2), SCHEMA)
    keys = v.filter(F.col("key").endswith("7")).select("key")
    batch = top_n_similar_batch(v, keys, 5)
    counts = batch.counts.first()
    queries = keys.count()
    assert batch.rows.count() == queries * 6
    assert counts.scored + counts.skipped == 2 * queries * n     # two passes
    assert counts.scored < 0.1 * queries * n
    plan = batch.rows._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_tables_and_sizes(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([("a", [1.0])], SCHEMA)
    assert top_n_similar_batch(none, one.select("key"), 3).rows.count() == 0
    assert top_n_similar_batch(one, none.select("key"), 3).rows.count() == 0
    assert found(top_n_similar_batch(one, one.select("key"), 3)) == {"a": [("a", 1.0)]}
    with pytest.raises(ValueError, match="different sizes"):
        top_n_similar_batch(one.unionByName(spark.createDataFrame([("b", [1.0, 2.0])], SCHEMA)), one.select("key"), 1)


def test_rounding_is_sparks(spark):
    xs = [0.5, 0.1234565, -0.1234565, 0.12345649999999999, 0.0000005, 1.0, -1e-9, 0.9999995, *np.random.default_rng(0).uniform(-1, 1, 200).tolist()]
    rounded = [r.x for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").orderBy("i").select(F.round("x", 6).alias("x")).collect()]
    assert _round(np.array(xs), 6).tolist() == rounded
