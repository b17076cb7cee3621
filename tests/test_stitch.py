"""Stitched first-order walks: right steps, right distribution, few turns."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rambler.operators.stitch import build_segments, stitched_walk
from rambler.operators.walk import build_graph, random_walk
from rambler.params import WalkParams


def paths(result):
    return {(r.rnd, r.v0): r.path for r in result.paths.collect()}


@pytest.fixture(scope="module")
def graph(spark, karate):
    g = build_graph(karate)
    yield g
    g.unpersist()


def test_long_walks_take_few_turns(spark, karate, graph):
    found = stitched_walk(graph, WalkParams(walk_length=80, num_walks=2, seed=4))
    walks = paths(found)
    edges = {(r.src, r.dst) for r in karate.collect()}
    edges |= {(b, a) for a, b in edges}
    assert len(walks) == 68 and all(p[0] == v and len(p) == 82 for (_, v), p in walks.items())
    assert all((a, b) in edges for p in walks.values() for a, b in zip(p, p[1:]))
    assert found.turns <= 20        # 81 moves
    assert paths(random_walk(graph, WalkParams(walk_length=80, num_walks=2, seed=4, sampler="stitched"))) == walks


def test_same_walks_on_any_partitions(spark, karate):
    seen = []
    for n in (1, 6):
        g = build_graph(karate.repartition(n), partitions=n)
        seen.append(paths(stitched_walk(g, WalkParams(walk_length=9, num_walks=3, seed=1))))
        g.unpersist()
    assert seen[0] == seen[1]


def test_where_walks_are_after_some_moves(spark):
    """Against powers of the transition matrix, for weighted edges and all starts together."""
    edges = [(0, 1, 1.0), (0, 2, 2.0), (1, 2, 3.0), (2, 3, 0.5), (3, 4, 4.0), (4, 0, 1.5), (5, 0, 0.25)]
    g = build_graph(spark.createDataFrame(edges, "src long, dst long, w double"))
    rounds, moves = 3000, 7
    walks = paths(stitched_walk(g, WalkParams(walk_length=moves - 1, num_walks=rounds, seed=9)))
    g.unpersist()
    p = np.zeros((6, 6))
    for a, b, w in edges:
        p[a, b] += w
        p[b, a] += w
    p /= p.sum(1, keepdims=True)
    for step in (1, 2, 4, moves):
        want = np.linalg.matrix_power(p, step)
        for v in range(6):
            seen = Counter(walks[r, v][step] for r in range(rounds))
            for u in range(6):
                spread = np.sqrt(rounds * want[v, u] * (1 - want[v, u]))
                assert abs(seen[u] - rounds * want[v, u]) <= 5 * spread + 1e-9, (step, v, u)


def test_segments_are_walks_and_numbers_are_unique(spark, karate, graph):
    pool = build_segments(graph, 2, 11, 3)
    assert pool.groupBy("level", "v", "k").count().filter("count > 1").isEmpty()
    gaps = pool.groupBy("level", "v").agg(F.max("k").alias("k"), F.count(F.lit(1)).alias("n")).filter("k <> n - 1")
    assert gaps.isEmpty() and pool.filter(F.size("path") > F.pow(F.lit(2), F.col("level"))).isEmpty()
    assert pool.filter(F.element_at("path", -1) != F.col("end")).isEmpty()


def test_sinks_end_walks(spark):
    g = build_graph(spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (1, 3, 2.0), (4, 4, 1.0)], "src long, dst long, w double"), directed=True)
    walks = paths(stitched_walk(g, WalkParams(walk_length=6, num_walks=5, seed=2)))
    g.unpersist()
    assert all(p in ([1, 2, 3], [1, 3]) for (_, v), p in walks.items() if v == 1)
    assert all(p == [3] for (_, v), p in walks.items() if v == 3) and all(p == [4] * 8 for (_, v), p in walks.items() if v == 4)
    with pytest.raises(ValueError, match="p and q"):
        stitched_walk(g, WalkParams(p=0.5))


def test_nothing_of_a_walk_is_broadcast(spark, karate, monkeypatch):
    from rambler.operators import stitch, walk
    from rambler.session import materialize, write_scratch
    seen = []

    def note(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.append("Join" in plan)
        assert "Broadcast" not in plan, plan

    def noted(write):
        def run(df, *args, **kw):
            note(df)
            return write(df, *args, **kw)
        return run

    g = build_graph(karate, directed=False)
    monkeypatch.setattr(stitch, "materialize", noted(materialize))
    monkeypatch.setattr(stitch, "write_scratch", noted(write_scratch))
    random_walk(g, WalkParams(walk_length=4, num_walks=1, p=1.0, q=1.0, seed=3, sampler="stitched"))
    note(walk.rejection_step(walk.init_walkers(g, 1), g, WalkParams(walk_length=4, num_walks=1, p=0.5, q=2.0, seed=3), 8))
    g.unpersist()
    assert sum(seen) > 5
