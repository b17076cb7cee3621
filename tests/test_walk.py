"""Graph loading and walks: the modelled system's tests plus invariants and distribution."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rambler.operators import graph as G
from rambler.operators.walk import build_graph, init_walkers, random_walk, rejection_step
from rambler.params import WalkParams
from rambler.sources.text import parse_edge_lines


def test_karate_load_counts(spark, karate):
    und = G.graph_stats(karate, directed=False).collect()[0]
    d = G.graph_stats(karate, directed=True).collect()[0]
    assert (und.entries, und.vertices) == (156, 34)      # parallel "9 33" kept
    assert (d.entries, d.vertices) == (78, 34)           # sinks are vertices


def test_first_step_two_vertex_graph(spark):
    lines = spark.createDataFrame([("1   2",)], "value string")
    g = build_graph(parse_edge_lines(lines, weighted=False), directed=True)
    r = random_walk(g, WalkParams(walk_length=0, num_walks=1, seed=1))
    paths = {x.v0: list(x.path) for x in r.paths.collect()}
    assert paths == {1: [1, 2], 2: [2]}


def _sequential(edges, start, u, length):
    """Sequential oracle: inverse-CDF walk over dst-sorted, merged lists with a constant draw."""
    nb = defaultdict(lambda: defaultdict(float))
    for s, d, w in edges:
        nb[s][d] += w
    path = [start]
    while len(path) < length + 2:
        lst = sorted(nb[path[-1]].items())
        if not lst:
            break
        tot, acc, pick = sum(w for _, w in lst), 0.0, lst[0][0]
        for d, w in lst:
            acc += w
            if acc >= u * tot:
                pick = d
                break
        path.append(pick)
    return path


@pytest.mark.parametrize("sampler", ["rejection", "cdf"])
@pytest.mark.parametrize("u,length", [(0.1, 1), (0.9, 1), (0.1, 50), (0.9, 50)])
def test_constant_draw_walk_matches_sequential(spark, karate, sampler, u, length):
    g = build_graph(karate, directed=False)
    r = random_walk(g, WalkParams(walk_length=length, num_walks=1, sampler=sampler), u1=u)
    got = {x.v0: list(x.path) for x in r.paths.collect()}
    both = [(x.src, x.dst, x.w) for x in karate.collect()]
    both += [(d, s, w) for s, d, w in both]
    assert len(got) == 34
    for v, path in got.items():
        assert path == _sequential(both, v, u, length)


@pytest.fixture(scope="module")
def events_graph(spark):
    from rambler.sources.derived import events_edges
    e = events_edges(spark, "/root/testdata/sf0.001").cache()
    return e


def test_walk_invariants_and_reproducibility(spark, events_graph):
    g = build_graph(events_graph, directed=True)
    p = WalkParams(walk_length=5, num_walks=2, p=0.5, q=2.0, seed=7)
    a = random_walk(g, p, trials=1).paths.collect()
    b = random_walk(g, p, trials=8).paths.collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))          # independent of batching
    edges = {(r.src, r.dst) for r in events_graph.collect()}
    n_v = G.graph_vertices(events_graph, directed=True).count()
    assert len(a) == 2 * n_v
    for r in a:
        path = list(r.path)
        assert 1 <= len(path) <= p.walk_length + 2
        assert all((x, y) in edges for x, y in zip(path, path[1:]))
    short = [list(r.path) for r in a if len(r.path) < p.walk_length + 2]
    out = defaultdict(int)
    for s, _ in edges:
        out[s] += 1
    assert all(out[path[-1]] == 0 for path in short)                 # short only at a sink


def test_partitioned_equals_unpartitioned(spark, events_graph):
    p = WalkParams(walk_length=4, num_walks=1, p=0.5, q=2.0, seed=3)
    a = random_walk(build_graph(events_graph), p).paths.collect()
    parted = G.edge_partitions(events_graph, 3, 3).repartition(3, "part").drop("part")
    b = random_walk(build_graph(parted), p).paths.collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_rejection_step_distribution(spark):
    # prev = 1 with neighbours {2, 4, 5, 6}; cur = 6 with neighbours {1, 3, 4}; p = q = 2
    # → weights 0.5 (back to 1), 0.5 (3: not next to 1), 1 (4: next to 1).
    e = spark.createDataFrame([(1, 2, 1.0), (1, 4, 1.0), (1, 5, 1.0), (1, 6, 1.0), (6, 3, 1.0), (6, 4, 1.0)],
                              "src long, dst long, w double")
    g = build_graph(e, directed=False)
    n = 4000
    w = spark.createDataFrame([(0, i, 1, 1, 6, 3, 3.0, 0) for i in range(n)],
                              "rnd int, v0 long, step int, prev long, cur long, n long, tot double, tb long")
    params = WalkParams(walk_length=5, p=2.0, q=2.0, seed=11)
    picks = Counter()
    for _ in range(20):
        nxt = rejection_step(w, g, params, trials=4).cache()
        picks.update(r.cur for r in nxt.where("tb = 0").collect())
        w = nxt.where("tb > 0")
        if w.count() == 0:
            break
    assert sum(picks.values()) == n
    for v, share in ((1, 0.25), (3, 0.25), (4, 0.5)):
        sd = (share * (1 - share) / n) ** 0.5
        assert abs(picks[v] / n - share) < 4 * sd


def test_default_trials():
    from rambler.operators.walk import _accept_ratios, default_trials
    assert default_trials(1.0, 1.0) == 1
    for p, q in ((0.5, 2.0), (1.0, 2.0), (4.0, 0.25), (0.25, 1.0)):
        worst = min(_accept_ratios(p, q))
        assert 2 / worst <= default_trials(p, q) < 2 / worst + 1
        assert (1 - worst) ** default_trials(p, q) < 0.15          # stalled walkers go on next turn


def _decimal_edges(spark, n=600):
    import random
    rnd = random.Random(4)
    return spark.createDataFrame([(0, d, rnd.choice([0.1, 0.7, 0.3, 12.34])) for d in range(1, n + 1)], "src long, dst long, w double")


def test_every_draw_falls_into_one_interval(spark):
    """Draws on and next to every border of a vertex with decimal weights: one step each."""
    import math
    g = build_graph(_decimal_edges(spark), directed=True)
    lst = sorted({(r.dst, r.cb, r.ca) for r in g.index.where("src = 0").collect()})
    assert all(x[2] == y[1] for x, y in zip(lst, lst[1:])) and lst[0][1] == 0
    tot = lst[-1][2]
    borders = [x[2] for x in lst[:: len(lst) // 25]]
    draws = {min(max(math.nextafter(b / tot, way), 0.0), 1 - 2**-53) for b in borders for way in (0.0, b / tot, 1.0)}
    w = spark.createDataFrame([(0, 0, 0, None, 0, len(lst), tot, 0)],
                              "rnd int, v0 long, step int, prev long, cur long, n long, tot double, tb long")
    for u in sorted(draws):
        thr = u * tot
        want = next((d for d, _, ca in lst if ca >= thr), lst[0][0])
        got = rejection_step(w, g, WalkParams(walk_length=0), 1, u1=u).collect()
        assert [r.cur for r in got] == [want], u


def test_walks_with_decimal_weights_do_not_depend_on_partitions(spark):
    e = _decimal_edges(spark, 200)
    p = WalkParams(walk_length=4, num_walks=1, p=0.5, q=2.0, seed=9)
    runs = [sorted(map(tuple, random_walk(build_graph(e, partitions=n), p).paths.collect())) for n in (1, 4, 8)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 201


def test_unequal_weights_distribution(spark):
    e = spark.createDataFrame([(1, 2, 0.1), (1, 3, 0.7), (1, 4, 1.2)], "src long, dst long, w double")
    g = build_graph(e, directed=True)
    n = 6000
    w = spark.createDataFrame([(0, i, 0, None, 1, 3, 2.0, 0) for i in range(n)],
                              "rnd int, v0 long, step int, prev long, cur long, n long, tot double, tb long")
    picks = Counter(r.cur for r in rejection_step(w, g, WalkParams(walk_length=0, seed=2), 1).collect())
    assert sum(picks.values()) == n
    for v, share in ((2, 0.05), (3, 0.35), (4, 0.6)):
        assert abs(picks[v] / n - share) < 4 * (share * (1 - share) / n) ** 0.5


@pytest.mark.parametrize("hub_first", [True, False])
def test_star_graph_keys_are_spread(spark, hub_first):
    """All walkers of a turn stand on the hub: its index keys, copied or bucketed, share them out."""
    n = 400
    rows = [(0, d, 1.0) if hub_first else (d, 0, 1.0) for d in range(1, n + 1)] + [(0, n + 1, 1.0)]
    e = spark.createDataFrame(rows, "src long, dst long, w double")
    g = build_graph(e, directed=not hub_first, partitions=8)
    hub = g.vertices.where("v = 0").first()
    keys = hub.n * hub.copies                       # keys of the index that walkers on the hub draw
    share = g.edges.where("dst = 0").count() / g.edges.count()
    assert share / keys <= 1 / (4 * 8) + 1e-9
    paths = random_walk(g, WalkParams(walk_length=3, num_walks=1, p=0.5, q=2.0, seed=1)).paths
    assert paths.count() == n + 2


def test_scratch_holds_one_walker_table_at_the_end(spark, karate):
    import os
    from rambler.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    r = random_walk(build_graph(karate), WalkParams(walk_length=6, num_walks=1, p=0.5, q=2.0))
    left = [x for x in set(os.listdir(root)) - before if x.startswith("rambler-walkers")]
    assert left == [] and r.paths.count() == 34


def test_adjacency_blocks_in_order_and_sinks(spark):
    rows = [(1, d, 1.0) for d in range(40, 0, -1)] + [(1, 7, 2.0), (1, 7, 2.0), (2, 1, 1.0)]
    e = spark.createDataFrame(rows, "src long, dst long, w double")
    a = G.adjacency(e, G.graph_vertices(e, directed=True), block_size=16).collect()
    blocks = {(r.src, r.block): [(x.dst, x.w) for x in r.nbrs] for r in a}
    assert [len(blocks[1, b]) for b in range(3)] == [16, 16, 10]
    assert sum((blocks[1, b] for b in range(3)), []) == sorted((d, w) for s, d, w in rows if s == 1)
    assert blocks[2, 0] == [(1, 1.0)] and blocks[3, 0] == [] and len(blocks) == 3 + 1 + 38


def test_turns_read_the_index_in_order(spark, karate):
    g = build_graph(karate, directed=False)
    step = rejection_step(init_walkers(g, 1), g, WalkParams(walk_length=4, num_walks=1, p=0.5, q=2.0, seed=3), 8)
    lines = step._jdf.queryExecution().executedPlan().toString().split("\n")
    cached = [i for i, line in enumerate(lines) if "InMemoryTableScan" in line]
    assert len(cached) == 2
    depth = [max(line.rfind("+- "), line.rfind(":- ")) for line in lines]
    for i in cached:
        at, above = i, lines[i]
        while at == i or any(x in above for x in ("Filter", "Project", "TableCacheQueryStage")):
            at = next(j for j in range(at - 1, -1, -1) if 0 <= depth[j] < depth[at])
            above = lines[at]
        assert "SortMergeJoin" in above, above
    g.unpersist()


def test_the_tail_of_a_walk_draws_no_more_than_a_turn(spark, karate, monkeypatch):
    from rambler.operators import walk
    seen, step = [], walk.rejection_step

    def noted(walkers, graph, params, trials, u1=None):
        seen.append((walkers.where((F.col("n") > 0) & (F.col("step") <= params.walk_length)).count(), trials))
        return step(walkers, graph, params, trials, u1)

    monkeypatch.setattr(walk, "rejection_step", noted)
    g = build_graph(karate, directed=False)
    random_walk(g, WalkParams(walk_length=2, num_walks=3, p=0.25, q=4.0, seed=3, trials=2))
    g.unpersist()
    assert len(seen) > 4 and all(n * trials <= 2 * seen[0][0] for n, trials in seen[1:])
    assert seen[-1][1] > 2


def test_the_index_has_little_more_than_the_edges(spark):
    """No vertex's attributes, 1.25 rows an edge and one a vertex; one direction of an undirected edge is a key."""
    e = spark.createDataFrame([(0, d, 0.25 + d % 7) for d in range(1, 401)] + [(1, 2, 1.0), (5, 5, 2.0)], "src long, dst long, w double")
    g = build_graph(e)
    assert set(g.index.columns) == {"src", "bucket", "copy", "dst", "cb", "ca", "first"}
    assert g.index.filter("copy = 0").count() <= 1.25 * g.edges.count() + 2 * g.vertices.count()
    assert {(r.src, r.dst) for r in g.keys.collect()} == {(r.src, r.dst) for r in e.collect()}
    path = g.index_path.removeprefix("file:")
    import os
    assert os.path.isdir(path)
    g.unpersist()
    assert not os.path.exists(path)


def test_written_tables_leave_no_shuffle_files(spark, karate):
    import os
    from rambler.session import materialize

    def files():
        dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f for d in dirs for _, _, names in os.walk(str(d)) for f in names if f.startswith("shuffle_")}

    g = build_graph(karate)
    before = files()
    shuffled = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    assert materialize(shuffled, "shuffled").count() == 7
    walks = random_walk(g, WalkParams(walk_length=3, num_walks=1, p=0.5, q=2.0, seed=3))
    # but for one small shuffle a turn, which counts the walkers that are left
    assert len(files() - before) <= 4 * (walks.turns + 2)
    g.unpersist()
