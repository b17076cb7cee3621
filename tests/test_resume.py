"""Walks that go on after their driver was lost."""

import pytest

from rambler.operators import walk as W
from rambler.params import WalkParams
from rambler.session import scratch_path


def paths(result):
    return {(r.rnd, r.v0): r.path for r in result.paths.collect()}


@pytest.mark.parametrize("sampler", ["rejection", "cdf"])
def test_a_killed_walk_goes_on_from_its_last_turn(spark, karate, monkeypatch, sampler):
    params = WalkParams(walk_length=5, num_walks=1, p=0.5, q=2.0, seed=8, sampler=sampler)
    g = W.build_graph(karate)
    whole = W.random_walk(g, params)
    state = scratch_path(spark, "turns")
    calls = []
    for name in ("rejection_step", "prefix_step"):
        def step(*a, _f=getattr(W, name), **kw):
            calls.append(1)
            if len(calls) == 4:
                raise KeyboardInterrupt     # as if the driver were lost in its fourth turn
            return _f(*a, **kw)
        monkeypatch.setattr(W, name, step)
    with pytest.raises(KeyboardInterrupt):
        W.random_walk(g, params, resume=state)
    rest = W.random_walk(g, params, resume=state)
    assert paths(rest) == paths(whole) and rest.turns == whole.turns - 3
    again = W.random_walk(g, params, resume=state)
    assert again.turns == 0 and paths(again) == paths(whole)
    with pytest.raises(ValueError, match="another walk"):
        W.random_walk(g, WalkParams(walk_length=5, num_walks=1, seed=9), resume=state)
    g.unpersist()
