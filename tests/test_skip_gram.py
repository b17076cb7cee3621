"""Skip-gram by buckets: pairs, reproducibility, and what the vectors know."""

from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from rambler.operators.embed import path_tokens, train_vectors
from rambler.operators.skip_gram import context_pairs, embedding_quality, fit_skip_gram
from rambler.operators.walk import build_graph, random_walk
from rambler.params import WalkParams, Word2VecParams

PARAMS = Word2VecParams(dim=16, window=3, iterations=8, trainer="buckets", buckets=3, seed=5)


def test_pairs_within_the_window(spark, monkeypatch):
    import rambler.operators.skip_gram as M
    monkeypatch.setattr(M, "SENTENCE_PIECE", 7)     # sentences in several pieces
    sentences = [[f"w{i * i % 11}" for i in range(n)] for n in (0, 1, 2, 5, 30)] + [["a", None, "b", "a"]]
    want = Counter()
    for s in sentences:
        s = [w for w in s if w is not None]
        for i in range(len(s)):
            for j in range(i + 1, min(len(s), i + 4)):
                want[s[i], s[j]] += 1
                want[s[j], s[i]] += 1
    got = Counter()
    for r in context_pairs(spark.createDataFrame([(s,) for s in sentences], "tokens array<string>"), 3).collect():
        got[r.word, r.other] += r.n
    assert got == want


@pytest.fixture(scope="module")
def walked(spark, karate):
    g = build_graph(karate)
    paths = random_walk(g, WalkParams(walk_length=20, num_walks=10, seed=2)).paths
    g.unpersist()
    return path_tokens(paths)


def vectors(df):
    return {r.key: tuple(r.vector) for r in df.collect()}


def test_same_vectors_on_any_partitions(spark, walked):
    found = []
    for n in (1, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        found.append(vectors(fit_skip_gram(walked.repartition(n), PARAMS)))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1] and set(found[0]) == {str(i) for i in range(1, 35)}
    assert vectors(fit_skip_gram(walked, replace(PARAMS, seed=6))) != found[0]


@pytest.mark.parametrize("buckets", [1, 4])
def test_neighbours_are_closer_than_others(spark, walked, karate, buckets):
    v = {int(k): np.array(x) / np.linalg.norm(x) for k, x in vectors(fit_skip_gram(walked, replace(PARAMS, iterations=15, buckets=buckets))).items()}
    edges = {(r.src, r.dst) for r in karate.collect()}
    near, far = [], []
    for a in v:
        for b in v:
            if a < b:
                (near if (a, b) in edges or (b, a) in edges else far).append(v[a] @ v[b])
    assert np.mean(near) > np.mean(far) + 0.1


def test_a_vocabulary_beyond_the_driver_goes_to_buckets(spark, walked):
    params = Word2VecParams(dim=8, window=2, iterations=1, max_vocabulary_bytes=64)
    found, model = train_vectors(walked, params)
    assert model is None and found.count() == 34
    row = embedding_quality(found, walked, 8).first()
    assert (row.words, row.dim, row.finite) == (34, 8, 34)
    with pytest.raises(ValueError, match="max_vocabulary_bytes"):
        train_vectors(walked, replace(params, trainer="driver"))


def test_rare_words_and_empty_tables(spark):
    tokens = spark.createDataFrame([(["a", "b", "a", "b", "rare"],), (["a"],), ([],), (None,)], "tokens array<string>")
    assert set(vectors(fit_skip_gram(tokens, replace(PARAMS, min_count=2, buckets=5)))) == {"a", "b"}
    assert fit_skip_gram(tokens.limit(0), PARAMS).count() == 0
    assert fit_skip_gram(tokens, replace(PARAMS, min_count=9)).count() == 0


def test_the_node2vec_job_trains_by_buckets(spark, karate, tmp_path):
    from rambler.params import JobParams
    from rambler.plans.jobs import node2vec_job
    job = JobParams(walk=WalkParams(walk_length=4, num_walks=1, seed=5), w2v=replace(PARAMS, iterations=1), output=str(tmp_path), output_partitions=2)
    assert node2vec_job(spark, karate, job).count() == 34
    assert spark.read.parquet(str(tmp_path / "bin")).select(F.size("vector")).distinct().first()[0] == 16


def test_a_driver_without_room_for_the_words_goes_to_buckets(spark, walked, monkeypatch):
    """The matrices of 34 words take 2,176 bytes, the words on Spark ML's driver 62,152."""
    from rambler.operators import embed
    params = Word2VecParams(dim=8, window=2, iterations=1, max_vocabulary_bytes=4096)
    assert embed.driver_room(spark) <= 1 << 30      # the default bound of what tasks send
    found, model = train_vectors(walked, params)
    assert model is not None and found.count() == 34
    monkeypatch.setattr(embed, "driver_room", lambda spark: 40_000)
    found, model = train_vectors(walked, params)
    assert model is None and found.count() == 34
    assert train_vectors(walked, replace(params, trainer="driver"))[1] is not None


def test_a_large_vocabulary_is_the_work_of_many_tasks(spark, walked, monkeypatch):
    import rambler.operators.skip_gram as M
    params = replace(PARAMS, iterations=1, buckets=None)
    monkeypatch.setattr(M, "BUCKET_WORDS", 10)
    assert vectors(fit_skip_gram(walked, params)) == vectors(fit_skip_gram(walked, replace(params, buckets=4)))
