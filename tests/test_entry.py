"""The driver contract and the embedding step."""

import __spark_entry__ as ent


def test_queries_have_oracles(spark):
    from rambler.plans.oracle import ORACLE
    from rambler.plans.queries import QUERIES
    assert set(ORACLE) == set(QUERIES)
    assert set(ent.oracle_sql()) <= set(ent.queries()) and set(QUERIES) <= set(ent.queries())


def test_entry_smoke(spark):
    df = ent.entry(spark)
    rows = df.collect()
    assert df.columns == ["key", "vector"] and len(rows) > 0
    assert all(len(r.vector) == 16 for r in rows)


def test_embedding_vocabulary_and_model_reload(spark, tmp_path):
    from pyspark.ml.feature import Word2VecModel
    from rambler.operators.embed import fit_word2vec, model_vectors
    from rambler.params import Word2VecParams
    tokens = spark.createDataFrame([(["1", "2", "3"],), (["3", "4"],)], "tokens array<string>")
    m = fit_word2vec(tokens, Word2VecParams(dim=4, window=2, iterations=1))
    v = model_vectors(m)
    assert sorted(r.key for r in v.collect()) == ["1", "2", "3", "4"]
    m.write().overwrite().save(str(tmp_path / "bin"))
    again = model_vectors(Word2VecModel.load(str(tmp_path / "bin")))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, v.collect()))
