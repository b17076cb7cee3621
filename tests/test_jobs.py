"""The three jobs end to end on sf0.001 (outputs written, read back, consistent)."""

import os

from pyspark.sql import functions as F

from rambler.params import GraphParams, JobParams, WalkParams, Word2VecParams
from rambler.plans import jobs
from rambler.sources import derived as D, text as X

SF = "/root/testdata/sf0.001"


def _params(out, **kw):
    return JobParams(graph=GraphParams(contact_start="1995-01-01", contact_end="2001-12-31", user_date="2024-01-01",
                                       min_out_degree=1, max_out_degree=1000, min_in_degree=1, max_in_degree=1000),
                     walk=WalkParams(walk_length=4, num_walks=1, p=0.5, q=2.0, seed=5),
                     w2v=Word2VecParams(dim=8, window=3, iterations=1, max_sentence_length=6),
                     output=out, **kw)


def test_contact_node2vec_job(spark, tmp_path):
    out = str(tmp_path / "n2v")
    p = _params(out)
    vecs = jobs.contact_node2vec_job(spark, D.contact_log(spark, SF), D.user_snapshot(spark, SF), p)
    for sub in ("path", "vec", "bin", "id_map", "properties"):
        assert os.path.isdir(os.path.join(out, sub)), sub
    ids = spark.read.parquet(os.path.join(out, "id_map"))
    props = spark.read.parquet(os.path.join(out, "properties")).collect()[0]
    assert props.node_count == ids.count()
    # every vector is named by a phone of the id map, with dim entries
    v = X.read_vectors(spark, os.path.join(out, "vec"))
    assert v.count() == vecs.count() > 0
    assert v.join(ids, v.number == ids.phone_number, "left_anti").count() == 0
    assert {len(r.vector) for r in v.collect()} == {8}


def test_embedding_job_reads_walk_series(spark, tmp_path):
    out = str(tmp_path / "rw")
    p = _params(out)
    paths = jobs.walk_job(spark, D.events_edges(spark, SF), p)
    series = os.path.join(out, "path")
    emb = jobs.embedding_job(spark, _params(str(tmp_path / "emb"), input=series, output_partitions=2))
    vocab = paths.select(F.explode(F.col("path").cast("array<string>")).alias("key")).distinct()
    assert sorted(r.key for r in emb.collect()) == sorted(r.key for r in vocab.collect())


def test_run_job_dispatch_on_edge_list(spark, tmp_path):
    from dataclasses import replace
    from karate import KARATE_LINES
    src = tmp_path / "karate.txt"
    src.write_text("\n".join(f"{x} 1" for x in KARATE_LINES) + "\n")       # "src dst w" lines
    out = str(tmp_path / "run")
    base = replace(_params(out), input=str(src), weighted=True)
    paths = jobs.run_job(spark, replace(base, cmd="walk"))
    assert paths.count() == 34
    vecs = jobs.run_job(spark, replace(base, cmd="node2vec", output=str(tmp_path / "n2v")))
    assert vecs.count() == 34
    emb = jobs.run_job(spark, replace(base, cmd="embedding", input=os.path.join(out, "path"),
                                      output=str(tmp_path / "emb")))
    assert emb.count() == 34


def test_partitioned_edge_list_with_header_and_bad_lines(spark, tmp_path):
    from dataclasses import replace
    src = tmp_path / "edges.txt"
    src.write_text("# FromNodeId ToNodeId\n\n1 2 0\n2 3 x\n3 1\nnonsense line\n3 4 1\n")
    job = replace(_params(str(tmp_path / "run")), input=str(src), weighted=False, partitioned=True, cmd="walk", edge_parts=3)
    edges = {(r.src, r.dst): r.part for r in jobs.edge_list_edges(spark, job).collect()}
    assert set(edges) == {(1, 2), (2, 3), (3, 1), (3, 4)} and edges[1, 2] == 0 and edges[3, 4] == 1
    assert all(0 <= p < 3 for p in edges.values())       # missing and unparsable parts are drawn
    assert jobs.run_job(spark, job).count() == 4
    counts = X.edge_line_counts(spark.read.text(str(src))).first()
    assert tuple(counts) == (7, 4, 1, 2)
    report = spark.read.parquet(os.path.join(job.output, "report")).first()
    assert (report.paths, report.expected_paths, report.invalid_steps) == (4, 4, 0)


def test_embedding_job_names_vectors_by_a_saved_id_map(spark, tmp_path):
    (tmp_path / "walks.txt").write_text("0 1 2\n2 1 0\n")
    ids = str(tmp_path / "ids")
    spark.createDataFrame([("p0", 0), ("p1", 1), ("p2", 2)], "phone_number string, id long").write.parquet(ids)
    job = _params(str(tmp_path / "emb"), cmd="embedding", input=str(tmp_path / "walks.txt"), id_map=ids)
    assert sorted(r.key for r in jobs.run_job(spark, job).collect()) == ["p0", "p1", "p2"]


def test_vocabulary_bound(spark):
    import pytest
    from rambler.operators.embed import fit_word2vec
    tokens = spark.createDataFrame([(["1", "2", "3"],)], "tokens array<string>")
    with pytest.raises(ValueError, match="max_vocabulary_bytes"):
        fit_word2vec(tokens, Word2VecParams(dim=4, max_vocabulary_bytes=64))


def test_one_file_is_written_after_a_shuffle(spark):
    from rambler.sources.text import _files
    df = spark.range(100).groupBy((F.col("id") % 7).alias("k")).agg(F.collect_list("id").alias("ids"))
    plan = _files(df, True, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce 1" not in plan and "REPARTITION_BY_NUM" in plan
    assert not JobParams().single_output
