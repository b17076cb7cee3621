"""Phone normalisation, contact pipeline pieces, text sources and sinks, similarity."""

import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from rambler.functions.phone import normalize_phone
from rambler.operators import contacts as C, graph as G, similarity as S
from rambler.sources import text as X

PHONES = [("13912345678", "13912345678"), ("8613912345678", "13912345678"),
          ("00008613912345678", "13912345678"), ("086139123456789", ""), ("12912345678", ""),
          ("+8613912345678", ""), ("013912345678", ""), ("13912345678\n", ""), (" 13912345678", ""),
          ("", ""), (None, None)]


def test_phone_edge_cases(spark):
    df = spark.createDataFrame([(a,) for a, _ in PHONES], "p string")
    got = [r.n for r in df.select(normalize_phone("p").alias("n")).collect()]
    assert got == [b for _, b in PHONES]


def test_region_filter_is_substring(spark):
    u = spark.createDataFrame([(1, "1,2"), (2, "12,3"), (3, "4,5")], "id long, region_ids string")
    assert sorted(r.id for r in C.users_in_regions(u, ["1"]).collect()) == [1, 2]
    assert C.users_in_regions(u, None).count() == 3


def test_degree_range_upper_bound_exclusive(spark):
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "c")], "src_number string, dest_number string")
    assert {r.phone_number for r in G.out_degree_in_range(pairs, 1, 2).collect()} == {"b"}
    assert {r.phone_number for r in G.out_degree_in_range(pairs, 1, 3).collect()} == {"a", "b"}


def test_edge_list_forms(spark):
    lines = spark.createDataFrame([("1 2",), ("1 3 2.5",), ("2 3 x",), ("", )], "value string")
    got = sorted(tuple(r) for r in X.parse_edge_lines(lines).select("src", "dst", "w").collect())
    assert got == [(1, 2, 1.0), (1, 3, 2.5), (2, 3, 1.0)]
    four = spark.createDataFrame([("1 2 7 3.0",), ("1 3 5",)], "value string")
    got = sorted(tuple(r) for r in X.parse_edge_lines(four, partitioned=True).collect())
    assert got == [(1, 2, 3.0, 7), (1, 3, 1.0, 5)]


def test_text_sinks_round_trip(spark):
    out = tempfile.mkdtemp(prefix="rambler-io-", dir="/tmp")
    paths = spark.createDataFrame([(0, 1, [1, 2, 3]), (0, 4, [4])], "rnd int, v0 long, path array<long>")
    X.write_paths(paths, os.path.join(out, "path"), single_output=True)
    assert len([f for f in os.listdir(os.path.join(out, "path")) if f.startswith("part-")]) == 1   # K6
    back = X.read_walk_series(spark, os.path.join(out, "path"))
    assert sorted(list(r.tokens) for r in back.collect()) == [["1", "2", "3"], ["4"]]
    vec = spark.createDataFrame([("a", [1.0, 0.5]), ("b", [0.25, -2.0])], "key string, vector array<double>")
    X.write_vectors(vec, os.path.join(out, "vec"), single_output=False, partitions=2)
    got = {r.number: list(r.vector) for r in X.read_vectors(spark, os.path.join(out, "vec")).collect()}
    assert got == {"a": [1.0, 0.5], "b": [0.25, -2.0]}


def test_cosine_and_top_n(spark):
    vec = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0]), ("c", [0.0, 1.0]), ("z", [0.0, 0.0])],
                                "key string, vector array<double>")
    top = S.top_n_similar(vec.where("key != 'z'"), "a", 1).collect()
    assert [r.key for r in top] == ["a", "b"] and top[0].cos == pytest.approx(1.0)
    # a zero vector's NaN ranks above every number in descending order (Double.compare order)
    assert [r.key for r in S.top_n_similar(vec, "a", 1).collect()] == ["z", "a"]
    z = S.pair_similarity(vec, spark.createDataFrame([("a", "z")], "k1 string, k2 string")).collect()[0]
    assert math.isnan(z.cos)
    assert [r.key for r in S.missing_keys(vec, spark.createDataFrame([("q",), ("a",)], "key string")).collect()] == ["q"]
    with pytest.raises(Exception):
        S.top_n_similar(vec, "missing", 1).collect()
