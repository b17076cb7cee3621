"""Tables laid out by date, ids that last, and parts by degree."""

import pytest
from pyspark.sql import functions as F

from rambler.operators import graph as G
from rambler.sources.tables import on_days, read_dates, write_by_date


def _files_read(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numFiles").value()


@pytest.mark.parametrize("unit", ["day", "month"])
def test_only_the_ranges_folders_are_read(spark, tmp_path, unit):
    path = str(tmp_path / unit)
    log = spark.range(400).select(F.col("id").alias("user_id"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("dt"))
    write_by_date(log, path, unit=unit)
    all_, some = read_dates(spark, path, unit=unit), read_dates(spark, path, "2020-01-05", "2020-01-09", unit=unit)
    assert all_.count() == 400 and some.count() == 20 and all_.select("user_id", "dt").exceptAll(log).isEmpty()
    assert _files_read(some) == (5 if unit == "day" else 1) < _files_read(all_)
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: ["):]
    assert ("dt" if unit == "day" else "month") in filters[: filters.index("]")] and "2020" in filters[: filters.index("]")]
    days = spark.createDataFrame([("2020-01-07", 1), ("2020-03-01", 0)], "d string, ok int").filter("ok = 1").select(F.to_date("d").alias("dt"))
    found = on_days(all_, days, unit=unit)
    assert found.count() == 4 and "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()


def test_ids_last(spark):
    named = lambda *names: spark.createDataFrame([(n,) for n in names], "phone_number string")
    first = G.dense_ids(named("b", "d", "f"))
    second = G.extend_ids(first, named("a", "b", "e", "z", "f", "a"))
    assert {r.phone_number: r.id for r in second.collect()} == {"b": 0, "d": 1, "f": 2, "a": 3, "e": 4, "z": 5}
    assert {r.phone_number: r.id for r in G.extend_ids(second, named("c", "d")).collect()}["c"] == 6
    assert {r.phone_number: r.id for r in G.extend_ids(first.limit(0), named("x", "w")).collect()} == {"w": 0, "x": 1}


def test_a_cut_by_degree_copies_fewer_vertices(spark):
    hubs = spark.range(2000).select((F.col("id") % 5).alias("src"), (F.col("id") % 701 + 100).alias("dst"), F.lit(1.0).alias("w")).distinct()
    by_degree = G.parted_orient(G.degree_cut(hubs, 8, 3), directed=False)
    drawn = G.parted_orient(G.edge_partitions(hubs, 8, 3), directed=False)
    assert by_degree.count() == drawn.count()
    assert G.replication_factor(by_degree).first().factor < 0.7 * G.replication_factor(drawn).first().factor
    pairs = {(r.src, r.dst): r.part for r in by_degree.collect()}
    assert all(pairs[b, a] == p for (a, b), p in pairs.items())
