"""Degree filters, dense ids, edge building and graph statistics.

Every aggregation here is a ``groupBy`` with map-side partial aggregation; joins on
the (unique) phone keys are plain equi-joins, left to AQE to choose and split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rambler.functions.draws import draw
from rambler.functions.weights import EXPONENT, from_units, unit_exponent, unit_sum_limit, weight_units
from rambler.operators.ordering import global_rank, segmented_cumsum


# ---------------------------------------------------------------- degrees

def out_degree_in_range(pairs: DataFrame, lo: int, hi: int) -> DataFrame:
    """A2: ``(phone_number, out_degree)`` with ``lo <= out_degree < hi`` (upper bound exclusive)."""
    return (pairs.groupBy(F.col("src_number").alias("phone_number"))
            .agg(F.count(F.lit(1)).alias("out_degree"))
            .where((F.col("out_degree") >= lo) & (F.col("out_degree") < hi)))


def in_degree_in_range(pairs: DataFrame, lo: int, hi: int) -> DataFrame:
    """A3: ``(phone_number, in_degree)`` with ``lo <= in_degree < hi``."""
    return (pairs.groupBy(F.col("dest_number").alias("phone_number"))
            .agg(F.count(F.lit(1)).alias("in_degree"))
            .where((F.col("in_degree") >= lo) & (F.col("in_degree") < hi)))


def degree_histogram(degrees: DataFrame, col: str) -> DataFrame:
    """A4/A5: ``(<col>, total_num)`` = number of vertices per degree value."""
    return degrees.groupBy(col).agg(F.count(F.lit(1)).alias("total_num"))


def vertices_in_degree_range(pairs: DataFrame, min_out: int, max_out: int,
                             min_in: int, max_in: int) -> DataFrame:
    """Phones whose out-degree and in-degree are both in range."""
    o = out_degree_in_range(pairs, min_out, max_out)
    i = in_degree_in_range(pairs, min_in, max_in)
    return i.join(o, "phone_number").select("phone_number")


def pairs_in_degree_range(pairs: DataFrame, vertices: DataFrame) -> DataFrame:
    """Pairs whose two ends are in range (keys unique, so two semi joins)."""
    v = vertices.select("phone_number")
    return (pairs.join(v, pairs.src_number == v.phone_number, "left_semi")
            .join(v, pairs.dest_number == v.phone_number, "left_semi"))


# ---------------------------------------------------------------- ids

def dense_ids(vertices: DataFrame, key: str = "phone_number") -> DataFrame:
    """A1: ``(key, id)`` with ids 0..n-1 in key order.

    Deterministic (unlike ``zipWithIndex`` over shuffle output), so the id map can be
    saved and re-joined later.  Range partitioned: no single-partition window.
    """
    return global_rank(vertices.select(key), [key], "id")


def extend_ids(saved: DataFrame, vertices: DataFrame, key: str = "phone_number") -> DataFrame:
    """A1/K4 for a later run: ``saved`` (key, id) as it is, and new keys of ``vertices`` after its largest id.

    New keys are ranked by range among themselves, so ids stay dense if ``saved``'s were, and a key
    never changes its id.  Keys that ``vertices`` no longer has keep theirs.
    """
    known = saved.select(key, F.col("id").cast("bigint").alias("id"))
    new = vertices.select(key).distinct().join(known, key, "left_anti")
    first = known.agg((F.coalesce(F.max("id"), F.lit(-1)) + 1).alias("n")).first()["n"]
    return known.unionByName(dense_ids(new, key).withColumn("id", F.col("id") + F.lit(first)))


def indexed_pairs(pairs: DataFrame, id_map: DataFrame) -> DataFrame:
    """Replace both phones by their ids (inner joins drop pairs with an unknown end)."""
    src = id_map.select(F.col("phone_number").alias("src_number"), F.col("id").alias("src_number_id"))
    dst = id_map.select(F.col("phone_number").alias("dest_number"), F.col("id").alias("dest_number_id"))
    return pairs.join(src, "src_number").join(dst, "dest_number").select("src_number_id", "dest_number_id")


def graph_counts(id_map: DataFrame, pairs_in_range: DataFrame) -> DataFrame:
    """A7 (+ K5 content): node count = id-map rows, edge count = in-range pairs (not distinct)."""
    e = pairs_in_range.select(F.count(F.lit(1))).scalar()   # scalar subquery, one value
    return id_map.agg(F.count(F.lit(1)).alias("node_count")).select("node_count", e.alias("edge_count"))


# ---------------------------------------------------------------- graph building

def edges_from_pairs(indexed: DataFrame) -> DataFrame:
    """Indexed pairs as an unweighted edge list ``(src, dst, w = 1.0)``."""
    return indexed.select(F.col("src_number_id").alias("src"), F.col("dest_number_id").alias("dst"),
                          F.lit(1.0).alias("w"))


def orient(edges: DataFrame, directed: bool) -> DataFrame:
    """Undirected graphs store both directions; parallel edges are kept (not deduplicated)."""
    e = edges.select("src", "dst", F.coalesce(F.col("w").cast("double"), F.lit(1.0)).alias("w"))
    if directed:
        return e
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))


def graph_vertices(edges: DataFrame, directed: bool) -> DataFrame:
    """Every vertex, sinks of a directed graph included."""
    e = orient(edges, directed)
    return e.select(F.col("src").alias("v")).unionByName(e.select(F.col("dst").alias("v"))).distinct()


def merge_parallel(edges: DataFrame, exponent: int = EXPONENT) -> DataFrame:
    """Parallel edges summed (exactly) into one ``(src, dst)`` row; a pick among copies is a pick of the sum."""
    return edges.groupBy("src", "dst").agg(from_units(F.sum(weight_units("w", exponent)), exponent).alias("w"))


def merged_edges(edges: DataFrame, write) -> tuple[DataFrame, int]:
    """``merge_parallel`` in units that fit the weights, written by ``write``, and their exponent.

    Weights are first added up in the usual units, beside what tells whether these fit (the least weight,
    and plain sums); only a graph that needs others is added up again.
    """
    w = F.col("w").cast("double")
    usual = F.round(w * F.lit(10.0**EXPONENT)).try_cast("bigint")
    merged = write(edges.groupBy("src", "dst").agg(from_units(F.try_sum(usual)).alias("w"), F.min(F.when(w > 0, w)).alias("least"), F.sum(w).alias("about")))
    seen = merged.agg(F.min("least").alias("least"), F.sum("about").alias("all")).first()
    largest = seen["all"]       # bounds every vertex's sum, and mostly does
    if largest and unit_sum_limit(EXPONENT) <= largest:
        largest = merged.groupBy("src").agg(F.sum("about").alias("s")).agg(F.max("s")).first()[0]
    exponent = unit_exponent(seen["least"], largest)
    if exponent != EXPONENT:
        return write(merge_parallel(edges, exponent)), exponent
    return merged.drop("least", "about"), exponent


def adjacency(edges: DataFrame, vertices: DataFrame | None = None, block_size: int = 1024) -> DataFrame:
    """``(src, block, nbrs ARRAY<STRUCT<dst, w>>)``, parallel edges kept.

    A vertex's list, ordered by ``(dst, w)``, is cut into blocks of ``block_size`` entries
    (block 0 has the first ones), so the blocks in order are the list, and no group holds
    more than one block however large the hub.  A vertex of ``vertices`` (v) without an edge
    (a sink) has one empty block.
    """
    # equal entries are counted, so that places are sums over unique rows
    entries = edges.groupBy("src", "dst", "w").agg(F.count(F.lit(1)).alias("_m"))
    placed = segmented_cumsum(entries, "src", ["dst", "w"], "_m", before="_first", after="_last")
    first, last = F.floor(F.col("_first") / block_size), F.floor((F.col("_last") - 1) / block_size)
    blocks = placed.withColumn("block", F.explode(F.sequence(first, last)))
    inside = F.least("_last", (F.col("block") + 1) * block_size) - F.greatest("_first", F.col("block") * block_size)
    found = (blocks.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), inside)))
             .groupBy("src", "block").agg(F.array_sort(F.collect_list(F.struct("dst", "w"))).alias("nbrs")))
    if vertices is None:
        return found
    none = F.array().cast(found.schema["nbrs"].dataType)
    return (vertices.select(F.col("v").alias("src")).join(found, "src", "left")
            .select("src", F.coalesce("block", F.lit(0).cast("bigint")).alias("block"), F.coalesce("nbrs", none).alias("nbrs")))


def graph_stats(edges: DataFrame, directed: bool) -> DataFrame:
    """A10: vertex count and adjacency-entry count (parallel edges counted)."""
    n = orient(edges, directed).select(F.count(F.lit(1))).scalar()   # scalar subquery
    v = graph_vertices(edges, directed).agg(F.count(F.lit(1)).alias("vertices"))
    return v.select("vertices", n.alias("entries"))


def edge_partitions(edges: DataFrame, num_parts: int, seed: int = 0, part_col: str | None = None) -> DataFrame:
    """``(src, dst, w, part)``; the given part column, else a keyed draw in ``[0, n)``.

    Both directions of an undirected pair get the same part (drawn from the unordered pair).
    """
    lo, hi = F.least("src", "dst"), F.greatest("src", "dst")
    drawn = F.floor(draw(F.lit(seed), F.lit("part"), lo, hi) * num_parts).cast("int")
    part = F.coalesce(F.col(part_col).cast("int"), drawn) if part_col else drawn
    return edges.select("src", "dst", "w", part.alias("part"))


def degree_cut(edges: DataFrame, num_parts: int, seed: int = 0) -> DataFrame:
    """A11 by degree: ``(src, dst, w, part)``, the part drawn from the edge's end of lower degree (ties: the smaller id).

    A hub's edges spread over the parts of its neighbours, while a vertex of low degree has most of its
    edges in one part, so fewer vertices need copies than with parts drawn by pair.  Both directions of a
    pair get the same part.
    """
    degree = (edges.select(F.col("src").alias("v")).unionByName(edges.select(F.col("dst").alias("v")))
              .groupBy("v").agg(F.count(F.lit(1)).alias("n")))
    of = lambda end: degree.select(F.col("v").alias(end), F.col("n").alias(f"_{end}"))
    lower = F.when((F.col("_src") < F.col("_dst")) | ((F.col("_src") == F.col("_dst")) & (F.col("src") < F.col("dst"))), F.col("src")).otherwise(F.col("dst"))
    part = F.floor(draw(F.lit(seed), F.lit("part"), lower) * num_parts).cast("int")
    return edges.select("src", "dst", "w").join(of("src"), "src").join(of("dst"), "dst").select("src", "dst", "w", part.alias("part"))


def parted_orient(parted: DataFrame, directed: bool) -> DataFrame:
    """A8 for a partitioned edge list: the reversed entry keeps the part."""
    if directed:
        return parted
    return parted.unionByName(parted.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w", "part"))


def vertex_home_partition(parted: DataFrame) -> DataFrame:
    """One home part per vertex (the smallest it touches; deterministic)."""
    return parted.groupBy(F.col("src").alias("v")).agg(F.min("part").alias("part"))


def partition_balance(parted: DataFrame) -> DataFrame:
    """Per part, distinct vertices held (replicas) and links."""
    return parted.groupBy("part").agg(F.count_distinct("src").alias("replicas"),
                                      F.count(F.lit(1)).alias("links"))


def replication_factor(parted: DataFrame) -> DataFrame:
    """A13 summary: Σ replicas over parts, distinct vertices, and their ratio."""
    reps = parted.select("src", "part").distinct().select(F.count(F.lit(1))).scalar()
    return (parted.agg(F.count_distinct("src").alias("vertices"))
            .select(reps.alias("replicas"), "vertices",
                    F.round(reps / F.col("vertices"), 6).alias("factor")))


def vertex_replicas(parted: DataFrame) -> DataFrame:
    """``(part, v, dst, w)``: every part that a vertex touches has a copy of all its neighbours."""
    copies = parted.select(F.col("src").alias("v"), "part").distinct()
    return copies.join(parted.select(F.col("src").alias("v"), "dst", "w"), "v").select("part", "v", "dst", "w")


def neighbors_of(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """``(v, dst, w)`` for each requested vertex; a sink (or unknown vertex) gets one null row."""
    return vertices.select("v").join(edges, F.col("v") == F.col("src"), "left").select("v", "dst", "w")
