"""The three jobs of the modelled system as pipeline functions.

Outputs go under ``params.output``: ``path`` (walks as text), ``report`` (W10), ``vec``
(vectors as text), ``bin`` (the Word2Vec model), ``id_map`` and ``properties`` (Parquet).
``single_output`` and ``output_partitions`` hold for every text and table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from rambler.operators import contacts as C, graph as G
from rambler.operators.embed import name_vectors, path_tokens, train_vectors
from rambler.operators.walk import build_graph, random_walk, walk_report
from rambler.params import JobParams
from rambler.session import materialize
from rambler.sources import text as X


def build_contact_graph(contacts: DataFrame, users: DataFrame, params: JobParams):
    """Pairs → degree range → dense ids → indexed edges; returns ``(edges, id_map, counts)``."""
    gp = params.graph
    # written once: two degree tables, two semi joins and the id replacement read it
    pairs = materialize(C.phone_pairs(contacts, users, gp.contact_start, gp.contact_end, gp.user_date,
                                      gp.region_ids), "pairs")
    vin = G.vertices_in_degree_range(pairs, gp.min_out_degree, gp.max_out_degree,
                                     gp.min_in_degree, gp.max_in_degree)
    id_map = G.dense_ids(vin)
    edges = G.edges_from_pairs(G.indexed_pairs(pairs, id_map))
    counts = G.graph_counts(id_map, G.pairs_in_degree_range(pairs, vin))
    return edges, id_map, counts


def _write(df: DataFrame, params: JobParams, name: str, write=X.write_table, **kw) -> None:
    write(df, os.path.join(params.output, name), single_output=params.single_output, partitions=params.output_partitions, **kw)


def walk_job(spark: SparkSession, edges: DataFrame, params: JobParams) -> DataFrame:
    """Walks written as tab-joined lines under ``output/path``, and their report.

    With ``params.resume`` the walk's turns are kept under ``output/turns``: started again after its
    driver was lost, the job goes on from the last whole one.
    """
    g = build_graph(edges, directed=params.walk.directed, partitions=params.walk.partitions)
    walks = random_walk(g, params.walk, resume=os.path.join(params.output, "turns") if params.resume else None)
    _write(walks.paths, params, "path", X.write_paths)
    _write(walk_report(walks, g.edges, g.vertices, params.walk.num_walks, params.walk.walk_length), params, "report")
    g.unpersist()       # the walks are written; training needs the memory
    return walks.paths


def embedding_job(spark: SparkSession, params: JobParams, id_map: DataFrame | None = None) -> DataFrame:
    """Walk series (text) → Word2Vec → vectors, named through the id map (given, or saved at ``params.id_map``)."""
    if id_map is None and params.id_map:
        id_map = spark.read.parquet(params.id_map)
    series = materialize(X.read_walk_series(spark, params.input, params.output_partitions), "series")
    return _save_model_outputs(series, params, id_map)


def node2vec_job(spark: SparkSession, edges: DataFrame, params: JobParams,
                 id_map: DataFrame | None = None) -> DataFrame:
    """E5: walks → Word2Vec → vectors; everything written under ``params.output``."""
    paths = walk_job(spark, edges, params)
    return _save_model_outputs(path_tokens(paths), params, id_map)


def _save_model_outputs(tokens: DataFrame, params: JobParams, id_map: DataFrame | None) -> DataFrame:
    """``bin`` holds Spark ML's model, or the vectors as a table if they were trained by buckets."""
    vecs, model = train_vectors(tokens, params.w2v)
    if model is not None:
        model.write().overwrite().save(os.path.join(params.output, "bin"))     # K3
    else:
        vecs.write.mode("overwrite").parquet(os.path.join(params.output, "bin"))
    if id_map is not None:                                                      # J5
        vecs = name_vectors(vecs, id_map).select(F.col("phone_number").alias("key"), "vector")
    _write(vecs, params, "vec", X.write_vectors)                                # K2
    return vecs


def _saved_contact_graph(spark: SparkSession, contacts: DataFrame, users: DataFrame, params: JobParams):
    """The contact graph's edges, and its id map as saved and read again (so ids can't change)."""
    edges, id_map, counts = build_contact_graph(contacts, users, params)
    _write(id_map, params, "id_map")                                            # K4
    _write(counts, params, "properties")                                        # K5
    return edges, spark.read.parquet(os.path.join(params.output, "id_map"))


def contact_node2vec_job(spark: SparkSession, contacts: DataFrame, users: DataFrame, params: JobParams) -> DataFrame:
    """The full main program: contact graph → id map + properties → node2vec → named vectors."""
    edges, id_map = _saved_contact_graph(spark, contacts, users, params)
    return node2vec_job(spark, edges, params, id_map)


def edge_list_edges(spark: SparkSession, params: JobParams) -> DataFrame:
    """The edge list at ``params.input``; a missing or unparsable part of a partitioned list is drawn.

    Spark places rows by the keys of its joins, so a part is data here: it doesn't move the edges.
    """
    edges = X.read_edge_list(spark, params.input, params.weighted, params.partitioned)
    if params.partitioned:
        edges = G.edge_partitions(edges, params.edge_parts, params.walk.seed, part_col="part")
    return edges


def run_job(spark: SparkSession, params: JobParams, contacts: DataFrame | None = None,
            users: DataFrame | None = None) -> DataFrame:
    """Dispatch on ``params.cmd``: ``node2vec``, ``walk`` or ``embedding``.

    ``node2vec`` and ``walk`` read the edge list at ``params.input`` when it is set
    (``weighted`` / ``partitioned`` say which columns it has), else build the graph from
    the contact log and the user snapshot.  ``embedding`` reads the walk series at
    ``params.input``.  Returns the vectors (node2vec, embedding) or the paths (walk).
    """
    if params.cmd == "embedding":
        return embedding_job(spark, params)
    if params.cmd not in ("node2vec", "walk"):
        raise ValueError(f"unknown cmd {params.cmd!r}")
    if params.input:
        edges = edge_list_edges(spark, params)
        if params.partitioned:
            _write(G.partition_balance(G.parted_orient(edges, params.walk.directed)), params, "balance")
        edges = edges.select("src", "dst", "w")
        return walk_job(spark, edges, params) if params.cmd == "walk" else node2vec_job(spark, edges, params)
    if contacts is None or users is None:
        raise ValueError("either params.input (an edge list) or contacts and users are needed")
    if params.cmd == "walk":
        return walk_job(spark, _saved_contact_graph(spark, contacts, users, params)[0], params)
    return contact_node2vec_job(spark, contacts, users, params)
