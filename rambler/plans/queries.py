"""The query catalogue: one builder per operator, over the whole test tables.

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame whose columns are named
exactly like those of the matching SQL in ``rambler.plans.oracle``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.feature import Word2VecModel
from pyspark.sql import DataFrame, functions as F

from rambler.functions.draws import draw
from rambler.functions.phone import normalize_phone
from rambler.functions.vectors import cosine, dot, norm
from rambler.operators import contacts as C, graph as G, similarity as S
from rambler.operators.embed import fit_word2vec, model_vectors, name_vectors, path_tokens
from rambler.operators.sampling import second_order_sample, second_order_weights, weighted_sample
from rambler.operators.skip_gram import embedding_quality, fit_skip_gram
from rambler.operators.similarity_batch import top_n_similar_batch
from rambler.operators.walk import build_graph, init_walkers, random_walk, walk_report
from rambler.params import JobParams, WalkParams, Word2VecParams
from rambler.plans import jobs
from rambler.session import materialize, scratch_path
from rambler.sources import derived as D, text as X
from rambler.sources.tables import on_days, read_dates, table, write_by_date

# Fixed query parameters (shared with the oracle SQL).
START, END, USER_DATE = "1996-01-01", "2000-12-31", D.USER_SNAPSHOT_DATE
EARLIER_END = "1999-06-30"  # of the first of two runs that share ids
BUSY_PRICE = 400_000        # days with an order above it
REGIONS = ("1", "7")
OUT_RANGE, IN_RANGE = (10, 50), (15, 45)
SEED, P, Q, L = 42, 0.5, 2.0, 6
PARTS = 4
TOPN_KEY, TOPN_N = "7", 5
BLOCK = 16
STITCHED_L = 10             # 11 moves: 8 + 2 + 1
TINY, LARGE = 1e-12, 1e11   # weights' scales that units of 1e-8 don't serve
W2V = Word2VecParams(dim=16, window=5, iterations=1)
BUCKET_EPOCHS = 5


# ---------------------------------------------------------------- shared inputs

def _pairs(spark, d):
    return C.phone_pairs(D.contact_log(spark, d), D.user_snapshot(spark, d), START, END, USER_DATE)


def _pairs_once(spark, d):
    """The pair table written once: degrees, semi joins and id replacement all read it."""
    return materialize(_pairs(spark, d), "pairs")


def _vertices_in_range(spark, d):
    return G.vertices_in_degree_range(_pairs_once(spark, d), *OUT_RANGE, *IN_RANGE)


def _id_map(spark, d):
    return G.dense_ids(_vertices_in_range(spark, d))


def _contact_edges(spark, d):
    pairs = _pairs_once(spark, d)
    vin = G.vertices_in_degree_range(pairs, *OUT_RANGE, *IN_RANGE)
    return G.edges_from_pairs(G.indexed_pairs(pairs, G.dense_ids(vin)))


def _walk_out(paths: DataFrame) -> DataFrame:
    return paths.select(F.col("rnd").cast("int").alias("rnd"), "v0",
                        F.array_join(F.col("path").cast("array<string>"), " ").alias("path"),
                        F.size("path").cast("bigint").alias("len"))


def _edges(spark, d, graph: str):
    if graph == "contacts":
        return _contact_edges(spark, d)
    if graph == "prices":
        return D.price_edges(spark, d)
    return D.events_edges(spark, d)


def _walk(spark, d, graph: str, directed: bool, rounds: int, sampler: str = "rejection",
          walk_length: int = L, edges=None, p: float = P, q: float = Q):
    g = build_graph(_edges(spark, d, graph) if edges is None else edges, directed=directed)
    walks = random_walk(g, WalkParams(walk_length=walk_length, num_walks=rounds, p=p, q=q, seed=SEED,
                                      sampler=sampler))
    g.unpersist()
    return walks


def _vectors(spark, d):
    return D.vectors_from_embeddings(spark, d)


def _emb_pairs(spark, d, gap: int):
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    o = e.select((F.col("vec_id") - gap).alias("vec_id"), F.col("vec_id").alias("id2"), F.col("x").alias("y"))
    return e.join(o, "vec_id").select(F.col("vec_id").alias("id1"), "id2", "x", "y")


# ---------------------------------------------------------------- S, P, K

def q_contacts_in_range(spark, d):
    return C.contacts_in_range(D.contact_log(spark, d), START, END)


def _log_by_month(spark, d):
    path = scratch_path(spark, "contact-log")
    write_by_date(D.contact_log(spark, d), path, unit="month")
    return path


def q_contacts_by_date(spark, d):
    """S1 from a table laid out by date: only the range's folders are read."""
    return read_dates(spark, _log_by_month(spark, d), START, END, unit="month").select("user_id", "phone_number", "dt")


def q_contacts_on_busy_days(spark, d):
    """S1 with the days given by another table: folders are pruned at run time."""
    busy = table(spark, d, "orders").filter(F.col("o_totalprice") > BUSY_PRICE).select(F.to_date("o_orderdate").alias("dt")).distinct()
    return on_days(read_dates(spark, _log_by_month(spark, d), unit="month"), busy, unit="month").select("user_id", "phone_number", "dt")


def q_users_snapshot(spark, d):
    return C.users_snapshot(D.user_snapshot(spark, d), USER_DATE).select("id", "mobile_number", "region_ids")


def q_edge_list_scan(spark, d):
    e = D.events_edges(spark, d)
    wtxt = F.when(F.col("w") > 3, F.lit("x")).otherwise(F.col("w").cast("bigint").cast("string"))
    lines = e.select(F.concat_ws(" ", F.col("src").cast("string"), F.col("dst").cast("string"), wtxt).alias("value"))
    return X.parse_edge_lines(lines, weighted=True, partitioned=False).select("src", "dst", "w")


def q_walk_series_scan(spark, d):
    lines = X.paths_as_lines(_walk(spark, d, "events", False, 1).paths, " ").select(F.col("line").alias("value"))
    t = X.parse_walk_lines(lines)
    return t.select(F.array_join("tokens", ",").alias("tokens"), F.size("tokens").cast("bigint").alias("n"))


def q_vector_text_scan(spark, d):
    lines = X.vectors_as_lines(_vectors(spark, d), sep=" ")
    v = X.parse_vector_lines(lines)
    return v.select("number", F.posexplode("vector").alias("i", "x")).select(
        "number", F.col("i").cast("bigint").alias("i"), "x")


def q_paths_as_lines(spark, d):
    return X.paths_as_lines(_walk(spark, d, "events", False, 1).paths).select(
        F.col("rnd").cast("int").alias("rnd"), "v0", "line")


def q_phone_normalize(spark, d):
    c = D.contact_log(spark, d)
    return c.select("user_id", "phone_number", normalize_phone("phone_number").alias("normalized"))


def q_users_in_regions(spark, d):
    return C.users_in_regions(D.user_snapshot(spark, d), REGIONS).select("id", "mobile_number", "region_ids")


def q_path_tokens(spark, d):
    tokens = path_tokens(_walk(spark, d, "events", False, 1).paths)
    return tokens.select(F.array_join("tokens", " ").alias("tokens"))


def q_vector_dot(spark, d):
    return _emb_pairs(spark, d, 1).select("id1", "id2", F.round(dot("x", "y"), 6).alias("dot"))


def q_vector_norm(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", F.round(norm(F.col("embedding").cast("array<double>")), 6).alias("norm"))


def q_cosine_pairs(spark, d):
    return _emb_pairs(spark, d, 1).select("id1", "id2", F.round(cosine("x", "y"), 6).alias("cos"))


# ---------------------------------------------------------------- joins, degrees, ids

def q_phone_pairs(spark, d):
    return _pairs(spark, d)


def q_distinct_contacts(spark, d):
    return C.distinct_contacts(C.contacts_in_range(D.contact_log(spark, d), START, END))


def q_out_degree_in_range(spark, d):
    return G.out_degree_in_range(_pairs(spark, d), *OUT_RANGE)


def q_in_degree_in_range(spark, d):
    return G.in_degree_in_range(_pairs(spark, d), *IN_RANGE)


def q_out_degree_histogram(spark, d):
    return G.degree_histogram(G.out_degree_in_range(_pairs(spark, d), *OUT_RANGE), "out_degree")


def q_in_degree_histogram(spark, d):
    return G.degree_histogram(G.in_degree_in_range(_pairs(spark, d), *IN_RANGE), "in_degree")


def q_vertices_in_degree_range(spark, d):
    return _vertices_in_range(spark, d)


def q_pairs_in_degree_range(spark, d):
    pairs = _pairs_once(spark, d)
    return G.pairs_in_degree_range(pairs, G.vertices_in_degree_range(pairs, *OUT_RANGE, *IN_RANGE))


def q_dense_ids(spark, d):
    return _id_map(spark, d)


def q_stable_ids(spark, d):
    """A1/K4 over two contact ranges: the second run keeps the first one's saved ids."""
    log, users = D.contact_log(spark, d), D.user_snapshot(spark, d)
    vertices = lambda end: G.vertices_in_degree_range(materialize(C.phone_pairs(log, users, START, end, USER_DATE), "pairs"), *OUT_RANGE, *IN_RANGE)
    saved = materialize(G.dense_ids(vertices(EARLIER_END)), "id-map")
    return G.extend_ids(saved, vertices(END))


def q_indexed_pairs(spark, d):
    pairs = _pairs_once(spark, d)
    vin = G.vertices_in_degree_range(pairs, *OUT_RANGE, *IN_RANGE)
    return G.indexed_pairs(pairs, G.dense_ids(vin))


def q_graph_counts(spark, d):
    pairs = _pairs_once(spark, d)
    vin = G.vertices_in_degree_range(pairs, *OUT_RANGE, *IN_RANGE)
    return G.graph_counts(G.dense_ids(vin), G.pairs_in_degree_range(pairs, vin))


def q_named_vectors(spark, d):
    nv = name_vectors(_vectors(spark, d), _id_map(spark, d))
    return nv.select("phone_number", "id", F.size("vector").cast("bigint").alias("dim"))


# ---------------------------------------------------------------- graph building

def q_edges_undirected(spark, d):
    return G.orient(_contact_edges(spark, d), directed=False)


def q_graph_vertices(spark, d):
    return G.graph_vertices(_contact_edges(spark, d), directed=True)


def _adjacency_out(a):
    txt = F.transform("nbrs", lambda x: F.concat(x["dst"].cast("string"), F.lit(":"), x["w"].cast("bigint").cast("string")))
    return a.select("src", "block", F.size("nbrs").cast("bigint").alias("n"), F.array_join(txt, " ").alias("nbrs"))


def q_adjacency(spark, d):
    return _adjacency_out(G.adjacency(G.orient(_contact_edges(spark, d), directed=False)))


def q_adjacency_directed(spark, d):
    """Sinks have one empty block; lists of more than BLOCK entries several."""
    e = D.events_edges(spark, d)
    return _adjacency_out(G.adjacency(G.orient(e, directed=True), G.graph_vertices(e, directed=True), block_size=BLOCK))


def q_graph_stats(spark, d):
    return G.graph_stats(D.events_edges(spark, d), directed=False)


def _parted(spark, d):
    return G.parted_orient(G.edge_partitions(D.events_edges(spark, d), PARTS, SEED), directed=False)


def _parted_by_degree(spark, d):
    e = D.price_edges(spark, d).groupBy("src", "dst").agg(F.sum("w").alias("w"))
    return G.parted_orient(G.degree_cut(materialize(e, "edges"), PARTS, SEED), directed=False)


def q_edge_partitions_by_degree(spark, d):
    return _parted_by_degree(spark, d).select("src", "dst", "part")


def q_replication_factor_by_degree(spark, d):
    """A13 of the cut by degree, beside that of the drawn cut of the same edges."""
    by_degree = materialize(_parted_by_degree(spark, d), "parted")
    drawn = G.parted_orient(G.edge_partitions(by_degree.filter("src < dst").drop("part"), PARTS, SEED), directed=False)
    other = G.replication_factor(drawn).select("factor").scalar()
    return G.replication_factor(by_degree).select("replicas", "vertices", "factor", other.alias("drawn_factor"))


def _given_parts(spark, d):
    """A11's other branch: every third edge names its part, the others' are drawn."""
    given = F.when(F.pmod(F.col("src") + F.col("dst"), F.lit(3)) == 0, F.pmod("src", F.lit(PARTS)).cast("int"))
    return G.edge_partitions(D.events_edges(spark, d).withColumn("given", given), PARTS, SEED, part_col="given")


def q_edge_partitions_given(spark, d):
    return _given_parts(spark, d).select("src", "dst", "part")


def q_edge_partitions(spark, d):
    return _parted(spark, d).select("src", "dst", "part")


def q_vertex_home_partition(spark, d):
    return G.vertex_home_partition(_parted(spark, d))


def q_partition_balance(spark, d):
    return G.partition_balance(_parted(spark, d))


def q_replication_factor(spark, d):
    return G.replication_factor(_parted(spark, d))


def q_vertex_replicas(spark, d):
    return G.vertex_replicas(_parted(spark, d))


def q_neighbors_of(spark, d):
    e = D.events_edges(spark, d)
    return G.neighbors_of(G.orient(e, directed=True), G.graph_vertices(e, directed=True))


# ---------------------------------------------------------------- samplers and walks

def _first_draw_cands(spark, d):
    g = G.merge_parallel(G.orient(D.events_edges(spark, d), directed=False))
    c = g.select(F.col("src").alias("v0"), "dst", "w")
    return g, c.withColumn("u", draw(F.lit(SEED), F.lit(0), "v0", F.lit(1), F.lit(0), F.lit(1)))


def q_weighted_sample(spark, d):
    _, c = _first_draw_cands(spark, d)
    return weighted_sample(c, ["v0"], out="next")


def _second_cands(spark, d):
    g, c = _first_draw_cands(spark, d)
    first = weighted_sample(c, ["v0"], out="cur")
    cands = (first.join(g, first.cur == g.src)
             .select("v0", F.col("v0").alias("prev"), "cur", "dst", "w"))
    return g, cands


def q_second_order_weights(spark, d):
    g, cands = _second_cands(spark, d)
    return second_order_weights(cands, g, P, Q).select("v0", "dst", "w2")


def q_second_order_step(spark, d):
    g, cands = _second_cands(spark, d)
    cands = cands.withColumn("u", draw(F.lit(SEED), F.lit(0), "v0", F.lit(2), F.lit(0), F.lit(1)))
    return second_order_sample(cands, g, ["v0", "prev", "cur"], P, Q).select("v0", "next")


def q_walkers_init(spark, d):
    g = build_graph(D.events_edges(spark, d), directed=True)
    w = materialize(init_walkers(g, 2).select("rnd", "v0"), "walkers")
    g.unpersist()
    return w


def q_first_step(spark, d):
    return _walk_out(_walk(spark, d, "events", True, 2, walk_length=0).paths)


def q_random_walk_undirected(spark, d):
    return _walk_out(_walk(spark, d, "contacts", False, 1).paths)


def q_random_walk_weighted(spark, d):
    return _walk_out(_walk(spark, d, "events", False, 1).paths)


def q_random_walk_directed(spark, d):
    return _walk_out(_walk(spark, d, "events", True, 2).paths)


def q_random_walk_cdf(spark, d):
    return _walk_out(_walk(spark, d, "events", False, 1, sampler="cdf").paths)


def q_random_walk_decimal(spark, d):
    """Weights with cents, many of which have no exact binary form."""
    return _walk_out(_walk(spark, d, "prices", False, 1).paths)


def _scaled(spark, d, by: float):
    return D.events_edges(spark, d).withColumn("w", F.col("w") * F.lit(by))


def q_random_walk_tiny_weights(spark, d):
    """Weights from 1e-12 on: the unit comes from the graph."""
    return _walk_out(_walk(spark, d, "events", False, 1, edges=_scaled(spark, d, TINY)).paths)


def q_random_walk_large_weights(spark, d):
    return _walk_out(_walk(spark, d, "events", False, 1, edges=_scaled(spark, d, LARGE)).paths)


def q_random_walk_resumed(spark, d):
    """E4/W6 stopped after two turns and gone on with by another run, from the written turns."""
    edges = materialize(D.events_edges(spark, d), "edges")
    state = scratch_path(spark, "turns")
    params = WalkParams(walk_length=L, num_walks=1, p=P, q=Q, seed=SEED)
    for most in (2, None):
        g = build_graph(edges)
        walks = random_walk(g, params, resume=state, most_turns=most)
        g.unpersist()
    return _walk_out(walks.paths)


def q_random_walk_stitched(spark, d):
    """W6 for p = q = 1, by doubling segments."""
    return _walk_out(_walk(spark, d, "events", False, 2, sampler="stitched", walk_length=STITCHED_L, p=1.0, q=1.0).paths)


def q_random_walk_partitioned(spark, d):
    """The edges come with a part for some of them (A11 keeps it and draws the others'); a walk belongs
    to its start's home part (A12)."""
    parted = materialize(_given_parts(spark, d), "parted")
    home = G.vertex_home_partition(G.parted_orient(parted, directed=False)).withColumnRenamed("v", "v0")
    return _walk_out(_walk(spark, d, "events", False, 1, edges=parted.select("src", "dst", "w")).paths).join(home, "v0").select("rnd", "v0", "part", "path", "len")


def q_dead_end_walks(spark, d):
    w = _walk_out(_walk(spark, d, "events", True, 2).paths)
    return w.where(F.col("len") < L + 2).select("rnd", "v0", "len")


def q_walk_counts(spark, d):
    w = _walk(spark, d, "events", True, 2).paths
    return w.groupBy(F.col("rnd").cast("int").alias("rnd")).agg(F.count(F.lit(1)).alias("paths"))


def q_walk_quality(spark, d):
    e = D.events_edges(spark, d)
    r = _walk(spark, d, "events", True, 2)
    return walk_report(r, G.orient(e, directed=True), G.graph_vertices(e, directed=True), 2, L)


def q_node_embedding_size(spark, d):
    """E1+E2: vocabulary = vertices on paths, one vector of ``dim`` each."""
    paths = _walk(spark, d, "events", False, 1).paths
    v = model_vectors(fit_word2vec(path_tokens(paths), W2V))
    return v.select("key", F.size("vector").cast("bigint").alias("dim"))


def q_node_embedding_buckets(spark, d):
    """E1+E2 without the driver: vectors trained by buckets, and whether they know who walks next to whom."""
    paths = materialize(_walk(spark, d, "events", False, 1).paths, "paths")
    v = materialize(fit_skip_gram(path_tokens(paths), replace(W2V, window=2, iterations=BUCKET_EPOCHS, buckets=3)), "vectors")
    return embedding_quality(v, path_tokens(paths), W2V.dim)


# ---------------------------------------------------------------- text forms and jobs

def _edge_lines(spark, d, form: str):
    """The events graph as one of the four line forms, with a header, a comment, blank and damaged lines."""
    e = D.events_edges(spark, d)
    s, t, w = (F.col(c).cast("bigint").cast("string") for c in ("src", "dst", "w"))
    part = F.when(F.pmod("src", F.lit(5)) == 0, F.lit("?")).otherwise(F.pmod("src", F.lit(PARTS)).cast("string"))
    columns = {"plain": [s, t], "weight": [s, t, w], "part": [s, t, part], "part_weight": [s, t, part, w]}[form]
    good = e.select(F.concat_ws(" ", *columns).alias("value"))
    bad = e.select(F.concat(F.lit("# "), s).alias("value")).unionByName(e.select(F.concat(s, F.lit(" x")).alias("value")))
    return good.unionByName(bad).unionByName(spark.createDataFrame([("# FromNodeId ToNodeId",), ("",)], "value string"))


FORMS = {"plain": (False, False), "weight": (True, False), "part": (False, True), "part_weight": (True, True)}


def q_edge_list_forms(spark, d):
    out = None
    for form, (weighted, partitioned) in FORMS.items():
        e = X.parse_edge_lines(_edge_lines(spark, d, form), weighted, partitioned).withColumn("form", F.lit(form))
        out = e if out is None else out.unionByName(e)
    return out.select("form", "src", "dst", "w", "part")


def q_edge_line_counts(spark, d):
    return X.edge_line_counts(_edge_lines(spark, d, "weight"))


def _job(spark, **kw):
    return JobParams(walk=WalkParams(walk_length=L, num_walks=1, p=P, q=Q, seed=SEED), w2v=W2V,
                     output=scratch_path(spark, "job"), output_partitions=3, **kw)


def _lines(spark, job):
    return spark.read.text(f"{job.output}/path")


def q_job_walk(spark, d):
    """E4 with K1: the written lines."""
    job = _job(spark)
    jobs.walk_job(spark, D.events_edges(spark, d), job)
    return _lines(spark, job).select(F.col("value").alias("line"))


def q_job_node2vec(spark, d):
    """E5 with K2: the keys and sizes of the written vectors."""
    job = _job(spark)
    jobs.node2vec_job(spark, D.events_edges(spark, d), job)
    return X.read_vectors(spark, f"{job.output}/vec").select("number", F.size("vector").cast("bigint").alias("dim"))


def q_job_embedding(spark, d):
    """E3 with J5: trained on a written walk series, named by a saved id map."""
    walked = _job(spark)
    jobs.walk_job(spark, _contact_edges(spark, d), walked)
    X.write_table(_id_map(spark, d), f"{walked.output}/id_map")
    job = _job(spark, cmd="embedding", input=f"{walked.output}/path", id_map=f"{walked.output}/id_map")
    jobs.run_job(spark, job)
    return X.read_vectors(spark, f"{job.output}/vec").select("number", F.size("vector").cast("bigint").alias("dim"))


def q_job_model(spark, d):
    """K3: the saved model of Spark ML, loaded again."""
    job = replace(_job(spark), w2v=replace(W2V, trainer="driver"))
    jobs.node2vec_job(spark, D.events_edges(spark, d), job)
    v = model_vectors(Word2VecModel.load(f"{job.output}/bin"))
    return v.agg(F.count(F.lit(1)).alias("words"), F.max(F.size("vector")).cast("bigint").alias("dim"))


def q_output_files(spark, d):
    """K6: files that each setting writes."""
    e = materialize(D.events_edges(spark, d), "edges")
    out = None
    for name, single in (("single", True), ("several", False)):
        path = scratch_path(spark, "files")
        X.write_table(e, path, single_output=single, partitions=3)
        n = (spark.read.parquet(path).select(F.col("_metadata.file_name").alias("f"))
             .agg(F.count_distinct("f").alias("files"), F.count(F.lit(1)).alias("edges")).withColumn("setting", F.lit(name)))
        out = n if out is None else out.unionByName(n)
    return out.select("setting", "files", "edges")


# ---------------------------------------------------------------- similarity

def q_vector_lookup(spark, d):
    keys = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key"))
    v = S.vector_lookup(_vectors(spark, d), keys)
    return v.select("key", F.posexplode("vector").alias("i", "x")).select(
        "key", F.col("i").cast("bigint").alias("i"), "x")


def q_vector_lookup_missing(spark, d):
    keys = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key"))
    return S.missing_keys(_vectors(spark, d), keys)


def q_pair_similarity(spark, d):
    e = table(spark, d, "embeddings")
    pairs = e.select(F.col("vec_id").cast("string").alias("k1"), (F.col("vec_id") + 2).cast("string").alias("k2"))
    r = S.pair_similarity(_vectors(spark, d), pairs)
    return r.select("k1", "k2", F.round("cos", 6).alias("cos"))


def q_topn_similar(spark, d):
    return S.top_n_similar(_vectors(spark, d), TOPN_KEY, TOPN_N, digits=6).select("key", "cos")


def q_topn_similar_batch(spark, d):
    """E8 for every customer that has a vector."""
    keys = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key"))
    return top_n_similar_batch(_vectors(spark, d), keys, TOPN_N, digits=6).rows.select("query", F.col("rank").cast("int").alias("rank"), "key", "cos")


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}
