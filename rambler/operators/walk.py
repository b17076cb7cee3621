"""Second-order (node2vec) random walks as a driver loop of DataFrame joins.

State is one row per walker ``(rnd, v0, step, prev, cur, n, tot, copies, tb)``: round, start
vertex, index of ``cur`` in the path, previous vertex, the current vertex with its
out-degree ``n``, weight total ``tot`` and number of ``copies`` in the index, and the first
trial number not yet used.  Every step appends long-form rows ``(rnd, v0, step, vertex)``
to a table; paths are assembled once at the end, so paths are never shuffled per step.  Draws are keyed hashes of
``(seed, rnd, v0, step, trial, slot)``: a recomputed partition walks identically.

Two samplers give the same node2vec step distribution (weight ``w/p`` back to ``prev``,
``w`` to a common neighbour of ``prev``, ``w/q`` otherwise):

* ``"rejection"`` (default): a first-order inverse-CDF pick through a bucketed index,
  accepted with probability ``f/max(f)``.  Each trial is an equi-join on
  ``(vertex, bucket)`` plus a point lookup of ``(prev, candidate)``, so the work per
  walker does not depend on the degree of the vertex it stands on and no group ever
  holds a hub's neighbour list.  Only candidates whose draw lies between the two
  acceptance bounds are looked up.  Trials of a walker are evaluated ``trials`` at a time;
  the first accepted trial wins, so the result does not depend on ``trials``, and no trial
  is made after one that is accepted whatever its candidate.
* ``"cdf"``: the modelled system's own draw: one ``u`` per step, the first neighbour
  whose running share of the modified weights is ``>= u``, from running sums that are
  built once and corrected per walker (``prefix_step``); use it to reproduce that draw
  sequence.
* ``"stitched"`` (p = q = 1 only): segments made ahead by doubling (``stitch``), in a
  few turns instead of one a move; the same distribution by other draws.

For ``p = q = 1`` and the first step both samplers make the same pick from the same draw.

Running weights are sums of whole units (``rambler.functions.weights``): neighbouring
intervals share their border exactly, so every draw falls into one interval, on any cluster.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from rambler.functions.draws import DRAW_SCALE, draw
from rambler.functions.weights import EXPONENT, from_units, weight_units
from rambler.operators.graph import merge_parallel, merged_edges, orient
from rambler.operators.ordering import written_cumsum
from rambler.operators.prefix_step import PrefixIndex, build_prefix_index, prefix_step
from rambler.operators.walk_index import BUCKET_EDGES, bucket_count, bucket_of, explode_buckets, spread
from rambler.params import WalkParams
from rambler.session import delete_scratch, ensure_checkpoint_dir, is_whole, materialize, scratch_path, shuffles_released, write_scratch

WALKER_COLS = ["rnd", "v0", "step", "prev", "cur", "n", "tot", "copies", "tb"]


@dataclass
class WalkGraph:
    edges: DataFrame      # (src, dst, w): oriented, parallel edges merged
    keys: DataFrame       # (src, dst): membership lookups, hash-partitioned and sorted on both; src <= dst unless directed
    vertices: DataFrame   # (v, n, tot, copies): every vertex, sinks with n = 0
    index: DataFrame      # (src, bucket, copy, dst, cb, ca, first), hash-partitioned and sorted on the first three
    directed: bool
    exponent: int = EXPONENT    # weights are whole numbers of 10 ** -exponent
    partitions: int = 1         # of index and keys
    index_path: str | None = None   # the table that the cached index was read from

    def views(self) -> tuple[str, str, str]:
        """Temp-view names of ``index``, ``keys`` and ``vertices`` (registered once per graph)."""
        if not getattr(self, "_views", None):
            self._views = (_view(self.index, "index"), _view(self.keys, "keys"), _view(self.vertices, "vertices"))
        return self._views

    def unpersist(self) -> None:
        """Release the caches, the index's table and the views; written walks don't need them."""
        spark = self.index.sparkSession
        for df in (self.keys, self.index):
            df.unpersist()
        for name in getattr(self, "_views", None) or ():
            spark.catalog.dropTempView(name)
        if self.index_path:
            delete_scratch(spark, self.index_path)
        self._views = self.index_path = None


EDGES_PER_PARTITION = 2_000_000
SHARES_PER_PARTITION = 4  # an index key expected to draw more than 1/4 of a partition's walkers is copied
FORESEEN = 16             # trials, at most, that are looked through for one that is accepted whatever its candidate


def build_graph(edges: DataFrame, directed: bool = False, partitions: int | None = None,
                persist: bool = True) -> WalkGraph:
    """Orient, merge parallel edges and build the sampling index.

    The per-vertex running weights come from a range-partitioned segmented scan, so a
    hub's list is spread over as many tasks as its size needs.  A vertex that many walkers
    will stand on but that has few edges (so few index keys) is listed in several copies,
    by its share of all weight coming in; walkers choose a copy by hash.  With ``persist``
    the merged edges, the vertex table and the index's rows are written under the checkpoint directory
    (the running weights, which are then deleted, always are), and the index and the key table are cached
    hash-partitioned and sorted for the walk's joins: a turn shuffles and sorts walkers, and reads the index
    in order.  The index has no more than a draw needs; what is known of the vertex a walker comes to is
    joined to walkers, which are fewer than edges.
    """
    spark = edges.sparkSession
    # written tables (not caches): read back with size-based partitions, lineage cut
    merged, exponent = merged_edges(orient(edges, directed), lambda df: materialize(df, "edges")) if persist \
        else (merge_parallel(orient(edges, directed)), EXPONENT)
    size = merged.agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w")).first()
    # Walker shuffles must match the index's partitioning every turn, so its partition
    # count is sized from the graph, not from a session default.  Walks don't depend on it.
    n_part = partitions or max(spark.sparkContext.defaultParallelism, -(-size["n"] // EDGES_PER_PARTITION))
    units, sums_path = written_cumsum(merged.select("src", "dst", weight_units("w", exponent).alias("_units")), "src", ["dst"], "_units",
                                      before="cb", after="ca", partitions=n_part, written=persist)
    cum = units.select("src", "dst", from_units("cb", exponent).alias("cb"), from_units("ca", exponent).alias("ca"))
    stats = cum.groupBy(F.col("src").alias("v")).agg(F.count(F.lit(1)).alias("n"), F.max("ca").alias("tot"),
                                                     F.min("dst").alias("first_dst"))
    incoming = merged.groupBy(F.col("dst").alias("v")).agg(F.sum("w").alias("win"))
    share = F.coalesce("win", F.lit(0.0)) / F.lit(float(size["w"] or 1.0)) / F.greatest(bucket_count(F.coalesce("n", F.lit(0))), F.lit(1))
    slots = SHARES_PER_PARTITION * n_part
    vertices = (incoming.join(stats, "v", "full_outer")
                .select("v", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.coalesce("tot", F.lit(0.0)).alias("tot"),
                        F.greatest(F.ceil(F.least(share, F.lit(1.0)) * slots), F.lit(1)).cast("int").alias("copies"), "first_dst"))
    if persist:
        vertices = materialize(vertices, "vertices")
    # the join comes before the rows of an edge are multiplied
    e = cum.join(spread(vertices.withColumnRenamed("v", "src")), "src")
    buckets = bucket_count(F.col("n"))
    e = e.withColumns({"lo": bucket_of(F.col("cb"), buckets, F.col("tot")), "hi": bucket_of(F.col("ca"), buckets, F.col("tot"))})
    e = e.select("src", "copies", "dst", "cb", "ca", (F.col("dst") == F.col("first_dst")).alias("first"), "lo", "hi")
    index = (explode_buckets(e).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
             .select("src", "bucket", "copy", "dst", "cb", "ca", "first"))
    index_path = None
    if persist:
        index, index_path = write_scratch(index, "index")     # the cached table keeps one shuffle, not those of its joins
        delete_scratch(spark, sums_path)
    keys = merged.select("src", "dst") if directed else merged.select("src", "dst").filter("src <= dst")
    # a cached table keeps its order: no turn sorts it again
    index = index.repartition(n_part, "src", "bucket", "copy").sortWithinPartitions("src", "bucket", "copy")
    keys = keys.repartition(n_part, "src", "dst").sortWithinPartitions("src", "dst")
    g = WalkGraph(edges=merged, keys=keys, vertices=vertices.drop("first_dst"), index=index, directed=directed, exponent=exponent, partitions=n_part,
                  index_path=index_path)
    if persist:
        for df in (g.keys, g.index):
            df.persist(StorageLevel.MEMORY_AND_DISK).count()
    return g


def init_walkers(graph: WalkGraph, num_walks: int, rounds: list[int] | None = None) -> DataFrame:
    """One walker per vertex per round (``rnd`` in 0..num_walks-1), standing at step 0."""
    rounds = rounds if rounds is not None else list(range(num_walks))
    return graph.vertices.select(
        F.explode(F.array(*[F.lit(r) for r in rounds])).alias("rnd"), F.col("v").alias("v0"),
        F.lit(0).alias("step"), F.lit(None).cast("bigint").alias("prev"), F.col("v").alias("cur"),
        "n", "tot", "copies", F.lit(0).cast("bigint").alias("tb"))


def _accept_ratios(p: float, q: float) -> tuple[float, float, float]:
    f_back, f_in, f_out = 1.0 / p, 1.0, 1.0 / q
    m = max(f_back, f_in, f_out)
    return f_back / m, f_in / m, f_out / m


def _draw_sql(seed: int, *parts: str) -> str:
    """SQL text of ``rambler.functions.draws.draw`` (same keys, same 52-bit fraction)."""
    cols = ", ".join(f"CAST({p} AS STRING)" for p in (str(seed), *parts))
    return (f"(CAST(CAST(conv(substring(md5(concat_ws('|', {cols})), 1, 13), 16, 10) AS BIGINT) AS DOUBLE)"
            f" / {DRAW_SCALE!r}D)")


def _view(df: DataFrame, tag: str) -> str:
    import uuid
    name = f"_rambler_{tag}_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(name)
    return name


def rejection_step(walkers: DataFrame, graph: WalkGraph, params: WalkParams, trials: int,
                   u1: float | None = None) -> DataFrame:
    """One loop turn of the rejection sampler; returns the next walker state.

    Advanced walkers have ``tb = 0``; walkers whose ``trials`` trials were all rejected
    keep their place with ``tb`` moved on; finished walkers and dead ends are gone.
    ``u1`` replaces the candidate draw (tests use a constant, as the modelled system's do).

    A candidate is accepted below the ratio of its kind: going back is told from the
    candidate itself, and a draw below both other ratios, or not below either, is decided
    without asking which of them holds.  A draw below all three is accepted before its candidate
    is known, so later trials aren't made; candidates that are rejected go no further.  Only the rest
    is looked up; a decided candidate joins by a hash instead of ``(prev, dst)``, so the walkers around
    a hub share no key.  Trials carry what they need, the state is joined to the accepted ones.

    The turn is one SQL statement over temp views: one analysis per turn instead of a
    few hundred driver round trips for column objects.
    """
    spark = walkers.sparkSession
    L, seed = params.walk_length, params.seed
    if "copies" not in walkers.columns:
        walkers = walkers.withColumn("copies", F.lit(1))
    w = _view(walkers, "walkers")
    ix, keys, vertices = graph.views()
    active = f"SELECT rnd, v0, step, prev, cur, n, tot, copies, tb FROM {w} WHERE n > 0 AND step <= {L}"
    u1_sql = f"{float(u1)!r}D" if u1 is not None else _draw_sql(seed, "rnd", "v0", "step + 1", "t", "1")

    def candidates(listed: str, carried: str) -> str:
        return f"""
      SELECT /*+ MERGE(i) */ c.rnd, c.v0, c.t, c.cur, {carried}, i.dst
      FROM (SELECT x.*, CASE WHEN x.tot > 0 THEN CAST(floor(x.thr * x.k / x.tot) AS BIGINT) ELSE 0L END AS b
            FROM (SELECT y.*, {u1_sql} * y.tot AS thr, ceil(y.n / {BUCKET_EDGES}) AS k,
                         CAST(pmod(xxhash64(y.rnd, y.v0, y.t), y.copies) AS INT) AS cp FROM ({listed}) y) x) c
      JOIN {ix} i ON i.src = c.cur AND i.bucket = c.b AND i.copy = c.cp
      WHERE i.ca >= c.thr AND (i.cb < c.thr OR i.first)"""

    try:
        if params.p == 1.0 and params.q == 1.0 and trials == 1:
            return spark.sql(f"""SELECT /*+ MERGE(v) */ m.rnd, m.v0, m.step + 1 AS step, m.cur AS prev, v.v AS cur, v.n, v.tot,
                                        v.copies, 0L AS tb
                                 FROM ({candidates(f"SELECT *, tb AS t FROM ({active}) a", "c.step")}) m JOIN {vertices} v ON v.v = m.dst""")
        rb, ri, ro = _accept_ratios(params.p, params.q)
        lower, upper = min(ri, ro), max(ri, ro)
        sure = [f"WHEN {_draw_sql(seed, 'rnd', 'v0', 'step + 1', f'tb + {j}', '2')} < {min(rb, lower)!r}D THEN {j}L" for j in range(min(trials - 1, FORESEEN))]
        last = f"CASE WHEN prev IS NULL THEN 0L {' '.join(sure)} ELSE {trials - 1}L END"
        listed = f"""SELECT z.*, {_draw_sql(seed, "rnd", "v0", "step + 1", "t", "2")} AS u2
                     FROM (SELECT *, explode(sequence(tb, tb + {last})) AS t FROM ({active}) a) z"""
        ends = ("prev", "dst") if graph.directed else ("least(prev, dst)", "greatest(prev, dst)")
        # numeric min_by keeps the regroup a hash aggregate (a struct min would sort)
        return spark.sql(f"""
          SELECT /*+ MERGE(v) */ s.rnd, s.v0,
                 CASE WHEN s.pt IS NOT NULL THEN s.step + 1 ELSE s.step END AS step,
                 CASE WHEN s.pt IS NOT NULL THEN s.cur ELSE s.prev END AS prev,
                 v.v AS cur, v.n, v.tot, v.copies,
                 CASE WHEN s.pt IS NOT NULL THEN 0L ELSE s.tb + {trials} END AS tb
          FROM (SELECT /*+ MERGE(g) */ o.*, g.pt, coalesce(g.pd, o.cur) AS at
                FROM ({active}) o LEFT JOIN (
                  SELECT rnd, v0, min(t) AS pt, min_by(dst, t) AS pd
                  FROM (SELECT /*+ MERGE(k) */ a.rnd, a.v0, a.t, a.dst
                        FROM (SELECT f.*, CASE WHEN f.ask THEN {ends[0]} ELSE xxhash64(f.rnd, f.v0, f.t) END AS ps,
                                     CASE WHEN f.ask THEN {ends[1]} ELSE f.dst END AS pd
                              FROM (SELECT e.*, coalesce(e.dst <> e.prev AND e.u2 >= {lower!r}D, false) AS ask
                                    FROM ({candidates(listed, "c.prev, c.u2")}) e
                                    WHERE e.prev IS NULL OR e.u2 < (CASE WHEN e.dst = e.prev THEN {rb!r}D ELSE {upper!r}D END)) f) a
                        LEFT JOIN {keys} k ON k.src = a.ps AND k.dst = a.pd
                        WHERE NOT a.ask OR a.u2 < (CASE WHEN k.src IS NOT NULL THEN {ri!r}D ELSE {ro!r}D END)) j
                  GROUP BY rnd, v0) g ON g.rnd = o.rnd AND g.v0 = o.v0) s
          JOIN {vertices} v ON v.v = s.at""")
    finally:
        spark.catalog.dropTempView(w)      # the analysed statement no longer needs the name


def _prefix_state(walkers: DataFrame, graph: WalkGraph, ix: PrefixIndex) -> DataFrame:
    """Walkers after their first step, with what ``prefix_step`` needs to know of prev and cur."""
    at = ix.vertices.select(F.col("v").alias("cur"), "tq")
    behind = ix.vertices.select(F.col("v").alias("prev"), F.col("n").alias("pn"))
    return walkers.join(at, "cur").join(behind, "prev").select("rnd", "v0", "step", "prev", "cur", "n", "pn", "tq", "tb")


@dataclass
class WalkResult:
    steps: DataFrame      # (rnd, v0, step, vertex)
    paths: DataFrame      # (rnd, v0, path ARRAY<BIGINT>)
    turns: int = 0        # of the loop


def assemble_paths(steps: DataFrame) -> DataFrame:
    """Long-form steps to one path per walk (groups are bounded by walk_length + 2)."""
    return (steps.groupBy("rnd", "v0")
            .agg(F.array_sort(F.collect_list(F.struct("step", "vertex"))).alias("_s"))
            .select("rnd", "v0", F.transform("_s", lambda x: x["vertex"]).alias("path")))


def default_trials(p: float, q: float) -> int:
    """Trials per walker per turn: twice the number that the rarest kind of step needs on average.

    More trials would move rows that are seldom used; a walker whose trials are all
    rejected (at most about one in seven) goes on from the next trial in the next turn.
    """
    return max(1, math.ceil(2 / min(_accept_ratios(p, q)))) if (p, q) != (1.0, 1.0) else 1


class _Turns:
    """The written state of a walk: one table of walkers and one of new steps a turn.

    A turn is whole once its steps are, which are written last; the walkers before it are then deleted.
    In a folder of its own (``resume``) the state outlives the driver: another run finds the last whole
    turn, if it asks for the same walk of the same graph.
    """

    def __init__(self, graph: WalkGraph, params: WalkParams, rounds: list[int] | None, resume: str | None):
        self.spark, self.kept = graph.edges.sparkSession, bool(resume)
        self.base = resume.rstrip("/") if resume else scratch_path(self.spark, "walk")
        self.turn = -1
        if resume:
            size = graph.edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("src", "dst", "w")).alias("x")).first()
            asked = repr((replace(params, trials=None, partitions=None), rounds, size["n"], size["x"], graph.directed))
            if is_whole(self.spark, f"{self.base}/manifest"):
                if self.spark.read.text(f"{self.base}/manifest").first()["value"] != asked:
                    raise ValueError(f"{self.base} holds another walk")
                while is_whole(self.spark, self.steps_path(self.turn + 1)):
                    self.turn += 1
            else:
                self.spark.createDataFrame([(asked,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.base}/manifest")

    def steps_path(self, turn: int) -> str:
        return f"{self.base}/steps/turn={turn}"

    def walkers(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/walkers/{self.turn}")

    def add(self, walkers: DataFrame) -> DataFrame:
        """Write the next turn's walkers and their steps; the walkers as a table."""
        self.turn += 1
        with shuffles_released(self.spark):
            walkers.write.mode("overwrite").parquet(f"{self.base}/walkers/{self.turn}")
        walkers = self.spark.read.schema(walkers.schema).parquet(f"{self.base}/walkers/{self.turn}")
        (walkers.where(F.col("tb") == 0).select("rnd", "v0", "step", F.col("cur").alias("vertex"))
         .write.mode("overwrite").parquet(self.steps_path(self.turn)))
        if self.turn:
            self._delete(f"{self.base}/walkers/{self.turn - 1}")
        return walkers

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def close(self) -> None:
        if not self.kept:
            self._delete(f"{self.base}/walkers")

    def steps(self) -> DataFrame:
        return self.spark.read.schema("rnd int, v0 bigint, step int, vertex bigint").parquet(
            *[self.steps_path(t) for t in range(self.turn + 1)])


def random_walk(graph: WalkGraph, params: WalkParams, trials: int | None = None, u1=None,
                rounds: list[int] | None = None, resume: str | None = None, most_turns: int | None = None) -> WalkResult:
    """All rounds walk together; a full path has ``walk_length + 2`` vertices.

    The driver holds only the loop.  Every turn the walker state is written as a Parquet
    table under the session's checkpoint directory and read back (lineage cut, survives
    executor loss), its new steps are written beside it, and the turn before is deleted.
    The loop ends when no walker can go on.

    ``resume`` names a shared folder for this state instead: a run whose driver was lost goes
    on from the last whole turn when it is started again with the same graph and parameters,
    and gives the same paths.  ``most_turns`` ends this run after so many turns.
    """
    spark = graph.edges.sparkSession
    ensure_checkpoint_dir(spark)
    L = params.walk_length
    trials = trials or params.trials or default_trials(params.p, params.q)
    first_order = params.p == 1.0 and params.q == 1.0
    if params.sampler not in ("rejection", "cdf", "stitched"):
        raise ValueError(f"unknown sampler {params.sampler!r}")
    if params.sampler == "stitched":
        from rambler.operators.stitch import stitched_walk
        return stitched_walk(graph, params, rounds)
    # the scanning sampler's first step, and all of its steps if p = q = 1, are the other's first trial
    scan = params.sampler == "cdf" and not first_order
    prefixes = None
    turns = _Turns(graph, params, rounds, resume)
    if turns.turn >= 0:
        walkers = turns.walkers()
    else:
        walkers = init_walkers(graph, params.num_walks, rounds)
        if params.partitions:
            walkers = walkers.repartition(params.partitions, "rnd", "v0")
        walkers = turns.add(walkers)
    done, most = 0, 0
    while done != most_turns:
        left = walkers.where((F.col("n") > 0) & (F.col("step") <= L)).count()
        if not left:
            break
        turn, most = turns.turn, max(most, left)
        if scan and turn:
            if prefixes is None:
                prefixes = build_prefix_index(graph.edges, params.p, params.q, graph.exponent, graph.partitions)
            if "tq" not in walkers.columns:
                walkers = _prefix_state(walkers, graph, prefixes)
            nxt = prefix_step(walkers, prefixes.edges, prefixes, L, params.seed, u=u1)
        else:
            # the first step has no previous vertex: its first trial is always accepted;
            # past step L+1 only stalled walkers are left: batches that are the larger, the fewer these are, end the tail sooner
            k = 1 if (turn == 0 or first_order or scan) else (trials if turn < L + 1 else min(most // left, 8) * trials)
            nxt = rejection_step(walkers, graph, params, k, u1=u1)
        walkers = turns.add(nxt)
        done += 1
    turns.close()
    if prefixes is not None:
        prefixes.unpersist()
    steps = turns.steps()
    return WalkResult(steps=steps, paths=assemble_paths(steps), turns=done)


def walk_report(result: WalkResult, edges: DataFrame, vertices: DataFrame, num_walks: int, walk_length: int) -> DataFrame:
    """One row ``(paths, expected_paths, short_paths, invalid_steps)`` about every walk.

    ``edges`` are the oriented edges, ``vertices`` (v) all start vertices; a step is
    invalid if it isn't an edge.
    """
    steps = result.steps
    nxt = steps.select("rnd", "v0", (F.col("step") - 1).alias("step"), F.col("vertex").alias("to"))
    moves = steps.join(nxt, ["rnd", "v0", "step"]).select(F.col("vertex").alias("src"), F.col("to").alias("dst"))
    invalid = moves.join(edges, ["src", "dst"], "left_anti").select(F.count(F.lit(1))).scalar()
    n_v = vertices.select(F.count(F.lit(1))).scalar()
    lengths = steps.groupBy("rnd", "v0").agg(F.count(F.lit(1)).alias("len"))
    return (lengths.agg(F.count(F.lit(1)).alias("paths"),
                        F.sum(F.when(F.col("len") < walk_length + 2, 1).otherwise(0)).cast("bigint").alias("short_paths"))
            .select("paths", (n_v * num_walks).alias("expected_paths"), "short_paths", invalid.alias("invalid_steps")))
