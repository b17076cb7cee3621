"""First-order walks (p = q = 1) stitched from walk segments that are made ahead, by doubling.

A walk of T moves takes T turns step by step.  Here every vertex first gets a supply of one-move segments,
all drawn at once.  A segment of 2 ** (i+1) moves is one of 2 ** i (a head) and another that starts where
the head ends (a tail), and every segment is used once: the heads that arrive at a vertex are numbered, and
number k takes the vertex's k-th tail.  Walkers then take the longest segment that fits what they have left.

What a vertex needs at each level is foreseen from its share of all incoming weight, which is how often
undirected walks visit it, plus room for chance.  Where it isn't enough, a head stays as it is (its level
counts, not its length) and a walker makes one move by its own draw, so walks are never cut, dropped or
biased: who takes which segment depends on numbers of earlier arrivals and never on what lies ahead.

A segment's draw is keyed by (seed, vertex, number), a walker's own by (seed, round, start, step): paths are
the same on any number of partitions.  T = 82 takes 6 doublings and a handful of turns of walkers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rambler.functions.draws import draw
from rambler.functions.weights import weight_units
from rambler.operators.ordering import segmented_cumsum
from rambler.operators.walk import WalkGraph, WalkResult, assemble_paths, init_walkers
from rambler.operators.walk_index import bucket_count, bucket_of, spread
from rambler.params import WalkParams
from rambler.session import delete_scratch, materialize, scratch_path, write_scratch

SPARE = 0.15        # of the walkers may want a level that no full walk needs
_RUN = 1024         # segments of a vertex that are listed at once


def _ample(mean: Column) -> Column:
    """Room for a count of this mean: two deviations and one more."""
    return F.ceil(mean + 2.0 * F.sqrt(mean) + 1.0).cast("bigint")


def _numbered(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """``key``, ``order`` and ``k``: the place of each row within its key, spread over ranges, not one task a key."""
    ones = rows.select(*key, *order, F.lit(1).cast("bigint").alias("_one"))
    return segmented_cumsum(ones, key, order, "_one", before="k", after="_k").drop("_one", "_k")


def supply(graph: WalkGraph, rounds: int, moves: int) -> DataFrame:
    """``(v, n0, t0, n1, t1, ...)`` for every vertex with an edge: level i has n_i segments at v, of which the
    first n_(i+1) become heads, the next t_i are tails, and the rest are for walkers."""
    top = moves.bit_length() - 1
    incoming = graph.edges.groupBy(F.col("dst").alias("v")).agg(F.sum(weight_units("w", graph.exponent).cast("decimal(38,0)")).alias("win"))
    v = materialize(graph.vertices.filter("n > 0").select("v").join(spread(incoming), "v", "left").withColumn("win", F.coalesce("win", F.lit(0).cast("decimal(38,0)"))), "shares")
    all_ = v.agg(F.sum("win").alias("win"), F.count(F.lit(1)).alias("n")).first()
    share = F.col("win").cast("double") / F.lit(float(all_["win"] or 1))
    walkers = float(all_["n"] * rounds)
    v = v.withColumns({f"n{top}": F.lit(rounds).cast("bigint"), f"t{top}": F.lit(0).cast("bigint")})
    total = walkers
    for i in range(top - 1, -1, -1):
        wanting = walkers if moves >> i & 1 else SPARE * walkers
        v = v.withColumn(f"t{i}", _ample(share * F.lit(total)))
        v = v.withColumn(f"n{i}", F.col(f"n{i + 1}") + F.col(f"t{i}") + _ample(share * F.lit(wanting)))
        total = float(v.agg(F.sum(f"n{i}")).first()[0] or 0)
    return materialize(v.drop("win"), "supply")


def _single_moves(graph: WalkGraph, movers: DataFrame, u: Column, ids: list[str]) -> DataFrame:
    """``ids`` with ``(end, en, et, ec)``: one weighted move of movers that stand at ``cur`` (n, tot, copies)."""
    placed = movers.withColumn("_u", u * F.col("tot"))
    placed = placed.withColumns({"_b": bucket_of(F.col("_u"), bucket_count(F.col("n")), F.col("tot")), "_c": F.pmod(F.xxhash64(*ids), F.col("copies")).cast("int")})
    ix = graph.index
    hit = spread(placed).join(ix, (F.col("cur") == ix["src"]) & (F.col("_b") == ix["bucket"]) & (F.col("_c") == ix["copy"]))
    hit = hit.filter((ix["ca"] >= F.col("_u")) & ((ix["cb"] < F.col("_u")) | ix["first"]))
    at = graph.vertices.select(F.col("v").alias("end"), F.col("n").alias("en"), F.col("tot").alias("et"), F.col("copies").alias("ec"))
    return hit.select(*ids, ix["dst"].alias("end")).join(spread(at), "end").select(*ids, "end", "en", "et", "ec")


def _one_move_segments(graph: WalkGraph, counts: DataFrame, seed: int) -> DataFrame:
    """``(v, j, path, end, en, et, ec)``: all segments of level 0."""
    runs = counts.select("v", "n0", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n0") - 1) / _RUN))).alias("run"))
    at = graph.vertices.withColumnRenamed("v", "cur")
    movers = (runs.join(spread(at), F.col("v") == F.col("cur")).repartition("v", "run")
              .withColumn("j", F.explode(F.sequence(F.col("run") * _RUN, F.least("n0", (F.col("run") + 1) * _RUN) - 1))))
    moved = _single_moves(graph, movers, draw(F.lit(seed), F.lit("segment"), "v", "j"), ["v", "j"])
    return moved.select("v", "j", F.array("end").alias("path"), "end", "en", "et", "ec")


def build_segments(graph: WalkGraph, rounds: int, moves: int, seed: int) -> DataFrame:
    """``(level, v, k, path, end, en, et, ec)``: the segments that walkers can take, k from 0 at each (level, v)."""
    top = moves.bit_length() - 1
    counts = supply(graph, rounds, moves)
    level = materialize(_one_move_segments(graph, counts, seed), "segments")
    pool = None
    for i in range(top + 1):
        here = level.join(spread(counts.select("v", *[F.col(c) if c.startswith("t") or i < top else F.lit(0).cast("bigint").alias(c)
                                               for c in ([f"n{i + 1}"] if i < top else []) + [f"t{i}"]])), "v")
        heads_end = F.col(f"n{i + 1}") if i < top else F.lit(0).cast("bigint")
        tails_end = heads_end + F.col(f"t{i}")
        free = here.filter(F.col("j") >= tails_end).select(F.lit(i).alias("level"), "v", (F.col("j") - tails_end).alias("k"), "path", "end", "en", "et", "ec")
        pool = free if pool is None else pool.unionByName(free)
        if i == top:
            return materialize(pool, "pool")
        heads = here.filter(F.col("j") < heads_end).select("v", "j", "path", "end", "en", "et", "ec")
        tails = (here.filter((F.col("j") >= heads_end) & (F.col("j") < tails_end))
                 .select(F.col("v").alias("end"), (F.col("j") - heads_end).alias("k"),
                         *[F.col(c).alias(f"t_{c}") for c in ("path", "end", "en", "et", "ec")]))
        found = _numbered(heads.filter("en > 0").select("end", "v", "j"), ["end"], ["v", "j"]).join(spread(tails), ["end", "k"]).drop("end", "k")
        joined = heads.join(spread(found), ["v", "j"], "left")
        on = F.col("t_path").isNotNull()
        level = materialize(joined.select("v", "j", F.when(on, F.concat("path", "t_path")).otherwise(F.col("path")).alias("path"),
                                          *[F.coalesce(f"t_{c}", c).alias(c) for c in ("end", "en", "et", "ec")]), "segments")


def stitched_walk(graph: WalkGraph, params: WalkParams, rounds: list[int] | None = None) -> WalkResult:
    """W4–W9 for p = q = 1, by segments; ``turns`` of the result counts the walkers' turns."""
    if (params.p, params.q) != (1.0, 1.0):
        raise ValueError("segments serve first-order walks only: p and q must be 1")
    spark = graph.edges.sparkSession
    moves = params.walk_length + 1
    walkers = init_walkers(graph, params.num_walks, rounds).select("rnd", "v0", "step", "cur", "n", "tot", "copies")
    n_rounds = len(rounds) if rounds is not None else params.num_walks
    pool = build_segments(graph, n_rounds, moves, params.seed)
    steps, wishes = scratch_path(spark, "steps"), scratch_path(spark, "wishes")
    walkers, held = write_scratch(walkers, "walkers")
    walkers.select("rnd", "v0", "step", F.col("cur").alias("vertex")).write.parquet(steps)
    spark.createDataFrame([], "level int, v bigint").write.parquet(wishes)
    turns = 0
    while True:
        left = F.lit(moves) - F.col("step")
        level = (F.floor(F.log2(left.cast("double") + 0.5))).cast("int")     # the longest that fits
        active = walkers.filter((F.col("n") > 0) & (left > 0)).withColumn("level", level)
        if active.isEmpty():
            break
        wanted = materialize(_numbered(active, ["level", "cur"], ["rnd", "v0"]).withColumnRenamed("cur", "v"), "wanted")
        used = spark.read.parquet(wishes).groupBy("level", "v").agg(F.count(F.lit(1)).alias("used"))
        asked = wanted.join(spread(used), ["level", "v"], "left").withColumn("k", F.col("k") + F.coalesce("used", F.lit(0))).drop("used")
        taken = asked.join(spread(pool), ["level", "v", "k"]).select("rnd", "v0", "path", "end", "en", "et", "ec")
        got = materialize(active.join(spread(taken), ["rnd", "v0"], "left"), "taken")
        own = _single_moves(graph, got.filter("path IS NULL").drop("end", "en", "et", "ec"),
                            draw(F.lit(params.seed), "rnd", "v0", F.col("step") + 1, F.lit(0), F.lit(1)), ["rnd", "v0", "step"])
        moved = (got.filter("path IS NOT NULL").select("rnd", "v0", "step", "path", "end", "en", "et", "ec")
                 .unionByName(own.withColumn("path", F.array("end"))))
        moved = materialize(moved, "moved")
        moved.select("rnd", "v0", (F.col("step") + 1).alias("step"), F.posexplode("path").alias("i", "vertex")) \
             .select("rnd", "v0", (F.col("step") + F.col("i")).alias("step"), "vertex").write.mode("append").parquet(steps)
        wanted.select("level", "v").write.mode("append").parquet(wishes)
        before = held
        walkers, held = write_scratch(moved.select("rnd", "v0", (F.col("step") + F.size("path")).alias("step"), F.col("end").alias("cur"),
                                                   F.col("en").alias("n"), F.col("et").alias("tot"), F.col("ec").alias("copies")), "walkers")
        delete_scratch(spark, before)
        turns += 1
    delete_scratch(spark, held)
    delete_scratch(spark, wishes)
    steps = spark.read.parquet(steps)
    return WalkResult(steps=steps, paths=assemble_paths(steps), turns=turns)
