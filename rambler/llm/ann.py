"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation multiplies by random signs and applies the fast Hadamard transform, three times; a
rotated unit vector is hashed to the signed axis nearest to it.  A table has two such hashes: the first
names a cell, the second a bucket within the cell.  A query probes the buckets whose two axes are
nearest to it (multiprobe), over all tables; what it finds there is ranked exactly.

Equal vectors are one class, searched once and standing for its ``k + 1`` smallest ids, which is all
that any result can show of it.  Cells are dealt to tasks; a cell with more than ``cell_rows`` vectors
is split by a salt, and its queries visit every part.  A task holds one part of a cell at a time, and
queries stream past it.

A vector's direction is hashed, and inner products depend on lengths too: vectors of similar length are
a band, with cells of its own.  Every query searches every band, from the longest vectors on, except
those whose longest vector can't reach the worst score that it needs.  The smallest bands, as long as
they hold no more than a twentieth of the vectors, aren't hashed but searched whole, in blocks.  A query
that found fewer classes than it needs, or whose finds were met in so few tables that others must have
been missed (Chao's estimate), probes ``FURTHER`` times as many buckets; if that isn't enough either, it
is ranked against all vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rambler.session import materialize

BAND = float(np.log(1.05))  # lengths in a band differ by less than this factor, as a logarithm
UNSEEN = 0.1  # a query with a larger share of its classes missed, as estimated, goes on
FURTHER = 6
MARGIN = 1e-9  # more than rounding changes in the logarithm of a score
OUTLYING = 0.05  # of the vectors, at most, are in bands searched whole
PAIRS = 1 << 16  # scored exactly at once
SLOTS = 1 << 15  # queries whose best scores so far a task remembers


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row; the row length is a power of two."""
    n, step = x.shape[1], 1
    while step < n:
        pairs = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def rotate(x: np.ndarray, seed: int, table: int, which: int) -> np.ndarray:
    width = 1 << max(1, int(x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    rng = np.random.default_rng([seed, width, table, which])
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], width))
    return x


def nearest_axis(rotated: np.ndarray) -> np.ndarray:
    """Twice the number of the nearest axis, and 1 more on its negative side; ties to the first."""
    axis = np.abs(rotated).argmax(1)
    return 2 * axis + (rotated[np.arange(len(rotated)), axis] < 0)


def probed(first: np.ndarray, second: np.ndarray, probes: int) -> np.ndarray:
    """``[query, cell, bucket]``: whether a query probes it, for the ``probes`` pairs of signed axes nearest to it."""
    def near(rotated):
        far = np.abs(rotated).max(1, keepdims=True) - np.stack([rotated, -rotated], 2).reshape(len(rotated), -1)
        order = np.argsort(far, 1, kind="stable")
        return order, np.take_along_axis(far, order, 1) ** 2

    (a, far_a), (b, far_b) = near(first), near(second)
    # pair (i, j) of the sorted axes has (i + 1) * (j + 1) - 1 pairs before it
    i, j = np.nonzero(np.outer(np.arange(a.shape[1]) + 1, np.arange(b.shape[1]) + 1) <= probes)
    best = np.argsort(far_a[:, i] + far_b[:, j], 1, kind="stable")[:, :probes]
    out = np.zeros((len(first), a.shape[1], b.shape[1]), bool)
    rows = np.arange(len(first))[:, None]
    out[rows, a[rows, i[best]], b[rows, j[best]]] = True
    return out


def _matrices(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors of a batch, for each length that vectors have."""
    column = b.column("vector")
    lengths = np.diff(np.asarray(column.offsets))
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield rows, np.asarray(column.take(pa.array(rows)).flatten()).reshape(-1, dim)


CELL = ["dim", "band", "t", "cell", "salt"]
PLACED = "dim int, band int, t int, cell int, salt int, query boolean, bucket binary, cls long, vector array<double>"


class Hashing:
    """The tables' hashes of vectors' directions."""

    def __init__(self, tables: int, probes: int, seed: int):
        self.tables, self.probes, self.seed = tables, probes, seed

    def rotations(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        scaled = x / np.abs(x).max(1, keepdims=True)
        units = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
        for t in range(self.tables):
            yield t, rotate(units, self.seed, t, 0), rotate(units, self.seed, t, 1)


def _cells(hashing: Hashing, bands: set[tuple[int, int]]):
    """How many vectors each cell of the bands ``(dim, band)`` has, one row for each cell that a task meets."""
    names = ["dim", "band", "t", "cell"]

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple, int] = {}
        for b in it:
            band = np.asarray(b.column("band"))
            for own, x in _matrices(b):
                hashed = np.array([(x.shape[1], int(v)) in bands for v in band[own]])
                for t, first, _ in hashing.rotations(x[hashed]) if hashed.any() else ():
                    keys, counts = np.unique(np.stack([band[own[hashed]], nearest_axis(first)], 1), axis=0, return_counts=True)
                    for (of, cell), m in zip(keys.tolist(), counts.tolist()):
                        key = (x.shape[1], of, t, cell)
                        n[key] = n.get(key, 0) + m
        yield pa.record_batch([*(pa.array([k[i] for k in n], pa.int32()) for i in range(4)), pa.array(list(n.values()), pa.int64())], names=[*names, "n"])
    return count


def _place(hashing: Hashing, parts: dict[tuple, int], bands: dict[tuple[int, int], float]):
    """Rows ``(dim, band, t, cell, salt, query, bucket, cls, vector)``: vectors in their buckets, and queries
    in each cell they probe, ``bucket`` being a bit mask there.

    ``bands``: the logarithm of the largest length in each ``(dim, band)`` to search now.  A query's
    ``needed`` is the logarithm of the score below which it needs nothing more, if there is one.
    """
    names = [*CELL, "query", "bucket", "cls", "vector"]

    def rows(b, chosen, x, band, t, cell, salt, query, bucket):
        n = len(chosen)
        return pa.record_batch(
            [pa.array(np.full(n, x.shape[1]), pa.int32()), pa.array(band, pa.int32()), pa.array(np.full(n, t), pa.int32()), pa.array(cell, pa.int32()),
             pa.array(salt, pa.int32()), pa.array(np.full(n, query)), pa.array(bucket, pa.binary()),
             b.column("cls").take(pa.array(chosen)), b.column("vector").take(pa.array(chosen))], names=names)

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for a in range(0, whole.num_rows, 128):
                b = whole.slice(a, 128)
                cls, band, is_query, log_length = (np.asarray(b.column(c)) for c in ("cls", "band", "is_query", "log_length"))
                needed = np.asarray(b.column("needed").fill_null(-np.inf))
                for own, x in _matrices(b):
                    dim = x.shape[1]
                    held = np.flatnonzero([(dim, int(v)) in bands for v in band[own]])
                    for t, first, second in hashing.rotations(x[held]) if len(held) else ():
                        cell, of = nearest_axis(first), band[own[held]]
                        split = np.array([parts[dim, int(v), t, int(c)] for v, c in zip(of, cell)])
                        bucket = [int(v).to_bytes(4, "big") for v in nearest_axis(second)]
                        yield rows(b, own[held], x, of, t, cell, cls[own[held]] % split, False, bucket)
                    reach = {v: log_length[own] + most + MARGIN >= needed[own] for (d, v), most in bands.items() if d == dim}
                    asks = np.flatnonzero(is_query[own] & np.any([*reach.values(), np.zeros(len(own), bool)], axis=0))
                    for t, first, second in hashing.rotations(x[asks]) if len(asks) else ():
                        wanted = probed(first, second, hashing.probes)
                        for of, near in reach.items():
                            q, cell = np.nonzero(wanted.any(2) & near[asks, None])
                            masks = np.packbits(wanted[q, cell], axis=1)
                            split = np.array([parts.get((dim, of, t, int(c)), 0) for c in cell], np.int64)
                            each = np.repeat(np.arange(len(q)), split)  # a query visits all parts; cells without vectors have none
                            salt = np.arange(len(each)) - np.repeat(np.cumsum(split) - split, split)
                            yield rows(b, own[asks[q[each]]], x, np.full(len(each), of), t, cell[each], salt, True, [m.tobytes() for m in masks[each]])

    return place


def _blocks(vectors: DataFrame, queries: DataFrame, block_rows: int) -> DataFrame:
    """Rows as ``_place`` makes them, so that every query meets every vector of its dimension.

    Vectors and queries are dealt to parts of about ``block_rows``; each two parts are a cell.
    """
    def counted(rows, name):
        return rows.groupBy(F.size("vector").alias("dim")).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(name))

    def dealt(rows, query, own, of_own, other, of_other, bucket):
        part = F.pmod(F.xxhash64("cls"), F.col(of_own)).cast("int").alias(own)
        each = F.explode(F.sequence(F.lit(0), F.col(of_other) - 1)).alias(other)
        fixed = [F.lit(0).alias("band"), F.lit(0).alias("t"), F.lit(query).alias("query"), F.lit(bytearray(bucket)).alias("bucket")]
        return rows.withColumn("dim", F.size("vector")).join(parts, "dim").select("dim", part, each, *fixed, "cls", "vector").select(*CELL, "query", "bucket", "cls", "vector")

    parts = materialize(counted(vectors, "of_vectors").join(counted(queries, "of_queries"), "dim"), "blocks")
    return (dealt(vectors, False, "salt", "of_vectors", "cell", "of_queries", b"\0").unionByName(
            dealt(queries, True, "cell", "of_queries", "salt", "of_vectors", b"\x80")))


def _rounds(bands: list) -> list[dict[tuple[int, int], float]]:
    """The logarithm of the largest length of each ``(dim, band)``, from the longest vectors on; a round has
    at least as many vectors as all before it."""
    rounds: list[dict] = []
    for dim in sorted({b["dim"] for b in bands}):
        at = before = now = 0
        for b in sorted((b for b in bands if b["dim"] == dim), key=lambda b: b["band"]):
            if at == len(rounds):
                rounds.append({})
            rounds[at][dim, b["band"]] = b["most"]
            now += b["n"]
            if now >= before:
                at, before, now = at + 1, before + now, 0
    return rounds


class SoFar:
    """For each query a score that ``keep`` classes of this task reach, so that lower ones needn't be told.

    Cells of one table hold different classes, so their best scores add up; the next table begins anew.
    Queries share ``SLOTS`` places, where the last one stays; one that lost its place tells more.
    """

    def __init__(self, keep: int):
        self.keep, self.table = keep, None
        self.owner, self.floor = np.full(SLOTS, -1, np.int64), np.full(SLOTS, -np.inf)
        self.scores = np.full((SLOTS, keep), -np.inf)

    def turn(self, table: tuple) -> None:
        if table != self.table:
            self.table = table
            self.scores.fill(-np.inf)

    def of(self, asking: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = (asking ^ asking >> 33) % SLOTS
        return slot, np.where(self.owner[slot] == asking, self.floor[slot], -np.inf)

    def add(self, slot, asking, q, place, scores) -> None:
        own = (self.owner[slot] == asking)[:, None]
        new = np.full((len(asking), self.keep), -np.inf)
        new[q, place] = scores
        all_ = np.concatenate([np.where(own, self.scores[slot], -np.inf), new], 1)
        top = -np.partition(-all_, self.keep - 1, 1)[:, : self.keep]
        floor = np.maximum(np.where(own[:, 0], self.floor[slot], -np.inf), top.min(1))
        self.owner[slot], self.floor[slot], self.scores[slot] = asking, floor, top


def _search(keep: int):
    """Rows sorted by cell, vectors before queries: each query's best ``keep`` of the buckets it probes."""

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, vectors, buckets, classes = None, [], [], []
        so_far = SoFar(keep)
        for b in it:
            keys = np.stack([np.asarray(b.column(c)) for c in CELL] + [np.asarray(b.column("query")).astype(np.int32)], 1)
            edges = np.r_[0, np.flatnonzero((np.diff(keys, axis=0) != 0).any(1)) + 1, len(keys)]
            for a, z in zip(edges[:-1].tolist(), edges[1:].tolist()):
                cell, some = tuple(keys[a, : len(CELL)].tolist()), b.slice(a, z - a)
                x = np.asarray(some.column("vector").flatten()).reshape(-1, cell[0])
                if cell != at:
                    at, vectors, buckets, classes = cell, [], [], []
                    so_far.turn(cell[:3])
                if not keys[a, len(CELL)]:
                    vectors.append(x)
                    buckets.append(np.array([int.from_bytes(v, "big") for v in some.column("bucket").to_pylist()]))
                    classes.append(np.asarray(some.column("cls")))
                elif vectors:
                    if len(vectors) > 1:
                        vectors, buckets, classes = [np.concatenate(vectors)], [np.concatenate(buckets)], [np.concatenate(classes)]
                    for q in range(0, len(x), 256):
                        masks = np.unpackbits(np.frombuffer(b"".join(some.column("bucket").slice(q, 256).to_pylist()), np.uint8).reshape(len(x[q : q + 256]), -1), axis=1)
                        yield from best(x[q : q + 256], np.asarray(some.column("cls"))[q : q + 256], masks.astype(bool), vectors[0], buckets[0], classes[0], so_far)

    def best(x, asking, masks, vectors, buckets, classes, so_far):
        slot, floor = so_far.of(asking)
        scores = np.where(masks[:, buckets], x @ vectors.T, -np.inf)
        m = min(keep, scores.shape[1])
        least = np.maximum(np.partition(scores, -m, 1)[:, -m], floor)
        # whatever may tie with the last one is kept until scores are exact
        slack = 1e-14 * x.shape[1] * np.linalg.norm(x, axis=1) * np.linalg.norm(vectors, axis=1).max()
        q, found = np.nonzero(np.isfinite(scores) & (scores >= (least - slack)[:, None]))
        exact = np.concatenate([np.zeros(0), *(np.add.reduce(x[q[a : a + PAIRS]] * vectors[found[a : a + PAIRS]], 1) for a in range(0, len(q), PAIRS))])
        order = np.lexsort((classes[found], -exact, q))
        place = np.arange(len(q)) - np.searchsorted(q, q)  # q is sorted, and stays so
        few = (place < keep) & (exact[order] >= floor[q])
        q, order = q[few], order[few]
        so_far.add(slot, asking, q, place[few], exact[order])
        yield pa.record_batch([pa.array(asking[q]), pa.array(classes[found[order]]), pa.array(exact[order])], names=["asking", "cls", "score"])

    return search


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, tables: int = 12, probes: int = 640, seed: int = 11,
            cell_rows: int = 50_000, exact_rows: int = 1_000, block_rows: int = 5_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` largest inner products found for each query.  A query
    for which hashing doesn't find enough, even with further probes, is ranked against all vectors.

    ``is_query`` is a condition on ``id_col``.  Nearest first, ties to the smaller id; never the query's
    own row; fewer rows where there are fewer candidates.  Null ids, and vectors that are null, empty,
    zero or hold null or non-finite components, take no part; vectors of different lengths never meet.
    Rows that repeat id and vector are one.  An id with several vectors is a candidate with each; as a
    query it asks with each, and ranks run for each.  Other columns aren't read; an empty table gives no
    rows.  Bands searched whole have at most ``exact_rows`` vectors each, together at most ``OUTLYING``
    of all of their dimension; they are searched in blocks of ``block_rows``.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias(id_col), F.col(vector_col).cast("array<double>").alias("vector"))
    usable = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    rows = rows.filter(F.col(id_col).isNotNull() & usable).distinct()
    rows = materialize(rows.select(F.col(id_col).alias("id"), "vector", is_query.alias("is_query")), "vectors")
    queries = rows.filter("is_query").select("id", "vector")

    smallest = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    classes = (rows.withColumn("n", smallest).filter(F.col("n") <= k + 1).groupBy("vector")
               .agg(F.sort_array(F.collect_list("id")).alias("ids")))
    # numbers in the order of smallest ids, so that ties of classes go to these; they hold once written
    classes = materialize(classes.orderBy(F.col("ids")[0], "vector").withColumn("cls", F.monotonically_increasing_id()), "numbered")
    asked = queries.select("vector").distinct().withColumn("asked", F.lit(True))
    classes = classes.join(asked, "vector", "left").withColumn("is_query", F.coalesce("asked", F.lit(False))).drop("asked")
    largest = F.array_max(F.transform("vector", F.abs))
    log_length = F.log(largest) + F.log(F.aggregate("vector", F.lit(0.0), lambda s, v: s + (v / largest) * (v / largest))) / 2
    classes = materialize(classes.withColumn("dim", F.size("vector")).withColumn("log_length", log_length), "classes")
    longest = classes.groupBy("dim").agg(F.max("log_length").alias("longest"))
    band = F.floor((F.col("longest") - F.col("log_length")) / BAND).cast("int")
    classes = materialize(classes.join(longest, "dim").withColumn("band", band).drop("longest"), "banded")
    bands = classes.groupBy("dim", "band").agg(F.count(F.lit(1)).alias("n"), F.max("log_length").alias("most"))
    asking = classes.filter("is_query")

    def searched(dealt: DataFrame, hits: int) -> DataFrame:
        dealt = dealt.repartition(*CELL).sortWithinPartitions(*CELL, "query")
        return dealt.mapInArrow(_search(k + 1), "asking long, cls long, score double").withColumn("hits", F.lit(hits))

    best = Window.partitionBy("asking").orderBy(F.desc("score"), "cls")

    def merged(top: DataFrame | None, found: DataFrame) -> DataFrame:
        """Each query's best ``k + 1`` classes: its own may be one of them."""
        found = found.groupBy("asking", "cls").agg(F.max("score").alias("score"), F.sum("hits").cast("int").alias("hits"))
        if top is not None:  # a class is met in one band, or again when a query goes on
            found = top.unionByName(found).groupBy("asking", "cls").agg(F.max("score").alias("score"), F.max("hits").alias("hits"))
        return materialize(found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n"), "top")

    every = max(tables, 3)  # hits of what isn't left to chance
    of_dim = Window.partitionBy("dim")  # bands of a dimension: no more than factors of 1.05 between the least and the largest number
    up_to = F.sum("n").over(of_dim.orderBy("n", "band").rowsBetween(Window.unboundedPreceding, 0))
    whole = (up_to <= OUTLYING * F.sum("n").over(of_dim)) & (F.col("n") <= exact_rows)
    bands = materialize(bands.withColumn("whole", whole), "bands")
    small = bands.filter("whole").select("dim", "band")
    top = merged(None, searched(_blocks(classes.join(small, ["dim", "band"], "left_semi"), asking, block_rows), every))

    large = bands.filter(~F.col("whole")).collect()
    hashing = Hashing(tables, probes, seed)
    hashed = {(b["dim"], b["band"]) for b in large}
    cells = (classes.select("vector", "band").mapInArrow(_cells(hashing, hashed), "dim int, band int, t int, cell int, n long")
             .groupBy("dim", "band", "t", "cell").agg(F.sum("n").alias("n")).collect()) if large else []  # at most 4 * dimension * tables rows a band
    parts = {(r["dim"], r["band"], r["t"], r["cell"]): -(-r["n"] // cell_rows) for r in cells}
    for now in _rounds(large):
        full = top.groupBy("asking").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst")).filter((F.col("n") > k) & (F.col("worst") > 0))
        known = classes.join(full.select(F.col("asking").alias("cls"), F.log("worst").alias("needed")), "cls", "left")
        known = known.select("cls", "vector", "is_query", "band", "log_length", "needed")
        top = merged(top, searched(known.mapInArrow(_place(hashing, parts, now), PLACED), 1))

    once, twice = (F.count_if(F.col("hits") == n) for n in (1, 2))
    candidates = bands.groupBy("dim").agg(F.sum("n").alias("candidates"))

    def starved(top: DataFrame) -> DataFrame:
        counts = top.groupBy(F.col("asking").alias("cls")).agg(F.count(F.lit(1)).alias("n"), (once * (once - 1) / (2 * (twice + 1))).alias("unseen"))
        too_few = F.coalesce("n", F.lit(0)) < F.least(F.lit(k + 1), "candidates")
        found = asking.join(counts, "cls", "left").join(candidates, "dim").filter(too_few | (F.col("unseen") > UNSEEN * F.col("n")))
        return materialize(found.select("cls", "vector"), "starved")

    left = starved(top)
    if large and not left.isEmpty():
        known = classes.drop("is_query").join(left.select("cls", F.lit(True).alias("goes_on")), "cls", "left")
        known = known.select("cls", "vector", F.coalesce("goes_on", F.lit(False)).alias("is_query"), "band", "log_length", F.lit(None).cast("double").alias("needed"))
        every_band = {(b["dim"], b["band"]): b["most"] for b in large}
        further = Hashing(tables, FURTHER * probes, seed)
        top = merged(top, searched(known.mapInArrow(_place(further, parts, every_band), PLACED), 1))
        left = starved(top)
    if not left.isEmpty():
        top = merged(top, searched(_blocks(classes, left, block_rows), every))

    listed = top.join(classes.select("cls", "ids"), "cls").select("asking", (F.col("asking") == F.col("cls")).alias("own"), F.explode("ids").alias("vec_id"), "score")
    listed = (listed.withColumn("n", F.row_number().over(Window.partitionBy("asking").orderBy(F.desc("score"), "vec_id")))
              .filter(F.col("n") <= k + 1).drop("n"))
    who = queries.join(classes.select("vector", F.col("cls").alias("asking")), "vector").select(F.col("id").alias("query_id"), "asking")
    result = who.join(listed, "asking").filter(~F.col("own") | (F.col("vec_id") != F.col("query_id")))
    rank = F.row_number().over(Window.partitionBy("query_id", "asking").orderBy(F.desc("score"), "vec_id"))
    return result.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
