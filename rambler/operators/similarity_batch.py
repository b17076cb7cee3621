"""E8 for a table of keys: exact cosine top-N of many keys, without scoring all pairs.

Every vector goes to its nearest pivot (a bounded sample of the vectors), and rows are laid out by
(pivot, angle to the pivot).  A block is a stretch of this order with one pivot, so a block knows its
smallest and largest angle.  Angles obey the triangle inequality: a query at angle a to the pivot is at
least max(0, a - largest, smallest - a) away from every row of the block, and a block whose bound falls
below the query's (n+1)-th best score so far is skipped for that query, exactly.

Queries come in chunks of bounded size, broadcast one after another; rows never move for a query.  A
chunk makes two passes: each query searches the blocks of its own pivot, which gives it a first
(n+1)-th best score, and then all blocks that this score doesn't rule out.  A task keeps n+1 rows a
query.  Scores are folded left to right like ``rambler.functions.vectors``, so they equal the other
similarity queries' in every bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rambler.functions.vectors import norm
from rambler.session import materialize

_MARGIN = 1e-9      # what a matrix product can differ from the folded score, and more
_HELD = 1 << 19     # found pairs that a task holds before it keeps the best


@dataclass(frozen=True)
class BlockSettings:
    pivots: int = 2_048             # at most; the square root of the number of rows, if that is less
    block_rows: int = 2_048
    broadcast_bytes: int = 64 << 20  # of queries at once


@dataclass
class BatchSimilarity:
    rows: DataFrame     # (query, rank, key, cos): rank from 1, the query itself among them
    counts: DataFrame   # one row (scored, skipped): pairs of a query and a row


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten()
    return np.asarray(flat, dtype=np.float64).reshape(-1, dim)


def _round(x: np.ndarray, digits: int | None) -> np.ndarray:
    """Half up on the shortest decimal text, as Spark's ``round`` does."""
    if digits is None:
        return x
    scaled = np.abs(x) * 10.0**digits
    out = np.copysign(np.floor(scaled + 0.5) / 10.0**digits, x)
    step = Decimal(1).scaleb(-digits)
    for i in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-4):
        out[i] = float(Decimal(repr(float(x[i]))).quantize(step, rounding=ROUND_HALF_UP))
    return out


def _folded_cosines(x: np.ndarray, y: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x))
    for i in range(x.shape[1]):
        total = total + x[:, i] * y[:, i]
    return total / lengths


class _Search:
    """A chunk's queries, and the best rows that one task has found for each."""

    def __init__(self, names, vectors, norms, angles, least, n, digits):
        self.names, self.vectors, self.norms, self.n, self.digits = names, vectors, norms, n, digits
        self.unit = vectors / norms[:, None]
        self.angles, self.least = angles, least.copy()
        self.best = pd.DataFrame({"q": np.zeros(0, np.int64), "cos": np.zeros(0), "key": np.zeros(0, object)})
        self.new, self.held, self.scored, self.skipped = [], 0, 0, 0

    def block(self, pivot: int, low: float, high: float, keys: np.ndarray, vectors: np.ndarray, norms: np.ndarray, only: np.ndarray | None) -> None:
        to_pivot = self.angles[:, pivot]
        nearest = np.maximum(0.0, np.maximum(to_pivot - high, low - to_pivot))
        wanted = np.cos(nearest) + _MARGIN >= self.least
        if only is not None:
            wanted &= only == pivot
        wanted = np.flatnonzero(wanted)
        self.scored += len(wanted) * len(keys)
        self.skipped += (len(self.names) - len(wanted)) * len(keys)
        unit = vectors / norms[:, None]
        for at in range(0, len(wanted), 512):
            some = wanted[at : at + 512]
            q, r = np.nonzero(self.unit[some] @ unit.T >= self.least[some, None] - _MARGIN)
            q = some[q]
            cos = _round(_folded_cosines(self.vectors[q], vectors[r], self.norms[q] * norms[r]), self.digits)
            self.new.append(pd.DataFrame({"q": q, "cos": cos, "key": keys[r]}))
            self.held += len(q)
            if self.held >= _HELD:
                self.keep_best()

    def keep_best(self) -> None:
        found = pd.concat([self.best, *self.new]) if self.new else self.best
        found = found.sort_values(["q", "cos", "key"], ascending=[True, False, True], kind="stable")
        place = found.groupby("q").cumcount()
        self.best = found[place <= self.n].reset_index(drop=True)
        last = self.best[self.best.groupby("q").cumcount() == self.n]
        slack = 0.0 if self.digits is None else 0.5 * 10.0**-self.digits + 1e-12    # what rounds to the same score
        q = last["q"].to_numpy()
        self.least[q] = np.maximum(self.least[q], last["cos"].to_numpy() - slack)
        self.new, self.held = [], 0


def _angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))


def lay_out(rows: DataFrame, pivots: np.ndarray, dim: int) -> DataFrame:
    """``(key, vector, length)`` with ``pivot`` and ``angle``, written in this order."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                some = b.slice(at, 4096)
                x = _matrix(some.column("vector"), dim)
                angles = _angles(x / np.asarray(some.column("length"))[:, None], shared.value)
                nearest = angles.argmin(1)
                yield pa.record_batch([*some.columns, pa.array(nearest.astype(np.int32)), pa.array(angles[np.arange(len(x)), nearest])],
                                      names=["key", "vector", "length", "pivot", "angle"])

    placed = materialize(rows.mapInArrow(place, "key string, vector array<double>, length double, pivot int, angle double"), "placed")
    order = ["pivot", "angle", "key"]
    return materialize(placed.repartitionByRange(*order).sortWithinPartitions(*order), "blocks")


def _pass(laid_out: DataFrame, chunk, own: bool, dim: int, block_rows: int) -> DataFrame:
    """Search every block for the broadcast queries: ``(query, key, cos, scored, skipped)``; counts have no query."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = chunk.value
        s = _Search(*queries)
        only = s.angles.argmin(1) if own else None
        for b in batches:
            pivot, angle, length = (np.asarray(b.column(c)) for c in ("pivot", "angle", "length"))
            keys, vectors = b.column("key").to_numpy(zero_copy_only=False), _matrix(b.column("vector"), dim)
            cuts = np.flatnonzero(np.diff(pivot)) + 1
            for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(pivot)]):
                for at in range(x, y, block_rows):
                    to = min(y, at + block_rows)
                    s.block(int(pivot[at]), angle[at], angle[to - 1], keys[at:to], vectors[at:to], length[at:to], only)
        s.keep_best()
        n = len(s.best)
        yield pa.record_batch([pa.array(s.names[s.best["q"].to_numpy()], pa.string()), pa.array(s.best["key"].to_numpy(), pa.string()),
                               pa.array(s.best["cos"].to_numpy()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                              names=["query", "key", "cos", "scored", "skipped"])
        yield pa.record_batch([pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), pa.nulls(1, pa.float64()), pa.array([s.scored]), pa.array([s.skipped])],
                              names=["query", "key", "cos", "scored", "skipped"])

    return laid_out.mapInArrow(search, "query string, key string, cos double, scored long, skipped long")


def top_n_similar_batch(vectors: DataFrame, keys: DataFrame, n: int, key: str = "key", digits: int | None = None,
                        settings: BlockSettings = BlockSettings()) -> BatchSimilarity:
    """E8 for many keys: the ``n + 1`` most similar rows of every key of ``keys`` that has a vector.

    The same rows as ``top_n_similar`` for each key: by cosine (rounded to ``digits``), then key, the key
    itself included.  A vector without a direction (zero, or of non-finite length) has cosine NaN with all
    others, which sorts above every number.  Null vectors take no part, ``missing_keys`` lists keys without
    one; keys repeated in ``keys`` count once, rows that repeat a key in ``vectors`` are rows of their own.
    """
    spark = vectors.sparkSession
    rows = materialize(vectors.filter(F.col("vector").isNotNull()).select(F.col(key).cast("string").alias("key"), "vector", norm("vector").alias("length")), "vectors")
    found = F.col("length").between(5e-324, 1.7976931348623157e308)
    straight, flat = rows.filter(found), rows.filter(~found)
    size = straight.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("vector")).alias("low"), F.max(F.size("vector")).alias("dim")).first()
    if size["n"] and size["low"] != size["dim"]:
        raise ValueError("vectors of different sizes")
    # a query with a direction meets the first n + 1 rows without one; a query without one, the first of all rows
    firsts = lambda df: df.orderBy("key").limit(n + 1).agg(F.array_sort(F.collect_list("key")).alias("k")).select("k").scalar()
    wanted = keys.select(F.col(key).cast("string").alias("query")).distinct()
    asked = materialize(wanted.join(rows, F.col("query") == F.col("key")).select("query", "vector", "length"), "queries")
    nan = F.lit(float("nan"))
    parts = [asked.filter(found).select("query", F.explode(firsts(flat)).alias("key"), nan.alias("cos")),
             asked.filter(~found).select("query", F.explode(firsts(rows)).alias("key"), nan.alias("cos"))]
    counts = spark.createDataFrame([], "scored long, skipped long")
    if size["n"]:
        dim = size["dim"]
        n_pivots = max(1, min(settings.pivots, int(size["n"] ** 0.5)))
        some = straight.orderBy(F.xxhash64("key"), "key").limit(n_pivots).select("vector", "length").collect()   # bounded by settings.pivots
        pivots = np.array([r["vector"] for r in some]) / np.array([r["length"] for r in some])[:, None]
        laid_out = lay_out(straight, pivots, dim)
        queries = asked.filter(found)
        n_chunks = -(-queries.count() * (dim + len(pivots)) * 16 // settings.broadcast_bytes)   # vectors, units and angles
        for c in range(n_chunks):
            held = queries.filter(F.pmod(F.xxhash64("query"), F.lit(n_chunks)) == c).orderBy("query").toPandas()
            if held.empty:
                continue
            x, length = np.stack(held["vector"].to_numpy()), held["length"].to_numpy()
            first = (held["query"].to_numpy(), x, length, _angles(x / length[:, None], pivots), np.full(len(x), -2.0), n, digits)
            chunk = spark.sparkContext.broadcast(first)
            near = materialize(_pass(laid_out, chunk, True, dim, settings.block_rows), "own-pivots")
            slack = 0.0 if digits is None else 0.5 * 10.0**-digits + 1e-12
            by_score = Window.partitionBy("query").orderBy(F.col("cos").desc(), "key")
            least = (near.filter("query IS NOT NULL").withColumn("place", F.row_number().over(by_score)).filter(F.col("place") == n + 1)
                     .select("query", "cos").toPandas().set_index("query")["cos"])      # one number a query of the chunk
            known = pd.Series(first[0]).map(least).fillna(-2.0).to_numpy(np.float64) - slack
            second = spark.sparkContext.broadcast((*first[:4], known, n, digits))
            done = materialize(_pass(laid_out, second, False, dim, settings.block_rows), "all-blocks")
            parts.append(done.filter("query IS NOT NULL").select("query", "key", "cos"))
            for made in (near, done):
                counts = counts.unionByName(made.filter("query IS NULL").select("scored", "skipped"))
    candidates = parts[0]
    for p in parts[1:]:
        candidates = candidates.unionByName(p)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("cos").desc(), "key"))
    best = candidates.withColumn("rank", place).filter(F.col("rank") <= n + 1).select("query", "rank", "key", "cos")
    return BatchSimilarity(best, counts.agg(F.sum("scored").alias("scored"), F.sum("skipped").alias("skipped")))
