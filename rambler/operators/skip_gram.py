"""E1/E2 for vocabularies of any size: skip-gram with negative sampling over buckets of words.

Spark ML's Word2Vec holds the whole vocabulary's vectors on the driver.  Here both matrices (a word as
centre, a word as context) are tables.  Words are dealt to B buckets by hash, and an epoch has B rounds: in
round r, centre bucket i trains against context bucket (i + r) % B, for all i at once.  No two tasks of a
round share a bucket, so rounds need no locks and the result doesn't depend on their order or on the
number of partitions.  A task holds one centre and one context bucket (``bucket_bytes`` bounds them, and
``BUCKET_WORDS``, so that a large vocabulary is the work of many tasks) and streams their pairs; each round's matrices are a written table, from which a lost executor's work starts
again.

Pairs within the window are counted over all walks first, so a pair that occurs often is one row with its
count.  Within a round they go in the order of a keyed hash, in batches of fixed size; negative contexts
are drawn from the task's context bucket by count ** 0.75, from a generator keyed by seed, epoch, round,
bucket and batch.  Steps are scaled by rows' past gradients (Adagrad), whose sum is a column of the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rambler.functions.vectors import cosine, norm
from rambler.params import Word2VecParams
from rambler.session import delete_scratch, materialize, write_scratch

BATCH = 256             # pairs that are trained at once
SENTENCE_PIECE = 1000   # words whose pairs are made from one row
BUCKET_WORDS = 1 << 17  # of a bucket, about, unless the number of buckets is given
CENTRE, CONTEXT, PAIR = 0, 1, 2
_ROW = "side int, bucket long, word string, other string, n long, vec array<float>, g2 float"


def _word_counts(tokens: DataFrame, params: Word2VecParams, col: str) -> DataFrame:
    words = tokens.select(F.explode(col).alias("word")).filter("word IS NOT NULL")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= params.min_count)


def context_pairs(tokens: DataFrame, window: int, col: str = "tokens") -> DataFrame:
    """``(word, other, n)``: how often two words stand within ``window`` places, for both orders."""
    t = tokens.select(F.filter(col, lambda x: x.isNotNull()).alias("t")).filter(F.size("t") > 1)
    piece = t.select("t", F.explode(F.sequence(F.lit(1), F.size("t"), F.lit(SENTENCE_PIECE))).alias("at"))
    piece = piece.select(F.slice("t", F.col("at"), F.lit(SENTENCE_PIECE)).alias("own"), F.slice("t", F.col("at") + 1, F.lit(SENTENCE_PIECE + window - 1)).alias("after"))
    ahead = lambda k: F.zip_with("own", F.slice("after", k, F.lit(SENTENCE_PIECE)), lambda a, b: F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), b.alias("c")))
    found = piece.select(F.explode(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(window)), ahead))).alias("p")).filter("p.c IS NOT NULL")
    counted = found.groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("a").alias("word"), F.col("b").alias("other"), "n").unionByName(counted.select(F.col("b").alias("word"), F.col("a").alias("other"), "n"))


def _first_matrices(words: DataFrame, params: Word2VecParams, bucket) -> DataFrame:
    """Centres start at keyed draws in +-1/(2 dim), contexts at zero."""
    unit = lambda i: (F.pmod(F.xxhash64(F.lit(params.seed), F.col("word"), i), F.lit(1 << 24)) / F.lit(float(1 << 24)) - 0.5) / params.dim
    start = F.transform(F.sequence(F.lit(1), F.lit(params.dim)), unit).cast("array<float>")
    zero = F.array_repeat(F.lit(0.0).cast("float"), params.dim)
    columns = lambda side, vec: words.select(F.lit(side).alias("side"), bucket("word").alias("bucket"), "word", F.lit(None).cast("string").alias("other"),
                                             "n", vec.alias("vec"), F.lit(0.0).cast("float").alias("g2"))
    return columns(CENTRE, start).unionByName(columns(CONTEXT, zero))


class _Matrix:
    """A bucket's words in order, with their vectors and past squared gradients."""

    def __init__(self, parts: list[pa.Table], dim: int):
        rows = pa.concat_tables(parts)
        self.words = pd.Index(rows.column("word").to_pandas())
        self.counts = rows.column("n").to_numpy().astype(np.float64)
        self.vec = rows.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim).copy()
        self.g2 = rows.column("g2").to_numpy().copy()

    def step(self, at: np.ndarray, gradient: np.ndarray, lr: float) -> None:
        order = np.argsort(at, kind="stable")
        rows, begins = np.unique(at[order], return_index=True)
        total = np.add.reduceat(gradient[order], begins, axis=0)
        self.g2[rows] += (total * total).mean(1)
        self.vec[rows] += lr * total / np.sqrt(self.g2[rows] + 1e-10)[:, None]

    def batches(self, side: int, bucket: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.words), 10_000):
            some = slice(at, at + 10_000)
            n = len(self.words[some])
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * self.vec.shape[1])
            yield pa.record_batch([pa.array(np.full(n, side, np.int32)), pa.array(np.full(n, bucket, np.int64)), pa.array(self.words[some], pa.string()),
                                   pa.nulls(n, pa.string()), pa.array(self.counts[some].astype(np.int64)),
                                   pa.ListArray.from_arrays(offsets, pa.array(self.vec[some].ravel())), pa.array(self.g2[some])], schema=schema)


def _train_batch(centres: _Matrix, contexts: _Matrix, c, o, times, noise, negatives: int, lr: float, rng) -> None:
    """One step on a batch of pairs ``c``, ``o`` that occur ``times``."""
    drawn = np.searchsorted(noise, rng.random((len(c), negatives)) * noise[-1], side="right").clip(max=len(noise) - 1)
    at = np.concatenate([o[:, None], drawn], 1)
    x, y = centres.vec[c], contexts.vec[at]
    score = 1.0 / (1.0 + np.exp(-np.einsum("pd,pkd->pk", x, y).clip(-30, 30)))
    share = -score
    share[:, 0] += 1.0
    share[:, 1:][drawn == o[:, None]] = 0.0     # the pair's own context is no negative one
    share = (share * times[:, None]).astype(np.float32)
    for_x = np.einsum("pk,pkd->pd", share, y)
    for_y = (share[:, :, None] * x[:, None, :]).reshape(-1, x.shape[1])
    centres.step(c, for_x, lr)
    contexts.step(at.ravel(), for_y, lr)


def _round(matrices: DataFrame, pairs: DataFrame, epoch: int, turn: int, n_buckets: int, params: Word2VecParams) -> DataFrame:
    dim, lr, seed, negatives = params.dim, params.bucket_lr, params.seed, params.negatives
    task = F.when(F.col("side") == CONTEXT, F.pmod(F.col("bucket") - turn, F.lit(n_buckets))).otherwise(F.col("bucket"))
    rows = matrices.withColumn("key", F.lit(0).cast("long")).unionByName(
        pairs.filter(F.col("shift") == turn).select(F.lit(PAIR).alias("side"), "bucket", "word", "other", "n", F.lit(None).cast("array<float>").alias("vec"),
                                                    F.lit(None).cast("float").alias("g2"), F.xxhash64(F.lit(seed), F.lit(epoch), "word", "other").alias("key")))
    rows = rows.withColumn("task", task.cast("int"))
    dealt = rows.repartitionById(n_buckets, F.col("task")).sortWithinPartitions("task", "side", "key", "word", "other").drop("key")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, held = None, {CENTRE: [], CONTEXT: [], PAIR: []}, 0
        ready = None
        schema = None

        def begin():
            centres, contexts = _Matrix(parts[CENTRE], dim), _Matrix(parts[CONTEXT], dim)
            return centres, contexts, np.cumsum(contexts.counts**0.75)

        def learn(all_: bool):
            """Train on the held pairs, but for those of a batch that isn't full."""
            nonlocal ready, held, number
            if not held:
                return
            if ready is None and not (parts[CENTRE] and parts[CONTEXT]):
                parts[PAIR], held = [], 0       # all of the bucket's words are too rare
                return
            if ready is None:
                ready = begin()
                parts[CENTRE], parts[CONTEXT] = [], []
            centres, contexts, noise = ready
            rows = pa.concat_tables(parts[PAIR])
            c, o = centres.words.get_indexer(rows.column("word").to_pandas()), contexts.words.get_indexer(rows.column("other").to_pandas())
            times = rows.column("n").to_numpy()
            upto = len(c) if all_ else len(c) // BATCH * BATCH
            for a in range(0, upto, BATCH):
                some = slice(a, min(a + BATCH, upto))
                known = (c[some] >= 0) & (o[some] >= 0)     # rare words have no vector
                rng = np.random.default_rng([seed, epoch, turn, at, number])
                number += 1
                if known.any():
                    _train_batch(centres, contexts, c[some][known], o[some][known], times[some][known], noise, negatives, lr, rng)
            parts[PAIR], held = ([rows.slice(upto)], len(c) - upto) if upto < len(c) else ([], 0)

        def finish():
            learn(True)
            centres, contexts = ready[:2] if ready else (parts[CENTRE] and _Matrix(parts[CENTRE], dim), parts[CONTEXT] and _Matrix(parts[CONTEXT], dim))
            if centres:
                yield from centres.batches(CENTRE, at, schema)
            if contexts:
                yield from contexts.batches(CONTEXT, (at + turn) % n_buckets, schema)

        number = 0
        for batch in batches:
            whole = pa.table(batch)
            schema = schema or whole.drop_columns(["task"]).schema
            task, side = whole.column("task").to_numpy(), whole.column("side").to_numpy()
            cuts = np.flatnonzero((np.diff(task) != 0) | (np.diff(side) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(task)]):
                if at is not None and task[a] != at:
                    yield from finish()
                    parts, held, ready, number = {CENTRE: [], CONTEXT: [], PAIR: []}, 0, None, 0
                at = int(task[a])
                parts[int(side[a])].append(whole.slice(a, b - a).drop_columns(["task"]))
                if side[a] == PAIR:
                    held += b - a
                    if held >= BATCH:
                        learn(False)
        if at is not None:
            yield from finish()

    return dealt.mapInArrow(train, _ROW)


def fit_skip_gram(tokens: DataFrame, params: Word2VecParams, col: str = "tokens") -> DataFrame:
    """``(key STRING, vector ARRAY<DOUBLE>)`` of every word with ``min_count`` occurrences.

    Equal on any number of partitions.  Null words are left out; an empty table gives no rows.
    """
    spark = tokens.sparkSession
    words = materialize(_word_counts(tokens, params, col), "words")
    size = words.count()
    row_bytes = 4 * params.dim + 100        # a vector, and about as much for its word and index as this
    n_buckets = params.buckets or max(1, -(-size * row_bytes // params.bucket_bytes), -(-size // BUCKET_WORDS))
    bucket = lambda c: F.pmod(F.xxhash64(F.lit(params.seed), c), F.lit(n_buckets))
    pairs = context_pairs(tokens, params.window, col)
    pairs = pairs.select(bucket("word").alias("bucket"), "word", "other", "n", F.pmod(bucket("other") - bucket("word"), F.lit(n_buckets)).cast("int").alias("shift"))
    # a round reads only its own folder
    pairs, pairs_path = write_scratch(pairs, "pairs", partition_by=["shift"])
    matrices, held = write_scratch(_first_matrices(words, params, bucket), "matrices")
    for epoch in range(params.iterations):
        for turn in range(n_buckets):
            before = held
            matrices, held = write_scratch(_round(matrices, pairs, epoch, turn, n_buckets, params), "matrices")
            delete_scratch(spark, before)
    delete_scratch(spark, pairs_path)
    return matrices.filter(F.col("side") == CENTRE).select(F.col("word").alias("key"), F.col("vec").cast("array<double>").alias("vector"))


def embedding_quality(vectors: DataFrame, tokens: DataFrame, dim: int, col: str = "tokens") -> DataFrame:
    """One row ``(words, dim, finite, neighbours_closer)`` about ``(key, vector)``.

    ``finite`` counts vectors of ``dim`` finite numbers that aren't all zero; ``neighbours_closer`` tells whether
    words that stand side by side in ``tokens`` have a higher mean cosine than all pairs of different words.  The
    latter mean comes from the sum of the unit vectors, not from pairs.
    """
    v = vectors.select("key", "vector", norm("vector").alias("length"))
    good = (F.size("vector") == dim) & (F.col("length") > 0) & (F.col("length") < float("inf"))
    unit = v.filter(good).select("key", F.posexplode(F.transform("vector", lambda x: x / F.col("length"))).alias("i", "x"))
    sums = unit.groupBy("i").agg(F.sum("x").alias("s"))
    total = sums.agg(F.sum(F.col("s") * F.col("s"))).first()[0] or 0.0
    n = v.filter(good).count()
    every = (total - n) / (n * (n - 1)) if n > 1 else 0.0
    pairs = context_pairs(tokens, 1, col).filter("word <> other").select("word", "other").distinct()
    a, b = (v.select(F.col("key").alias(k), F.col("vector").alias(f"v_{k}")) for k in ("word", "other"))
    near = pairs.join(a, "word").join(b, "other").agg(F.avg(cosine("v_word", "v_other"))).first()[0] or 0.0
    return v.agg(F.count(F.lit(1)).alias("words"), F.max(F.size("vector")).cast("bigint").alias("dim"), F.count_if(good).alias("finite"),
                 F.lit(near > every).alias("neighbours_closer"))
