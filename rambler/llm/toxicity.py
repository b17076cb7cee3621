"""Toxicity by non-negative positive-unlabelled learning.

The training data are confirmed toxic texts and unlabelled texts, a share of which (the class prior)
is toxic too; nobody says which.  The risk of a classifier is estimated from both:
``prior * loss(toxic as 1) + max(0, loss(unlabelled as 0) - prior * loss(toxic as 0))``; the difference
corrects for the toxic among the unlabelled and is kept from going below zero.

A text is toxic if some of it is.  A word has hashed features (itself and its beginnings), the sum of
their weights is its strength, and the strongest word of a text, scaled and shifted, is its logit.
``members`` classifiers are trained in numpy, each in its own task on its own sample; a score is the
mean of their probabilities.  Tasks that scan texts turn drawn ones into features, so that training
holds no texts.  Scoring reads whole texts, in slices of words.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rambler.llm.common import give_back

BEGINNINGS = (4, 5, 6)  # letters (bytes) of a word's beginning that make a feature
N_FEATURES = len(BEGINNINGS) + 1
SLICE_BYTES = 1 << 18  # of texts that are turned into features at once
TEXTS = 256  # that training looks at together


@dataclass(frozen=True)
class Settings:
    """``positives`` and ``unlabelled`` bound the rows that a classifier is trained on, ``sample_bytes`` the
    bytes of either kind (in expectation: rows are drawn by a hash of their id and text)."""

    members: int = 3
    positives: int = 1_500
    unlabelled: int = 5_000
    sample_bytes: int = 24 << 20
    bits: int = 20
    epochs: int = 30
    rate: float = 0.05
    smoothing: float = 4.0
    least_positives: int = 4
    seed: int = 5


_rng = np.random.default_rng(77)
_BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0xD6E8FEB86659FD93
_UNBASE = pow(_BASE, -1, 1 << 64)
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        out = np.full(max(n, 1 << 20), np.uint64(base))
        out[0] = 1
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base][:n]


_GAP = re.compile(rb"[^a-z\x80-\xff]")


def slices(texts: Iterable[str]) -> Iterator[list[tuple[int, bytes]]]:
    """Lists of ``(text's number, lower-case bytes)``, about ``SLICE_BYTES`` each; long texts are cut between words."""
    held, size = [], 0
    for i, text in enumerate(texts):
        data, a = text.lower().encode("utf-8", "replace"), 0
        while a == 0 or a < len(data):
            gap = _GAP.search(data, a + SLICE_BYTES)
            z = gap.end() if gap else len(data)
            held.append((i, data[a:z]))
            size += z - a
            if size >= SLICE_BYTES:
                yield held
                held, size = [], 0
            a = max(z, 1)
    if held:
        yield held


def word_features(parts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``[word, feature]`` buckets of all words in order, and how many words each part has."""
    parts = [p + b" " for p in parts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    letter = _IS_LETTER[data]
    edges = np.flatnonzero(np.diff(letter, prepend=False, append=False))
    begins, ends = edges[::2], edges[1::2]
    sums = np.cumsum(_BYTE_VALUES[data] * _powers(_BASE, len(data)))
    before = np.where(begins > 0, sums[begins - 1], np.uint64(0))
    shift = _powers(_UNBASE, len(data))[begins]
    out = np.empty((len(begins), N_FEATURES), np.int32)
    for k, n in enumerate((*BEGINNINGS, 0)):
        stop = np.minimum(begins + n, ends) if n else ends
        hashed = (sums[stop - 1] - before) * shift + np.uint64(n * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        hashed = (hashed ^ hashed >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
        out[:, k] = (hashed >> np.uint64(64 - bits)).astype(np.int32)
    part_ends = np.cumsum([len(p) for p in parts])
    return out, np.diff(np.searchsorted(begins, part_ends), prepend=0)


def _strongest(features: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strength of each text's strongest word (0 without words), and that word's number (-1)."""
    strength = sum(weights[features[:, k]] for k in range(N_FEATURES))
    filled = np.flatnonzero(counts)
    begins = (np.cumsum(counts) - counts)[filled]
    best, where = np.zeros(len(counts)), np.full(len(counts), -1)
    if len(filled):
        best[filled] = np.maximum.reduceat(strength, begins)
        hits = np.flatnonzero(strength == np.repeat(best[filled], counts[filled]))
        text = np.repeat(filled, counts[filled])[hits]
        first, at = np.unique(text, return_index=True)
        where[first] = hits[at]
    return best, where


def distinct_words(features: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's words once (by the bucket of the whole word)."""
    key = np.repeat(np.arange(len(counts)), counts) << 32 | features[:, -1]
    _, first = np.unique(key, return_index=True)
    first.sort()
    return features[first], np.bincount(key[first] >> 32, minlength=len(counts))


def train(blocks: list[tuple[np.ndarray, np.ndarray]], positive: np.ndarray, prior: float, s: Settings) -> tuple[np.ndarray, float, float]:
    """Weights, scale and shift that lower the non-negative risk; ``positive`` marks the confirmed texts.

    ``blocks``: features and counts of some texts each, all in order; what is derived from them is held
    for one block at a time.
    """
    size = 1 << s.bits
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    df = np.zeros((2, size), np.int32)
    at = 0
    for features, counts in blocks:
        text = np.repeat(np.arange(at, at + len(counts)), counts)
        at += len(counts)
        for k in range(N_FEATURES):  # texts that have the feature, by class
            pairs = np.unique(text << s.bits | features[:, k])
            np.add.at(df, (positive[pairs >> s.bits].astype(int), pairs & (size - 1)), 1)
    weights = np.log((df[1] + s.smoothing) / (df[0] * (n_p / n_u) + s.smoothing))
    weights[df[1] < s.least_positives] = 0.0
    del df

    def strongest() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text's strength, which texts have words, and the features of their strongest words."""
        best, worded, touched = [], [], []
        for features, counts in blocks:
            of_block, where = _strongest(features, counts, weights)
            best.append(of_block)
            worded.append(where >= 0)
            touched.append(features[where[where >= 0]])
        return np.concatenate(best), np.flatnonzero(np.concatenate(worded)), np.concatenate(touched)

    scale, shift = 1.0, 0.0
    best, _, _ = strongest()
    if positive.any():
        shift = -float(np.median(best[positive])) / 2 if np.median(best[positive]) > 0 else 0.0
    state = [np.zeros(size), np.zeros(size)]
    extra = np.zeros((2, 2))
    for epoch in range(1, s.epochs + 1):
        best, used, touched = strongest()
        z = scale * best + shift
        p = 1 / (1 + np.exp(-z))
        loss_0 = np.logaddexp(0, z)  # of calling it clean
        corrected = loss_0[~positive].sum() / n_u - prior * loss_0[positive].sum() / n_p
        as_toxic = np.where(positive, prior * (p - 1) / n_p, 0.0)
        as_clean = np.where(positive, -prior * p / n_p, p / n_u)
        slope = as_toxic + as_clean if corrected >= 0 else -as_clean
        gradient = np.zeros(size)
        np.add.at(gradient, touched.ravel(), np.repeat(slope[used] * scale, N_FEATURES))
        state[0] *= 0.9
        state[0] += 0.1 * gradient
        state[1] *= 0.99
        state[1] += 0.01 * gradient**2
        moved = np.flatnonzero(state[1])
        weights[moved] -= s.rate * state[0][moved] / (1 - 0.9**epoch) / (np.sqrt(state[1][moved] / (1 - 0.99**epoch)) + 1e-8)
        own = np.array([(slope * best).sum(), slope.sum()])
        extra[0] = 0.9 * extra[0] + 0.1 * own
        extra[1] = 0.99 * extra[1] + 0.01 * own**2
        step = s.rate * extra[0] / (1 - 0.9**epoch) / (np.sqrt(extra[1] / (1 - 0.99**epoch)) + 1e-8)
        scale, shift = max(0.05, scale - step[0]), shift - step[1]
    return weights.astype(np.float32), float(scale), float(shift)


def probabilities(texts: list[str], models: list[tuple[np.ndarray, float, float]], bits: int) -> np.ndarray:
    best = np.full((len(models), len(texts)), -np.inf)
    for held in slices(texts):
        features, counts = word_features([part for _, part in held], bits)
        worded = counts > 0
        at = np.array([i for i, _ in held])[worded]
        for m, (weights, _, _) in enumerate(models):
            np.maximum.at(best[m], at, _strongest(features, counts, weights)[0][worded])
    best[np.isneginf(best)] = 0.0  # no words
    total = np.zeros(len(texts))
    for m, (_, scale, shift) in enumerate(models):
        total += 1 / (1 + np.exp(-(scale * best[m] + shift)))
    return total / max(1, len(models))


def _text_features(bits: int):
    """Drawn texts as the features of their distinct words."""
    def emit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for row in range(b.num_rows):
                parts = [distinct_words(*word_features([part for _, part in held], bits)) for held in slices([b.column("text")[row].as_py()])]
                features = np.concatenate([f for f, _ in parts])
                features, _ = distinct_words(features, np.array([len(features)]))
                yield pa.record_batch([b.column("member").slice(row, 1), b.column("positive").slice(row, 1), b.column("row").slice(row, 1),
                                       pa.array([features.tobytes()], pa.binary())], names=["member", "positive", "row", "features"])
        give_back()
    return emit


def _sample(docs: DataFrame, labels: DataFrame, training, s: Settings, id_col: str, text_col: str) -> tuple[DataFrame, float]:
    """``(member, positive, row, text)`` of the training sample, and the class prior.

    Rows are drawn by their own hashes, so an id that repeats, or none, is drawn in part like any
    other; rows equal in id and text teach a member once.
    """
    whole = 1 << 30

    def below(share: float, *key) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(whole)) < int(min(1.0, share) * whole)

    def by_members(rows: DataFrame, share: float, salt: int, *key) -> DataFrame:
        """A copy of a row for each member that drew it."""
        drawn = [F.when(below(share, *key, F.lit(s.seed * 1000 + m * 2 + salt)), m) for m in range(s.members)]
        return rows.withColumn("member", F.explode(F.filter(F.array(*drawn), lambda m: m.isNotNull())))

    def share(rows: DataFrame, most: int, copies: int = 1) -> float:
        found = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
        return copies * min(most / max(1, found["n"]), s.sample_bytes / max(1, found["size"] or 0))

    labelled = (labels.filter(training & F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
                .groupBy(F.col(id_col).alias("doc")).agg(F.max("toxic").alias("toxic")))
    counted = labelled.agg(F.avg((F.col("toxic") == 1).cast("double")).alias("prior"), F.count_if(F.col("toxic") == 1).alias("toxic")).first()
    ids = by_members(labelled.filter("toxic = 1").select("doc"), s.positives / max(1, counted["toxic"]), 1, "doc")
    confirmed = F.broadcast(ids)  # at most members * positives, about
    texts = docs.filter(training).select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(confirmed, "doc")  # more rows than ids where ids repeat, or texts are long
    positives = found.filter(below(share(found, s.positives, s.members), "doc", "text", F.lit(s.seed)))
    others = by_members(texts, share(texts, s.unlabelled), 0, "doc", "text")
    rows = (positives.select("member", F.lit(True).alias("positive"), F.xxhash64("doc", "text").alias("row"), "text")
            .unionByName(others.select("member", F.lit(False).alias("positive"), F.xxhash64("doc", "text").alias("row"), "text")))
    return rows.dropDuplicates(["member", "positive", "row"]), counted["prior"] or 0.0


def fit(docs: DataFrame, labels: DataFrame, training, s: Settings, id_col: str = "doc_id", text_col: str = "text") -> list:
    """The members' models ``(buckets, weights, scale, shift)``; none without a confirmed text."""
    sample, prior = _sample(docs, labels, training, s, id_col, text_col)
    schema = "buckets binary, weights binary, scale double, shift double"

    def model(positive: list[bool], blocks: list) -> Iterator[pa.RecordBatch]:
        if any(positive):
            weights, scale, shift = train(blocks, np.array(positive), prior, s)
            used = np.flatnonzero(weights).astype("<i4")
            yield pa.record_batch([pa.array([used.tobytes()], pa.binary()), pa.array([weights[used].astype("<f4").tobytes()], pa.binary()),
                                   pa.array([scale]), pa.array([shift])], names=["buckets", "weights", "scale", "shift"])

    def block(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        held = texts.to_pylist()
        return np.frombuffer(b"".join(held), np.int32).reshape(-1, N_FEATURES), np.array([len(x) // (4 * N_FEATURES) for x in held])

    def learn(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by member; one member's features are held at a time."""
        at, positive, blocks = None, [], []
        for b in it:
            members = np.asarray(b.column("member"))
            edges = np.r_[0, np.flatnonzero(np.diff(members)) + 1, len(members)].tolist()
            for a, z in zip(edges[:-1], edges[1:]) if len(members) else ():
                if members[a] != at:
                    yield from model(positive, blocks)
                    at, positive, blocks = members[a], [], []
                positive += b.column("positive").slice(a, z - a).to_pylist()
                blocks += [block(b.column("features").slice(x, min(TEXTS, z - x))) for x in range(a, z, TEXTS)]
        yield from model(positive, blocks)
        give_back()

    features = sample.mapInArrow(_text_features(s.bits), "member int, positive boolean, row long, features binary")
    dealt = features.repartition(4 * s.members, "member").sortWithinPartitions("member", "positive", "row")  # the same model whatever order rows came in
    found = dealt.mapInArrow(learn, schema).collect()
    return sorted((bytes(r["buckets"]), bytes(r["weights"]), r["scale"], r["shift"]) for r in found)  # at most members * 2 ** bits weights


def _open(models: list, bits: int) -> list:
    opened = []
    for buckets, weights, scale, shift in models:
        table = np.zeros(1 << bits, np.float32)
        table[np.frombuffer(buckets, "<i4")] = np.frombuffer(weights, "<f4")
        opened.append((table, scale, shift))
    return opened


def _score(texts: pa.Array, models: list, bits: int) -> np.ndarray:
    found = [probabilities([t or "" for t in texts.slice(a, 128).to_pylist()], models, bits) for a in range(0, len(texts), 128)]
    return np.concatenate([np.zeros(0), *found])


def without_toxic(docs: DataFrame, labels: DataFrame, training: Column, settings: Settings = Settings(), threshold: float = 0.7,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose score is below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, training, settings, id_col, text_col))
    bits = settings.bits

    def clean(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = _open(shared.value, bits)
        for b in it:
            yield b.filter(pa.array(_score(b.column(text_col), models, bits) < threshold))
        give_back()

    return docs.mapInArrow(clean, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, training: Column, settings: Settings = Settings(), threshold: float = 0.7,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)``, one row for each row of ``docs``; ``predicted`` is score >= threshold.

    ``labels`` has ``id_col`` and ``toxic``; ``training`` is a condition on ``id_col`` that says which
    rows may teach.  Rows of labels without id or label teach nothing; an id labelled twice is toxic if
    it was once.  Without a confirmed toxic text nothing is learned and all scores are 0.  Null and empty
    texts are texts without words.  Null ids and repeated rows stay as rows; other columns aren't read;
    an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, training, settings, id_col, text_col))
    bits = settings.bits

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = _open(shared.value, bits)
        for b in it:
            yield pa.record_batch([b.column("doc"), pa.array(_score(b.column("text"), models, bits))], names=["doc", "score"])
        give_back()

    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    scored = rows.mapInArrow(score, f"doc {kind}, score double")
    return scored.select(F.col("doc").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
