"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a generator keyed by the letter itself, so
that all tasks agree without a shared alphabet.  An n-gram is bound from its letters' vectors, each
permuted (rolled) by its place, by elementwise product.  A document bundles (sums) the vectors of all
its n-grams, a language those of all its documents; the nearest language by cosine is the prediction.

Texts are lower-cased; whatever isn't a letter counts as one word boundary, itself a symbol.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rambler.llm.common import worker_cache

UND = "und"


class Profiles:
    """Bundled n-gram vectors of texts.  ``max_grams`` bounds the table of bound vectors of a worker."""

    def __init__(self, dim: int, n: int, seed: int, max_grams: int = 16_384):
        self.dim, self.n, self.seed, self.max_grams = dim, n, seed, max_grams
        self.is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        self.letters: dict[int, np.ndarray] = {}
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros((0, dim), np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) >= 4096:
                self.letters.clear()
            bits = np.random.Generator(np.random.Philox(key=[self.seed, code])).integers(0, 2, self.dim, dtype=np.int8)
            self.letters[code] = 2 * bits - 1
        return self.letters[code]

    def gram(self, key: int) -> np.ndarray:
        vector = np.ones(self.dim, np.int8)
        for place in range(self.n):
            vector = vector * np.roll(self.letter(key >> 21 * place & 0x1FFFFF), place)
        return vector

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams of a text as numbers, and how often each occurs; none without a letter."""
        codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(self.is_letter[codes], codes, 0)
        codes = codes[np.r_[True, (codes[1:] != 0) | (codes[:-1] != 0)]].astype(np.uint64)
        if len(codes) < self.n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys = codes[: len(codes) - self.n + 1].copy()
        for place in range(1, self.n):
            keys |= codes[place : len(codes) - self.n + 1 + place] << np.uint64(21 * place)
        return np.unique(keys, return_counts=True)

    def bundle(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of ``counts`` times the bound vectors, in pieces of bounded memory."""
        total = np.zeros(self.dim, np.float64)
        for at in range(0, len(keys), self.max_grams // 2):
            some = keys[at : at + self.max_grams // 2]
            total += counts[at : at + len(some)].astype(np.float32) @ self.vectors(some)
        return total

    def vectors(self, keys: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.keys, keys)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == keys[known]
        if not known.all():
            new = keys[~known]
            if len(self.keys) + len(new) > self.max_grams:
                self.keys, self.rows, new = self.keys[:0], self.rows[:0], keys
            made = np.stack([self.gram(int(k)) for k in new])
            order = np.argsort(merged := np.concatenate([self.keys, new]))
            self.keys, self.rows = merged[order], np.concatenate([self.rows, made])[order]
            place = np.searchsorted(self.keys, keys)
        return self.rows[place].astype(np.float32)




def _profiles(*setting: int) -> Profiles:
    """The bound vectors that this Python worker keeps between tasks."""
    cache, key = worker_cache(), f"profiles {setting}"
    if key not in cache:
        cache[key] = Profiles(*setting)
    return cache[key]


def prototypes(docs: DataFrame, training: Column, dim: int, n: int, seed: int,
               text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, dims)``: the bundle of all n-grams of all training rows with text and language.

    A task adds up its own rows first, so that one row for each task and language is shuffled.
    """
    rows = docs.filter(training & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles, sums = _profiles(dim, n, seed), {}
        for b in batches:
            langs = np.array(b.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                total = sums.setdefault(lang, np.zeros(dim))
                own = b.column("text").filter(pa.array(langs == lang))
                for at in range(0, len(own), 256):  # n-grams are counted over some texts, then bound and added once
                    total += profiles.bundle(*profiles.counts(" ".join(own.slice(at, 256).to_pylist())))
        if sums:
            yield pa.record_batch([pa.array(sums), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                                  names=["lang", "part"])

    parts = rows.mapInArrow(bundles, "lang string, part array<double>")
    each = parts.select("lang", F.posexplode("part").alias("place", "x")).groupBy("lang", "place").agg(F.sum("x").alias("x"))
    return each.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "x"))), lambda s: s["x"]).alias("dims"))


def language_id(docs: DataFrame, training: Column, dim: int = 512, n: int = 3, seed: int = 7, max_languages: int = 10_000,
                id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(doc_id, lang_pred, score)``, one row for each row of ``docs``; ``score`` is the cosine, at least 0.

    ``training`` says from which rows languages are learned; rows without text or language teach
    nothing.  ``und`` with score 0 if the text is null or has no letter, or if nothing was learned.
    Equal cosines go to the first language in order.  Null ids and repeated rows stay as rows; other
    columns aren't read; an empty table gives no rows.  The prototypes come to the driver: one vector
    a language, and more than ``max_languages`` is an error.
    """
    learned = prototypes(docs, training, dim, n, seed, text_col, lang_col).orderBy("lang").limit(max_languages + 1).collect()
    if len(learned) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    langs = [r["lang"] for r in learned]
    protos = np.array([r["dims"] for r in learned], np.float64).reshape(-1, dim)
    protos /= np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-300)
    shared = docs.sparkSession.sparkContext.broadcast((langs, protos))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, protos = shared.value
        profiles = _profiles(dim, n, seed)
        for b in batches:
            preds, scores = [], []
            for text in b.column("text").to_pylist():
                keys, counts = profiles.counts(text or "")
                vector = profiles.bundle(keys, counts)
                norm = np.linalg.norm(vector)
                if not len(keys) or not langs or norm == 0:
                    preds.append(UND)
                    scores.append(0.0)
                else:
                    cosines = protos @ (vector / norm)
                    best = int(np.argmax(cosines))
                    preds.append(langs[best])
                    scores.append(min(1.0, max(0.0, float(cosines[best]))))
            yield pa.record_batch([b.column("doc"), pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                                  names=["doc", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(predict, f"doc {kind}, lang_pred string, score double").withColumnRenamed("doc", id_col)
