"""MinHash near-duplicates with sequential Bayesian verification.

Texts are sets of word shingles; two are linked if their Jaccard similarity is at least a threshold.

1. Signatures.  Equal sets become one class, so copies cost nothing from here on.
2. Candidates.  Classes that agree in all rows of a band share a bucket.  A bucket's members are paired
   with one member only, the one that shares most buckets, never with each other.
3. Pruning.  Candidates' sketches (8 bits of independent minima) are compared batch by batch; a pair is
   dropped once the posterior probability that its similarity reaches the threshold, given the matches
   so far, is below ``miss``.
4. Verification.  The survivors' full sets are compared exactly; links make components.
5. The rest.  A bucket whose members are all in one component is settled: any further link in it joins
   what is joined.  Members of the other buckets are searched without loss: two sets that similar must
   share a token among the rarest of each (prefix filter, with length and position bounds).  Of the
   classes that share such a token, only those outside its largest component are paired, with classes
   of other components.  These pairs too are pruned, verified, and added to the components.

A link is missed only if its classes share no bucket (``(1 - t ** rows) ** bands`` at similarity t, here
2.4e-5 at 0.75) or by pruning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rambler.llm.common import digest, texts
from rambler.llm.components import components
from rambler.llm.shingles import MinHash, mix, shingle_set
from rambler.session import materialize


@dataclass(frozen=True)
class Settings:
    words: int = 5
    percent: int = 75       # the least similarity
    bands: int = 28
    rows: int = 4
    sketch: int = 128       # minima compared when pruning
    batch: int = 32
    miss: float = 1e-4      # a pair is dropped below this posterior probability of being similar
    seed: int = 3
    pairs_per_task: int = 2_000


def least_matches(s: Settings) -> list[int]:
    """For each batch end: with fewer matches than this, a similarity of the threshold is less likely than ``miss``.

    Uniform prior; a minimum's 8 bits agree by similarity, or else by chance in one case of 256.
    """
    t = (np.arange(10_000) + 0.5) / 10_000
    agree = t + (1 - t) / 256
    out = []
    for n in range(s.batch, s.sketch + 1, s.batch):
        for m in range(n + 1):
            log = m * np.log(agree) + (n - m) * np.log1p(-agree)
            density = np.exp(log - log.max())
            if density[t >= s.percent / 100].sum() / density.sum() >= s.miss:
                out.append(m)
                break
    return out


def _digest(members: np.ndarray) -> bytes:
    """16 bytes that tell sets apart."""
    return b"".join(mix(members ^ np.uint64(x)).sum(dtype=np.uint64).tobytes() for x in (0, 0x5851F42D4C957F2D))


def _signatures(s: Settings):
    def sign(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        banding, sketching = MinHash(s.bands * s.rows, s.seed), MinHash(s.sketch, s.seed + 1)
        weights = mix(np.arange(1, s.rows + 1, dtype=np.uint64)) | np.uint64(1)
        numbers = mix(np.arange(s.bands, dtype=np.uint64) + np.uint64(s.seed))
        for b in it:
            rows = []
            for text in b.column("text").cast(pa.binary()):
                members = shingle_set(text.as_buffer(), s.words)
                if not len(members):
                    rows.append((b"", 0, b"", b""))
                    continue
                keys = mix((banding(members).reshape(s.bands, s.rows) * weights).sum(1, dtype=np.uint64) ^ numbers)
                rows.append((_digest(members), len(members), keys.tobytes(), (sketching(members) & np.uint64(255)).astype(np.uint8).tobytes()))
            kinds = (pa.binary(), pa.int64(), pa.binary(), pa.binary())
            yield pa.record_batch([b.column("doc"), b.column("sha"), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))],
                                  names=["doc", "sha", "digest", "n", "keys", "sketch"])
    return sign


def _bucket_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        keys = np.frombuffer(b"".join(b.column("keys").to_pylist()), np.int64)
        cls = np.asarray(b.column("cls"))
        yield pa.record_batch([pa.array(keys), pa.array(np.repeat(cls, len(keys) // max(1, len(cls))))], names=["key", "cls"])


def prune(pairs: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """The pairs ``(a, b)`` that the sequential test doesn't drop."""
    sides = [classes.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")) for x in "ab"]
    known = pairs.join(sides[0], "a").join(sides[1], "b")
    known = known.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * s.percent)
    least = least_matches(s)

    def test(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, s.sketch) for c in ("s_a", "s_b"))
            left, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for k, m in enumerate(least):
                some = slice(k * s.batch, (k + 1) * s.batch)
                matches[left] += (a[left, some] == b[left, some]).sum(1)
                left = left[matches[left] >= m]
            yield batch.select(["a", "b"]).take(pa.array(left))

    return known.select("a", "b", "s_a", "s_b").mapInArrow(test, "a long, b long")


def verify(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose full sets are similar enough.  ``texts`` has ``(cls, text)``.

    A class meets its partners in a task; one with many is sent to several tasks, its partners dealt
    out among them.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / s.pairs_per_task).cast("int").alias("parts"))
    partners = (pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
                .join(texts.withColumnRenamed("cls", "b"), "b").select("a", "part", "b", "text"))
    centers = (texts.withColumnRenamed("cls", "a").join(parts, "a")
               .select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "text"))
    dealt = partners.unionByName(centers).repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))

    def compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center = np.zeros(0, np.uint64)
        for batch in it:
            found = []
            texts = batch.column("text").cast(pa.binary())
            for a, b, text in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), texts):
                members = shingle_set(text.as_buffer(), s.words)
                if b is None:
                    center = members
                    continue
                at = np.minimum(np.searchsorted(center, members), len(center) - 1)
                both = int((center[at] == members).sum())
                if 100 * both >= s.percent * (len(center) + len(members) - both):
                    found.append((a, b))
            yield pa.record_batch([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long")


def _tokens(s: Settings):
    def explode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for cls, text in zip(b.column("cls").to_pylist(), b.column("text").cast(pa.binary())):
                members = shingle_set(text.as_buffer(), s.words).view(np.int64)
                yield pa.record_batch([pa.array(np.full(len(members), cls)), pa.array(members), pa.array(np.full(len(members), len(members)))],
                                      names=["cls", "token", "n"])
    return explode


def prefixes(texts: DataFrame, s: Settings) -> DataFrame:
    """``(token, cls, n, place)``: the rarest tokens of each class that any similar set must share one of.

    ``texts``: the classes to search.  ``place`` counts a class's tokens from the rarest, from 0.
    """
    rows = texts.mapInArrow(_tokens(s), "cls long, token long, n long")
    # a token of one class only is among the rarest but pairs nothing: it is counted, not kept
    rows = rows.withColumn("freq", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("freq > 1")
    of_class = Window.partitionBy("cls")
    place = F.col("n") - F.count(F.lit(1)).over(of_class) + F.row_number().over(of_class.orderBy("freq", "token")) - 1
    rows = rows.withColumn("place", place).filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * s.percent / 100))
    return rows.select("token", "cls", "n", "place")


def rest_pairs(prefixes: DataFrame, component: DataFrame, s: Settings) -> DataFrame:
    """All pairs ``(a, b)`` of different components that share a prefix token and can be similar.

    Of each token's classes those outside its largest component are paired with those of others.
    """
    rows = prefixes.join(component, F.col("cls") == F.col("vertex"), "left").select(
        "token", "cls", "n", "place", F.coalesce("component", "cls").alias("comp"))
    sizes = rows.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("size"))
    largest = (sizes.groupBy("token").agg(F.max(F.struct("size", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"))
               .filter("comps > 1").select("token", F.col("top.comp").alias("main")))
    mixed = rows.join(largest, "token")
    side = lambda x: mixed.select("token", "main", *[F.col(c).alias(f"{c}_{x}") for c in ("cls", "n", "place", "comp")])
    left, right = side("a").filter("comp_a != main").drop("main"), side("b").drop("main")
    enough = F.ceil((F.col("n_a") + F.col("n_b")) * s.percent / (100 + s.percent))  # shared tokens that this similarity takes
    left_over = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    similar_sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * s.percent
    on = [left["token"] == right["token"], F.col("comp_a") != F.col("comp_b"), similar_sizes, left_over >= enough]
    return left.join(right, on).select(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row for each row of ``docs``.

    ``component_id`` is the smallest id reachable by links, the row's own included; ``kept`` marks the
    row that has it.  Null, empty and wordless texts have no shingles, are linked with nothing and kept.
    Rows that repeat a text are linked whatever their ids.  A null id is larger than any other; if a
    component has no other, its ``component_id`` is null and its rows are kept.  Other columns aren't
    read; an empty table gives no rows.
    """
    rows = texts(docs, id_col, text_col).select(F.col("doc").cast("long").alias("doc"), "text", digest(F.col("text")).alias("sha"))
    signed = materialize(rows.mapInArrow(_signatures(s), "doc long, sha binary, digest binary, n long, keys binary, sketch binary"), "signatures")
    classes = (signed.filter("n > 0").groupBy("digest")
               .agg(F.min(F.struct(F.col("doc").isNull().alias("no_id"), "doc", "sha")).alias("row"), *[F.first(c).alias(c) for c in ("n", "keys", "sketch")])
               .select("digest", "row.doc", "row.sha", "n", "keys", "sketch").withColumn("cls", F.monotonically_increasing_id()))  # numbers that hold once written
    classes = materialize(classes, "classes")

    buckets = classes.select("cls", "keys").mapInArrow(_bucket_rows, "key long, cls long")
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = materialize(buckets.join(shared, "key"), "buckets")
    # an original meets its copies more often than they meet each other
    meetings = members.groupBy("cls").agg(F.sum("size").alias("meetings"))
    centers = (members.join(meetings, "cls").groupBy("key")
               .agg(F.max(F.struct("meetings", "cls")).alias("top")).select("key", F.col("top.cls").alias("center")))

    # a class's text is that of its first row, found by id and text: an id on many rows meets only its own class
    wanted = members.select("cls").distinct().join(classes.select("cls", F.col("doc").alias("first_doc"), F.col("sha").alias("first_sha")), "cls")
    found = rows.join(wanted, (F.col("sha") == F.col("first_sha")) & F.col("doc").eqNullSafe(F.col("first_doc"))).select("cls", "text")
    full = materialize(found.dropDuplicates(["cls"]), "texts")

    pairs = (members.join(centers, "key").filter("cls != center")
             .select(F.least("center", "cls").alias("a"), F.greatest("center", "cls").alias("b")).distinct())
    pairs = materialize(pairs, "stars")
    links = materialize(verify(materialize(prune(pairs, classes, s), "pairs"), full, s), "links")
    component = components(links)

    of_member = members.join(component, F.col("cls") == F.col("vertex"), "left").select("key", "cls", F.coalesce("component", "cls").alias("comp"))
    unsettled = of_member.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x != y").select("key")
    open_ = of_member.join(unsettled, "key").select("cls").distinct()
    rest = materialize(prefixes(full.join(open_, "cls"), s), "prefixes")
    more = rest_pairs(rest, component, s).join(pairs, ["a", "b"], "left_anti")
    more_links = materialize(verify(materialize(prune(more, classes, s), "rest-pairs"), full, s), "rest-links")
    if not more_links.isEmpty():
        component = components(component.select(F.col("vertex").alias("a"), F.col("component").alias("b")).unionByName(more_links))

    own = classes.join(component, F.col("cls") == F.col("vertex"), "left").select("digest", "doc", F.coalesce("component", "cls").alias("comp"))
    least = own.groupBy("comp").agg(F.min("doc").alias("component_id"))
    ids = own.join(least, "comp").select("digest", "component_id")
    result = signed.select("doc", "digest", "n").join(ids, "digest", "left")
    component_id = F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component_id"))
    return result.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), component_id.alias("component_id"),
                         F.col("doc").eqNullSafe(component_id).alias("kept"))
