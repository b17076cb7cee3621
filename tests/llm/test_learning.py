"""op 4, op 7, op 10: held-out accuracy and recall; op 8: an exact round trip."""

import hashlib

import numpy as np
from llm_helpers import SF001, pairs
from pyspark.sql import functions as F

from rambler.llm.ann import _rounds, hadamard, nearest, probed
from rambler.llm.chat_format import CHUNK_BYTES, format_chats, read_digests
from rambler.llm.common import held_out
from rambler.llm.language_id import language_id
from rambler.llm.toxicity import Settings, _sample, probabilities, slices, toxicity, without_toxic, word_features


def test_toxicity_on_held_out_rows(spark):
    base = SF001.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    held = held_out("doc_id", 3, 1)
    got = toxicity(docs, labels, ~held).join(labels, "doc_id").filter(held).groupBy("toxic").agg(F.avg("predicted").alias("p"))
    share = {r.toxic: r.p for r in got.collect()}
    assert share[1] > 0.85 and share[0] < 0.06


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(5, 1, 2), (4, 0, 2), (None, 1, 2), (3, None, 2), (5, 0, 2)], "doc_id long, toxic int, score int")
    every = F.lit(True)
    got = toxicity(odd, labels, every, Settings(members=1, epochs=3)).collect()
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(d) for d, _ in pairs(odd))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert {r.score for r in toxicity(odd, labels.limit(0), every).collect()} == {0.0}
    assert toxicity(none, labels, every).count() == 0
    kept = without_toxic(odd, labels.limit(0), every)
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_sample_is_bounded_by_rows_and_bytes(spark):
    """Rows under one id, or none, are drawn in part; long texts are drawn less; equal rows teach once."""
    s = Settings(members=3, positives=50, unlabelled=200, sample_bytes=20_000)
    labels = spark.createDataFrame([(i, int(i < 10)) for i in range(40)], "doc_id long, toxic int")
    ids = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.col("id") % 40).cast("long").alias("doc_id")
    rows = spark.range(6_000).select(ids, F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    same = spark.range(3_000).select(F.lit(2).cast("long").alias("doc_id"), F.lit("the same").alias("text"))
    for docs, most in ((rows.unionByName(same), 1), (rows.withColumn("text", F.repeat("text", 100)), 20_000)):
        sample, prior = _sample(docs, labels, F.lit(True), s, "doc_id", "text")
        got = sample.groupBy("positive", "member").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("size")).collect()
        assert prior == 0.25 and len(got) == 6
        for r in got:
            bound = 50 if r.positive else 200
            assert 0 < r.n <= 1.8 * bound and r.size <= 1.8 * s.sample_bytes
        assert sample.filter("text = 'the same'").groupBy("member", "positive").count().filter("count > 1").count() == 0


def test_long_texts_are_cut_between_words(spark):
    text = "Größe und Maß, " * 60_000 + "x" * 400_000 + " Ende"
    parts = [p for held in slices([text, "", "kurz"]) for p in held]
    assert {i: b"".join(p for j, p in parts if j == i).decode() for i in range(3)} == {0: text.lower(), 1: "", 2: "kurz"}
    whole, _ = word_features([text.lower().encode()], 20)
    cut = np.concatenate([word_features([p], 20)[0] for i, p in parts if i == 0])
    assert len(parts) > 4 and (whole == cut).all()
    weights = np.zeros(1 << 20)
    weights[whole[-1]] = 1.0      # of the last word
    ends, none, other = probabilities([text, "", "kurz"], [(weights, 1.0, -2.0)], 20)
    assert ends > 0.8 and none == other


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF001.replace('0.001', '0.01')}/documents.parquet")
    held = held_out("doc_id", 4, 2)
    got = language_id(docs, ~held).join(docs.select("doc_id", "lang"), "doc_id").filter(held)
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_language_of_odd_rows(spark, odd, none, docs):
    learned = odd.unionByName(docs.filter("doc_id >= 20").limit(50), allowMissingColumns=True)
    got = language_id(learned, F.lit(True)).collect()
    assert len(got) == learned.count()
    by = dict(pairs(learned))
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id not in (None, 3):       # ids with one text
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in by[r.doc_id] or ""))
    unlearned = language_id(odd, F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in unlearned} == {("und", 0.0)} and len(unlearned) == odd.count()
    assert language_id(none, F.lit(True)).count() == 0


def brute(vectors, queries, k):
    out = {}
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids])
    for q in queries:
        s = (x * vectors[q]).sum(1)
        out[q] = [ids[j] for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
    return out


def test_hadamard_is_orthonormal():
    h = hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16)) and np.allclose(np.abs(h), 0.25)


def test_nearest_recall_and_order(spark):
    table = spark.read.parquet(f"{SF001}/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    rows = nearest(table, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    want = brute(vectors, [i for i in vectors if i % 20 == 0], 20)
    assert [r.rank for r in rows] == list(range(1, 21)) * len(want)
    assert sum(r.vec_id in want[r.query_id] for r in rows) / len(rows) >= 0.9
    for a, b in zip(rows, rows[1:]):
        assert a.query_id != b.query_id or (-a.score, a.vec_id) < (-b.score, b.vec_id)
    assert all(abs(r.score - vectors[r.query_id] @ vectors[r.vec_id]) < 1e-12 and r.vec_id != r.query_id for r in rows)


def test_nearest_of_copies_lengths_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    good = {i: (rng.normal(size=8) * rng.choice([0.1, 1, 10])).tolist() for i in range(60)}
    good |= {i: good[0] for i in range(100, 160)}            # copies: their smallest ids answer
    bad = [(200, None), (220, [0.0] * 8), (240, [None, *[1.0] * 7]), (260, [float("nan")] * 8), (280, [float("inf")] * 8), (300, []), (None, good[1]), (320, [1.0, 2.0])]
    rows = spark.createDataFrame([(i, v, 1) for i, v in [*good.items(), *good.items(), *bad]], "vec_id long, embedding array<double>, cls int")
    got = {}
    for r in nearest(rows, F.col("vec_id") % 20 == 0, k=20, tables=12, probes=256).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = brute({i: np.array(v) for i, v in good.items()}, [i for i in good if i % 20 == 0], 20)
    assert set(got) <= set(want)
    assert sum(len(set(got[q]) & set(want[q])) for q in got) / sum(map(len, want.values())) >= 0.9
    assert nearest(rows.limit(0), F.lit(True)).count() == 0


def recall(spark, x, queries, **settings):
    """The share of the true 20 nearest that is found, and the fewest rows of a query."""
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {q: [] for q in queries}
    for r in nearest(rows, F.col("vec_id").isin(queries), **settings).collect():
        got[r.query_id].append(r.vec_id)
    want = brute(dict(enumerate(x)), queries, 20)
    return sum(len(set(got[q]) & set(want[q])) for q in queries) / sum(map(len, want.values())), min(map(len, got.values()))


def test_nearest_where_lengths_differ(spark):
    rng = np.random.default_rng(5)
    unit = rng.normal(size=(2000, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    queries = list(range(0, 2000, 50))
    lognormal = unit * np.exp(rng.normal(size=(2000, 1)) * 0.1)
    one_long = unit * np.where(np.arange(2000) == 77, 20, 1)[:, None]
    for x, settings in ((one_long, {}), (lognormal, {})):
        found, fewest = recall(spark, x, queries, **settings)
        assert found >= 0.93 and fewest == 20


def test_every_query_gets_its_rows(spark):
    rng = np.random.default_rng(6)
    few = rng.normal(size=(21, 64))
    few /= np.linalg.norm(few, axis=1, keepdims=True)
    opposite = np.concatenate([few[:1], -few[:1]])
    centers = np.repeat(few[:2], (10, 2000), axis=0)
    clusters = centers + rng.normal(size=centers.shape) * 0.01
    clusters /= np.linalg.norm(clusters, axis=1, keepdims=True)
    for x, queries in ((few, list(range(21))), (few[:15], list(range(15))), (opposite, [0, 1]), (clusters, list(range(10)))):
        found, fewest = recall(spark, x, queries)
        assert fewest == min(20, len(x) - 1) and found >= 0.9


def test_ties_go_to_the_smallest_ids(spark):
    """60 vectors of equal score, none alike: the smallest ids are found, and only they."""
    rows = [(i, [1.0, *(float(i == j) for j in range(1, 61))]) for i in range(61)]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, probes=1 << 14).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, 1.0) for i in range(1, 21)]


def test_an_id_with_several_vectors(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [-2.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = [(r.rank, r.vec_id, r.score) for r in nearest(rows, F.col("vec_id") == 0, probes=16).collect()]
    with_first = [(1, 1, 2.0), (2, 0, 0.0), (3, 1, -2.0)]
    with_second = [(1, 0, 0.0), (2, 1, 0.0), (3, 1, 0.0)]
    assert sorted(got) == sorted(with_first + with_second)


def test_hashing_decides_on_small_tables(spark, monkeypatch):
    """The vectors of sf0.01 are hashed; the scan takes what hashing left, and its share is small."""
    import rambler.llm.ann as ann
    scanned = []
    blocks = ann._blocks
    monkeypatch.setattr(ann, "_blocks", lambda vectors, queries, n: scanned.append((vectors.count(), queries.count())) or blocks(vectors, queries, n))
    table = spark.read.parquet(f"{SF001.replace('0.001', '0.01')}/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    rows = nearest(table, F.col("vec_id") % 20 == 0).collect()
    want = brute(vectors, [i for i in vectors if i % 20 == 0], 20)
    assert sum(r.vec_id in want[r.query_id] for r in rows) / (20 * len(want)) >= 0.9
    assert scanned[0][0] <= 0.05 * len(vectors) and sum(q for _, q in scanned[1:]) <= 0.1 * len(want)


def test_probes_reach_every_bucket():
    x = np.random.default_rng(7).normal(size=(3, 8))
    assert probed(x, x[:, ::-1], 256).all() and (probed(x, x[:, ::-1], 40).sum((1, 2)) == 40).all()


def test_rounds_grow_and_begin_with_the_longest():
    bands = [{"dim": 2, "band": b, "n": n, "most": -b * 0.05} for b, n in enumerate((5, 3, 4, 20, 1))]
    assert [sorted(b for _, b in r) for r in _rounds(bands[::-1])] == [[0], [1, 2], [3], [4]]


def test_few_candidates(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in nearest(rows, F.col("vec_id") == 0, probes=16).collect()]
    assert sorted(got) == [(0, 1, 1, 1.0), (0, 2, 2, 0.0)]


def chats_by_hand(rows):
    key = lambda x: (x is not None, x)
    out = {}
    for conv, turn, role, text in sorted(((c, t, r or "", x or "") for c, t, r, x in rows), key=lambda r: (key(r[0]), key(r[1]), r[2], r[3])):
        n, turns, loss = out.get(conv, (0, "", ""))
        out[conv] = (n + 1, turns + f"{role}\n{text}\n", loss + (text if role == "assistant" else ""))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {c: (n, digest(t), len(x), digest(x)) for c, (n, t, x) in out.items()}


def test_chats_round_trip(spark):
    odd = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", odd), (1, 1, "assistant", odd), (1, None, "sy:stem\n", "###\\h####</turn></turn"), (2, 0, None, None), (2, 3, "assistant", ""),
            (None, 0, "assistant", "\\e\\\\###"), (3, 0, "assistant", "é漢😀" * 70_000), (3, 1, "user", "x" * (CHUNK_BYTES + 5)), (3, 2, "assistant", "### a: b</turn>\n"), (-4, 0, "", "")]
    rows += [(9, t, ("user", "assistant")[t % 2], f"turn {t} " * 50) for t in range(5000)]
    frame = spark.createDataFrame([(*r, b"b", 1) for r in rows], "conv_id long, turn long, role string, text string, body binary, chunk int")
    chunks = format_chats(frame).cache()
    assert chunks.filter("conv = 9").count() > 1
    got = {r.conv_id: r for r in read_digests(chunks).collect()}
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == chats_by_hand(rows)
    for r in chunks.collect():
        assert not [m for m in r.mask if not 0 <= m["from"] <= m["to"] <= len(r.body.decode())]
    assert read_digests(format_chats(frame.limit(0))).count() == 0
