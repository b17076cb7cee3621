"""The pipeline: every stage against a brute-force version on its own input."""

import corpus_pipeline
import pyarrow as pa
import sentencepiece
from llm_helpers import SF001, pairs
from pyspark.sql import functions as F
from test_ledgers import by_hand
from test_text_joins import components_by_hand, contaminated

from rambler.llm.common import held_out, table
from rambler.llm.secret_scan import redact
from rambler.llm.toxicity import toxicity
from rambler.session import BATCH_BYTES, bound_batches


def test_stages(spark):
    docs = table(spark, SF001, "documents").cache()
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF001).cache()
        assert after.dtypes == docs.dtypes
        rows, left = pairs(before), dict(pairs(after))
        if name == "toxicity":
            found = toxicity(before, table(spark, SF001, "labels"), ~held_out("doc_id", 3, 1)).collect()
            assert set(left) == {r.doc_id for r in found if not r.predicted}
        elif name == "near_duplicates":
            assert sorted(left) == sorted(int(r[1 : r.index(",")]) for r in components_by_hand(rows) if r.endswith("True)"))
        elif name == "decontamination":
            items = pairs(table(spark, SF001, "benchmark").withColumnRenamed("item_id", "doc_id"))
            assert sorted(left) == sorted(int(r[1 : r.index(",")]) for r in contaminated(rows, items) if r.endswith("False)"))
        else:
            assert left == {d: redact(t, by_hand(t)) if by_hand(t) else t for d, t in rows}
            assert all(r.n_chars == len(r.text) for r in after.collect())
        before = after
    sp = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECES)
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF001).collect()
    assert {r.doc_id: r.ids for r in last} == {d: sp.encode(t) for d, t in pairs(before)}


def test_repeated_rows_and_null_ids(spark):
    docs = table(spark, SF001, "documents").limit(3)
    more = docs.unionByName(docs).unionByName(spark.sql("SELECT CAST(NULL AS LONG) doc_id, 'lone text here' text, 'en' lang, 's' source, 14L n_chars"))
    kept = corpus_pipeline.drop_near_duplicates(spark, more, SF001)
    assert kept.count() == 4 and kept.dtypes == docs.dtypes
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF001).count() == 0


def test_rows_that_share_an_id_are_judged_alone(spark):
    docs = table(spark, SF001, "documents")
    leak = table(spark, SF001, "benchmark").orderBy("item_id").first().text
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = lambda pairs: spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in pairs], docs.schema)
    order = lambda pairs: sorted(pairs, key=repr)

    clean = [(None, a), (None, b), (5, c), (None, None), (None, "")]
    got = corpus_pipeline.drop_contaminated(spark, rows([*clean, (None, leak), (5, f"{b} {leak} {c}")]), SF001)
    assert order(pairs(got)) == order(clean) and got.dtypes == docs.dtypes

    got = corpus_pipeline.drop_near_duplicates(spark, rows([(5, a), (5, b), (3, a + " more"), (9, b + " more"), (None, c), (None, c + " more"), (7, ""), (7, ""), (8, "")]), SF001)
    got = pairs(got)
    assert {(3, a + " more"), (5, b), (7, ""), (8, "")} < set(got) and len(got) == 5
    assert sum(d is None for d, _ in got) == 1
    same_id = pairs(corpus_pipeline.drop_near_duplicates(spark, rows([(4, a), (4, a + " more"), (4, c)]), SF001))
    assert len(same_id) == 2 and (4, c) in same_id


def test_batches_of_texts_are_bounded(spark):
    key, before = "spark.sql.execution.arrow.maxBytesPerBatch", spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = table(spark, SF001, "documents")
    sizes = lambda: [r.size for r in spark.range(0, 9000, 1, 1).selectExpr("repeat('x', 4000) text").mapInArrow(
        lambda it: (pa.record_batch([pa.array([b.nbytes])], names=["size"]) for b in it), "size long").collect()]
    try:
        for name in ("toxicity", "near_duplicates", "secrets", "sentencepiece"):
            spark.conf.unset(key)
            dict(corpus_pipeline.STAGES)[name](spark, docs.limit(5), SF001)
            assert max(sizes()) < 1.1 * BATCH_BYTES and sum(sizes()) > 30 << 20, name
        spark.conf.set(key, "1m")
        bound_batches(spark)
        assert spark.conf.get(key).lower() in ("1m", "1048576b")
    finally:
        spark.conf.set(key, before)


def test_stages_do_the_whole_work_of_their_operators(spark, monkeypatch):
    """op 3 reports on every row, items and all, and op 2's ids are decoded again."""
    docs = table(spark, SF001, "documents")
    leaks = table(spark, SF001, "benchmark").orderBy("item_id").limit(2).collect()
    texts = [f"{leaks[0].text} and {leaks[1].text}", "plain  words", "a ▁ mark", "", None, None]
    rows = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], docs.schema)
    written = {}
    monkeypatch.setattr(corpus_pipeline, "materialize", lambda df, tag, f=corpus_pipeline.materialize: written.setdefault(tag, f(df, tag)))
    assert corpus_pipeline.drop_contaminated(spark, rows, SF001).count() == 5
    found = written["contamination"].orderBy(F.desc("n_hit")).collect()
    assert len(found) == 6 and found[0].contaminated and not any(r.contaminated for r in found[1:])
    assert found[0].n_items >= 2 and found[0].items_sha256 != found[1].items_sha256 and found[0].n_words >= found[0].n_hit > 0
    last = {r.doc_id: r.round_trip for r in corpus_pipeline.tokenize(spark, rows, SF001).collect()}
    assert last == {i: t != "a ▁ mark" for i, t in enumerate(texts)}      # the mark stands for a space
