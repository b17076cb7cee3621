"""op 1 and op 9: work done once per content."""

import hashlib
import re

import public_tokenizers
from llm_helpers import pairs
from tokenizers import Tokenizer

from rambler.llm.queries import BYTE_BPE
from rambler.llm.secret_scan import redactions, rule_version, secret_scan
from rambler.llm.token_counts import token_counts

KINDS = ("assign", "access", "hex")
PATTERNS = (r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", r"AKIA[A-Z0-9]+", r"[0-9a-f]+")


def by_hand(text):
    found = []
    for k, pattern in enumerate(PATTERNS):
        at = 0
        while m := re.compile(pattern, re.A | re.I * (k == 0)).search(text, at):
            at = m.end()
            own = m[2] if k == 0 else m[0]
            # only the keyword may be in either case, and its classes hold both anyway
            if len(own) >= (12, 18, 16)[k]:
                found.append((m.start(), k, m.end()))
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_findings_of_every_row(spark, docs, odd, none, scratch):
    for i, rows in enumerate((docs, odd)):
        got = secret_scan(rows, f"{scratch}/{i}").collect()
        want = sorted((repr(d), by_hand(t or "")) for d, t in pairs(rows))
        assert sorted((repr(r.doc_id), r.spans) for r in got) == want
        for r in got:
            assert [r.n_assign, r.n_access, r.n_hex] == [len(re.findall(f"(?:^|,){k}:", r.spans)) for k in KINDS]
    assert secret_scan(none, f"{scratch}/none").count() == 0


def test_rules(spark, scratch):
    texts = ["passwd='AAAABBBBCCCC' x", "password: short", "password: short:aaaaaaaaaaaaaaaa", "API_KEY = " + "z" * 12, "AKIA" + "A" * 14, "AKIA" + "A" * 13,
             "0123456789abcdef", "0123456789abcde", "token=" + "0123456789abcdef" * 2, "ééé secret=aaaaaaaaaaaa"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.spans for r in secret_scan(rows, scratch).collect()} == {i: by_hand(t) for i, t in enumerate(texts)}


def test_only_unseen_blobs_are_scanned(spark, scratch):
    v1 = spark.createDataFrame([(1, "token = aaaaaaaaaaaaaaaa"), (2, "clean"), (3, "clean")], "doc_id long, text string")
    v2 = spark.createDataFrame([(1, "clean"), (9, "token = aaaaaaaaaaaaaaaa"), (4, "new 0123456789abcdef")], "doc_id long, text string")
    secret_scan(v1, scratch).collect()
    assert spark.read.parquet(scratch).count() == 2
    again = {r.doc_id: r.spans for r in secret_scan(v2, scratch).collect()}
    ledger = spark.read.parquet(scratch)
    assert ledger.count() == 3 and {r.version for r in ledger.collect()} == {rule_version()}
    assert again[1] == "" and again[9].startswith("assign:0:") and again[4] == "hex:4:20"
    # a row of another rule version doesn't count as scanned
    other = scratch + "-other"
    ledger.selectExpr("digest", "'old' AS version", "n_assign", "n_access", "n_hex", "'x' AS spans").write.parquet(other)
    assert all(r.spans != "x" for r in secret_scan(v2, other).collect())
    assert spark.read.parquet(other).count() == 3 + 3


def test_redactions_keep_rows_and_columns(odd, scratch):
    out = redactions(odd, scratch)
    assert out.columns == odd.columns and out.count() == odd.count()
    texts = [r.text for r in out.collect()]
    assert texts.count("[SECRET]") == 3 and texts.count(None) == 2 and not any(by_hand(t or "") for t in texts)


def test_counts_equal_the_library(docs, odd, none, scratch):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for rows in (docs, odd):
        got = sorted(map(repr, map(tuple, token_counts(rows, BYTE_BPE, scratch).collect())))
        n = {x or "": len(t.encode(x or "", add_special_tokens=False).ids) for _, x in pairs(rows)}
        assert got == sorted(repr((d, len((x or "").encode()), n[x or ""], n[x or ""] > 512)) for d, x in pairs(rows))
    assert token_counts(none, BYTE_BPE, scratch).count() == 0


def test_cache_holds_each_content_once_and_is_believed(spark, scratch):
    rows = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, None), (4, "")], "doc_id long, text string")
    token_counts(rows, BYTE_BPE, scratch).collect()
    cache = spark.read.parquet(scratch)
    assert cache.count() == 2
    planted = scratch + "-planted"
    digest = hashlib.sha256(b"one two").digest()
    cache.filter(cache.digest == digest).withColumn("n_tokens", cache.n_tokens * 0 + 99).write.parquet(planted)
    got = {r.doc_id: r.n_tokens for r in token_counts(rows, BYTE_BPE, planted).collect()}
    assert got == {1: 99, 2: 99, 3: 0, 4: 0}     # the stored count is used, only the miss was encoded
    assert spark.read.parquet(planted).count() == 2
