"""Secret scans with an incremental blob ledger.

Every version of every path is a row ``(path, content)``.  A content is known by its SHA-256; the
ledger holds the findings of each (blob, rule version) pair that was ever scanned.  A run scans only
the pairs the ledger lacks, appends them, and joins the findings to all paths that hold the blob.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rambler.llm.common import digest, texts
from rambler.llm.contents import known, work_on_unseen

# Kind, pattern, the group whose length counts, and the least length of a finding.
# Kinds are listed in the order in which findings that start together are reported.
RULES = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
FINDINGS = "n_assign long, n_access long, n_hex long, spans string"
# Runs of 16 are found without visiting shorter ones; a maximal run matches the same way.
_SCAN = tuple((kind, re.compile(p if kind != "hex" else r"[0-9a-f]{16,}", re.ASCII), group, least) for kind, p, group, least in RULES)


def rule_version() -> str:
    return hashlib.sha256(repr(RULES).encode()).hexdigest()[:16]


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """``(start, rule number, end)`` in code points, in report order; per rule leftmost, not overlapping."""
    found = []
    for k, (_, pattern, group, least) in enumerate(_SCAN):
        found += [(m.start(), k, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(found)


def format_spans(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{RULES[k][0]}:{a}:{b}" for a, k, b in found)


def _scan_batches(it):
    for b in (whole.slice(a, 256) for whole in it for a in range(0, whole.num_rows, 256)):
        found = [find_secrets(t) for t in b.column("text").to_pylist()]
        counts = [pa.array([sum(x[1] == k for x in f) for f in found], pa.int64()) for k in range(len(RULES))]
        yield pa.record_batch([b.column("digest"), *counts, pa.array(map(format_spans, found), pa.string())],
                              names=["digest", "n_assign", "n_access", "n_hex", "spans"])


def secret_scan(versions: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, spans)``, one row for each row of ``versions``.

    ``spans`` joins ``kind:start:end`` (code points, end exclusive) with commas; empty without
    findings, so also for null and empty texts.  Null ids and repeated rows stay as rows; other
    columns aren't read; an empty table gives no rows.  ``ledger`` is a folder that Spark can read
    and write; it may be new.
    """
    got = work_on_unseen(texts(versions, id_col, text_col), ledger, rule_version(), FINDINGS,
                         lambda rows: rows.mapInArrow(_scan_batches, f"digest binary, {FINDINGS}"))
    return got.select(F.col("doc").alias(id_col), "n_assign", "n_access", "n_hex", "spans")


def redact(text: str, spans: str, mark: str = "[SECRET]") -> str:
    """``text`` with every span of ``spans`` replaced; spans that overlap become one mark."""
    out, at = [], 0
    for span in spans.split(","):
        a, b = map(int, span.split(":")[1:])
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redactions(versions: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``versions`` with all its columns, every secret in ``text_col`` replaced.

    The scan goes through the ledger; texts with findings meet them by their digest.  Null texts stay null.
    """
    spark = versions.sparkSession
    secret_scan(versions, ledger, id_col, text_col)  # fills the ledger
    found = known(spark, ledger, rule_version(), FINDINGS).filter("spans != ''")
    found = found.select(F.col("digest").alias("__digest"), F.col("spans").alias("__spans"))
    joined = versions.withColumn("__own", digest(F.col(text_col))).join(found, F.col("__own") == F.col("__digest"), "left")
    names = versions.columns

    def replace(it):
        for b in (whole.slice(a, 256) for whole in it for a in range(0, whole.num_rows, 256)):
            texts, spans = b.column(text_col).to_pylist(), b.column("__spans").to_pylist()
            new = pa.array([redact(t, s) if s else t for t, s in zip(texts, spans)], b.column(text_col).type)
            yield pa.record_batch([new if c == text_col else b.column(c) for c in names], names=names)

    return joined.drop("__own", "__digest").mapInArrow(replace, versions.schema)
