"""Token counts with a digest cache.

Counts are kept by (SHA-256 of the text, tokenizer version).  A run encodes each distinct text that
the cache lacks once, appends its count and joins the cache back to every row.  The tokenizer's
version is the digest of its file, so a changed file never reads old counts.  The text is
normalised only as far as counts can't change: null becomes the empty text.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rambler.llm.bpe import encoder
from rambler.llm.common import texts
from rambler.llm.contents import work_on_unseen


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def token_counts(docs: DataFrame, tokenizer_path: str, cache: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row for each row of ``docs``.

    Null and empty texts have 0 bytes and 0 tokens.  Null ids and repeated rows stay as rows.
    Other columns of ``docs`` aren't read.  An empty table gives no rows.  ``cache`` is a folder
    that Spark can read and write; it may be new.
    """
    def count(rows: DataFrame) -> DataFrame:
        def batches(it):
            for b in it:
                _, counts = encoder(tokenizer_path).encode(b.column("text"), counts_only=True)
                yield pa.record_batch([b.column("digest"), pa.array(counts)], names=["digest", "n_tokens"])
        return rows.mapInArrow(batches, "digest binary, n_tokens long")

    got = work_on_unseen(texts(docs, id_col, text_col), cache, tokenizer_version(tokenizer_path), "n_tokens long", count)
    return got.select(F.col("doc").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
