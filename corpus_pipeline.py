"""Training-data pipeline over ``documents``: each stage works on all that its predecessor kept.

1. toxicity (op 4): documents scored as toxic go; learned from the confirmed toxic ones among ``labels``.
2. near duplicates (op 5): one document of each group of linked documents stays.
3. decontamination (op 3): documents with a passage of ``benchmark`` go; op 3's report on every document is written.
4. secrets (op 1): every secret found is replaced by ``[SECRET]``; the documents stay.
5. SentencePiece (op 2): what is left becomes token ids, which are decoded again and compared with the text.

Every stage returns the columns of ``documents``, the last one doc_id, ids, n_pieces and round_trip.  A document is
its row, and every decision is made by row: a null doc_id is a value like any other, and what shares a
doc_id with a row that goes doesn't go with it.  Of a group of near duplicates the row with the smallest
doc_id stays (null is the largest; then the smallest SHA-256 of the text), and of wordless rows that
repeat an id and text, one.

Stages that send texts to Python workers bound the bytes of a batch, for the session: what a large batch
leaves behind in an executor would be there beside the next stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rambler.llm.common import digest, held_out, table
from rambler.llm.decontaminate import decontaminate
from rambler.llm.near_dup import near_duplicates
from rambler.llm.secret_scan import redactions
from rambler.llm.sentencepiece_lattice import encode, read_pieces
from rambler.llm.toxicity import without_toxic
from rambler.session import bound_batches, materialize, scratch_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return without_toxic(docs, table(spark, sf_dir, "labels"), training=~held_out("doc_id", 3, 1))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    keyed = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "keyed")  # numbers that hold once written
    found = materialize(near_duplicates(keyed.select("_row", "text"), id_col="_row").select("_row", "n_shingles", "component_id"), "groups")
    rows = keyed.select("_row", "doc_id", F.sha2("text", 256).alias("sha")).join(found, "_row")
    wordless = F.col("n_shingles") == 0
    group = [F.when(~wordless, F.col("component_id")).alias("component"), F.when(wordless, F.col("doc_id")).alias("id"),
             F.when(wordless, F.col("sha")).alias("content")]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sha", "_row"))
    kept = rows.groupBy(*group).agg(first.alias("first")).select("first._row")
    gone = materialize(found.select("_row").join(kept, "_row", "left_anti"), "copies")
    return keyed.join(gone, "_row", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = digest(F.coalesce(F.col("text"), F.lit("")))
    # written whole, or Spark would leave out all of it but the decision
    report = materialize(decontaminate(docs.select(own.alias("digest"), "text"), table(spark, sf_dir, "benchmark"), id_col="digest"), "contamination")
    gone = materialize(report.filter("contaminated").select("digest").distinct(), "contaminated")
    return docs.join(gone, own == gone["digest"], "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    clean = redactions(docs, scratch_path(spark, "secret-ledger"))
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    encoded = encode(docs.select("doc_id", "text"), read_pieces(PIECES), round_trip_col="round_trip")
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("sentencepiece", tokenize),
]

# Learned scores, similarity joins over whole texts and tokenizers have no SQL; tests/llm checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
