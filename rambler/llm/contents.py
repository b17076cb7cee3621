"""Content-addressed work: do something once for every distinct text that a ledger lacks.

The ledger is a folder of Parquet files with ``digest`` (SHA-256 of the text), ``version`` (of
the rules or the tokenizer) and the results.  A run finds the digests it lacks by joining digests
only, fetches one text for each, works on those and appends the results.

Only the chosen texts need to move: a missing digest is assigned the smallest id that has it, and
texts join the misses on (id, digest).  A digest with a third of all rows is thus never a key that
texts are dealt by.  A repeated (id, digest) row may be worked on twice; its results are equal and
``known`` reads each digest once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from rambler.llm.common import digest, exists


def known(spark, ledger: str, version: str, schema: str) -> DataFrame:
    """The ledger's results for ``version``, one row per digest; ``schema`` has the result columns."""
    columns = f"digest binary, version string, {schema}"
    rows = (spark.read.schema(columns).parquet(ledger) if exists(spark, ledger) else spark.createDataFrame([], columns))
    rows = rows.filter(F.col("version") == version).drop("version")
    return rows.groupBy("digest").agg(*[F.first(c).alias(c) for c in rows.columns[1:]])


def work_on_unseen(rows: DataFrame, ledger: str, version: str, schema: str,
                   work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` (doc, text) with the ledger's results joined to every row, without the text.

    ``work`` maps ``(digest, text)`` to ``(digest, <schema>)``.  Returns ``(doc, n_bytes, <schema>)``.
    """
    spark = rows.sparkSession
    keyed = rows.select("doc", digest(F.col("text")).alias("digest"), "text")
    seen = known(spark, ledger, version, schema)
    misses = (keyed.groupBy("digest").agg(F.min("doc").alias("doc"))
              .join(seen.select("digest"), "digest", "left_anti").withColumnRenamed("digest", "missing"))
    chosen = (keyed.join(misses.withColumnRenamed("doc", "first_doc"),
                         F.col("doc").eqNullSafe(F.col("first_doc")) & (F.col("digest") == F.col("missing")))
              .select("digest", "text"))
    work(chosen).withColumn("version", F.lit(version)).write.mode("append").parquet(ledger)
    results = known(spark, ledger, version, schema)
    paths = rows.select("doc", digest(F.col("text")).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"))
    return paths.join(results, "digest").drop("digest")
