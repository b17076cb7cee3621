"""Inputs derived from the provided tables.

The modelled system reads a contact log, a user snapshot and edge lists; the test
tables have none of these, so they are derived here.  Each derivation has the same
text in ``__spark_entry__.oracle_sql`` so the engines see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rambler.operators.ordering import ordered_lead
from rambler.sources.tables import table

# Fixed values of the contact-log derivation: phone prefix by l_linenumber % 4
# (0: none, 1: "86", 2: "086", 3: the invalid "12"), then "139" and 8 digits.
PHONE_PREFIXES = ("", "86", "086", "12")
USER_SNAPSHOT_DATE = "2024-01-01"


def events_sequence_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(a, b)``: each event's user and the user of the next event of the same type and day.

    Same result as ``lead(user_id) OVER (PARTITION BY event_type, date(ts) ORDER BY ts,
    event_id)``, computed over range partitions so a busy (type, day) never lands in
    one task.  Nulls and self pairs are dropped.
    """
    ev = (table(spark, sf_dir, "events")
          .select("user_id", "event_type", F.to_date("ts").alias("day"), "ts", "event_id"))
    led = ordered_lead(ev, ["event_type", "day"], ["ts", "event_id"], "user_id", "b")
    return (led.where(F.col("user_id").isNotNull() & F.col("b").isNotNull()
                      & (F.col("user_id") != F.col("b")))
            .select(F.col("user_id").alias("a"), "b"))


def events_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst, w)`` events graph, one row per unordered pair with ``src < dst``.

    ``w`` counts consecutive-user occurrences in either order.  Read as undirected
    (``orient``) it is the symmetric weighted graph; read as directed it is acyclic,
    so every walk ends in a sink.
    """
    pr = events_sequence_pairs(spark, sf_dir)
    return (pr.groupBy(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
            .agg(F.count(F.lit(1)).cast("double").alias("w")))


def price_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst, w)``: suppliers and the parts ordered from them (ids from 10 000 000 on), one row per
    ``lineitem``.  ``w`` has cents, most of which no double holds exactly: from the price in cents,
    modulo 9973, plus 1, as hundredths."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice")
    cents = F.round(F.col("l_extendedprice").cast("double") * 100).cast("bigint")
    return li.select(F.col("l_suppkey").cast("bigint").alias("src"), (F.col("l_partkey") + 10_000_000).cast("bigint").alias("dst"),
                     ((cents % 9973 + 1) / F.lit(100.0)).alias("w"))


def contact_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, phone_number, dt)`` from ``orders ⋈ lineitem``.

    ``user_id = o_custkey``, ``dt = date(o_orderdate)``, phone = prefix by
    ``l_linenumber % 4`` + ``'139'`` + ``lpad(l_partkey % n_customers, 8, '0')``.
    ``n_customers`` is a scalar subquery, evaluated once.
    """
    n_cust = table(spark, sf_dir, "customer").select(F.count(F.lit(1))).scalar()
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    prefix = F.element_at(F.array(*[F.lit(p) for p in PHONE_PREFIXES]),
                          (F.pmod(F.col("l_linenumber"), F.lit(4)) + 1).cast("int"))
    number = F.lpad(F.pmod(F.col("l_partkey"), n_cust).cast("string"), 8, "0")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"),
                    F.concat(prefix, F.lit("139"), number).alias("phone_number"),
                    F.to_date("o_orderdate").alias("dt")))


def user_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, mobile_number, region_ids, dt)`` from ``customer ⋈ nation``.

    ``nation`` has a fixed, tiny size (25 rows), so it is broadcast.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("id"),
                    F.concat(F.lit("139"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"))
                    .alias("mobile_number"),
                    F.concat_ws(",", F.col("c_nationkey").cast("string"),
                                F.col("n_regionkey").cast("string")).alias("region_ids"),
                    F.lit(USER_SNAPSHOT_DATE).cast("date").alias("dt")))


def vectors_from_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key STRING, vector ARRAY<DOUBLE>)`` from the ``embeddings`` table."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("key"),
        F.col("embedding").cast("array<double>").alias("vector"))
