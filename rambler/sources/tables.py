"""Parquet table access (column pruning and filters reach the scan)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _folder(day: str, unit: str) -> str:
    return day if unit == "day" else unit


def write_by_date(df: DataFrame, path: str, day: str = "dt", unit: str = "day") -> None:
    """S1/S2's layout: a folder for each day, or for each "month" or "year" of small tables.

    A folder's rows are brought together before they are written, so it has few files; one that is much
    larger than the others is split.
    """
    folder = _folder(day, unit)
    if folder != day:
        df = df.withColumn(folder, F.trunc(day, unit))
    df.hint("rebalance", F.col(folder)).write.mode("overwrite").partitionBy(folder).parquet(path)


def read_dates(spark: SparkSession, path: str, start: str | None = None, end: str | None = None, day: str = "dt",
               unit: str = "day") -> DataFrame:
    """The days from ``start`` to ``end`` (inclusive) of a table written by date: other folders aren't read."""
    rows, folder = spark.read.parquet(path), _folder(day, unit)
    for bound, keep in ((start, "__ge__"), (end, "__le__")):
        if bound:
            date = F.lit(bound).cast("date")
            rows = rows.where(getattr(F.col(day), keep)(date))
            rows = rows.where(getattr(F.col(folder), keep)(F.trunc(date, unit))) if folder != day else rows
    return rows


def on_days(rows: DataFrame, days: DataFrame, day: str = "dt", unit: str = "day") -> DataFrame:
    """The ``rows`` (``read_dates``) of ``days`` (one column, distinct): their folders are found at run time."""
    folder = _folder(day, unit)
    keyed = days.select(day) if folder == day else days.select(day, F.trunc(day, unit).alias(folder))
    return rows.join(keyed, [day] if folder == day else [folder, day])
