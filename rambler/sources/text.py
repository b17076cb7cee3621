"""Text sources and sinks (whitespace/tab separated lines), as Spark text scans and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def _parts(value: str = "value"):
    return F.split(F.trim(F.col(value)), r"\s+")


def parse_edge_lines(lines: DataFrame, weighted: bool = True, partitioned: bool = False) -> DataFrame:
    """S3: ``src dst``, ``src dst w``, ``src dst part`` or ``src dst part w`` lines → ``(src, dst, w, part)``.

    The weight is the last column; the partition is the third.  With three columns the
    ``partitioned`` flag decides what the third one is.  A missing or unparsable weight is 1.0,
    a missing or unparsable partition null.  Lines that don't begin with two ids (headers,
    comments, blank or damaged lines) give no edge; ``edge_line_counts`` counts them.
    """
    p = _parts()
    n = F.size(p)
    src = F.try_element_at(p, F.lit(1)).try_cast("bigint")
    dst = F.try_element_at(p, F.lit(2)).try_cast("bigint")
    third = F.try_element_at(p, F.lit(3))
    last = F.try_element_at(p, F.lit(-1))
    if weighted:
        has_w = (n >= 4) | ((n == 3) & F.lit(not partitioned))
        w = F.coalesce(F.when(has_w, last.try_cast("double")), F.lit(1.0))
    else:
        w = F.lit(1.0)
    part = F.when(F.lit(partitioned) & (n >= 3), third.try_cast("int")) if partitioned else F.lit(None).cast("int")
    return (lines.select(src.alias("src"), dst.alias("dst"), w.alias("w"), part.alias("part"))
            .where(F.col("src").isNotNull() & F.col("dst").isNotNull()))


def edge_line_counts(lines: DataFrame) -> DataFrame:
    """One row ``(lines, edges, blank, skipped)``: skipped are the other lines without two ids."""
    p = _parts()
    blank = F.length(F.trim("value")) == 0
    ids = F.try_element_at(p, F.lit(1)).try_cast("bigint").isNotNull() & F.try_element_at(p, F.lit(2)).try_cast("bigint").isNotNull()
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.count_if(ids).alias("edges"), F.count_if(blank).alias("blank"),
                     F.count_if(~ids & ~blank).alias("skipped"))


def read_edge_list(spark: SparkSession, path: str, weighted: bool = True, partitioned: bool = False) -> DataFrame:
    return parse_edge_lines(spark.read.text(path), weighted, partitioned)


def parse_walk_lines(lines: DataFrame) -> DataFrame:
    """One whitespace-separated path per line → ``tokens ARRAY<STRING>``."""
    return lines.where(F.length(F.trim("value")) > 0).select(_parts().alias("tokens"))


def read_walk_series(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    df = parse_walk_lines(spark.read.text(path))
    return df.repartition(partitions) if partitions else df


def parse_vector_lines(lines: DataFrame) -> DataFrame:
    """``key v0 v1 …`` lines → ``(number STRING, vector ARRAY<DOUBLE>)``."""
    p = _parts()
    return (lines.where(F.length(F.trim("value")) > 0)
            .select(F.element_at(p, 1).alias("number"),
                    F.transform(F.slice(p, 2, F.size(p) - 1), lambda x: x.cast("double")).alias("vector")))


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return parse_vector_lines(spark.read.text(path))


def paths_as_lines(paths: DataFrame, sep: str = "\t") -> DataFrame:
    """K1 content: one line per path, ids joined by ``sep``."""
    return paths.select("rnd", "v0", F.array_join(F.col("path").cast("array<string>"), sep).alias("line"))


def vectors_as_lines(vectors: DataFrame, key: str = "key", sep: str = "\t") -> DataFrame:
    """K2 content: ``key<sep>v0<sep>v1…``."""
    return vectors.select(F.concat_ws(sep, F.col(key).cast("string"),
                                      F.array_join(F.col("vector").cast("array<string>"), sep)).alias("value"))


def _files(df: DataFrame, single_output: bool, partitions: int) -> DataFrame:
    """K6: one output file, or ``partitions`` files.  One file takes a shuffle, so that only the
    writing, and not the computing, happens in one task."""
    return df.repartition(1 if single_output else partitions)


def write_paths(paths: DataFrame, path: str, single_output: bool = False, partitions: int = 200) -> None:
    """K1: tab-joined paths as text (one per line)."""
    _files(paths_as_lines(paths).select(F.col("line").alias("value")), single_output, partitions) \
        .write.mode("overwrite").text(path)


def write_vectors(vectors: DataFrame, path: str, key: str = "key", single_output: bool = False,
                  partitions: int = 200) -> None:
    """K2: ``key\\tv0\\t…`` text."""
    _files(vectors_as_lines(vectors, key), single_output, partitions).write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, single_output: bool = False, partitions: int = 200) -> None:
    """K4/K5: id map, dataset properties and other tables as Parquet."""
    _files(df, single_output, partitions).write.mode("overwrite").parquet(path)
