"""Benchmark decontamination: a prefix-filtered set join, in DataFrame operations only.

A window is 10 consecutive words of a benchmark item; an item of fewer words is one window.  A
document contains a window only if it contains every token of it, so one necessary token is enough to
find all candidates: tokens (one-word shingles) are ordered by how often they occur in the documents,
and a window is indexed under its rarest token and that token's place.  Exploded document words meet
this index by an equi-join.  The place gives where the window would have to begin; candidates that
would begin before or end after the document are dropped (length and position bounds), the others are
verified word by word over the window's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rambler.llm.common import lower_ascii
from rambler.session import materialize

# Fixed value: what separates words once A-Z is lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def windows_of(items: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``(item, window)``: each distinct window of each item; none for an item without words."""
    items = items.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    return (items.withColumn("at", F.explode(starts)).select("item", F.slice("w", F.col("at"), F.lit(size)).alias("window"))
            .distinct())


def index_windows(windows: DataFrame, docs: DataFrame, broadcast_rows: int) -> DataFrame:
    """``(token, place, window)``: each distinct window under its rarest token in ``docs`` (doc, words).

    ``place`` counts from 0.  Windows with a token that no document has can't occur and are left out.
    """
    tokens = windows.select("window").distinct().select("window", F.posexplode("window").alias("place", "token"))
    vocabulary = _small(tokens.select("token").distinct(), broadcast_rows)
    counts = (docs.select(F.explode("words").alias("token")).join(vocabulary, "token").groupBy("token")
              .agg(F.count(F.lit(1)).alias("n")))
    rarest = tokens.join(counts, "token", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "place")).alias("rarest"))
    return rarest.filter("rarest.n > 0").select("rarest.token", "rarest.place", "window")


def _small(table: DataFrame, rows: int) -> DataFrame:
    """``table`` written once, and broadcast if it has at most ``rows`` rows."""
    table = materialize(table, "benchmark")
    return F.broadcast(table) if table.count() <= rows else table


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 10, broadcast_rows: int = 200_000,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``, one row for each row of ``docs``.

    Null and empty texts have no words and are clean.  Rows that repeat an id with the same text each
    get the same result; with another text, each its own.  Items with a null id mark words but aren't
    listed.  Other columns aren't read.  Without documents there are no rows, without items all are
    clean.  ``broadcast_rows`` bounds what is broadcast of the benchmark (windows of at most ``size``
    words); a larger benchmark is joined by shuffling.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("version"), words_of(text).alias("words"))
    windows = materialize(windows_of(items, size, item_col, item_text_col), "windows")
    index = _small(index_windows(windows, rows, broadcast_rows), broadcast_rows)

    start, length = F.col("at") - F.col("place"), F.size("window")
    found = (rows.select("doc", "version", "words", F.posexplode("words").alias("at", "word"))
             .join(index, F.col("word") == F.col("token"))
             .filter((start >= 0) & (start + length <= F.size("words")))
             .filter(F.slice("words", start + 1, length) == F.col("window"))
             .select("doc", "version", start.alias("start"), (start + length).alias("stop"), "window"))
    found = materialize(found, "hits")

    earlier = Window.partitionBy("doc", "version").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(earlier), F.lit(0))), F.lit(0))
    hit = found.withColumn("fresh", fresh).groupBy("doc", "version").agg(F.sum("fresh").alias("n_hit"))
    listed = (found.select("doc", "version", "window").distinct().join(windows, "window").filter("item IS NOT NULL")
              .select("doc", "version", F.col("item").cast("string").alias("item")).distinct().groupBy("doc", "version")
              .agg(F.sort_array(F.collect_list("item")).alias("items")))
    results = hit.join(listed, hit["doc"].eqNullSafe(listed["doc"]) & (hit["version"] == listed["version"]), "left").select(
        hit["doc"].alias("of"), hit["version"].alias("of_version"), "n_hit", "items")

    all_rows = rows.select("doc", "version", F.size("words").cast("long").alias("n_words"))
    joined = all_rows.join(results, F.col("doc").eqNullSafe(F.col("of")) & (F.col("version") == F.col("of_version")), "left")
    n_hit, items = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(F.col("doc").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                         F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
