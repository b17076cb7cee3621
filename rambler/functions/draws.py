"""Keyed pseudo-random draws.

A draw is a pure function of its key, so a recomputed partition (lost executor,
evicted cache) draws exactly what it drew before, and any SQL engine with md5 can
reproduce it: ``u = int(first 13 hex digits of md5("k1|k2|...")) / 2**52`` in [0, 1).
"""

from pyspark.sql import Column, functions as F

DRAW_SCALE = 4503599627370496.0  # 2**52


def draw(*keys: Column | str | int) -> Column:
    parts = [F.lit(str(k)) if isinstance(k, int) else (F.col(k) if isinstance(k, str) else k)
             for k in keys]
    h = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(DRAW_SCALE)
