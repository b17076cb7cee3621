"""Dense-vector maths on ARRAY<DOUBLE> columns, folded left to right (bitwise reproducible)."""

from pyspark.sql import Column, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(x: Column | str, y: Column | str) -> Column:
    """Σ xᵢ·yᵢ as a sequential fold (null if the sizes differ)."""
    return F.aggregate(F.zip_with(_c(x), _c(y), lambda a, b: a * b), F.lit(0.0).cast("double"),
                       lambda acc, v: acc + v)


def norm(x: Column | str) -> Column:
    """√Σ xᵢ²."""
    return F.sqrt(F.aggregate(F.transform(_c(x), lambda a: a * a), F.lit(0.0).cast("double"),
                              lambda acc, v: acc + v))


def cosine(x: Column | str, y: Column | str) -> Column:
    """dot / (‖x‖·‖y‖); sizes must match (error otherwise); a zero vector gives NaN."""
    x, y = _c(x), _c(y)
    den = norm(x) * norm(y)
    checked = F.when(F.size(x) != F.size(y),
                     F.raise_error(F.lit("cosine: vectors of different sizes")).cast("double"))
    return F.coalesce(checked, F.when(den == 0.0, F.lit(float("nan"))).otherwise(dot(x, y) / den))
