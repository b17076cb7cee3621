"""Phone-number normalisation (the reference's only scalar UDF, as a column expression)."""

from pyspark.sql import Column, functions as F

# Fixed values (must equal the modelled system): an optional "86" country prefix with any
# number of leading zeros, then an 11-digit mobile number starting 13/14/15/17/18.
# ``\z`` instead of ``$``: the whole string must match, a trailing newline included.
PHONE_PATTERN = r"^(|0*86)(1[34578][0-9]{9})\z"


def normalize_phone(c: Column | str) -> Column:
    """The 11-digit mobile number, ``""`` when the input does not match, null for null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract(col, PHONE_PATTERN, 2)
