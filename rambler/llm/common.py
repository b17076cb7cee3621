"""Small shared parts of the operators."""

from __future__ import annotations

import ctypes
import hashlib
import os
import sys
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, text)`` of every row, null text as empty; no other column of ``docs`` can clash."""
    return docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, and no other letter."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(text: Column) -> Column:
    """The content address: 32 bytes of SHA-256 over the UTF-8 text."""
    return F.unhex(F.sha2(text, 256))


LONG_WORD = 64      # bytes


def rehash_long(hashes: np.ndarray, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
    """Replace the hashes of words of more than ``LONG_WORD`` bytes by digests of their bytes.

    Sums modulo 2 ** 64 tell short words apart, but not certain long ones, whatever the base and the
    values: such sums have words of 1,024 letters over two letters that always collide.
    """
    for i in np.flatnonzero(ends - begins > LONG_WORD).tolist():
        hashes[i] = int.from_bytes(hashlib.blake2b(data[begins[i] : ends[i]], digest_size=8).digest(), "little")


def held_out(id_col: str, mod: int, rest: int) -> Column:
    """Whether crc32 of the id's text leaves ``rest``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % mod == rest, F.lit(False))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, asked of the file system that Spark would use for it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def give_back() -> None:
    """Return the freed memory of this Python worker to the system.

    A worker outlives the stages whose arrays it held; allocators keep what was freed, beside whatever
    the next stage needs.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def worker_cache() -> dict:
    """A dictionary of this Python worker that outlives its tasks.

    Functions reach workers by value, their module's variables with them, so a variable would be
    new in every task.
    """
    return sys.modules.setdefault("_rambler_worker_cache", ModuleType("_rambler_worker_cache")).__dict__
