"""Order-dependent primitives that never put a whole key group into one task.

The data is range-partitioned on the full sort key, so a hot key is spread over as
many partitions as its size needs, and each partition is scanned once in Arrow
batches.  What crosses a partition border (a running sum, the next row) comes from
a summary with one row per partition, collected to the driver the way
``zipWithIndex`` collects partition sizes: its size is bounded by the partition
count, never by the data.  Range bounds are sampled anew by every execution, so the
sorted data is kept once (checkpointed, or written with the running sums inside each
partition, to which the carry is added on reading), in the session's checkpoint
directory; sort keys are unique at every call site, so the order inside a partition is
fixed too.  Ranks and leads re-check the summary they were given.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from rambler.functions.weights import EXPONENT, from_units, weight_units


PARTITION_BYTES = 128 << 20


def _ranged(df: DataFrame, cols: list[str], n: int | None, written: bool = False) -> tuple[DataFrame, str | None]:
    """Range-partitioned and sorted rows with their partition, and the path of a table to delete once they are read.

    The rows are written first (unless they are ``written``): range bounds are sampled from that table,
    not by running the plan once more, and its size on disk tells how many partitions it needs (``n`` overrides).  If the
    session's number is enough, AQE merges adjacent small ranges, so partitions stay ordered.
    """
    from rambler.session import ensure_checkpoint_dir, write_scratch
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = None
    if not written:
        df, path = write_scratch(df, "unsorted")
    wanted = -(-int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) // PARTITION_BYTES)
    if not n and wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        n = wanted
    ranged = df.repartitionByRange(n, *cols) if n else df.repartitionByRange(*cols)
    # The partition index is stored as data: a task's own index differs from it when the
    # scan is one branch of a union, or after partitions are coalesced.
    return ranged.sortWithinPartitions(*cols).withColumn(_PID, F.spark_partition_id()), path


def _sorted(df: DataFrame, cols: list[str], n: int | None) -> DataFrame:
    """Range-partition, sort, and checkpoint."""
    from rambler.session import delete_scratch, reliable_checkpoint
    ranged, path = _ranged(df, cols, n)
    done = reliable_checkpoint(ranged)
    delete_scratch(df.sparkSession, path)     # the checkpoint is eager and has its own copy
    return done


_PID = "_rpid"
_FIRST = "_rfirst"      # the row is of its partition's first key


def _summary_schema(fields: list[T.StructField]) -> T.StructType:
    return T.StructType([T.StructField("pid", T.IntegerType(), False)] + fields)


def _segment_sums(pdf: pd.DataFrame, keys: list[str], value: str, last_key, carry: int):
    """Running sums per run of equal keys, continuing ``carry`` for ``last_key``; int64, so exact."""
    new = np.zeros(len(pdf), dtype=bool)
    for c in keys:
        new |= (pdf[c] != pdf[c].shift()).to_numpy()
    seg = new.cumsum()
    vals = pdf[value].to_numpy(dtype="int64")
    run = np.cumsum(vals)
    starts = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
    cum = run - np.repeat((run - vals)[starts], np.diff(np.r_[starts, len(vals)]))
    if last_key is not None and _gkey(pdf, keys, 0) == last_key:
        cum[seg == seg[0]] += carry
    return cum, vals, starts


def segmented_cumsum(df: DataFrame, key: str | list[str], order: list[str], value: str,
                     before: str = "cum_before", after: str = "cum_after",
                     partitions: int | None = None, exponent: int = EXPONENT, written: bool = False) -> DataFrame:
    """Running sum of ``value`` within each ``key`` in ``order``; see ``written_cumsum``."""
    return written_cumsum(df, key, order, value, before, after, partitions, exponent, written)[0]


def written_cumsum(df: DataFrame, key: str | list[str], order: list[str], value: str,
                   before: str = "cum_before", after: str = "cum_after",
                   partitions: int | None = None, exponent: int = EXPONENT, written: bool = False) -> tuple[DataFrame, str]:
    """Running sum of ``value`` within each ``key`` in ``order``, and the path of the table that it reads.

    Adds ``before`` (sum of the earlier rows of the key) and ``after`` (including the row), both
    exact, so a row's ``before`` is the previous row's ``after`` whatever the partitions: integers
    are summed as they are, other numbers as whole units of 10 ** -exponent (null: 0).  ``written``
    says that ``df`` is a written table already, which saves writing it again.
    ``(*key, *order)`` must be unique, keys must not be null, and a key's sum must fit a 64-bit integer.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not isinstance(df.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        units, at = written_cumsum(df.withColumn("_units", weight_units(value, exponent)), keys, order, "_units", before, after, partitions, written=written)
        return units.withColumns({before: from_units(before, exponent), after: from_units(after, exponent)}).drop("_units"), at
    from rambler.session import delete_scratch, write_scratch
    ranged, path = _ranged(df, [*keys, *order], partitions, written)
    columns = ranged.columns

    def scan(batches):
        last_key, carry, in_first = None, 0, True
        for batch in batches:
            if not batch.num_rows:
                continue
            pdf = batch.select([*keys, value]).to_pandas()
            if pdf.isna().any(axis=None):
                raise ValueError("segmented_cumsum: null key or value")
            first = np.zeros(len(pdf), dtype=bool)
            cum, vals, starts = _segment_sums(pdf, keys, value, last_key, carry)
            if in_first and (last_key is None or _gkey(pdf, keys, 0) == last_key):
                first[: starts[1] if len(starts) > 1 else len(pdf)] = True
                in_first = len(starts) == 1
            else:
                in_first = False
            last_key, carry = _gkey(pdf, keys, len(pdf) - 1), int(cum[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cum - vals), pa.array(cum), pa.array(first)], names=[*columns, before, after, _FIRST])

    sums, at = write_scratch(ranged.mapInArrow(scan, T.StructType([*ranged.schema.fields, T.StructField(before, T.LongType()), T.StructField(after, T.LongType()),
                                                                   T.StructField(_FIRST, T.BooleanType())])), "sums")
    if path:
        delete_scratch(df.sparkSession, path)
    # a key's part in a partition: its sum, and its size, without overflow
    parts = sums.groupBy(_PID, *keys).agg(F.try_sum(value).alias("total"), F.sum(F.abs(F.col(value).cast("double"))).alias("size"))
    part = F.struct(*keys, "total", "size")
    summary = parts.groupBy(_PID).agg(F.min(part).alias("first"), F.max(part).alias("last"), F.max("size").alias("most")).collect()
    carry_in = [0] * (1 + max((r[_PID] for r in summary), default=0))      # one entry per partition
    chain_key, chain_total, chain_size = None, 0, 0.0
    for r in sorted(summary, key=lambda r: r[_PID]):
        first, last = tuple(r["first"])[:-2], tuple(r["last"])[:-2]
        chained = chain_key is not None and first == chain_key
        cin = chain_total if chained else 0
        first_size = r["first"]["size"] + (chain_size if chained else 0.0)
        chain_size = first_size if first == last else r["last"]["size"]
        if max(first_size, r["most"]) >= 2.0 ** 63:
            raise OverflowError(f"segmented_cumsum: the sums of {value} may not fit 64 bits")
        carry_in[r[_PID]] = cin
        chain_key, chain_total = last, (cin if first == last else 0) + r["last"]["total"]
    if any(carry_in):
        more = F.when(F.col(_FIRST), F.get(F.array(*map(F.lit, carry_in)).cast("array<bigint>"), F.col(_PID))).otherwise(F.lit(0).cast("bigint"))
        sums = sums.withColumns({before: F.col(before) + more, after: F.col(after) + more})
    return sums.drop(_PID, _FIRST), at


def global_rank(df: DataFrame, order: list[str], name: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (must be unique); no single-task window."""
    s = _sorted(df, order, partitions)

    def count(batches):
        c, pid = 0, None
        for pdf in batches:
            if len(pdf):
                c, pid = c + len(pdf), int(pdf[_PID].iloc[0])
        if c:
            yield pd.DataFrame({"pid": [pid], "n": [c]})

    sizes = s.mapInPandas(count, _summary_schema([T.StructField("n", T.LongType())])).collect()
    offsets, acc = {}, 0
    for r in sorted(sizes, key=lambda r: r.pid):
        offsets[r.pid] = (acc, r.n)
        acc += r.n

    out_schema = T.StructType(list(df.schema.fields) + [T.StructField(name, T.LongType(), False)])
    offsets = df.sparkSession.sparkContext.broadcast(offsets)

    def scan(batches):
        start = expect = None
        seen = 0
        for pdf in batches:
            if pdf.empty:
                continue
            if start is None:
                start, expect = offsets.value.get(int(pdf[_PID].iloc[0]), (0, -1))
            yield pdf.drop(columns=[_PID]).assign(**{name: np.arange(start + seen, start + seen + len(pdf), dtype="int64")})
            seen += len(pdf)
        if start is not None and seen != expect:
            raise RuntimeError("global_rank: partition contents changed between passes")

    return s.mapInPandas(scan, out_schema)


def ordered_lead(df: DataFrame, group: list[str], order: list[str], value: str, out: str = "next",
                 partitions: int | None = None) -> DataFrame:
    """``lead(value) OVER (PARTITION BY group ORDER BY order)`` without one task per group.

    ``(*group, *order)`` must be unique.  The last row of a partition takes its successor
    from the first row of the next non-empty partition.
    """
    s = _sorted(df, [*group, *order], partitions)
    vtype = df.schema[value].dataType

    def heads(batches):
        for pdf in batches:
            if not pdf.empty:
                yield pd.DataFrame({"pid": [int(pdf[_PID].iloc[0])], "g": [_gkey(pdf, group, 0)],
                                    "v": [_py(pdf[value].iloc[0])]})
                break
        for _ in batches:   # drain
            pass

    hs = sorted(s.mapInPandas(heads, _summary_schema([T.StructField("g", T.StringType()),
                                                      T.StructField("v", vtype)])).collect(),
                key=lambda r: r.pid)
    successor = df.sparkSession.sparkContext.broadcast({a.pid: (b.g, b.v) for a, b in zip(hs, hs[1:])})
    out_schema = T.StructType(list(df.schema.fields) + [T.StructField(out, vtype, True)])

    def scan(batches):
        nxt_g = nxt_v = None
        held = None
        for pdf in batches:
            if pdf.empty:
                continue
            pdf = pdf.drop(columns=[_PID]) if held is not None or _PID not in pdf else _first(pdf)
            if held is None and nxt_g is None:
                nxt_g, nxt_v = successor.value.get(pdf.attrs["pid"], (None, None))
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            held = pdf.iloc[[-1]].reset_index(drop=True)
            body = pdf.iloc[:-1]
            if len(body):
                yield _lead_within(pdf, group, value, out).iloc[:-1]
        if held is not None:
            last = held.assign(**{out: None})
            if nxt_g is not None and _gkey(held, group, 0) == nxt_g:
                last[out] = nxt_v
            yield last

    return s.mapInPandas(scan, out_schema)


def _py(x):
    """A plain Python scalar (numpy scalars and row upcasts would change the repr)."""
    return x.item() if hasattr(x, "item") else x


def _gkey(pdf: pd.DataFrame, group: list[str], i: int) -> str:
    return repr(tuple(_py(pdf[c].iloc[i]) for c in group))


def _first(pdf: pd.DataFrame) -> pd.DataFrame:
    pid = int(pdf[_PID].iloc[0])
    out = pdf.drop(columns=[_PID])
    out.attrs["pid"] = pid
    return out


def _lead_within(pdf: pd.DataFrame, group: list[str], value: str, out: str) -> pd.DataFrame:
    same = np.ones(len(pdf), dtype=bool)
    for c in group:
        col = pdf[c]
        same &= (col == col.shift(-1)).to_numpy()
    nxt = pdf[value].shift(-1)
    return pdf.assign(**{out: nxt.where(same, None)})
