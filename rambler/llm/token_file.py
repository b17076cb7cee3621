"""Token ids as a compressed file: canonical Huffman codes of limited length.

Format (a folder of Parquet tables, so that Spark's committer writes each file once):

- ``code``: ``(id, length)``.  Codes are canonical: counted up by (length, id).
- ``blocks``: one row for each block, in order of (part, block): the documents that have ids in it,
  how many ids of each, the bit offsets of checkpoints, and the payload, big-endian bits.  A
  checkpoint stands at each document's first id in the block and after every ``STEP`` ids of it.
  A block can be decoded by itself; a document may span blocks.
- ``parts``: ids in each part.  The parts are ranges of document ids in ascending order.

Writing: texts are encoded once into a staged table, while counting ids; code lengths come from the
global counts (one number for each id of the vocabulary, so bounded) by package-merge; each document
is coded where it lies, and only the coded bits are dealt by range and joined into blocks.
Reading: all checkpoints of a batch are decoded in step with one table lookup a step.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rambler.llm.bpe import encoder

STEP = 256             # ids between two checkpoints
BLOCK_IDS = 1 << 16    # a block ends with the piece that reaches this many ids
PIECE_IDS = 1 << 15    # a longer document is coded in pieces
PART_ROWS = 5_000      # documents in a part, about, up to MOST_PARTS parts
MOST_PARTS = 4_000
BLOCK_SCHEMA = ("part int, block long, docs array<long>, counts array<long>, at_end array<boolean>, "
                "checkpoints array<long>, n_ids long, payload binary")


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal lengths of at most ``limit`` bits for the ids with a count, 0 for the others (package-merge)."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([leaves, packages])
        at = np.argsort(merged, kind="stable")
        levels.append(at < len(leaves))
        merged = merged[at][: len(merged) // 2 * 2]
        packages = merged[0::2] + merged[1::2]
    take = 2 * len(leaves) - 2
    for is_leaf in reversed(levels):
        n = int(is_leaf[:take].sum())
        lengths[order[:n]] += 1
        take = 2 * (take - n)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each id with a length, as a number of that many bits."""
    codes, code, last = np.zeros(len(lengths), np.uint64), 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for i in order[lengths[order] > 0].tolist():
        code <<= int(lengths[i]) - last
        codes[i], last = code, int(lengths[i])
        code += 1
    return codes


def decoding_table(lengths: np.ndarray, limit: int) -> np.ndarray:
    """For each ``limit`` bits that can come next: id * 64 + length of the code they begin with."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    table = np.repeat(order * 64 + lengths[order], 1 << (limit - lengths[order]))
    return np.concatenate([table, np.zeros((1 << limit) - len(table), np.int64)])


def pack(ids: np.ndarray, counts: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bits of documents of ``counts`` ids, each from a whole byte on: the bytes, the byte offsets
    of the documents, and the bit offset of every id in its document."""
    n = lengths[ids]
    id_ends, bit_ends = np.cumsum(counts), np.append(0, np.cumsum(n))
    bits = bit_ends[id_ends] - bit_ends[id_ends - counts]
    byte_at = np.append(0, np.cumsum((bits + 7) // 8))
    within = bit_ends[:-1] - np.repeat(bit_ends[id_ends - counts], counts)
    at = within + np.repeat(byte_at[:-1] * 8, counts)
    wide = codes[ids] << (64 - n - (at & 31)).astype(np.uint64)  # in the 64 bits from the word it begins in
    word = at >> 5
    first = np.flatnonzero(np.diff(word, prepend=-1))
    words = np.zeros(byte_at[-1] // 4 + 3, np.uint64)
    if len(ids):
        words[word[first]] += np.add.reduceat(wide >> np.uint64(32), first)
        words[word[first] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), first)
    return words.astype(">u4").view(np.uint8)[: byte_at[-1]], byte_at, within


def unpack(payload: np.ndarray, at: np.ndarray, n: np.ndarray, table: np.ndarray, limit: int) -> np.ndarray:
    """``n[i]`` ids from bit ``at[i]`` on, for all i; the runs one after the other."""
    padded = np.concatenate([payload, np.zeros(12 - len(payload) % 4, np.uint8)]).view(">u4").astype(np.uint64)
    pairs = padded[:-1] << np.uint64(32) | padded[1:]
    order = np.argsort(-n, kind="stable")
    at, left, to = at[order].copy(), n[order], (np.cumsum(n) - n)[order]
    out = np.empty(int(n.sum()), np.int64)
    for k in range(int(left[0]) if len(left) else 0):
        m = int(np.searchsorted(-left, -k, side="left"))  # runs with more than k ids
        at, to = at[:m], to[:m]
        bits = pairs[at >> 5] << (at & 31).astype(np.uint64) >> np.uint64(64 - limit)
        got = table[bits.astype(np.int64)]
        out[to + k] = got >> 6
        at = at + (got & 63)
    return out


@dataclass(frozen=True)
class TokenFile:
    """A written file: its folder and the longest code."""

    path: str
    limit: int


def _stage(docs: DataFrame, tokenizer_path: str, end_id: int, path: str) -> DataFrame:
    """``(doc, ids)`` with the end id, and one row ``(null, counts)`` a task, in one pass over the texts."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, total = encoder(tokenizer_path), np.zeros(0, np.int64)
        for whole in it:
            for a in range(0, whole.num_rows, 1024):
                b = whole.slice(a, 1024)
                ids, n = e.encode(b.column("text"))
                ends = np.cumsum(n)
                ids = np.insert(ids, ends, end_id)
                seen = np.bincount(ids, minlength=len(total))
                seen[: len(total)] += total
                total = seen
                offsets = np.append(0, ends + np.arange(1, len(n) + 1)) * e.dtype.itemsize
                column = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.record_batch([b.column("doc"), column, pa.nulls(len(n), pa.list_(pa.int64()))], names=["doc", "ids", "counts"])
        if len(total):
            yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.tolist()], pa.list_(pa.int64()))],
                                  names=["doc", "ids", "counts"])

    docs.mapInArrow(batches, "doc long, ids binary, counts array<long>").write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, path: str, limit: int = 20,
                 id_col: str = "doc_id", text_col: str = "text") -> TokenFile:
    """Encode every text, append ``end_id`` to each, and write the file in ascending order of ids.

    Null text is empty, its only id is ``end_id``.  Null ids come first; rows with the same id stay
    as rows, in order of a checksum of their token ids.  Other columns aren't read; an empty table gives a file
    without blocks.  ``id_col`` must be an integer; ``path`` must be new.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    staged = _stage(rows, tokenizer_path, end_id, f"{path}/staged")
    counted = staged.filter("counts IS NOT NULL").select(F.posexplode("counts").alias("id", "n")).groupBy("id").agg(F.sum("n").alias("n"))
    found = {r["id"]: r["n"] for r in counted.filter("n > 0").collect()}  # at most the vocabulary
    counts = np.zeros(max(found, default=0) + 1, np.int64)
    counts[list(found)] = list(found.values())
    lengths = code_lengths(counts, limit)
    used = np.flatnonzero(lengths).tolist()
    spark.createDataFrame([(i, int(lengths[i])) for i in used], "id long, length int").coalesce(1).write.parquet(f"{path}/code")

    coded = staged.filter("ids IS NOT NULL").select("doc", "ids")
    n_docs = coded.count()
    n_parts = max(1, -(-n_docs // max(PART_ROWS, n_docs // MOST_PARTS)))
    bounds = coded.approxQuantile("doc", [k / n_parts for k in range(1, n_parts)], 0.2 / n_parts) if n_parts > 1 else []
    shared = spark.sparkContext.broadcast((lengths, canonical_codes(lengths), np.unique(np.array(bounds))))

    def code(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, codes, bounds = shared.value
        dtype = encoder(tokenizer_path).dtype
        for whole in it:
            for a in range(0, whole.num_rows, 1024):
                b = whole.slice(a, 1024)
                column = b.column("ids").cast(pa.large_binary())
                _, offsets, data = column.buffers()
                offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
                ids = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(dtype)
                counts = np.diff(offsets) // dtype.itemsize
                payload, byte_at, at = pack(ids, counts, codes, lengths)
                n_points = -(-counts // STEP)
                point_ends = np.cumsum(n_points)
                step = np.arange(n_points.sum()) - np.repeat(point_ends - n_points, n_points)
                points = at[np.repeat(np.cumsum(counts) - counts, n_points) + step * STEP]
                docs = b.column("doc").to_pylist()
                parts = [0 if d is None else int(np.searchsorted(bounds, d, side="right")) for d in docs]
                ties = [zlib.crc32(x.as_buffer()) for x in b.column("ids")]
                yield pa.record_batch(
                    [pa.array(parts, pa.int32()), b.column("doc"), pa.array(ties, pa.int64()), pa.array(counts),
                     pa.ListArray.from_arrays(pa.array(np.append(0, point_ends), pa.int32()), pa.array(points)),
                     pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(byte_at), pa.py_buffer(payload)]).cast(pa.binary())],
                    names=["part", "doc", "tie", "n", "points", "payload"])

    order = [F.asc_nulls_first(c) for c in ("part", "doc", "tie")]
    bits = coded.mapInArrow(code, "part int, doc long, tie long, n long, points array<long>, payload binary")
    blocks = bits.repartition(n_parts, "part").sortWithinPartitions(*order).mapInArrow(_blocks, BLOCK_SCHEMA)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids")).coalesce(1).write.parquet(f"{path}/parts")
    return TokenFile(path, limit)


def _blocks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted documents.  A long document is cut at checkpoints, where no byte need be shared out
    anew: a piece begins with the byte that its first bit is in."""
    part, number, open_ = None, 0, []

    def block():
        docs, counts, ends, points, bodies = zip(*open_)
        sizes = np.array([len(x) for x in bodies])
        base = (np.cumsum(sizes) - sizes) * 8
        return pa.record_batch(
            [pa.array([x], t) for x, t in (
                (part, pa.int32()), (number, pa.int64()), (list(docs), pa.list_(pa.int64())), (list(counts), pa.list_(pa.int64())),
                (list(ends), pa.list_(pa.bool_())), (np.concatenate([p + o for p, o in zip(points, base)]), pa.list_(pa.int64())),
                (sum(counts), pa.int64()), (b"".join(bodies), pa.binary()))],
            names=["part", "block", "docs", "counts", "at_end", "checkpoints", "n_ids", "payload"])

    size = 0
    for b in it:
        for i in range(b.num_rows):
            row_part, doc, n = (b.column(c)[i].as_py() for c in ("part", "doc", "n"))
            points, body = b.column("points")[i].values.to_numpy(), b.column("payload")[i].as_buffer()
            if open_ and row_part != part:
                yield block()
                open_, size = [], 0
            if row_part != part:
                part, number = row_part, 0
            for a in range(0, n, PIECE_IDS):
                own = points[a // STEP : (a + PIECE_IDS) // STEP]
                begin = int(own[0]) // 8
                end = (int(points[(a + PIECE_IDS) // STEP]) + 7) // 8 if a + PIECE_IDS < n else len(body)
                open_.append((doc, min(PIECE_IDS, n - a), a + PIECE_IDS >= n, own - begin * 8, bytes(body[begin:end])))
                size += open_[-1][1]
                if size >= BLOCK_IDS:
                    yield block()
                    open_, size, number = [], 0, number + 1
    if open_:
        yield block()


def open_tokens(path: str, limit: int = 20) -> TokenFile:
    return TokenFile(path, limit)


def read_tokens(spark: SparkSession, file: TokenFile, use, schema: str) -> DataFrame:
    """Decode every block where it lies.  ``use(part, block, docs, at_end, counts, ids)`` gives the rows
    (a RecordBatch) that a block becomes; ``ids`` are all its ids in order."""
    lengths_of = {r["id"]: r["length"] for r in spark.read.parquet(f"{file.path}/code").collect()}  # at most the vocabulary
    lengths = np.zeros(max(lengths_of, default=0) + 1, np.int64)
    lengths[list(lengths_of)] = list(lengths_of.values())
    shared, limit = spark.sparkContext.broadcast(lengths), file.limit

    def decode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(shared.value, limit)
        for whole in it:
            for a in range(0, whole.num_rows, 16):
                b = whole.slice(a, 16)
                rows = b.to_pylist()
                payloads = [np.frombuffer(r["payload"], np.uint8) for r in rows]
                base = np.cumsum([0] + [len(x) * 8 for x in payloads])
                at = np.concatenate([np.array(r["checkpoints"]) + o for r, o in zip(rows, base)])
                counts = np.concatenate([np.array(r["counts"]) for r in rows])
                n_points = -(-counts // STEP)
                runs = np.full(len(at), STEP)
                runs[np.cumsum(n_points) - 1] = counts - (n_points - 1) * STEP
                ids = unpack(np.concatenate(payloads), at, runs, table, limit)
                end = 0
                for r in rows:
                    begin, end = end, end + r["n_ids"]
                    yield use(r["part"], r["block"], r["docs"], r["at_end"], r["counts"], ids[begin:end])

    return spark.read.parquet(f"{file.path}/blocks").mapInArrow(decode, schema)


def _zeros_after(crc: int, n: int) -> int:
    """What a crc32 contributes once n more bytes have followed."""
    zeros = bytes(n)
    return zlib.crc32(zeros, crc) ^ zlib.crc32(zeros)


def read_digests(spark: SparkSession, file: TokenFile) -> DataFrame:
    """``(doc, start, n_tokens, ids_crc32)`` of each document, from the file alone.

    Blocks are decoded in any order to counts and checksums of pieces; only these are put in order.
    """
    def digest(part, block, docs, at_end, counts, ids):
        data, width = ids.astype("<u4").tobytes(), 4
        ends = np.cumsum(counts)
        crcs = [zlib.crc32(data[(e - n) * width : e * width]) for e, n in zip(ends.tolist(), counts)]
        k = len(docs)
        return pa.record_batch([pa.array([part] * k, pa.int32()), pa.array([block] * k, pa.int64()), pa.array(range(k), pa.int64()),
                                pa.array(docs, pa.int64()), pa.array(at_end, pa.bool_()), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())],
                               names=["part", "block", "place", "doc", "at_end", "n", "crc"])

    pieces = read_tokens(spark, file, digest, "part int, block long, place long, doc long, at_end boolean, n long, crc long")

    def join(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, n, crc = None, 0, 0, 0
        for b in it:
            out = []
            for row in zip(*(b.column(c).to_pylist() for c in ("part", "doc", "at_end", "n", "crc"))):
                if row[0] != part:
                    part, at, n, crc = row[0], 0, 0, 0
                crc = _zeros_after(crc, row[3] * 4) ^ row[4] if n else row[4]
                n += row[3]
                if row[2]:
                    out.append((part, row[1], at, n, crc))
                    at, n, crc = at + n, 0, 0
            yield pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int32(), *[pa.int64()] * 4))],
                                  names=["part", "doc", "within", "n_tokens", "ids_crc32"])

    found = (pieces.repartition("part").sortWithinPartitions("part", "block", "place")
             .mapInArrow(join, "part int, doc long, within long, n_tokens long, ids_crc32 long"))
    parts = spark.read.parquet(f"{file.path}/parts")  # one row a part, at most MOST_PARTS
    before = parts.select("part", (F.sum("n_ids").over(Window.orderBy("part")) - F.col("n_ids")).alias("before"))
    return found.join(F.broadcast(before), "part").select("doc", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
