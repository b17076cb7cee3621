"""Chat formatting by columnar byte assembly.

Template: a turn is ``### role: text</turn>`` and a line feed.  Texts and roles are escaped so that
neither ``###`` nor ``</turn>`` can occur in them; the escapes are undone exactly when reading.

Rows are dealt by ranges of (conversation, turn), so a long conversation spreads over tasks.  A task
assembles chunks: from the lengths of headers, contents and footers come their offsets in one
preallocated buffer, and each kind is copied there at once; the buffer becomes an Arrow column as it
is.  A conversation's text is its chunks in order of (part, chunk).  The loss mask is a list of
spans, in code points of the chunk, that cover the assistant's texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

# Fixed values of the template.  The escape character comes first when escaping.
HEAD, MIDDLE, FOOT = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\\\"), ("###", "\\h"), ("</turn>", "\\e"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
_BACK = {"\\": "\\", "h": "###", "e": "</turn>", "c": ":"}
_ESCAPED = re.compile(r"\\([\\hec])")
CHUNK_BYTES = 1 << 20      # a chunk ends after the turn that reaches this size
DIRECT_BYTES = 1 << 16     # a content of this size is copied as one slice
CHUNK_SCHEMA = "conv long, part int, chunk long, body binary, n_turns long, mask array<struct<from: long, to: long>>"


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[1]], text)


def _escape(column: pa.Array, escapes) -> pa.Array:
    column = column.cast(pa.large_string())
    for plain, escaped in escapes:
        column = pc.replace_substring(column, plain, escaped)
    return column


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The offsets of a large string column without nulls, and the bytes they refer to."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return offsets, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def _copy(to: np.ndarray, at: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> None:
    """Put each value of a column at its place: long ones as slices, the rest by scatter indices."""
    lengths = np.diff(offsets)
    for i in np.flatnonzero(lengths >= DIRECT_BYTES):
        to[at[i] : at[i] + lengths[i]] = data[offsets[i] : offsets[i + 1]]
    short = np.flatnonzero(lengths < DIRECT_BYTES)
    lengths = lengths[short]
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    to[np.repeat(at[short], lengths) + within] = data[np.repeat(offsets[:-1][short], lengths) + within]


def assemble(convs: np.ndarray, roles: pa.Array, texts: pa.Array) -> list[tuple[int, pa.Buffer, int, list]]:
    """Chunks ``(first row, body, turns, mask)`` of rows in order; none spans two conversations."""
    heads = pc.binary_join_element_wise(pa.scalar(HEAD, pa.large_string()), _escape(roles, ROLE_ESCAPES),
                                        pa.scalar(MIDDLE, pa.large_string()), pa.scalar("", pa.large_string()))
    bodies = _escape(texts, ESCAPES)
    foots = pa.array([FOOT], pa.large_string()).take(pa.array(np.zeros(len(bodies), np.int64)))
    columns = [_bytes_of(c) for c in (heads, bodies, foots)]
    lengths = np.stack([np.diff(offsets) for offsets, _ in columns], 1)
    chars = np.stack([np.asarray(pc.utf8_length(c)) for c in (heads, bodies, foots)], 1).astype(np.int64)
    ours = np.asarray(pc.equal(roles, "assistant"))
    turn_bytes = lengths.sum(1)
    # a chunk begins with a conversation, and after the turn that fills the one before
    starts, size = [], 0
    for i in range(len(convs)):
        if i == 0 or convs[i] != convs[i - 1] or size >= CHUNK_BYTES:
            starts.append(i)
            size = 0
        size += turn_bytes[i]
    found = []
    for a, b in zip(starts, [*starts[1:], len(convs)]):
        flat = lengths[a:b].ravel()
        ends = np.cumsum(flat)
        at = (ends - flat).reshape(-1, 3)
        body = np.empty(ends[-1], np.uint8)
        for k, (offsets, data) in enumerate(columns):
            _copy(body, at[:, k], offsets[a : b + 1], data)
        char_at = np.cumsum(chars[a:b].ravel()).reshape(-1, 3)  # ends, by code point
        mask = [{"from": int(x), "to": int(y)} for x, y in char_at[ours[a:b]][:, :2]]
        found.append((a, pa.py_buffer(body), b - a, mask))
    return found


def format_chats(turns: DataFrame) -> DataFrame:
    """``(conv, part, chunk, body, n_turns, mask)`` of ``(conv_id, turn, role, text)`` rows.

    Turns go by ``turn``, then role and text, nulls first; null role and text are empty; a null
    conv_id is a conversation too; repeated rows stay.  Other columns aren't read; an empty table
    gives no rows.
    """
    empty = F.lit("")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("turn")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                conv = b.column("conv")
                keys = np.array([-1 if x is None else x * 2 for x in conv.to_pylist()], object)
                for first, body, n, mask in assemble(keys, b.column("role"), b.column("text")):
                    offsets = pa.py_buffer(np.array([0, body.size], np.int32))
                    yield pa.record_batch(
                        [conv.slice(first, 1), pa.array([part], pa.int32()), pa.array([number], pa.int64()),
                         pa.Array.from_buffers(pa.binary(), 1, [None, offsets, body]), pa.array([n], pa.int64()),
                         pa.array([mask], pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))],
                        names=["conv", "part", "chunk", "body", "n_turns", "mask"])
                    number += 1

    return rows.mapInArrow(chunks, CHUNK_SCHEMA)


def read_turns(body: str) -> list[tuple[str, str]]:
    """The ``(role, text)`` turns of a formatted chunk."""
    turns = []
    for turn in body.split(FOOT)[:-1]:
        role, _, text = turn.removeprefix(HEAD).partition(MIDDLE)
        turns.append((unescape(role), unescape(text)))
    return turns


def read_digests(chunks: DataFrame) -> DataFrame:
    """What a reader gets from the output: turns, loss text and sizes of each conversation, as digests.

    A digest runs over a conversation in order, so its chunks stream through one task, one in memory
    at a time.
    """
    order = ["conv", "part", "chunk"]
    rows = chunks.select(*order, "body", "mask").repartition("conv").sortWithinPartitions(*order)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(conv):
            return pa.record_batch([pa.array([x], t) for x, t in zip(
                (conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), size),
                (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], names=names)

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        at = read  # no conversation yet
        for b in batches:
            for i in range(b.num_rows):
                conv = b.column("conv")[i].as_py()
                if at is read or conv != at:
                    if at is not read:
                        yield row(at)
                    at, n, size, loss_chars, turns, loss = conv, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                body = b.column("body")[i].as_py().decode()
                size += len(body)
                for role, text in read_turns(body):
                    n += 1
                    turns.update(f"{role}\n{text}\n".encode())
                for span in b.column("mask")[i].as_py():
                    text = unescape(body[span["from"] : span["to"]])
                    loss_chars += len(text)
                    loss.update(text.encode())
        if at is not read:
            yield row(at)

    return rows.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                 "formatted_chars long")
