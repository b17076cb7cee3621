"""Conversation prefix trie by whole-sequence collapse.

Conversations that begin like the first one of their group (``rebuild``) share long prefixes.  A turn
becomes a digest, a prefix of d turns the sum of 128-bit hashes of its (place, digest) pairs, kept as two
64-bit halves: sums run over ranges of (conversation, place), so a long conversation is no task's own.

1. Conversations of equal length and sum are one sequence: its smallest id, its weight and its end list.
2. Sequences that are proper prefixes of others (an anti-join with all proper prefixes) aren't leaves.
3. Prefixes of sequences, with weights, are grouped into nodes.
4. A node's saved tokens are credited to the sequence of its smallest member, (sequence, depth) being
   unique, summed from each sequence's end, and grouped by node again.

Texts are read once, for their digests and lengths; only digests are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from rambler.llm.running import running_sums
from rambler.session import materialize

_NODE = ["a", "b", "depth"]
CHUNK_BYTES = 1 << 20       # of an end list


def _quarters(x: Column) -> list[Column]:
    """A 64-bit number as two of 32 bits, whose sums can't overflow."""
    return [x.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(x, 32)]


def _half(low: Column, high: Column) -> Column:
    """Two sums of 32-bit numbers, modulo 2 ** 32, as a 64-bit number."""
    return F.shiftleft(high.bitwiseAND(F.lit(0xFFFFFFFF)), 32).bitwiseOR(low.bitwiseAND(F.lit(0xFFFFFFFF)))


def read_turns(turns: DataFrame) -> DataFrame:
    """``(conv, place, turn, chars)``, places from 0 by ``turn`` (null first), then role and the turn's digest."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("nth"), role.alias("role"),
                                                      digest.alias("turn"), F.char_length(text).cast("long").alias("chars"))
    rows = materialize(rows, "turns")
    placed = running_sums(rows, ["conv"], [F.col("nth").asc_nulls_first(), "role", "turn"], {"place": F.lit(1).cast("long")})
    return placed.select("conv", "place", "turn", "chars")


def rebuild(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like their group's first one: ``((conv, place, turn, chars), (conv))``.

    Conversation c takes the first h = crc32(c as text) % ``most`` turns of c - c % ``group`` (all if
    fewer, none if there are none) in place of its own first h.  The second table lists every
    conversation, also those that are left without turns.
    """
    turns = materialize(turns, "placed")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    lengths = materialize(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "lengths")
    first = F.col("conv") - F.pmod("conv", F.lit(group))
    heads = lengths.select(F.col("conv").alias("first"), F.col("n").alias("n_first"))
    convs = (lengths.select("conv", first.alias("first"), h.alias("h")).join(heads, "first", "left")
             .select("conv", "first", "h", F.least("h", F.coalesce("n_first", F.lit(0))).alias("taken")))
    convs = materialize(convs, "conversations")
    own = (turns.filter(F.col("place") >= h).join(convs.select("conv", "h", "taken"), "conv")
           .select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "turn", "chars"))
    opening = turns.filter((F.col("place") < most) & (F.pmod("conv", F.lit(group)) == 0)).withColumnRenamed("conv", "first")
    lent = (convs.select("conv", "first", "taken").join(opening, "first").filter(F.col("place") < F.col("taken"))
            .select("conv", "place", "turn", "chars"))
    return own.unionByName(lent), convs.select("conv")


def with_prefix_sums(turns: DataFrame) -> DataFrame:
    """``(conv, depth, chars, a, b, parent_a, parent_b)``: each turn as the last one of its prefix."""
    parts = [q for seed in (1, 2) for q in _quarters(F.xxhash64(F.lit(seed), F.col("place"), F.col("turn")))]
    names = [f"q{i}" for i in range(4)]
    rows = materialize(turns.select("conv", "place", "chars", *[p.alias(n) for p, n in zip(parts, names)]), "hashed")
    summed = running_sums(rows, ["conv"], ["place"], {f"s{n}": n for n in names})
    before, after = [F.col(f"s{n}") for n in names], [F.col(f"s{n}") + F.col(n) for n in names]
    return summed.select("conv", (F.col("place") + 1).alias("depth"), "chars", _half(*after[:2]).alias("a"), _half(*after[2:]).alias("b"),
                         _half(*before[:2]).alias("parent_a"), _half(*before[2:]).alias("parent_b"))


def end_digests(members: DataFrame) -> DataFrame:
    """``(a, b, depth, ends_sha256)`` of ``(conv, a, b, depth)``: SHA-256 over the ids in order, joined by commas.

    A hash runs over a list in order.  Ranges of (sequence, id) are joined to chunks of text where they
    lie, and a list's chunks stream through one task, one in memory at a time.
    """
    rows = members.repartitionByRange(*_NODE, "conv").sortWithinPartitions(*_NODE, "conv")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        node, held, size = None, [], 0

        def chunk():
            return pa.record_batch([pa.array([x], t) for x, t in zip((*node, part, number, ",".join(held)),
                                                                     (pa.int64(),) * 3 + (pa.int32(), pa.int64(), pa.string()))],
                                   names=[*_NODE, "part", "chunk", "ids"])

        for batch in batches:
            for *of, conv in zip(*[batch.column(c).to_pylist() for c in (*_NODE, "conv")]):
                if held and (of != node or size >= CHUNK_BYTES):
                    yield chunk()
                    number, held, size = number + 1, [], 0
                node = of
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield chunk()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            done = []
            for *of, ids in zip(*[batch.column(c).to_pylist() for c in (*_NODE, "ids")]):
                if of == node:
                    sha.update(b",")
                elif node is not None:
                    done.append((*node, sha.hexdigest()))
                if of != node:
                    node, sha = of, hashlib.sha256()
                sha.update(ids.encode())
            yield table(done)
        if node is not None:
            yield table([(*node, sha.hexdigest())])

    def table(rows):
        columns = list(zip(*rows)) or [()] * 4
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(),) * 3 + (pa.string(),))], names=[*_NODE, "ends_sha256"])

    cut = rows.mapInArrow(chunks, "a long, b long, depth long, part int, chunk long, ids string")
    return (cut.repartition(*_NODE).sortWithinPartitions(*_NODE, "part", "chunk")
            .mapInArrow(digests, "a long, b long, depth long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie over ``turns`` (conv, place, turn, chars), for the conversations ``convs`` (conv).

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.
    ``conv_id`` is the smallest member, so (conv_id, depth) tells nodes apart; the root has depth 0.
    Without conversations there are no nodes.
    """
    hashed = materialize(with_prefix_sums(turns), "prefix-sums")
    last = hashed.groupBy("conv").agg(F.max(F.struct("depth", "a", "b")).alias("last")).select("conv", "last.*")
    zero = F.lit(0).cast("long")
    ends = convs.join(last, "conv", "left").select("conv", *[F.coalesce(c, zero).alias(c) for c in _NODE])
    ends = materialize(ends, "ends")
    whole = ends.groupBy(*_NODE).agg(F.min("conv").alias("seq"), F.count(F.lit(1)).alias("weight"))
    whole = materialize(whole.join(end_digests(ends), _NODE), "sequences")

    roots = whole.select("seq", zero.alias("depth"), zero.alias("chars"), *[zero.alias(c) for c in ("a", "b", "parent_a", "parent_b")])
    named = hashed.withColumnRenamed("conv", "seq")
    lengths = whole.select("seq", F.col("depth").alias("length"))
    prefixes = materialize(named.join(lengths, "seq").drop("length").unionByName(roots), "prefixes")
    proper = prefixes.join(lengths, "seq").filter("depth < length").select(*_NODE).distinct()
    leaves = whole.join(proper, _NODE, "left_anti").select("seq", F.lit(1).cast("long").alias("leaf"))
    facts = materialize(whole.select("seq", "weight").join(leaves, "seq", "left").select("seq", "weight", F.coalesce("leaf", zero).alias("leaf")), "leaves")

    nodes = prefixes.join(facts, "seq").groupBy(*_NODE).agg(
        F.min("seq").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        F.max("chars").alias("chars"), F.max("parent_a").alias("parent_a"), F.max("parent_b").alias("parent_b"))
    nodes = materialize(nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("chars")), "nodes")

    credited = prefixes.select("seq", *_NODE).join(nodes.select(F.col("conv_id").alias("seq"), "depth", "own"), ["seq", "depth"], "left")
    credited = materialize(credited.withColumn("own", F.coalesce("own", zero)), "credited")
    deeper = running_sums(credited, ["seq"], [F.col("depth").desc()], {"deeper": "own"})
    saved = deeper.groupBy(*_NODE).agg(F.sum(F.col("deeper") + F.col("own")).alias("saved_tokens"))

    # all first turns are children of the root, which is told apart instead of joined
    up = {"parent_a": F.col("a"), "parent_b": F.col("b"), "parent_depth": F.col("depth")}
    children = nodes.filter("depth > 0").groupBy("parent_a", "parent_b", (F.col("depth") - 1).alias("up")).agg(F.count(F.lit(1)).alias("n_children"))
    children = children.select(F.col("parent_a").alias("a"), F.col("parent_b").alias("b"), F.col("up").alias("depth"), "n_children")
    root = nodes.filter("depth = 0").select("conv_id").scalar()
    parents = nodes.filter("depth > 0").select(*[v.alias(k) for k, v in up.items()], F.col("conv_id").alias("parent_conv_id"))
    linked = (nodes.filter("depth > 1").withColumn("parent_depth", F.col("depth") - 1)
              .join(parents, ["parent_a", "parent_b", "parent_depth"]).drop("parent_depth"))
    high = nodes.filter("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, root))
    linked = linked.unionByName(high)
    of_ends = whole.select(*_NODE, "ends_sha256")
    return (linked.join(children, _NODE, "left").join(saved, _NODE).join(of_ends, _NODE, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """``prefix_trie`` of the rebuilt ``(conv_id, turn, role, text)`` rows.

    Turns go by ``turn`` (null first), then role and digest; null role and text are empty; repeated rows
    are turns of their own.  Rows without a conv_id belong to no conversation and are left out.  Other
    columns aren't read; an empty table gives no rows.
    """
    return prefix_trie(*rebuild(read_turns(conversations), group, most))
