"""op 12 against a brute-force trie."""

import hashlib
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from rambler.llm.prefix_trie import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, conv long, depth int, a string, seq long"


def rebuilt(rows, group=100, most=6):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[conv].append((turn is not None, turn or 0, role, digest, text))
    convs = {c: [(r[2], r[4]) for r in sorted(turns)] for c, turns in convs.items()}
    h = {c: zlib.crc32(str(c).encode()) % most for c in convs}
    return {c: convs.get(c - c % group, [])[: h[c]] + turns[h[c] :] for c, turns in convs.items()}


def by_hand(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[c] for c in children[node])
    for node, who in members.items():
        ends = sorted(c for c in who if len(convs[c]) == len(node))
        yield repr((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children[node]), leaves[node], saved[node],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))


def check(spark, rows):
    table = spark.createDataFrame([(*r, 9, 9, "x", 9) for r in rows], SCHEMA)
    found = conversation_trie(table)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(repr(tuple(r)) for r in found.collect()) == sorted(by_hand(rows))


def test_trie_against_brute_force(spark):
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(205, 240), 1000]:       # 200 is absent
        for t in range(c * 7 % 11):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"text {t} {c % 3 if t > 4 else 0}" * (1 + t % 3)))
    rows += [(2000 + i, t, "user", "the same") for i in range(50) for t in range(3)]      # copies, and prefixes of one another
    rows += [(2100 + i, t, "user", "the same") for i in range(30) for t in range(i)]
    check(spark, rows)


def test_odd_conversations(spark):
    rows = [(1, 0, None, None), (1, None, "user", "first"), (1, 0, None, None), (1, 0, "user", ""), (1, 0, "u", "ser"), (None, 0, "user", "nobody's"),
            (300, 5, "user", "x" * 200_000), (300, 5, "user", "é漢字"), (301, 0, "assistant", "x" * 200_000), (302, 0, "", "user:x"), (99, 0, "user", "only")]
    check(spark, rows)
    check(spark, [(5, 0, "user", "hidden")])      # left without turns where h is above 0
    check(spark, [(c, 0, "user", "hidden") for c in range(1, 40)])
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_long_conversation_and_many_members(spark):
    long = spark.range(3000).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), (F.col("id") % 5).cast("string").alias("text"))
    many = spark.range(400_000, 420_000).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("hello").alias("text"))
    found = {(r.conv_id, r.depth): r for r in conversation_trie(long.unionByName(many).repartition(6)).collect()}
    kept = 3000 - zlib.crc32(b"7") % 6
    assert found[7, kept].n_leaves == 1 and found[7, 1].n_convs == 1 and found[7, 0].n_convs == 20_001
    ends = ",".join(str(c) for c in range(400_000, 420_000))
    node = found[400_000, 1]
    assert node.n_convs == 20_000 and node.saved_tokens == 19_999 * 5
    assert node.ends_sha256 == hashlib.sha256(ends.encode()).hexdigest()
