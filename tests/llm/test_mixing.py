"""op 11 against a brute-force apportionment, and its promises."""

import hashlib
import re
from collections import Counter, defaultdict

from llm_helpers import SF001
from pyspark.sql import functions as F

from rambler.llm.mixing import Settings, apportion_sources, mix, mixed_text, shard_quotas, source_targets
from rambler.llm.running import running_sums
from rambler.session import materialize

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def md5(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def targets_by_rounds(sizes, weights, most):
    """As the task words it: share out, cut to the limit, share the excess again until none is above."""
    rank = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {x: weights[i % len(weights)] for i, x in enumerate(rank)}
    target, excess, free = dict.fromkeys(sizes, 0.0), float(sum(sizes.values())), set(sizes)
    while excess > 1e-9 and free:
        total = sum(weight[x] for x in free)
        for x in free:
            target[x] += excess * weight[x] / total
        over = {x for x in free if target[x] >= most * sizes[x]}
        excess = sum(target[x] - most * sizes[x] for x in over)
        for x in over:
            target[x] = float(most * sizes[x])
        free -= over
    return rank, target


def highest(votes, seats, most):
    """Seat by seat to the highest quotient; ties to the first."""
    won = Counter()
    place = {x: i for i, x in enumerate(votes)}
    for _ in range(min(seats, sum(most.values()))):
        won[max((x for x in votes if won[x] < most[x]), key=lambda x: (votes[x] / (2 * won[x] + 1), -place[x]))] += 1
    return won


def by_hand(rows, s):
    sizes, lists = Counter(), defaultdict(list)
    for doc, text, source in rows:
        n = len(WORDS.findall(text or ""))
        sizes[source] += n
        lists[source].append((md5(s.seed, "doc", "null" if doc is None else doc, n), -1 if doc is None else doc, n, doc))
    rank, target = targets_by_rounds(sizes, s.weights, s.most)
    blocks = {x: max(1, int(sizes[x] / s.block + 0.5)) for x in rank if sizes[x]}
    votes = {x: int(target[x] * n / sizes[x] * 1000 + 0.5) for x, n in blocks.items()}
    won = highest(votes, min((sum(votes.values()) + 500) // 1000, s.most * sum(blocks.values())), {x: s.most * n for x, n in blocks.items()})
    out = []
    for i, x in enumerate(rank):
        taken = set()
        if sizes[x]:
            passes, rest = divmod(won[x], blocks[x])
            shards = {k: min(blocks[x] - k * s.shard, s.shard) for k in range(-(-blocks[x] // s.shard))}
            order = sorted(shards, key=lambda k: md5(s.seed, "shard", i, k))
            quota = highest({k: shards[k] for k in order}, rest, shards)
            for k, n in shards.items():
                own = sorted(range(k * s.shard, k * s.shard + n), key=lambda j: md5(s.seed, "block", i, j))
                taken.update(own[: quota[k]])
        begin = 0
        for _, _, n, doc in sorted(lists[x], key=lambda r: r[:3]):
            extra = sum(min(max(0, b // s.block), blocks[x] - 1) in taken for b in range(begin, begin + n))
            out.append((doc, x, n, sizes[x], round(target[x], 6), passes * n + extra if n else 0))
            begin += n
    return sorted(map(repr, out))


def got(docs, s):
    return sorted(repr((r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.taken)) for r in mix(docs, s).collect())


def test_mix_against_brute_force(spark, docs, odd, none):
    made = [(i, "w " * (i * 37 % 101), f"s{'aabbbcd'[i % 7]}") for i in range(120)] + [(5, "x y z", None), (5, "x y z", None), (None, "q " * 40, None), (7, "", "empty"), (8, None, "empty")]
    made = spark.createDataFrame(made, "doc_id long, text string, source string")
    for d, s in ((docs, Settings()), (made, Settings(block=5, shard=8, weights=(5, 1), most=2)), (odd, Settings(block=3, shard=4, broadcast_rows=0))):
        assert got(d, s) == by_hand([(r.doc_id, r.text, r.source) for r in d.collect()], s)
    assert mix(none).count() == 0
    assert {(r.target, r.taken) for r in mix(spark.createDataFrame([(1, "", "a"), (2, None, None)], made.schema)).collect()} == {(0.0, 0)}


def test_targets_are_met_and_texts_are_what_is_taken(spark, docs):
    s = Settings()
    mixed = mix(docs).join(docs.select("doc_id", "text"), "doc_id").withColumn("out", mixed_text(F.col("text"), F.col("passes"), F.col("spans")))
    by_source = defaultdict(int)
    for r in mixed.collect():
        words, out = WORDS.findall(r.text or ""), WORDS.findall(r.out)
        assert len(out) == r.taken <= s.most * r.size and len(words) == r.size
        assert Counter(out) == Counter(words * r.passes + [w for x in r.spans for w in words[x["from"] : x["to"]]])
        by_source[r.source, r.target] += r.taken
    assert all(abs(taken - target) <= 2 * s.block for (_, target), taken in by_source.items())


def test_reruns_agree_whatever_the_partitions(spark, docs):
    twice = docs.unionByName(docs.limit(40))
    want = got(twice, Settings())
    assert got(twice.repartition(7), Settings()) == want


def test_thousands_of_sources_and_shards(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3000).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"))
    s = Settings(block=4, shard=2)
    sizes = materialize(rows.groupBy("source").agg(F.sum(F.length("text") / 2).cast("long").alias("source_size")).withColumn("one", F.lit(1)), "sizes")
    won = apportion_sources(materialize(source_targets(sizes, s), "targets"), s)
    parties = {r["rank"]: r for r in won.collect()}
    votes = {k: round(r.target * r.n_blocks / r.source_size * 1000) for k, r in sorted(parties.items())}
    seats = (sum(votes.values()) + 500) // 1000
    # the smallest quotient that won is at least the largest that lost
    least = min(votes[k] / (2 * r.won - 1) for k, r in parties.items() if r.won)
    most = max(votes[k] / (2 * r.won + 1) for k, r in parties.items() if r.won < 3 * r.n_blocks)
    assert least >= most and sum(r.won for r in parties.values()) == seats
    quotas = shard_quotas(materialize(won, "won"), s).groupBy("rank").agg(F.sum("quota").alias("q"), F.max("passes").alias("p"), F.max("n_blocks").alias("n"))
    assert all(r.p * r.n + r.q == parties[r["rank"]].won for r in quotas.collect())


def test_running_sums_of_a_hot_key(spark):
    rows = materialize(spark.range(20_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 50).alias("key"), (F.col("id") * 7919 % 20_011).alias("at"), (F.col("id") % 9).alias("v")).repartition(5), "rows")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = running_sums(rows, ["key"], ["at"], {"before": "v", "place": F.lit(1)}).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sums, places = Counter(), Counter()
    for r in sorted(found, key=lambda r: (r.key, r.at)):
        assert (r.before, r.place) == (sums[r.key], places[r.key])
        sums[r.key] += r.v
        places[r.key] += 1


def test_no_python_in_the_mix(spark):
    from rambler.llm.queries import op11_mixing
    plan = op11_mixing(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Cartesian" not in plan and "NestedLoop" not in plan
