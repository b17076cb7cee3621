"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame operations only.

Every source's documents stand in a seeded order, as one sequence of words that is cut into blocks of
equal size, and the blocks into shards.  The seats to give are the blocks of the whole mix:

1. targets: the weights' shares of all words; no source goes above ``most`` times its size, and what it
   leaves is shared again (the common rate is found from running sums over the sources);
2. a source's votes are its target counted in its own blocks; the highest quotients votes / (2 k - 1)
   win a seat each.  Two divisors bound every source's seats from both sides, so only about three
   quotients a source need to be ranked;
3. a source's seats give whole passes over it, and the rest goes to its shards by highest quotients again;
4. a shard takes its quota of blocks with the smallest seeded digest, on top of the whole passes.  That is
   a digest threshold a shard, which documents meet by (source, shard): blocks are never shuffled.

Seeded digests are md5 texts, so any SQL engine can repeat the choice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rambler.llm.running import running_sums
from rambler.session import materialize


@dataclass(frozen=True)
class Settings:
    """``weights`` repeat over the sources in order of their names, null last."""

    weights: tuple[int, ...] = (1, 2, 3)
    most: int = 3                   # times a document may be taken
    block: int = 32                 # words
    shard: int = 1 << 14            # blocks
    seed: int = 11
    broadcast_rows: int = 100_000   # a table of sources or shards with more rows is joined by shuffling
    broadcast_letters: int = 1 << 24  # and so are sources whose names have more letters


# Fixed value: what a word is made of.
WORD = r"[^\x20\x09-\x0D]+"


def seeded(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def source_targets(sizes: DataFrame, s: Settings) -> DataFrame:
    """``(source, source_size, rank, weight, target)`` of ``(source, source_size)``.

    Ordered by most * size / weight, the sources at their limit come first: a source is among them if
    the rate of the words left to the weights left, once all before it are at their limit, reaches its own.
    """
    ranked = materialize(running_sums(sizes, ["one"], [F.col("source").isNull(), "source"], {"rank": F.lit(1)}), "ranked")
    weight = F.element_at(F.array(*[F.lit(w) for w in s.weights]), (F.col("rank") % len(s.weights) + 1).cast("int")).cast("long")
    ranked = materialize(ranked.withColumn("weight", weight), "weighted")
    total = ranked.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    size, weights = F.lit(total["size"] or 0).cast("long"), F.lit(total["weight"] or 0).cast("long")
    limit = F.col("source_size") * s.most
    exact = lambda c: c.cast("decimal(19,0)")  # noqa: E731  (products of whole numbers that may not fit 64 bits)
    cut = materialize(running_sums(ranked, ["one"], [limit / F.col("weight"), "rank"], {"limits": limit, "weights": "weight"}), "limits")
    words_left, weights_left = size - F.col("limits"), weights - F.col("weights")
    free = cut.filter(exact(limit) * exact(weights_left) > exact(words_left) * exact(F.col("weight")))
    # the first source below its limit tells the rate of all sources from it on
    first = free.agg(F.min_by(F.struct(words_left.alias("words"), weights_left.alias("weights"), F.col("rank")),
                              F.struct(limit / F.col("weight"), "rank")).alias("first")).first()["first"]
    if first is None:
        target = limit.cast("double")
    else:
        below = exact(limit) * exact(F.lit(first["weights"])) > exact(F.lit(first["words"])) * exact(F.col("weight"))
        target = F.when(below, (F.col("weight") * F.lit(first["words"])).cast("double") / F.lit(first["weights"])).otherwise(limit.cast("double"))
    return ranked.select("one", "source", "source_size", "rank", "weight", target.alias("target"))


def _seats(votes: Column, divisor: float | Column) -> Column:
    """Seats that a divisor gives: those numbered k with votes / (k - 1/2) >= divisor."""
    return F.floor(votes / divisor + 0.5).cast("long")


def _won(parties: DataFrame, key: list[str], name: list[str], seats: Column, tie: Column) -> DataFrame:
    """``parties`` (key, name, votes, low, high) with the seats won, by highest quotients.

    Everyone has ``low`` seats for certain and ``high`` at most; the quotients between are ranked for
    the rest of ``seats`` (a column of the key).
    """
    sure = parties.groupBy(*key).agg(F.sum("low").alias("sure"))
    rivals = parties.filter("high > low").withColumn("k", F.explode(F.sequence(F.col("low") + 1, F.col("high"))))
    quotient = F.col("votes") / (2 * F.col("k") - 1)
    rivals = materialize(rivals.select(*key, *name, quotient.alias("quotient"), tie.alias("tie"), "k", seats.alias("seats")), "quotients")
    placed = running_sums(rivals, key, [F.col("quotient").desc(), "tie", "k"], {"place": F.lit(1)})
    more = (placed.join(sure, key).filter(F.col("place") < F.col("seats") - F.col("sure"))
            .groupBy(*key, *name).agg(F.count(F.lit(1)).alias("more")))
    return parties.join(more, [*key, *name], "left").withColumn("won", F.col("low") + F.coalesce("more", F.lit(0)))


def apportion_sources(targets: DataFrame, s: Settings) -> DataFrame:
    """``targets`` with ``n_blocks`` and ``won``, the source's seats: at most ``most`` a block."""
    blocks = F.greatest(F.round(F.col("source_size") / s.block).cast("long"), F.lit(1).cast("long"))
    # in thousandths of a block, so that the sum doesn't depend on the order
    votes = F.round(F.col("target") * F.col("n_blocks") / F.col("source_size") * 1000).cast("long")
    parties = materialize(targets.filter("source_size > 0").withColumn("n_blocks", blocks).withColumn("votes", votes), "votes")
    all_ = parties.agg(F.sum("votes").alias("votes"), F.count(F.lit(1)).alias("n"), F.sum("n_blocks").alias("blocks")).first()
    if not all_["n"]:
        return parties.withColumn("won", F.lit(0).cast("long"))
    seats = min((all_["votes"] + 500) // 1000, all_["blocks"] * s.most)
    limit = F.col("n_blocks") * s.most
    low, slack = F.lit(0).cast("long"), all_["n"]
    if seats > slack:
        low = F.least(_seats(F.col("votes"), all_["votes"] / (seats - slack)), limit)
    while True:     # limits can leave seats to others: until those in question are enough
        high = F.least(_seats(F.col("votes"), all_["votes"] / (seats + slack)), limit)
        if parties.agg(F.sum(high)).first()[0] >= seats or slack > 4 * seats + all_["n"] * 1000:
            break
        slack *= 4
    parties = parties.withColumns({"low": low, "high": F.greatest(high, low)})
    return _won(parties, ["one"], ["rank"], F.lit(seats).cast("long"), F.col("rank")).drop("votes", "low", "high", "more")


def shard_quotas(sources: DataFrame, s: Settings) -> DataFrame:
    """``(rank, shard, n_blocks, shard_size, passes, quota, threshold)`` of the sources with seats.

    Every block is taken ``passes`` times, and those with a digest up to ``threshold`` (``quota`` of
    them) once more.
    """
    n = F.col("n_blocks")
    count = F.ceil(n / s.shard).cast("long")
    shards = (sources.select("rank", "source_size", "n_blocks", F.floor(F.col("won") / n).alias("passes"),
                             (F.col("won") % n).alias("rest"), count.alias("n_shards"))
              .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_shards") - 1) / 1024))))
              .withColumn("shard", F.explode(F.sequence(F.col("run") * 1024, F.least(F.col("n_shards"), F.col("run") * 1024 + 1024) - 1))).drop("run"))
    votes = F.least(n - F.col("shard") * s.shard, F.lit(s.shard)).cast("long")
    shards = shards.withColumn("votes", votes)
    sure = F.when(F.col("rest") > F.col("n_shards"), _seats(F.col("votes"), n / (F.col("rest") - F.col("n_shards")))).otherwise(0)
    shards = shards.withColumns({"low": F.least(sure, "votes").cast("long"),
                                 "high": F.least(_seats(F.col("votes"), n / (F.col("rest") + F.col("n_shards"))), "votes").cast("long")})
    shards = _won(materialize(shards.withColumn("high", F.greatest("low", "high")), "shards"), ["rank"], ["shard"], F.col("rest"),
                  seeded(s.seed, F.lit("shard"), F.col("rank"), F.col("shard")))
    # a shard is a small row but 2 ** 14 digests: as many tasks as can run
    shards = shards.repartition(4 * shards.sparkSession.sparkContext.defaultParallelism, "rank", "shard")
    own = F.sequence(F.col("shard") * s.shard, F.col("shard") * s.shard + F.col("votes") - 1)
    digests = F.array_sort(F.transform(own, lambda j: seeded(s.seed, F.lit("block"), F.col("rank"), j)))
    # a shard's last block goes on to the source's end
    return shards.select("rank", "shard", "n_blocks", "source_size", "passes", F.col("won").alias("quota"),
                         F.when(F.col("won") > 0, F.element_at(digests, F.col("won").cast("int"))).alias("threshold"))


def _with(rows: DataFrame, small: DataFrame, on: list[str], s: Settings, letters: Column | None = None) -> DataFrame:
    """``rows`` with the columns of ``small`` (unique in ``on``), broadcast if it is small enough.

    Otherwise ``small`` is repeated 16 times and rows are dealt over the copies, so that a hot key has 16 tasks at least.
    """
    size = small.agg(F.count(F.lit(1)).alias("n"), F.sum(F.lit(0) if letters is None else F.coalesce(letters, F.lit(0))).alias("letters")).first()
    if size["n"] <= s.broadcast_rows and (size["letters"] or 0) <= s.broadcast_letters:
        return rows.join(F.broadcast(small), on)
    copies = small.withColumn("_copy", F.explode(F.array(*[F.lit(i) for i in range(16)])))
    return rows.withColumn("_copy", F.pmod("_row", F.lit(16)).cast("int")).join(copies, [*on, "_copy"]).drop("_copy")


def mix(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, passes, spans)``, one row for each row of ``docs``.

    The mix takes the document ``passes`` times whole, and the words of ``spans`` (from, to; from 0, end
    exclusive) once more; ``taken`` counts the words.  A null text has no words; a null source is a source,
    ordered last; a document without words, or a source without any, takes nothing.  Rows that repeat an id
    and size are interchangeable: which of them takes what may differ between runs, the rows returned don't.
    A null id is an id like others.  Other columns aren't read; an empty table gives no rows.
    """
    s = settings
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = materialize(docs.select(F.col(id_col).alias("doc"), F.col(source_col).alias("source"), size.alias("size"))
                       .withColumn("_row", F.monotonically_increasing_id()), "sizes")
    sizes = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1)), "sources")
    targets = materialize(source_targets(sizes, s), "targets")
    named = F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))     # a key without null
    rows = _with(rows.withColumn("_name", named), targets.withColumn("_name", named).drop("source", "one", "weight"), ["_name"], s,
                 F.length("_name")).drop("_name")

    wordy = materialize(rows.filter("size > 0").withColumn("at", seeded(s.seed, F.lit("doc"), F.coalesce(F.col("doc").cast("string"), F.lit("null")), F.col("size"))), "wordy")
    placed = running_sums(wordy, ["rank"], ["at", "doc", "size", "_row"], {"begin": "size"})
    quotas = materialize(shard_quotas(apportion_sources(targets, s), s), "quotas")
    # a document's blocks; the last block of a source has what is left
    n = F.greatest(F.round(F.col("source_size") / s.block).cast("long"), F.lit(1).cast("long"))
    placed = placed.withColumns({"first": F.least(F.floor(F.col("begin") / s.block), n - 1),
                                 "last": F.least(F.floor((F.col("begin") + F.col("size") - 1) / s.block), n - 1)})
    cut = placed.withColumn("shard", F.explode(F.sequence(F.floor(F.col("first") / s.shard), F.floor(F.col("last") / s.shard))))
    cut = _with(cut, quotas.drop("source_size"), ["rank", "shard"], s)
    own = F.sequence(F.greatest("first", F.col("shard") * s.shard), F.least("last", F.col("shard") * s.shard + (s.shard - 1)))
    chosen = F.filter(own, lambda j: seeded(s.seed, F.lit("block"), F.col("rank"), j) <= F.col("threshold"))
    end = F.col("begin") + F.col("size")
    span = lambda j: F.struct((F.greatest(j * s.block, F.col("begin")) - F.col("begin")).alias("from"),
                              (F.least(F.when(j == n - 1, end).otherwise((j + 1) * s.block), end) - F.col("begin")).alias("to"))
    cut = cut.withColumn("spans", F.coalesce(F.transform(chosen, span), F.array().cast("array<struct<from:bigint,to:bigint>>")))
    cut = cut.withColumn("extra", F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["to"] - x["from"]))
    columns = ["doc", "source", "size", "source_size", "target"]
    taken = (cut.groupBy("_row").agg(*[F.first(c).alias(c) for c in [*columns, "passes"]], F.sum("extra").alias("extra"),
                                     F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("shard", "spans"))), lambda x: x["spans"])).alias("spans")))
    nothing = {"passes": F.lit(0).cast("long"), "extra": F.lit(0).cast("long"), "spans": F.array().cast(taken.schema["spans"].dataType)}
    kept = [*columns, *nothing]
    every = taken.select(*kept).unionByName(rows.filter("size = 0").withColumns(nothing).select(*kept))
    return every.select(F.col("doc").alias(id_col), "source", "size", "source_size", "target",
                        (F.col("passes") * F.col("size") + F.col("extra")).alias("taken"), "passes", "spans")


def mixed_text(text: Column, passes: Column, spans: Column) -> Column:
    """What a mix takes of a text: its words once for each pass, then those of the spans; joined by spaces."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    pieces = F.transform(spans, lambda x: F.slice(words, (x["from"] + 1).cast("int"), (x["to"] - x["from"]).cast("int")))
    return F.array_join(F.concat(F.flatten(F.array_repeat(words, passes.cast("int"))), F.flatten(pieces)), " ")
