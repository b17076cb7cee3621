"""The modelled system's second-order draw (W3) without reading whole neighbour lists.

With q fixed, all of a vertex's edges weigh w/q but for two kinds: back to ``prev`` (w/p), and to a
neighbour of ``prev`` (w).  Running sums of w/q are therefore built once per graph, and a step only needs
the corrections: the edge back, and the common neighbours, found by listing the smaller of the two lists
and looking up the other.  Sorted by neighbour, the corrections cut the running sum into pieces that differ
from the built one by a constant each.  The piece that holds the draw is found among the corrections of a
walker, and the edge inside a piece by the bucketed index of the built sums.

Sums are whole units, so they equal those of a full scan to the unit, and the pick is the same: the first
neighbour whose running share reaches the draw.  A step costs min(degree of prev, degree of cur) per walker.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from rambler.functions.draws import draw
from rambler.functions.weights import weight_units
from rambler.operators.ordering import segmented_cumsum
from rambler.operators.walk_index import bucket_of, explode_buckets
from rambler.session import materialize


@dataclass
class PrefixIndex:
    edges: DataFrame      # (src, dst, w, cb, ca, nd, td): running units of w/q; nd, td: degree and total of dst
    index: DataFrame      # (src, bucket, dst, cb, ca, first, nd, td)
    vertices: DataFrame   # (v, n, tq): degree, total of w/q
    exponent: int
    p: float
    q: float

    def unpersist(self) -> None:
        for df in (self.edges, self.index):
            df.unpersist()


def build_prefix_index(edges: DataFrame, p: float, q: float, exponent: int, partitions: int) -> PrefixIndex:
    """From merged, oriented ``(src, dst, w)``; written or cached once, hash-partitioned for the steps' joins."""
    units = materialize(edges.withColumn("uq", weight_units(F.col("w") / F.lit(float(q)), exponent)), "units")
    cum = materialize(segmented_cumsum(units, "src", ["dst"], "uq", before="cb", after="ca", partitions=partitions, written=True), "prefix-sums")
    stats = cum.groupBy(F.col("src").alias("v")).agg(F.count(F.lit(1)).alias("n"), F.max("ca").alias("tq"), F.min("dst").alias("first_dst"))
    stats = materialize(stats, "vertices")
    to = stats.select(F.col("v").alias("dst"), F.col("n").alias("nd"), F.col("tq").alias("td"))
    zero = F.lit(0).cast("bigint")
    full = (cum.join(to, "dst", "left").select("src", "dst", "w", "cb", "ca", F.coalesce("nd", zero).alias("nd"), F.coalesce("td", zero).alias("td")))
    own = full.join(stats.withColumnRenamed("v", "src"), "src")
    own = own.withColumns({"lo": bucket_of(F.col("cb"), F.col("n"), F.col("tq")), "hi": bucket_of(F.col("ca"), F.col("n"), F.col("tq"))})
    index = explode_buckets(own).select("src", "bucket", "dst", "cb", "ca", (F.col("dst") == F.col("first_dst")).alias("first"), "nd", "td")
    found = PrefixIndex(full.repartition(partitions, "src", "dst"), index.repartition(partitions, "src", "bucket"), stats.drop("first_dst"), exponent, p, q)
    for df in (found.edges, found.index):
        df.persist(StorageLevel.MEMORY_AND_DISK).count()
    return found


def _least_reaching(thr: Column, exponent: int) -> Column:
    """The smallest whole number a with a / 10 ** exponent >= thr, as doubles compare."""
    scale = F.lit(10.0**exponent)

    def search(t):
        near = F.ceil(t * scale).cast("bigint")
        # the product is off by a few units in the last place at most: 1024 each below 2 ** 63
        ends = F.struct((near - 4096).alias("lo"), (near + 4096).alias("hi"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(13)), ends, lambda s, _: halve(s, t), lambda s: s["hi"])

    def halve(s, t):
        mid = s["lo"] + F.shiftright(s["hi"] - s["lo"], 1)
        reached = mid / scale >= t
        return F.struct(F.when(reached, s["lo"]).otherwise(mid).alias("lo"), F.when(reached, mid).otherwise(s["hi"]).alias("hi"))

    return F.transform(F.array(thr), search)[0]     # a lambda's variable is evaluated once


def corrections(act: DataFrame, keys: DataFrame, ix: PrefixIndex) -> DataFrame | None:
    """``(rnd, v0, dst, cb, ca, by, nd, td)``: the edges of cur that don't weigh w/q, and by how many units more they weigh."""
    k = keys.select(F.col("src").alias("ks"), F.col("dst").alias("kd"))
    e = ix.edges
    parts = []
    units = lambda divisor: weight_units(F.col("w") / F.lit(float(divisor)), ix.exponent) - (F.col("ca") - F.col("cb"))
    row = lambda df, divisor: df.select("rnd", "v0", F.col("dst").alias("dst"), "cb", "ca", units(divisor).alias("by"), "nd", "td")
    if ix.p != ix.q:
        back = act.join(e, (F.col("cur") == F.col("src")) & (F.col("prev") == F.col("dst")))
        parts.append(row(back, ix.p))
    if ix.q != 1.0:
        by_prev = act.filter("pn <= n").join(k, F.col("prev") == F.col("ks")).join(e, (F.col("cur") == F.col("src")) & (F.col("kd") == F.col("dst")))
        by_cur = act.filter("pn > n").join(e, F.col("cur") == F.col("src")).join(k, (F.col("prev") == F.col("ks")) & (F.col("kd") == F.col("dst")))
        parts += [row(found.filter(F.col("dst") != F.col("prev")), 1.0) for found in (by_prev, by_cur)]
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def prefix_step(walkers: DataFrame, keys: DataFrame, ix: PrefixIndex, walk_length: int, seed: int, u: float | None = None) -> DataFrame:
    """The next state of walkers ``(rnd, v0, step, prev, cur, n, pn, tq)``: n, pn the degrees of cur and prev, tq the total of cur.

    ``u`` replaces the draw (tests use a constant, as the modelled system's do).  A walker's corrections
    are one array, of at most min(n, pn) + 1 entries.
    """
    act = walkers.filter((F.col("n") > 0) & (F.col("step") <= walk_length)).select("rnd", "v0", "step", "prev", "cur", "n", "pn", "tq")
    kind = "array<struct<dst:bigint,cb:bigint,ca:bigint,by:bigint,nd:bigint,td:bigint>>"
    found = corrections(act, keys, ix)
    if found is None:
        drawn = act.withColumn("c", F.array().cast(kind))
    else:
        lists = found.groupBy("rnd", "v0").agg(F.array_sort(F.collect_list(F.struct("dst", "cb", "ca", "by", "nd", "td"))).alias("c"))
        drawn = act.join(lists, ["rnd", "v0"], "left").withColumn("c", F.coalesce(F.col("c").cast(kind), F.array().cast(kind)))
    total = F.col("tq") + F.aggregate("c", F.lit(0).cast("bigint"), lambda a, x: a + x["by"])
    ud = F.lit(float(u)) if u is not None else draw(F.lit(seed), "rnd", "v0", F.col("step") + 1, F.lit(0), F.lit(1))
    reach = _least_reaching(ud * (total / F.lit(10.0**ix.exponent)), ix.exponent)
    none = F.lit(None).cast("bigint")
    start = F.struct(F.lit(0).cast("bigint").alias("off"), F.lit(False).alias("done"), none.alias("need"), none.alias("dst"), none.alias("nd"), none.alias("td"),
                     reach.alias("a"))

    def advance(s, x):
        before, after = x["cb"] + s["off"] >= s["a"], x["ca"] + s["off"] + x["by"] >= s["a"]
        here = ~before & after
        moved = F.struct((s["off"] + F.when(before | after, 0).otherwise(x["by"])).alias("off"), (before | after).alias("done"),
                         F.when(before, s["a"] - s["off"]).alias("need"), *[F.when(here, x[c]).alias(c) for c in ("dst", "nd", "td")], s["a"].alias("a"))
        return F.when(s["done"], s).otherwise(moved)

    # the fold is evaluated once for all of its fields
    folded = drawn.select("rnd", "v0", "step", "cur", "n", "tq", F.inline(F.array(F.aggregate("c", start, advance))))
    placed = materialize(folded.withColumn("need", F.when(F.col("done"), F.col("need")).otherwise(F.col("a") - F.col("off"))).drop("off", "done", "a"), "pieces")
    i = ix.index
    inside = placed.filter("dst IS NULL").drop("dst", "nd", "td").withColumn("b", F.greatest(bucket_of(F.col("need"), F.col("n"), F.col("tq")), F.lit(0)))
    inside = inside.join(i, (F.col("cur") == i["src"]) & (F.col("b") == i["bucket"]))
    inside = inside.filter(((i["cb"] < F.col("need")) & (F.col("need") <= i["ca"])) | ((F.col("need") <= 0) & i["first"]))
    columns = ["rnd", "v0", "step", "cur", "n", "dst", "nd", "td"]
    picked = placed.filter("dst IS NOT NULL").select(*columns).unionByName(inside.select(*columns))
    return picked.select("rnd", "v0", (F.col("step") + 1).alias("step"), F.col("cur").alias("prev"), F.col("dst").alias("cur"),
                         F.col("nd").alias("n"), F.col("n").alias("pn"), F.col("td").alias("tq"), F.lit(0).cast("bigint").alias("tb"))
