"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rambler.session import local_session  # noqa: E402
from rambler.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "phone_pairs",              # contact log ⋈ users, normalisation
    "dense_ids",                # degree filters + range-partitioned ids
    "indexed_pairs",
    "graph_stats",              # events graph build
    "adjacency",
    "weighted_sample",          # W1 (modelled draw semantics)
    "random_walk_weighted",     # node2vec walk, rejection sampler, events graph
    "random_walk_undirected",   # node2vec walk, rejection sampler, contact graph
    "random_walk_directed",     # directed with sinks, 2 rounds
    "random_walk_cdf",          # node2vec walk, scanning sampler
    "topn_similar",
    "pair_similarity",
    "node_embedding_size",      # walks + Word2Vec
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")))
    # Warm-up outside the timings: JVM, and the Python workers the Arrow scans use.
    spark.range(1).count()
    spark.range(64).repartition(8).mapInPandas(lambda it: it, "id long").count()
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        spark.catalog.clearCache()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
