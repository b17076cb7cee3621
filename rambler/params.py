"""Job parameters (frozen dataclasses replace the command-line parser)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class GraphParams:
    """How the graph is built from a contact log and a user snapshot."""

    contact_start: str = ""          # inclusive start of the contact-log ``dt`` range
    contact_end: str = ""            # inclusive end of the range
    user_date: str = ""              # the ``dt`` of the user snapshot
    region_ids: tuple[str, ...] | None = None   # substring filter on ``region_ids``; None = all
    min_out_degree: int = 1          # out-degree range [min, max)
    max_out_degree: int = 1000
    min_in_degree: int = 1           # in-degree range [min, max)
    max_in_degree: int = 1000


@dataclass(frozen=True)
class WalkParams:
    """Second-order (node2vec) walk settings."""

    walk_length: int = 80            # steps after the first one; a full path has walk_length + 2 vertices
    num_walks: int = 10              # walks (rounds) per start vertex
    p: float = 1.0                   # return parameter
    q: float = 1.0                   # in-out parameter
    directed: bool = False
    seed: int = 0                    # keyed draws: md5(seed|round|start|step[|dst])
    sampler: str = "rejection"       # "rejection" (default), "cdf" (reference draws) or "stitched" (p = q = 1, few turns)
    trials: int | None = None        # rejection trials per walker per turn; None = by p and q
    partitions: int | None = None    # index and walker partitions; None = sized from the graph


@dataclass(frozen=True)
class Word2VecParams:
    """Skip-gram settings: Spark ML's ``Word2Vec``, or training by buckets of words."""

    dim: int = 128
    window: int = 10
    lr: float = 0.025
    iterations: int = 10
    partitions: int | None = None    # training partitions; None = the session's parallelism
    min_count: int = 0
    seed: int = 42
    max_sentence_length: int | None = None   # longer walks would be cut; None = the longest walk
    max_vocabulary_bytes: int = 4 << 30      # Spark ML's driver holds vocabulary × dim floats; more goes to buckets
    trainer: str = "auto"            # "driver" (Spark ML), "buckets", or by the vocabulary's size and the driver's room
    negatives: int = 5               # buckets: negative contexts per pair
    bucket_lr: float = 0.1          # buckets: step size (scaled by past gradients)
    bucket_bytes: int = 1 << 30      # buckets: size of one; a task holds two
    buckets: int | None = None       # buckets: their number; None = by ``bucket_bytes``


@dataclass(frozen=True)
class JobParams:
    """Everything one job run needs."""

    cmd: str = "node2vec"            # node2vec | walk | embedding
    graph: GraphParams = field(default_factory=GraphParams)
    walk: WalkParams = field(default_factory=WalkParams)
    w2v: Word2VecParams = field(default_factory=Word2VecParams)
    output: str = ""                 # root folder of the outputs
    input: str = ""                  # edge list or walk series, depending on cmd
    weighted: bool = True            # weight column present in the edge list
    partitioned: bool = False        # partition column present in the edge list
    edge_parts: int = 200            # parts that are drawn for edges without one
    id_map: str = ""                 # a saved id map that names the vectors (embedding)
    single_output: bool = False      # one output file, else ``output_partitions`` files
    output_partitions: int = 200
    resume: bool = False             # keep a walk's turns under ``output`` until its paths are written, and go on from them
