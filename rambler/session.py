"""Session helpers: a tuned local session for tests/bench and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Shared defaults. AQE stays on so skewed joins are split and small shuffles coalesced.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE size cached plans' partitions too (otherwise a cache keeps the session default)
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "rambler",
                  driver_memory: str = "16g", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (not used on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**_DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster the directory must be a shared folder named by
    ``spark.checkpoint.dir`` (set by whoever launches the job); it is read
    from the session and never invented.  Only a local master without a
    setting gets a scratch folder, which is what tests need.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder "
                           "(HDFS/S3/ABFS) so walk steps can be checkpointed reliably")
    path = tempfile.mkdtemp(prefix="rambler-ckpt-", dir=os.environ.get("RAMBLER_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Let the session send Python workers batches of at most ``most`` bytes (a smaller bound stays).

    Spark's own bounds are 10,000 rows and 64 MB: a task's whole part of a table of texts, held by the
    executor and the worker several times over.  The bound holds for plans made from now on; what
    functions over batches return doesn't depend on it.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < held <= most:
        spark.conf.set(key, str(most))


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the session's (shared, reliable) checkpoint directory."""
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/rambler-{tag}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_released(spark: SparkSession):
    """Writes made inside delete their shuffle files when they end.

    Otherwise these stay on the executors' disks until the driver's JVM happens to collect the plan, and a
    loop of written tables piles them up.  A written table needs none of them again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_scratch(df, tag: str, partition_by: list[str] = ()):
    """Write ``df`` as a Parquet table under the checkpoint directory: ``(the table read back, its path)``.

    The schema is known, so reading back needs no job to infer it (and an empty table keeps it).
    """
    path = scratch_path(df.sparkSession, tag)
    with shuffles_released(df.sparkSession):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def delete_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table that ``write_scratch`` or ``scratch_path`` made, and nothing else."""
    if not path.startswith(f"{ensure_checkpoint_dir(spark).rstrip('/')}/rambler-"):
        raise ValueError(f"{path} is no scratch table of this session")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def is_whole(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end at ``path``: committers leave ``_SUCCESS`` last."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def materialize(df, tag: str):
    """Write ``df`` as a Parquet table under the checkpoint directory and read it back.

    One execution of the plan (``Dataset.checkpoint`` runs it twice unless cached), a cut
    lineage, and a copy that survives executor loss.
    """
    return write_scratch(df, tag)[0]


def reliable_checkpoint(df):
    """``Dataset.checkpoint`` (reliable, eager); keeps partitioning and in-partition order.

    Not cached first: a cached plan keeps the session's shuffle partition count unless
    ``canChangeCachedPlanOutputPartitioning`` is on, while the adaptive plan executed
    here is finalized once (shuffles run once, partitions coalesced) and shared by the
    count and the checkpoint write.
    """
    return df.checkpoint(eager=True)
