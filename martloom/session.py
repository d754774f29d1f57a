"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings that matter at scale; each is applied only where the cluster left it unset.
SCALE_SETTINGS = {
    # Re-plan from measured shuffle sizes: coalesce small partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Partitions are merged up to this size, not to one a core however large: keys of a few bytes
    # take some forty times that in the hash tables and sorts of a task.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # Rows go to Python by so many bytes, not by 10,000 however long: a batch of texts is held in the
    # executor, in the worker and, as strings, in the worker again.
    "spark.sql.execution.arrow.maxBytesPerBatch": "2m",
}

PARTITIONS_PER_CORE = 4


def configure(spark: SparkSession) -> SparkSession:
    """Apply the scale settings the session does not set itself."""
    explicit = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in SCALE_SETTINGS.items():
        if key not in explicit:
            spark.conf.set(key, value)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    partitions = "spark.sql.shuffle.partitions"
    if partitions not in explicit and initial not in explicit:
        # Start each exchange with a few partitions per core: on a large cluster the fixed
        # default leaves partitions that no task can hold, and adaptive execution can merge
        # small partitions but not split large ones of an aggregate. Never fewer than configured:
        # under dynamic allocation few cores are there at the start.
        per_core = PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
        configured = int(spark.conf.get(partitions))
        if per_core > configured:
            spark.conf.set(initial, str(per_core))
    return spark


def local_session(cpus: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-JVM session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("martloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Recording the Python call site of every column expression dominates building wide plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates, taken from ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a fresh temporary folder: on a cluster a
    machine-local path would be lost with its machine, so a missing setting is an error there.
    """
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        or spark.sparkContext.getCheckpointDir()
    )
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="martloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{scratch_root(spark).rstrip('/')}/martloom/{name}-{uuid.uuid4().hex}"


def written(df, name: str):
    """Cut lineage: write ``df`` to the shared folder and read it back.

    For a frame that several later jobs read; the files outlive any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
