"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. Memory stays with the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# A shuffle partition of this many bytes fits a task's share of an executor's memory.
SHUFFLE_BYTES = 128 << 20
SHUFFLE = "spark.sql.shuffle.partitions"
FIRST_SHUFFLE = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_local_scratch: list[tempfile.TemporaryDirectory] = []


def build_session(app_name: str = "jobmetrics", **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built.

    Where nobody has chosen a number of shuffle partitions, start with four per core of the
    cluster: adaptive execution merges partitions that are too small, but cannot cut an
    evenly filled one that is too large.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    default = 200
    if spark.conf.get(SHUFFLE) == str(default) and spark.conf.get(FIRST_SHUFFLE, None) is None:
        per_core = 4 * spark.sparkContext.defaultParallelism
        spark.conf.set(FIRST_SHUFFLE, str(max(default, per_core)))
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Start shuffles with a partition per ``SHUFFLE_BYTES`` of input, or more if there are more.

    Adaptive execution merges small partitions but cannot cut evenly filled ones. Returns the
    number of partitions shuffles start with.
    """
    known = int(spark.conf.get(FIRST_SHUFFLE, None) or spark.conf.get(SHUFFLE))
    wanted = max(known, -(-input_bytes // SHUFFLE_BYTES))
    if wanted > known:
        spark.conf.set(FIRST_SHUFFLE, str(wanted))
    return wanted


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Executors on other machines must see what is written there, so a local temporary
    folder is taken only when the setting is absent and the master is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if not _local_scratch:
            _local_scratch.append(tempfile.TemporaryDirectory(prefix="jobmetrics-"))
        base = _local_scratch[0].name
    return f"{base.rstrip('/')}/jobmetrics/{purpose}-{uuid.uuid4().hex}"
