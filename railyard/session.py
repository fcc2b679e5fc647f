"""Session construction and the shared scratch space.

Jobs never pick a machine-local temporary folder themselves: anything that
must outlive a task (lineage cuts, round-trips through files, streaming
checkpoints) goes under the cluster's ``spark.checkpoint.dir``. Only when a
session has no such setting (a unit test, a laptop) is one created.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the engine's plans assume. AQE re-plans joins from runtime sizes
# (broadcast only after the shuffle proves a side small), coalesces tiny
# partitions and splits skewed join partitions.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # AQE only merges partitions: start with many, so that a large shuffle isn't
    # squeezed into the default number
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
}


LOCAL_DRIVER_MEMORY = "12g"


def build_session(
    master: str | None = None,
    app: str = "railyard",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the engine's settings.

    ``shuffle_partitions`` should follow the data size (about one partition
    per 128-256 MB of shuffled data); AQE coalesces downwards at runtime.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", **ENGINE_CONF}
    if master and master.startswith("local"):
        # local mode runs every task inside the driver JVM (default heap 1 GB)
        conf["spark.driver.memory"] = LOCAL_DRIVER_MEMORY
        conf.pop("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    else:
        # on a shared cluster coalesce shuffle partitions towards the advisory
        # size instead of maximising their number (no floods of tiny tasks)
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set one only if the session has none (tests and local runs).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect sessions have no SparkContext
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="railyard-")
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:
            pass
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable (reliable, shared storage)."""
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(shared_root(spark))
    except Exception:
        pass


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a job are removed when it has ended. Else they stay until the driver's garbage
    collector meets the job's plan, so that the disk holds those of all jobs of a run."""
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE)
        else:
            spark.conf.set(_FREE, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared root."""
    return f"{shared_root(spark)}/railyard/{name}-{uuid.uuid4().hex}"
