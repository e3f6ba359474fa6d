"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from basketlab.functions.joins import bytes_of

# Settings every basketlab job relies on.  Sizes (executor memory, number of
# executors) are left to spark-submit; these are semantic / planner settings.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when the join's output partitioning was going
    # to be reused (lines x orders feeds the per-(order, product) aggregate):
    # one extra shuffle beats one task holding a third of the lines
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def get_spark(app: str = "basketlab", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the basketlab defaults.

    ``master`` is only set when given: on a cluster spark-submit decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a folder every executor can reach
    (HDFS / object store) and is never overridden here.  Where it is unset,
    ``default`` (such as a folder below a job's output) is registered; without
    one, a private folder is created in local mode only, as other masters'
    executors wouldn't see it.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None) or default
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir (or the job's --scratch) to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="basketlab-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name) if "://" not in base else base.rstrip("/") + "/tables/" + name


ROWS_PER_TASK = 500_000  # order lines that one task of a shuffle takes
MERGED_BYTES = 16 << 20  # of shuffled rows that adaptive execution puts into one task, at most: about a million order lines
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def enough_partitions(spark: SparkSession, rows: int) -> int:
    """Raises the session's shuffle partitions to what a table of ``rows`` rows needs; never lowers them.

    A fixed number of partitions lets each task, and what it sorts and spills,
    grow with the input.  Adaptive execution merges those that turn out small, up to
    ``MERGED_BYTES``: with the default of 64 MB it would merge them again, to five million rows
    that a task sorts or hashes in ten times as many bytes.
    """
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    if bytes_of(spark.conf.get(ADVISORY, "64MB")) > MERGED_BYTES:
        spark.conf.set(ADVISORY, str(MERGED_BYTES))
    return n


def materialize(df: DataFrame, name: str, keep_partitioning: bool = False,
                path: str | None = None) -> DataFrame:
    """Compute ``df`` once and cut its lineage in the shared checkpoint folder.

    Default: write a Parquet table and read it back (columnar: consumers read
    only the columns they need, filters are pushed into the scan).  With
    ``keep_partitioning`` a reliable checkpoint is used instead, which keeps
    the plan's output partitioning so a following join on the same keys
    needs no new shuffle; the rows are persisted first so the checkpoint does
    not recompute them.  ``path`` writes to a chosen location instead of
    a fresh folder below the checkpoint folder.
    """
    spark = df.sparkSession
    if keep_partitioning:
        checkpoint_dir(spark)
        cached = df.persist(StorageLevel.MEMORY_AND_DISK)
        out = cached.checkpoint(eager=True)
        cached.unpersist()
        return out
    path = path or scratch_path(spark, f"{name}_{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
