"""Session construction and the shared scratch location.

Library code never builds its own session: every function takes the
caller's ``SparkSession``.  ``build_session`` exists for tests, the bench and
the command line; on a cluster the platform's session is used as is.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes
# (broadcast when a side turns out small, sort-merge otherwise), coalesces
# small shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Coalesce shuffle output to the advisory size rather than to as many
    # tasks as there are cores: on a large shared cluster that means fewer,
    # fuller tasks (no measurable change at test size).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # An aggregate after a join may reuse the join's partitioning on a prefix
    # of its keys; AQE would then refuse to split a hot join key (the split
    # breaks that partitioning).  Forcing the split adds a shuffle only when
    # a skewed partition is actually found.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # The planner's size estimate for a Parquet scan is its compressed bytes,
    # several times below the hashed size in memory, so a fact that is 10 MB
    # on disk could be chosen as a broadcast build side.  Static broadcast
    # therefore needs a lower bound; AQE decides from measured shuffle sizes.
    "spark.sql.autoBroadcastJoinThreshold": "4m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "starmart", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is left
    alone; a fresh temporary folder is used only when nothing is configured
    (tests on one machine).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="starmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


_SCRATCH: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables (lineage cuts, sinks).

    Derived from ``spark.checkpoint.dir`` so every executor sees it.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = ensure_checkpoint_dir(spark)
    return conf_dir.rstrip("/") + "/starmart-scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch root.

    A lazy result may still read it, so it stays until ``remove_scratch``.
    """
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables of this process; call it once their results are used."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's file system (works for any scheme)."""
    if "://" not in path and not path.startswith("/"):
        path = os.path.abspath(path)
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def file_size(spark: SparkSession, path: str) -> int:
    """Length in bytes of a file (or total of a folder) via Hadoop."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def run_concurrently(jobs: Sequence[tuple[Callable, ...]], parallel: int = 4) -> list:
    """Submit independent Spark jobs from up to ``parallel`` threads.

    ``jobs`` holds ``(function, *args)`` tuples; results come back in order.
    Every job runs to its end before the first error is re-raised, so no
    write is left half-submitted.
    """
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = [pool.submit(fn, *args) for fn, *args in jobs]
    return [f.result() for f in futures]
