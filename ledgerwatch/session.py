"""Session construction and the shared scratch/checkpoint location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Shuffle partition count is left to the
# caller: the cluster default holds at scale, tests pass a small number.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only when the runtime size is known to be small; beyond it
    # AQE keeps the sort-merge plan.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # Oracle DATE has no zone; all timestamps are TIMESTAMP_NTZ and the
    # session zone only matters for the few LTZ round trips.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerwatch", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster's ``spark.checkpoint.dir`` wins. Only on a local master, where
    all tasks share the machine, a private folder is made when nothing is set;
    elsewhere that is an error, because other machines would not see it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(f"spark.checkpoint.dir is not set on {sc.master}: "
                               "name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerwatch-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for written tables."""
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/ledgerwatch/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    return path


def drop_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Remove scratch folders whose job is done."""
    jvm = spark._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
