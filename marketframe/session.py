"""Session settings and shared scratch space."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that hold at any scale.  The shuffle partition count is an upper bound: adaptive
# execution merges small partitions and splits skewed join partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # of keys that a JSON object repeats, the last one counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app_name: str = "marketframe", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# the temporary folder of each local application without a shared one
_local_folders: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for an intermediate table, below the cluster's shared ``spark.checkpoint.dir``.

    Only a local-mode session (tests, one machine) may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="run-")
        shared = _local_folders[app]
    return os.path.join(shared, f"{name}-{uuid.uuid4().hex}")
