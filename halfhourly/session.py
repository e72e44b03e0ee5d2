"""SparkSession settings every job in this package assumes."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the semantics depend on: UTC instants and dynamic partition
# overwrite (day-partition rewrites must leave other days untouched).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on measured sizes: no static (estimate-based) broadcast;
    # AQE may still switch a join to broadcast from the actual size of a
    # finished shuffle stage.  Explicit hints are used only for inputs whose
    # size is bounded by construction or checked (quality.broadcast_if_small).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # After a shuffle, AQE may replace a sort-merge join by a shuffled hash
    # join when every partition of the build side is below this size (no
    # sort; the per-partition hash map stays bounded).
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


_LOCAL_DIRS: dict[str, str] = {}


def get_spark(master: str | None = None, app: str = "halfhourly",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the package's required settings.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized from the input (roughly
    input bytes / 128 MB) and is left to the caller or to AQE coalescing.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.sql.execution.arrow.pyspark.enabled"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there; one is invented only for a
    local master, where driver and executors are one process.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local") or "cluster" in master:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="halfhourly-ckpt-")
        current = _LOCAL_DIRS[app]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)
