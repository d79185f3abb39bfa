"""Spark session helpers.

The engine never owns cluster configuration: it reads what the session has
and only fills in defaults that are missing (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Marks a session whose defaults were applied, so that later changes by the user stay.
CONFIGURED = "panelcast.configured"

# Settings the operators rely on. Applied only when the session does not
# already define them, so a cluster's own tuning always wins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Panel windows are keyed by (family, entity_id) while joins add the month:
    # let a join reuse a partitioning on a subset of its keys (one shuffle).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Broadcast only tables whose size the planner has measured below this.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "panelcast",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session; local defaults only where unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false") \
        .config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`DEFAULT_CONF` where the session leaves a key unset."""
    if spark.conf.get(CONFIGURED, None) is None:
        given = set_by_user(spark)
        for key, value in DEFAULT_CONF.items():
            if key not in given:
                spark.conf.set(key, value)
        spark.conf.set(CONFIGURED, "true")
    ensure_checkpoint_dir(spark)
    return spark


def set_by_user(spark: SparkSession) -> set[str]:
    """Keys of :data:`DEFAULT_CONF` that the cluster or the user has set."""
    conf = spark.sparkContext.getConf()
    return {k for k in DEFAULT_CONF if conf.contains(k)}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. Only a local session without one (a test) gets a folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        local = tempfile.mkdtemp(prefix="panelcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(local)
        return local
    return sc.getCheckpointDir()


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet to the shared folder and cut its lineage.

    Used for tables that several later steps read (the aggregated sales
    binding, the feature panel): they are computed once, later reads take only the columns they need, and a lost
    executor re-reads the files instead of recomputing from the raw scan.
    """
    return shared_table(df, name)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def shared_table(df, name: str):
    """``df`` written as Parquet to the shared folder and read back."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
