"""Session helpers: local sessions for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings for the ~100 TB cluster deployment (SQL confs, settable per session).
# Scans: 512 MB input splits keep ~200k scan tasks for 100 TB of Parquet. Shuffles:
# start from many partitions so no reducer spills heavily before AQE has statistics,
# then let AQE coalesce to ~256 MB partitions and split skewed ones; the fact-table
# aggregates shuffle only partial aggregates, so most stages coalesce to few tasks.
CLUSTER_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    # Broadcast by measured size only: the static threshold goes by estimated file size.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.files.maxPartitionBytes": str(512 << 20),
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.session.timeZone": "UTC",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict[str, str] | None = None) -> None:
    """Apply ``CLUSTER_SQL_CONF`` (plus overrides) to a session; leaves core confs alone."""
    for k, v in {**CLUSTER_SQL_CONF, **(overrides or {})}.items():
        spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "ledgerlens", event_log_dir: str | None = None) -> SparkSession:
    """A local session configured like the cluster one (AQE on, UTC, no UI)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # Coalesce shuffle partitions by the advisory size (64 MB) instead of keeping
         # default parallelism: Spark's recommended setting for shared clusters.
         .config("spark.sql.adaptive.coalescePartitions.parallelismFirst",
                 os.environ.get("LEDGERLENS_PARALLELISM_FIRST", "false"))
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if event_log_dir:
        b = (b.config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", event_log_dir)
             .config("spark.eventLog.compress", "false"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    On a cluster the setting is read from the session and never overridden.
    Only where it is unset and the master is local (tests) a scratch folder is created
    and set; a cluster without the setting is an error, as its machines share no folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext handle (e.g. a remote session)
        sc = None
    d = spark.conf.get(CHECKPOINT_CONF, None) or (sc.getCheckpointDir() if sc else None)
    if not d:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
        try:
            spark.conf.set(CHECKPOINT_CONF, d)
        except Exception:  # noqa: BLE001 - some sessions reject core confs at runtime
            pass
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
