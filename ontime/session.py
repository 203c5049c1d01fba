"""Session construction and lineage helpers.

The library never creates a global session; callers pass one in. ``build_session``
is a convenience for scripts, tests and the bench: UTC clock, ANSI on (Spark 4
default), adaptive execution with skew-join splitting and partition coalescing on.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ontime", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


MB = 1024 * 1024


def scale_settings(input_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of input.

    The initial shuffle partition count aims at ``target_partition_mb`` per partition
    (never fewer than two per core); AQE then
    coalesces small partitions and splits skewed ones around the same advisory size,
    so partitions fit executor memory without spilling. The broadcast threshold is
    kept at a fixed, checked size.
    """
    per = target_partition_mb * MB
    parts = max(2 * total_cores, -(-int(input_bytes) // per))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(per),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(per),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(per),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
    }


def app_id(spark: SparkSession) -> str:
    """Application id (classic sessions) or the session's own id (Spark Connect)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect sessions have no SparkContext
        return spark.conf.get("spark.app.id", None) or str(id(spark))


_PRIVATE_DIRS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: ``spark.checkpoint.dir`` when the cluster names one.

    That setting is read, never written (Spark rejects changing it at runtime). When
    it is unset the context's existing checkpoint folder is used. Only a local master (tests,
    scripts on one machine) may do without both: it gets a private folder, which is removed
    when the program ends. On a cluster that is an error, as executors share no local folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if not path:
        key = app_id(spark)
        if key in _PRIVATE_DIRS:
            path = _PRIVATE_DIRS[key]
        elif current:
            path = current
        else:
            if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            path = _PRIVATE_DIRS[key] = tempfile.mkdtemp(prefix="ontime-ckpt-")
            atexit.register(shutil.rmtree, path, ignore_errors=True)
    if sc is not None and not current:
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A table location under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)
