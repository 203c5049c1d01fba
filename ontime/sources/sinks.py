"""Writers: partitioned Parquet, plain Parquet, CSV exports, metrics JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str],
                      partitions: int | None = None) -> None:
    """Overwrite ``path`` as Parquet partitioned by ``keys``.

    Rows are clustered by the keys with a ``rebalance`` hint: AQE then sizes the
    write tasks from runtime statistics, splitting a partition value that holds a
    large share of the rows over several tasks (each near the advisory partition
    size) and merging small ones, so files stay few per directory and no task
    writes a hot value alone. ``partitions`` fixes the initial task count.
    """
    cols = list(keys)
    args = ([partitions] if partitions else []) + cols
    df.hint("rebalance", *args).write.mode("overwrite").partitionBy(*cols).parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Header CSV folder written by the executors (nothing is collected)."""
    out = df.select(*columns) if columns else df
    out.write.mode("overwrite").option("header", "true").csv(path)


def write_metrics(spark: SparkSession, metrics: dict[str, float], path: str) -> None:
    """One-row JSON with the metric values."""
    row = spark.createDataFrame([tuple(float(v) for v in metrics.values())], list(metrics))
    row.coalesce(1).write.mode("overwrite").json(path)
