"""Table registration: temp views over frames, and external catalog tables over Parquet folders.

An external table names a folder; dropping the table leaves the files. A partitioned folder's partitions are recovered
into the catalog, so queries by name prune them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ontime.operators.features import union_all


def register_tables(spark: SparkSession, train: DataFrame, test: DataFrame,
                    train_name: str = "train_data", test_name: str = "test_data",
                    union_name: str = "all_flights") -> list[str]:
    """Register ``train``/``test`` and their UNION ALL view; returns the view names."""
    train.createOrReplaceTempView(train_name)
    test.createOrReplaceTempView(test_name)
    union_all(spark.table(train_name), spark.table(test_name)).createOrReplaceTempView(union_name)
    return [train_name, test_name, union_name]


def quoted(name: str) -> str:
    """A table name, with its database if it has one, safe in SQL."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def register_location(spark: SparkSession, name: str, path: str, like: str | None = None) -> None:
    """External table ``name`` over a Parquet folder; replaces a table of that name.

    With ``like`` columns and partitioning are another table's, else they are read from the folder.
    """
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    layout = f"LIKE {quoted(like)} " if like else ""
    drop_table(spark, name)
    spark.sql(f"CREATE TABLE {quoted(name)} {layout}USING parquet LOCATION '{place}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {quoted(name)}")


def register_external(spark: SparkSession, train_path: str, test_path: str, train_name: str = "train_data",
                      test_name: str = "test_data", union_name: str = "all_flights") -> list[str]:
    """The train table by its folder, the test table as a copy of its layout over another folder, and their union view."""
    register_location(spark, train_name, train_path)
    register_location(spark, test_name, test_path, like=train_name)
    union_all(spark.table(train_name), spark.table(test_name)).createOrReplaceTempView(union_name)
    return [train_name, test_name, union_name]


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove the table (or a view in its way) from the catalog; files of an external table stay."""
    if "." not in name:
        spark.catalog.dropTempView(name)
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")


def list_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")
