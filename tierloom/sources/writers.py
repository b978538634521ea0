"""Writing results: files, tables, views and exports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.sources.readers import CSV_DIALECT


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """CSV in the dialect that :func:`tierloom.sources.readers.read_csv` reads; fields may hold quotes and newlines."""
    df.write.mode(mode).partitionBy(*partition_by).options(**CSV_DIALECT).csv(path)
    return path


def publish_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Materialise as a table; with ``path`` the files live there and the catalog only points at them."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def publish_view(df: DataFrame, name: str) -> None:
    """Materialise as a view: the name stands for the plan and nothing is stored."""
    df.createOrReplaceTempView(name)


def stamp_features(df: DataFrame, stamp: datetime | Column | None = None) -> DataFrame:
    """Add ``event_timestamp`` and ``created``. Pass the stamp to make a rerun write the same rows."""
    at = F.current_timestamp() if stamp is None else stamp if isinstance(stamp, Column) else F.lit(stamp)
    return df.withColumns({"event_timestamp": at, "created": at})


def append_evolving(target: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Append rows whose columns may differ; a column missing on one side is NULL there."""
    return batch if target is None else target.unionByName(batch, allowMissingColumns=True)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """Read files that were appended with different columns as one frame."""
    return spark.read.option("mergeSchema", True).parquet(path)


def show(df: DataFrame, rows: int = 20) -> None:
    """Console preview: schema and first rows."""
    df.printSchema()
    df.show(rows, truncate=False)
