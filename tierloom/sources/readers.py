"""Reading raw records: CSV seeds, Parquet, catalog tables and text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CUSTOMER_SEED = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("signup_date", T.DateType()),
        T.StructField("region", T.StringType()),
    ]
)

ORDER_SEED = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("order_amount", T.DoubleType()),
        T.StructField("STATUS", T.StringType()),
        T.StructField("last_updated", T.TimestampType()),
    ]
)


#: The dialect most tools write: a quote inside a quoted field is doubled, and spaces belong to the field.
CSV_DIALECT = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multiline: bool = False
) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the files twice.

    A row that does not fit the schema is an error. ``multiline`` allows newlines in quoted fields; a file is then
    read by one task, so write many files.
    """
    reader = spark.read.options(**CSV_DIALECT).option("multiLine", multiline).option("mode", "FAILFAST")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet files or a glob; only ``columns`` reach the scan."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table or view, by up to three name parts."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one row each: ``source`` (the file name), ``path``, and ``text`` (the whole content, UTF-8)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("source"),
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("text"),
    )


def is_there(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything, on whichever file system it names."""
    try:
        spark.read.format("binaryFile").load(path)  # lists the files and reads none
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def require_sources(spark: SparkSession, paths: Sequence[str]) -> None:
    """Fail, naming every missing input, before any work starts."""
    missing = [path for path in paths if not is_there(spark, path)]
    if missing:
        raise FileNotFoundError(f"missing sources: {', '.join(missing)}")
