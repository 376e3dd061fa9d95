"""Layer and result-table IO.

Writes go to a folder under the shared checkpoint root unless a path is
given (``churnkit.session.scratch_path``); reads always take an explicit
schema so no inference pass runs over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CSV_OPTS = {
    "header": "true",
    # keep blank-but-not-empty text (e.g. ' ') exactly as written
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_parquet(df: DataFrame, path: str, partition_by=None) -> str:
    """Overwrite a Parquet folder (optionally partitioned)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """E2."""
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> str:
    """Headered CSV, whitespace preserved."""
    df.write.mode("overwrite").options(**CSV_OPTS).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Headered CSV with a declared schema (no inference pass)."""
    return spark.read.schema(schema).options(**CSV_OPTS).csv(path)


def write_report(df: DataFrame, path: str, fmt: str = "json") -> str:
    """A result table (report, comparison) as JSON or CSV, one file."""
    w = df.coalesce(1).write.mode("overwrite")
    (w.json(path) if fmt == "json" else w.options(**CSV_OPTS).csv(path))
    return path
