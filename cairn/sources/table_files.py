"""Sizes of stored tables, from the file columns that Spark keeps beside the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_stats(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table_name, row_count, files, bytes, largest_file) per Parquet table. Only footers are read: rows
    are counted per file, with the file's size from ``_metadata``. Files without rows are not seen."""
    out = None
    for name, path in paths.items():
        files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
        files = files.groupBy("f").agg(F.max("s").alias("s"), F.count(F.lit(1)).alias("n"))
        row = files.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count(F.lit(1)).alias("files"),
                        F.coalesce(F.sum("s"), F.lit(0)).alias("bytes"), F.max("s").alias("largest_file"))
        row = row.select(F.lit(name).alias("table_name"), "row_count", "files", "bytes", "largest_file")
        out = row if out is None else out.unionByName(row)
    return out
