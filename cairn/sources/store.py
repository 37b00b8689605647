"""Named Parquet tables in one folder, by plain Spark reads and writes.

A table is a folder of Parquet files. Appends are Spark appends. A rewrite (upsert, marks, reset) is a
join-based merge whose result is written beside the table and then over it, because Spark does not
overwrite what a job reads; if the second write is lost, the result still lies in ``<name>__next``.
There are no versions and no own commit protocol: at a size or with writers that need them, keep the
tables in a table format with MERGE, for which ``operators.incremental.upsert`` is the DataFrame form."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class TableStore:
    """Named tables under one root directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        try:
            self.spark.read.parquet(self.path(name))
        except AnalysisException:  # no such folder, or nothing written into it
            return False
        return True

    def read(self, name: str, columns: list[str] | None = None, schema: StructType | None = None) -> DataFrame:
        """Full or projected scan (column pruning and filters reach the
        Parquet reader); with ``schema`` a table that is not there is empty."""
        if schema is not None and not self.exists(name):
            df = self.spark.createDataFrame([], schema)
        else:
            df = self.spark.read.parquet(self.path(name))
        return df.select(*columns) if columns else df

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        """The whole table anew; ``df`` may read the table itself."""
        df.write.mode("overwrite").parquet(self.path(f"{name}__next"))
        self.spark.read.parquet(self.path(f"{name}__next")).write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(self.path(name))

    def append(self, name: str, df: DataFrame) -> None:
        """The cost is the batch, not the table. Columns follow the
        table's schema."""
        cols = self.read(name).columns if self.exists(name) else df.columns
        df.select(*cols).write.mode("append").parquet(self.path(name))

    def upsert(self, name: str, source: DataFrame, keys: list[str], update_cols: list[str] | None = None,
               defaults: dict | None = None) -> None:
        """The first upsert merges into an empty table of the source's
        columns and the defaults."""
        from cairn.operators.incremental import upsert
        if self.exists(name):
            target = self.read(name)
        else:
            extra = {c: (d if isinstance(d, Column) else F.lit(d)) for c, d in (defaults or {}).items() if c not in source.columns}
            target = source.withColumns(extra).limit(0) if extra else source.limit(0)
        self.write(name, upsert(target, source, keys, update_cols, defaults))

    def rewrite(self, name: str, fn) -> None:
        """Apply a DataFrame -> DataFrame rewrite."""
        self.write(name, fn(self.read(name)))

    def stats(self, names: list[str]) -> DataFrame:
        """Rows, files and bytes per table."""
        from cairn.sources.table_files import table_stats
        return table_stats(self.spark, {n: self.path(n) for n in names})


def partitioned_write(df: DataFrame, path: str, date_col: str = "processing_date") -> None:
    """Table partitioned by date string; rewriting replaces only the
    partitions present in ``df`` (dynamic partition overwrite)."""
    (df.withColumn(date_col, F.col(date_col).cast("string"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))


def table_schema(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Column name, type and declared default with what the table holds:
    rows, rows with a value, and whether a null was found. One partial
    aggregation over all columns, turned into rows."""
    known = defaults or {}
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{f.name}`")).alias(f"_{i}") for i, f in enumerate(df.schema.fields)])
    rows = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.lit(None if known.get(f.name) is None else str(known[f.name]).lower()).cast("string").alias("column_default"),
                     F.col("_rows").alias("row_count"), F.col(f"_{i}").alias("value_count"), (F.col(f"_{i}") < F.col("_rows")).alias("has_nulls"))
            for i, f in enumerate(df.schema.fields)]
    return counts.select(F.explode(F.array(*rows)).alias("c")).select("c.*")
