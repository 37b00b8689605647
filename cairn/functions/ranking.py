"""Row numbers over a global (or per-group) order without funnelling all rows
through one task.

``Window.orderBy`` without ``partitionBy`` moves every row into a single
partition. Instead: range-partition on the order so each task holds one
contiguous slice, number rows inside each slice, and add the count of rows
in earlier slices (of the same group). The sliced rows are stored once
(``scan.range_slices``) before rows and totals are read from them; the offset
table, one row per (slice, group) pair, is broadcast only after a count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_numbers(df: DataFrame, order: list, outputs: dict[str, list[str]],
                num_partitions: int | None = None, known_rows: int | None = None,
                single_task_rows: int = 1_000_000) -> DataFrame:
    """Add one column per ``outputs`` item: name -> grouping columns ([] =
    global). All share ``order``, which must be total (end it with a key);
    rows of a group are numbered 1..n in that order. One range shuffle serves
    every output. Groupings must have few distinct values (tiers, flags).

    When the caller has counted the input (``known_rows``) and it is at most
    ``single_task_rows``, plain windows are used: the size check bounds what
    one task sorts, and the range sampling jobs are skipped."""
    order_cols = [_col(c) for c in order]
    if known_rows is not None and known_rows <= single_task_rows:
        return df.withColumns({
            name: F.row_number().over(Window.partitionBy(*part).orderBy(*order_cols)).cast("long")
            for name, part in outputs.items()})
    from cairn.functions.scan import broadcast_if_small, range_slices
    out = ranged = range_slices(df, order_cols, num_partitions)
    for name, part in outputs.items():
        out = out.withColumn(
            f"_rn_{name}", F.row_number().over(Window.partitionBy("_slice", *part).orderBy(*order_cols)))
    for name, part in outputs.items():
        counts = ranged.groupBy("_slice", *part).agg(F.count(F.lit(1)).alias("_cnt"))
        w = Window.partitionBy(*part).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("_slice", *part,
                                F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias(f"_off_{name}"))
        on = out["_slice"] == offsets["_slice"]
        for c in part:  # a null group is a group like any other
            on = on & out[c].eqNullSafe(offsets[c])
        offsets = broadcast_if_small(offsets)
        out = out.join(offsets, on).drop(*[offsets[c] for c in ("_slice", *part)])
        out = out.withColumn(name, (F.col(f"_rn_{name}") + F.col(f"_off_{name}")).cast("long")) \
                 .drop(f"_rn_{name}", f"_off_{name}")
    return out.drop("_slice")


def row_number_ordered(df: DataFrame, order: list, name: str = "row_number",
                       partition_by: list[str] | None = None, few_groups: bool = True,
                       num_partitions: int | None = None, known_rows: int | None = None,
                       single_task_rows: int = 1_000_000) -> DataFrame:
    """Single-output form of :func:`row_numbers`. With many groups
    (``few_groups=False``) a plain partitioned window is already spread over
    tasks and is used instead."""
    part = list(partition_by or [])
    if part and not few_groups:
        return df.withColumn(name, F.row_number().over(
            Window.partitionBy(*part).orderBy(*[_col(c) for c in order])))
    return row_numbers(df, order, {name: part}, num_partitions, known_rows, single_task_rows)
