"""Running aggregates per key in a fixed order ("scans"), in two physical
forms with identical results:

* ``window_scan``: plain window functions over ``partitionBy(key)``. One task
  per key group: right for the ordinary key, whose group fits a task.
* ``ranged_scan``: for hot keys (a key may hold a third of all rows).
  Range-partition on (key, order) so a hot key is cut into contiguous slices
  spread over many tasks; scan each slice locally; summarise every
  (slice, key) pair (sum / min / max / last / count); carry the summaries of
  earlier slices forward with a window over the slices of a key; combine.
  The slices are stored before rows and summaries are read from them, so both
  see the same cuts; the summary table is broadcast only after a count.

``hot_keys`` finds the keys above a row threshold with one partial
aggregation; at most total_rows / threshold keys qualify.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_HOT_KEY_ROWS = 5_000_000
HOT_KEY_CONF = "cairn.skew.hotKeyRows"


@dataclass(frozen=True)
class Run:
    """One running aggregate: ``fn`` in sum | min | max | last (last non-null)
    | total (count of non-null over the whole key); ``inclusive`` False means
    the frame ends at the previous row."""
    fn: str
    expr: Column
    inclusive: bool = True
    cast: object = None          # optional result type


Order = list[tuple[Column, bool]]  # (expression, ascending); nulls sort last


def _sort(order: Order) -> list[Column]:
    return [c.asc_nulls_last() if asc else c.desc_nulls_last() for c, asc in order]


def _window_fn(run: Run) -> Column:
    if run.fn == "sum":
        return F.sum(run.expr)
    if run.fn == "min":
        return F.min(run.expr)
    if run.fn == "max":
        return F.max(run.expr)
    if run.fn == "last":
        return F.last(run.expr, ignorenulls=True)
    raise ValueError(run.fn)


def window_scan(df: DataFrame, key: list[str], order: Order, runs: dict[str, Run]) -> DataFrame:
    ordered = Window.partitionBy(*key).orderBy(*_sort(order))
    inc = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exc = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*key)
    cols = {}
    for name, run in runs.items():
        if run.fn == "total":
            c = F.count(run.expr).over(whole)
        else:
            c = _window_fn(run).over(inc if run.inclusive else exc)
        cols[name] = c.cast(run.cast) if run.cast is not None else c
    return df.withColumns(cols)


def range_slices(df: DataFrame, order: list[Column], slices: int | None = None) -> DataFrame:
    """``df`` cut into contiguous slices of ``order``, numbered by ``_slice``,
    and *stored* (reliable checkpoint; this runs the input once, while the
    plan is built). Range bounds are sampled per execution: two branches that
    each ran the exchange would number rows and totals by different slices.
    From the stored rows on, a lost executor or a retried stage re-reads the
    same slices. Rows in = rows out."""
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartitionByRange(n, *order).withColumn("_slice", F.spark_partition_id()))


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast hint only after a count: beyond ``max_rows`` the join shuffles."""
    return F.broadcast(df) if df.count() <= max_rows else df


def ranged_scan(df: DataFrame, key: list[str], order: Order, *rounds: dict[str, Run],
                slices: int | None = None) -> DataFrame:
    """The scans of one key and order, one after the other (a round may read the columns of those before it),
    over slices that are cut and stored once."""
    r = range_slices(df, [*[F.col(k) for k in key], *_sort(order)], slices)
    for runs in rounds:
        r = _sliced_scan(r, key, order, runs)
    return r.drop("_slice")


def scans(ranged: bool, slices: int | None = None):
    """``scan(df, key, order, *rounds)`` in one of the two forms."""
    def windows(df: DataFrame, key: list[str], order: Order, *rounds: dict[str, Run]) -> DataFrame:
        for runs in rounds:
            df = window_scan(df, key, order, runs)
        return df

    return (lambda df, key, order, *rounds: ranged_scan(df, key, order, *rounds, slices=slices)) if ranged else windows


def _sliced_scan(r: DataFrame, key: list[str], order: Order, runs: dict[str, Run]) -> DataFrame:
    """One round over stored slices. Rows keep their slice, partitioning and order, so that the next round
    sorts and shuffles nothing again; the few carried values are stored before they are counted and joined."""
    lkey = ["_slice", *key]
    local = window_scan(r, lkey, order, {f"_loc_{k}": Run(v.fn, v.expr, v.inclusive)
                                         for k, v in runs.items() if v.fn != "total"})
    # ascending struct that sorts like ``order`` (desc only on numeric columns)
    okey = F.struct(*[(c if asc else -c) for c, asc in order])
    aggs = []
    for name, run in runs.items():
        t = f"_tot_{name}"
        if run.fn == "last":
            aggs.append(F.max_by(run.expr, F.when(run.expr.isNotNull(), okey)).alias(t))
        elif run.fn == "total":
            aggs.append(F.count(run.expr).alias(t))
        else:
            aggs.append(_window_fn(run).alias(t))
    summary = r.groupBy(*lkey).agg(*aggs)
    before = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*key)
    carry_cols = []
    for name, run in runs.items():
        t = F.col(f"_tot_{name}")
        if run.fn == "total":
            c = F.sum(t).over(everything)
        elif run.fn == "last":
            c = F.last(t, ignorenulls=True).over(before)
        else:
            c = _window_fn(Run(run.fn, t)).over(before)
        carry_cols.append(c.alias(f"_car_{name}"))
    carry = broadcast_if_small(cut(summary.select(*[F.col(k).alias(f"_car_{k}") for k in lkey], *carry_cols)))
    on = F.col("_slice") == F.col("_car__slice")
    for k in key:
        on = on & F.col(k).eqNullSafe(F.col(f"_car_{k}"))
    j = local.join(carry, on).drop(*[f"_car_{k}" for k in lkey])
    out = {}
    for name, run in runs.items():
        car, loc = F.col(f"_car_{name}"), F.col(f"_loc_{name}")
        if run.fn == "sum":
            out[name] = F.when(loc.isNull() & car.isNull(), F.lit(None)).otherwise(
                F.coalesce(car, F.lit(0)) + F.coalesce(loc, F.lit(0)))
        elif run.fn == "min":
            out[name] = F.least(car, loc)
        elif run.fn == "max":
            out[name] = F.greatest(car, loc)
        elif run.fn == "last":
            out[name] = F.coalesce(loc, car)
        else:
            out[name] = car
        if run.cast is not None:
            out[name] = out[name].cast(run.cast)
    drop = [f"_{kind}_{name}" for name in runs for kind in ("loc", "car")]
    return j.withColumns(out).drop(*drop)


def hot_key_rows(spark) -> int:
    return int(spark.conf.get(HOT_KEY_CONF, str(DEFAULT_HOT_KEY_ROWS)))


def hot_keys(df: DataFrame, key: list[str], threshold: int) -> DataFrame:
    """Keys with more than ``threshold`` rows (partial aggregation first)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > threshold).select(*key)


def split_hot(df: DataFrame, key: list[str], threshold: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(cold rows, hot rows or None). Finding the hot keys is one small
    action: a partial aggregation whose result has at most rows/threshold
    keys. Without hot keys the plan keeps only the ordinary form."""
    t = hot_key_rows(df.sparkSession) if threshold is None else threshold
    return _route(df, hot_keys(df, key, t), key)


def split_hot_by_counts(df: DataFrame, counts: DataFrame, key: list[str], count_col: str,
                        threshold: int | None = None, rows_per_count: int = 1) -> tuple[DataFrame, DataFrame | None]:
    """Like :func:`split_hot`, but with per-key counts the job computes anyway
    (e.g. transactions per wallet): no extra pass over ``df``. A key is hot
    when ``count_col * rows_per_count`` exceeds the threshold (an upper bound
    on its rows in ``df``)."""
    t = hot_key_rows(df.sparkSession) if threshold is None else threshold
    return _route(df, counts.where(F.col(count_col) * rows_per_count > t).select(*key), key)


def total(counts: DataFrame, count_col: str) -> int:
    """Sum of per-key counts (give it stored rows)."""
    return counts.agg(F.sum(count_col)).first()[0] or 0


def _route(df: DataFrame, keys: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the other keys and rows of the hot ones; the key list is stored
    and joined back null-safely, broadcast only after a count."""
    keys = cut(keys)
    if keys.isEmpty():
        return df, None
    hot = broadcast_if_small(keys.select(*[F.col(k).alias(f"_hot_{k}") for k in key]))
    on = None
    for k in key:
        same = F.col(k).eqNullSafe(F.col(f"_hot_{k}"))
        on = same if on is None else on & same
    return df.join(hot, on, "left_anti"), df.join(hot, on, "left_semi")


def cut(df: DataFrame) -> DataFrame:
    """Materialise and cut lineage with a reliable checkpoint (into the
    shared ``spark.checkpoint.dir``)."""
    from cairn.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
