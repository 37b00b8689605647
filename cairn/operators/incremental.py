"""Keyed upserts and processing flags as DataFrame rewrites (S7, M1-M3, M9,
M10, J4).

Upsert without a table format: union target and source rows, then one
aggregation per key keeps the winning source row and the target row; columns
are picked from the two afterwards. Both aggregates combine before the
shuffle, so a hot key never becomes one giant group, and the whole merge is
one shuffle by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.clean import nan_to_null


def dedupe_source(source: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the last in ``order`` (e.g. ingest time), else a
    deterministic choice (greatest row)."""
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        return source.dropDuplicates(keys)
    ordering = F.struct(*[F.col(c) for c in (order or rest)])
    agg = source.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordering).alias("_row"))
    return agg.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def conform(source: DataFrame, target_schema, defaults: dict | None = None,
            keep: list[str] = ()) -> DataFrame:
    """Shape source rows like the target: missing columns take their default
    (or null), extra columns are dropped (except ``keep``), types are cast."""
    defaults = defaults or {}
    cols = []
    for f in target_schema.fields:
        if f.name in source.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            d = defaults.get(f.name)
            d = d if isinstance(d, Column) else F.lit(d)
            cols.append(d.cast(f.dataType).alias(f.name))
    return source.select(*cols, *keep)


def upsert(target: DataFrame, source: DataFrame, keys: list[str],
           update_cols: list[str] | None = None, defaults: dict | None = None,
           source_order: list[str] | None = None) -> DataFrame:
    """Insert new keys; for existing keys overwrite ``update_cols`` with
    the source values. ``update_cols=None`` means every non-key column of the
    *target*, so columns the source lacks fall back to their defaults (M3:
    flags reset); an empty list means do nothing on conflict. NaN becomes
    null first (F7). Several source rows for one key: the last in
    ``source_order`` wins (default: a deterministic choice).

    One aggregation over target + source rows keeps, per key, the winning
    source row and the target row as two structs, whatever the width; columns
    are picked from them after the shuffle."""
    non_key = [c for c in target.columns if c not in keys]
    upd = set(non_key if update_cols is None else update_cols)
    src = nan_to_null(source)
    if source_order:
        # the order columns need not exist in the target: they only rank source rows
        src = conform(src.withColumn("_ord", F.struct(*[F.col(c) for c in source_order])),
                      target.schema, defaults, keep=["_ord"])
    else:
        src = conform(src, target.schema, defaults)
        src = src.withColumn("_ord", F.struct(*[F.col(c) for c in non_key] or [F.lit(0)]))
    tgt = target.withColumn("_ord", F.lit(None).cast(src.schema["_ord"].dataType))
    both = tgt.withColumn("_src", F.lit(False)).unionByName(src.withColumn("_src", F.lit(True)))
    row = F.struct(*[F.col(c) for c in non_key] or [F.lit(0).alias("_none")])
    merged = both.groupBy(*keys).agg(F.max_by(row, F.when(F.col("_src"), F.col("_ord"))).alias("_new"),
                                     F.max(F.when(~F.col("_src"), row)).alias("_old"))
    pick = lambda c: (F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col("_old")[c]) if c in upd
                      else F.when(F.col("_old").isNotNull(), F.col("_old")[c]).otherwise(F.col("_new")[c]))
    return merged.select(*[F.col(c) if c in keys else pick(c).alias(c) for c in target.columns])


def _keys_of_batch(batch: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """The batch's keys that exist. ``existing`` is the large side: semi-joined
    with the batch first, it is not shuffled whole - Spark broadcasts a small
    batch, and for one too large for that filters the scan by a Bloom filter of
    the batch's keys (``spark.sql.optimizer.runtime.bloomFilter.*``)."""
    return existing.select(*keys).join(batch.select(*keys).distinct(), keys, "left_semi").distinct()


def split_new_existing(batch: DataFrame, existing: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(new keys, existing keys) of a batch: anti and semi joins."""
    k = _keys_of_batch(batch, existing, keys)
    return batch.join(k, keys, "left_anti"), batch.join(k, keys, "left_semi")


def new_vs_updated(batch: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """M9: counts of inserted and updated keys of a batch (one row)."""
    k = _keys_of_batch(batch, existing, keys).withColumn("_exists", F.lit(True))
    j = batch.select(*keys).distinct().join(k, keys, "left")
    return j.agg(F.count_if(F.col("_exists").isNull()).alias("new_records"),
                 F.count_if(F.col("_exists")).alias("updated_records"))


def mark_processed(target: DataFrame, done_keys: DataFrame, keys: list[str], flag: str,
                   now: Column) -> DataFrame:
    """M1: set ``flag`` true and ``flag_at`` = now for the keys of a finished
    batch (run this only after the batch result is stored)."""
    k = done_keys.select(*keys).distinct().withColumn("_done", F.lit(True))
    j = target.join(k, keys, "left")
    done = F.col("_done").isNotNull()
    at = f"{flag}_at"
    out = j.withColumn(flag, F.when(done, F.lit(True)).otherwise(F.col(flag)))
    if at in target.columns:
        out = out.withColumn(at, F.when(done, now.cast(target.schema[at].dataType)).otherwise(F.col(at)))
    return out.select(*target.columns)


def reset_pnl(whales: DataFrame, pnl: DataFrame, gold: DataFrame, states: DataFrame,
              task_name: str = "silver_wallet_pnl") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Empty PnL and gold, PnL flags of whales back to false, the task's
    state rows removed. Returns the four new tables."""
    empty_pnl = pnl.limit(0)
    empty_gold = gold.limit(0)
    w = whales.withColumn("pnl_processed", F.lit(False))
    if "pnl_processed_at" in whales.columns:
        w = w.withColumn("pnl_processed_at", F.lit(None).cast(whales.schema["pnl_processed_at"].dataType))
    s = states.where(F.col("task_name") != task_name)
    return w, empty_pnl, empty_gold, s


def reset_summary(whales: DataFrame, pnl: DataFrame, states: DataFrame,
                  task_name: str = "silver_wallet_pnl") -> DataFrame:
    """M10 summary (U1): three labelled counts after a reset."""
    a = pnl.agg(F.count(F.lit(1)).alias("c")).select(
        F.lit("silver.silver_wallet_pnl").alias("table_name"), F.col("c").alias("record_count"),
        F.lit("All records cleared").alias("status"))
    b = whales.where(F.col("pnl_processed") == F.lit(False)).agg(F.count(F.lit(1)).alias("c")).select(
        F.lit("silver.silver_whales (pnl_processed=false)").alias("table_name"),
        F.col("c").alias("record_count"), F.lit("Ready for PnL recalculation").alias("status"))
    c = states.where(F.col("task_name") == task_name).agg(F.count(F.lit(1)).alias("c")).select(
        F.lit(f"pipeline.pipeline_state ({task_name})").alias("table_name"),
        F.col("c").alias("record_count"), F.lit("State entries cleared").alias("status"))
    return a.unionByName(b).unionByName(c)
