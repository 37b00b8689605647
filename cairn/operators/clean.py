"""Screening, cleaning and record-shaping operators.

Every one is a narrow projection/filter (no shuffle) except the dedupes
(one shuffle by key) and the global token rank of F9 (range shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from cairn.config import TokenScreen, TxFilter
from cairn.functions.expr import whole_days
from cairn.functions.ranking import row_number_ordered


def screen_tokens(tokens: DataFrame, s: TokenScreen | None = None) -> DataFrame:
    """bound filters (None = no filter), liquidity desc, one page
    (offset/limit), capped at the token limit. Ties broken by address."""
    s = s or TokenScreen()
    cond = F.lit(True)
    for c, bound, op in (("liquidity", s.min_liquidity, ">="), ("liquidity", s.max_liquidity, "<="),
                         ("volume_1h_usd", s.min_volume_1h, ">="),
                         ("price_change_2h_percent", s.min_price_change_2h, ">="),
                         ("price_change_24h_percent", s.min_price_change_24h, ">=")):
        if bound is not None:
            cond = cond & (F.col(c) >= bound if op == ">=" else F.col(c) <= bound)
    out = tokens.where(cond).orderBy(F.col("liquidity").desc_nulls_last(), F.col("token_address"))
    if s.offset:
        out = out.offset(s.offset)
    return out.limit(s.limit)


def unprocessed(df: DataFrame, flag: str) -> DataFrame:
    """rows whose processed flag is false (null is neither)."""
    return df.where(F.col(flag) == F.lit(False))


def due_for_refresh(tokens: DataFrame, now: Column, hours: int, limit: int | None = None,
                    flag: str = "whales_processed", at: str = "whales_processed_at") -> DataFrame:
    """never processed, or processed more than ``hours`` before ``now``;
    LIMIT n in key order."""
    due = (F.col(flag) == F.lit(False)) | (
        (F.col(flag) == F.lit(True)) & (F.col(at) < now - F.make_dt_interval(F.lit(0), F.lit(hours))))
    out = tokens.where(due)
    return out.orderBy("token_address").limit(limit) if limit else out


def due_for_refetch(wallets: DataFrame, now: Column, days: int,
                    at: str = "transactions_processed_at") -> DataFrame:
    """null timestamp, or at least ``days`` whole elapsed days."""
    return wallets.where(F.col(at).isNull() | (whole_days(F.col(at), now) >= days))


def base_value_usd() -> Column:
    """|base amount| x base price; 0 when either is null or 0."""
    a, p = F.col("base_ui_change_amount"), F.col("base_nearest_price")
    ok = a.isNotNull() & (a != 0) & p.isNotNull() & (p != 0)
    return F.when(ok, F.abs(a) * p).otherwise(F.lit(0.0))


def split_transactions(tx: DataFrame, f: TxFilter | None = None) -> tuple[DataFrame, DataFrame]:
    """F5 + M11: (kept, rejected-with-reason). A null type is a rejected row
    (the reference fails the whole wallet on it)."""
    f = f or TxFilter()
    t = F.lower(F.col("tx_type"))
    value = base_value_usd()
    reason = (F.when(F.col("tx_type").isNull(), "missing tx_type")
              .when(~t.isin(*f.include_types), "tx_type not included")
              .when(F.lit(f.min_value_usd > 0) & (value < f.min_value_usd), "below min value"))
    df = tx.withColumns({"tx_type": t, "value_usd": value, "reject_reason": reason})
    return (df.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            df.where(F.col("reject_reason").isNotNull()))


def clean_transactions(tx: DataFrame, f: TxFilter | None = None) -> DataFrame:
    return split_transactions(tx, f)[0]


STR_COLS = ("source", "base_symbol", "base_address", "base_type_swap",
            "quote_symbol", "quote_address", "quote_type_swap")


def transaction_record(tx: DataFrame, fetched_at: Column, batch_id: str,
                       data_source: str = "market_api") -> DataFrame:
    """bronze_transactions row: whale_id = 'whale_' || wallet, missing
    strings as '', fetch metadata."""
    return tx.select(
        F.coalesce("transaction_hash", F.lit("")).alias("transaction_hash"),
        F.concat(F.lit("whale_"), F.col("wallet_address")).alias("whale_id"),
        "wallet_address", "timestamp", F.lower("tx_type").alias("tx_type"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in STR_COLS[:4]],
        "base_ui_change_amount", "base_nearest_price",
        *[F.coalesce(c, F.lit("")).alias(c) for c in STR_COLS[4:]],
        "quote_ui_change_amount", "quote_nearest_price",
        fetched_at.alias("fetched_at"), F.lit(batch_id).alias("batch_id"),
        F.lit(data_source).alias("data_source"),
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> null in float/double columns; other columns untouched."""
    return df.select(*[
        F.when(F.isnan(f.name), F.lit(None).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def with_ingest_metadata(df: DataFrame, now: Column, batch_id: str,
                         flag: str = "silver_processed") -> DataFrame:
    """F8: ingest time, batch id, processing date, processed flag false."""
    return df.withColumns({
        "ingested_at": now, "batch_id": F.lit(batch_id),
        "processing_date": F.to_date(now), flag: F.lit(False),
        f"{flag}_at": F.lit(None).cast("timestamp_ntz"),
    })


def silver_token_record(bronze_tokens: DataFrame, now: Column) -> DataFrame:
    """all unprocessed bronze tokens, score 1.0, reason {criteria, rank},
    holder as integer. Rank follows token address (input order is not
    defined in a distributed table)."""
    src = unprocessed(bronze_tokens, "silver_processed")
    ranked = row_number_ordered(src, [F.col("token_address")], "_rank")
    return ranked.select(
        "token_address",
        F.lit(1.0).alias("selection_score"),
        F.struct(F.lit("all_bronze_tokens").alias("selection_criteria"),
                 F.col("_rank").alias("rank")).alias("selection_reason"),
        now.alias("selected_at"), F.lit(False).alias("whales_processed"),
        F.lit(None).cast("timestamp_ntz").alias("whales_processed_at"),
        "symbol", "name", "market_cap", "price_change_24h_percent", "volume_24h_usd", "liquidity",
        F.col("holder").cast("long").alias("holder_count"), "price",
    )


def ready_wallets(whales: DataFrame) -> DataFrame:
    """not yet PnL-processed and transactions fetched."""
    return whales.where((F.col("pnl_processed") == F.lit(False)) & (F.col("transactions_processed") == F.lit(True)))


def push_eligible(df: DataFrame) -> DataFrame:
    """F13."""
    return df.where(F.col("wallet_address").isNotNull() & (F.col("wallet_address") != ""))


def frequency_cap(df: DataFrame, max_per_day: float = 10.0) -> DataFrame:
    """F14."""
    f = F.col("trade_frequency_per_day")
    return df.where(f.isNull() | (f <= max_per_day))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key by ascending ``order`` (e.g. API rank
    or arrival position), not ``dropDuplicates``, which keeps an arbitrary one.

    ``min_by`` is a partial aggregate: every task reduces its rows to one per
    key before the shuffle, so a hot key (even a third of all rows) costs one
    row per task, not one giant group."""
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*[F.col(c) for c in order])).alias("_first"))
    return agg.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])
