"""Reports: status counts, distributions, top-k, activity, percentiles, histograms
(A3-A18, W5, L3, L4, U1). All are single aggregations or top-k plans."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.expr import round_half_up


def percentiles(df: DataFrame, columns: dict[str, str], qs=(0.95, 0.80, 0.60), digits: int = 4) -> DataFrame:
    """Exact linear-interpolated quantiles, one row with columns
    <label>_p<q*100>. The ranks floor/ceil((n-1)q) are selected by bucket
    refinement (``functions.selection``): a few jobs run while the plan is
    built, each moving bucket counts only; nothing is sorted and no task holds
    a column. Nulls do not count; NaN is above all numbers."""
    from cairn.functions.scan import cut
    from cairn.functions.selection import order_statistics
    df = cut(df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns.values())]))  # a round reads it once
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    places = {c: [(counts[c] - 1) * q for q in qs] for c in df.columns}
    ranks = {c: sorted({f(h) for h in hs for f in (math.floor, math.ceil)}) for c, hs in places.items() if counts[c]}
    at = order_statistics(df, ranks) if ranks else {}
    out = []
    for (label, _), (c, hs) in zip(columns.items(), places.items()):
        for q, h in zip(qs, hs):
            value = F.lit(None).cast("double")
            if counts[c]:
                lo, hi = at[c, math.floor(h)], at[c, math.ceil(h)]
                value = F.lit(lo) if lo == hi else F.lit(lo + (hi - lo) * (h - math.floor(h)))
            out.append(round_half_up(value, digits).alias(f"{label}_p{int(round(q * 100))}"))
    return df.sparkSession.range(1).select(*out)


def status_counts(df: DataFrame, key: list[str] | str, flags: list[str] = (),
                  times: list[str] = (), names: dict[str, str] | None = None, distinct: list[str] = ()) -> DataFrame:
    """A3: total, distinct key (composite keys joined with ':'), per flag the
    rows true and false, min and max of each time column, further distinct
    counts as scalar subqueries (several in one aggregation would copy every
    row per column)."""
    names = names or {}
    keys = [key] if isinstance(key, str) else list(key)
    kcol = F.col(keys[0]) if len(keys) == 1 else F.concat_ws(":", *keys)
    aggs = [F.count(F.col(keys[0])).alias(names.get("total", "total")),
            F.count_distinct(kcol).alias(names.get("distinct", "distinct_keys"))]
    for f in flags:
        aggs += [F.count_if(F.col(f) == F.lit(True)).alias(f"{f}_true"),
                 F.count_if(F.col(f) == F.lit(False)).alias(f"{f}_false")]
    for t in times:
        aggs += [F.min(t).alias(f"min_{t}"), F.max(t).alias(f"max_{t}")]
    for c in distinct:
        aggs.append(df.select(F.count_distinct(c)).scalar().alias(f"distinct_{c}"))
    return df.agg(*aggs)


def wallet_status(whales: DataFrame) -> DataFrame:
    """A4: five conditional counts over the two wallet flags."""
    tp, pp = F.col("transactions_processed"), F.col("pnl_processed")
    return whales.agg(
        F.count(F.lit(1)).alias("total_whales"),
        F.count_if(tp == F.lit(True)).alias("transactions_done"),
        F.count_if(pp == F.lit(True)).alias("pnl_done"),
        F.count_if((tp == F.lit(True)) & (pp == F.lit(False))).alias("ready_for_pnl"),
        F.count_if(pp == F.lit(False)).alias("pnl_pending"),
    )


def pnl_summary(pnl: DataFrame) -> DataFrame:
    """A5: records, eligible, mean coverage (2 digits), cost-basis method rows."""
    return pnl.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("smart_trader_eligible") == F.lit(True)).alias("smart_traders"),
        round_half_up(F.avg("coverage_ratio_percent"), 2).alias("avg_coverage_ratio"),
        F.count_if(F.col("calculation_method").like("%cost_basis%")).alias("new_method_records"),
    )


def share_of_total(df: DataFrame, by: str, drop_null: bool = False, times: str | None = None) -> DataFrame:
    """Rows per group and their percent of *all* rows (2 digits), also
    when null groups are filtered out (the types report does that). The total
    is a scalar subquery, computed once, not a join."""
    total = df.select(F.count(F.lit(1))).scalar()
    src = df.where(F.col(by).isNotNull()) if drop_null else df
    aggs = [F.count(F.lit(1)).alias("count")]
    if times:
        aggs += [F.min(times).alias("first_seen"), F.max(times).alias("last_seen")]
    g = src.groupBy(by).agg(*aggs)
    return g.withColumn("percentage", round_half_up(F.col("count") * 100.0 / total, 2))


def event_overview(ev: DataFrame) -> DataFrame:
    """Count, five distinct counts, first/last event and ingest times."""
    # one single-column aggregation each: several in one would copy every row per column
    distinct = lambda c: ev.select(F.count_distinct(c)).scalar()
    return ev.agg(
        F.count(F.lit(1)).alias("total_webhooks"),
        distinct("webhook_id").alias("unique_webhooks"),
        distinct("transaction_signature").alias("unique_transactions"),
        distinct("account_address").alias("unique_accounts"),
        distinct("token_address").alias("unique_tokens"),
        distinct("webhook_type").alias("unique_webhook_types"),
        F.min("webhook_timestamp").alias("first_webhook"), F.max("webhook_timestamp").alias("last_webhook"),
        F.min("ingested_at").alias("first_ingested"), F.max("ingested_at").alias("last_ingested"),
    )


def top_activity(ev: DataFrame, key: str, partner: str, n: int = 20) -> DataFrame:
    """A10: per key (non-null): events, distinct types, distinct partners,
    first and last time; top n by events (key breaks ties)."""
    g = ev.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("webhook_count"),
        F.count_distinct("webhook_type").alias("unique_types"),
        F.count_distinct(partner).alias(f"unique_{partner.split('_')[0]}s"),
        F.min("webhook_timestamp").alias("first_seen"), F.max("webhook_timestamp").alias("last_seen"))
    return g.orderBy(F.col("webhook_count").desc(), F.col(key)).limit(n)


def top_activity_of_candidates(ev: DataFrame, key: str, partner: str, n: int = 20) -> DataFrame:
    """A10 for keys of high cardinality: the n busiest keys are found by
    bounded candidates (``functions.selection.top_counts``), and only their
    rows are shuffled for the distinct counts and times."""
    from cairn.functions.selection import top_counts
    busiest = top_counts(ev, key, n).select(key)  # n rows
    return top_activity(ev.join(F.broadcast(busiest), key, "left_semi"), key, partner, n)


def daily_activity(ev: DataFrame, days: int = 14) -> DataFrame:
    """Per calendar date, latest ``days`` dates."""
    g = ev.where(F.col("webhook_timestamp").isNotNull()).groupBy(
        F.to_date("webhook_timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("webhook_count"),
        F.count_distinct("account_address").alias("unique_accounts"),
        F.count_distinct("token_address").alias("unique_tokens"),
        F.count_distinct("webhook_type").alias("unique_types"))
    return g.orderBy(F.col("date").desc()).limit(days)


def hourly_pattern(ev: DataFrame) -> DataFrame:
    """Per hour of day: events, distinct accounts, and the mean events per
    hour over all hours (a window over at most 24 grouped rows)."""
    g = ev.where(F.col("webhook_timestamp").isNotNull()).groupBy(
        F.hour("webhook_timestamp").alias("hour")).agg(
        F.count(F.lit(1)).alias("webhook_count"),
        F.count_distinct("account_address").alias("unique_accounts"))
    return g.withColumn("avg_per_hour", F.avg("webhook_count").over(Window.partitionBy()))


def symbol_holdings(holders: DataFrame) -> DataFrame:
    """Per symbol: distinct wallets and mean holding."""
    return holders.groupBy("token_symbol").agg(
        F.count_distinct("wallet_address").alias("unique_whales"),
        F.avg("ui_amount").alias("avg_holding"))


def value_counts_top(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """Top n values of a column, nulls dropped; value breaks ties."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(column)).limit(n))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between min and max of the non-null values, the
    last bin closed. min/max are scalar subqueries (evaluated once)."""
    x = F.col(column).cast("double")
    vals = df.where(F.col(column).isNotNull())
    lo = vals.select(F.min(x)).scalar()
    hi = vals.select(F.max(x)).scalar()
    width = (hi - lo) / bins
    idx = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((x - lo) * bins / (hi - lo)), F.lit(bins - 1))).cast("int")
    g = vals.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return g.select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_end"), "count")


def layer_overview(tables: dict[str, DataFrame]) -> DataFrame:
    """One row count per named table, stacked with unionByName."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def recent_events(ev: DataFrame, n: int = 10) -> DataFrame:
    """L3: newest n by ingest time (id breaks ties)."""
    return (ev.orderBy(F.col("ingested_at").desc_nulls_last(), F.col("webhook_id").desc())
            .limit(n).select("webhook_id", "webhook_type", "transaction_signature", "account_address",
                             "token_address", "webhook_timestamp", "ingested_at", "processing_status"))


def sample_payload(ev: DataFrame) -> DataFrame:
    """L4: the newest event with a non-empty payload."""
    return (ev.where(F.col("raw_payload").isNotNull() & (F.col("raw_payload") != "{}"))
            .orderBy(F.col("ingested_at").desc_nulls_last(), F.col("webhook_id").desc()).limit(1)
            .select("webhook_id", "webhook_type", "transaction_signature", "account_address",
                    "token_address", "raw_payload"))


def _pct_text(n, total) -> F.Column:
    return F.format_string("%.2f%%", round_half_up(n * 100.0 / total, 2))


def quality_report(ev: DataFrame) -> DataFrame:
    """Q1 (+U1): total and missing-field counts with percent text, in one
    aggregation turned into labelled rows with ``stack``."""
    a = ev.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("transaction_signature").isNull()).alias("no_sig"),
        F.count_if(F.col("account_address").isNull()).alias("no_account"),
        F.count_if(F.col("token_address").isNull()).alias("no_token"),
        F.count_if(F.col("raw_payload").isNull() | (F.col("raw_payload") == "{}")).alias("no_payload"))
    t = F.col("total")
    a = a.select("*", _pct_text(F.col("no_sig"), t).alias("p_sig"),
                 _pct_text(F.col("no_account"), t).alias("p_acc"),
                 _pct_text(F.col("no_token"), t).alias("p_tok"),
                 _pct_text(F.col("no_payload"), t).alias("p_pay"))
    return a.select(F.expr(
        "stack(5, 'Total Records', total, 'N/A', "
        "'Missing Transaction Signature', no_sig, p_sig, "
        "'Missing Account Address', no_account, p_acc, "
        "'Missing Token Address', no_token, p_tok, "
        "'Empty Raw Payload', no_payload, p_pay) AS (metric, count, percentage)"))


def health_report(ev: DataFrame, now) -> DataFrame:
    """Q2: events ingested in the last hour / day, failed, pending, and mean
    ingest delay in seconds over the last day (2 digits)."""
    ing = F.col("ingested_at")
    h1 = now - F.make_dt_interval(F.lit(0), F.lit(1))
    d1 = now - F.make_dt_interval(F.lit(1))
    delay = F.timestamp_diff("MICROSECOND", F.col("webhook_timestamp"), ing) / 1e6
    a = ev.agg(
        F.count_if(ing >= h1).cast("double").alias("h1"),
        F.count_if(ing >= d1).cast("double").alias("d1"),
        F.count_if(F.col("processing_status") == "failed").cast("double").alias("failed"),
        F.count_if(F.col("processing_status") == "pending").cast("double").alias("pending"),
        round_half_up(F.avg(F.when(F.col("webhook_timestamp").isNotNull() & (ing >= d1), delay)), 2)
        .alias("delay"))
    return a.select(F.expr(
        "stack(5, 'Webhooks in last hour', h1, 'Webhooks in last 24 hours', d1, "
        "'Failed processing count', failed, 'Pending processing count', pending, "
        "'Average ingestion delay (seconds)', delay) AS (metric, value)"))


def null_percentage_check(df: DataFrame, table: str, columns: list[str], max_pct: float = 10.0) -> DataFrame:
    """Q3: one data_quality_checks row per column: null percent vs threshold."""
    a = df.agg(F.count(F.lit(1)).alias("n"),
               *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])
    rows = None
    for c in columns:
        pct = F.when(F.col("n") > 0, F.col(f"null_{c}") * 100.0 / F.col("n")).otherwise(0.0)
        r = a.select(F.lit(table).alias("table_name"), F.lit("null_percentage").alias("check_type"),
                     F.lit(c).alias("column_name"), (pct <= max_pct).alias("passed"),
                     F.lit(float(max_pct)).alias("threshold"), round_half_up(pct, 4).alias("actual_value"),
                     F.col("n").alias("records_checked"), F.col(f"null_{c}").alias("violations_found"))
        rows = r if rows is None else rows.unionByName(r)
    return rows


def duplicate_percentage_check(df: DataFrame, table: str, key: list[str], max_pct: float = 5.0) -> DataFrame:
    """Q3: rows beyond the first per key, as a percent of all rows."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("c"))
    a = per_key.agg(F.sum("c").alias("n"), F.sum(F.col("c") - 1).alias("dups"))
    pct = F.when(F.col("n") > 0, F.col("dups") * 100.0 / F.col("n")).otherwise(0.0)
    return a.select(F.lit(table).alias("table_name"), F.lit("duplicate_percentage").alias("check_type"),
                    F.lit(",".join(key)).alias("column_name"), (pct <= max_pct).alias("passed"),
                    F.lit(float(max_pct)).alias("threshold"), round_half_up(pct, 4).alias("actual_value"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("records_checked"),
                    F.coalesce(F.col("dups"), F.lit(0)).cast("long").alias("violations_found"))


# ------------------------------------------------------- tracking integrity
def tracking_overview(whales: DataFrame, pnl: DataFrame) -> DataFrame:
    """Whales left-joined with PnL records, distinct counts both ways."""
    # one row per wallet first (partial aggregation), then plain counts
    one = (whales.where(F.col("wallet_address").isNotNull()).groupBy("wallet_address")
           .agg(F.max(F.coalesce("pnl_processed", F.lit(False))).alias("yes"),
                F.max(F.coalesce(~F.col("pnl_processed"), F.lit(False))).alias("no")))
    p = pnl.select("wallet_address").distinct().withColumn("has", F.lit(True))
    j = one.join(p, "wallet_address", "left")
    has = F.col("has").isNotNull()
    return j.agg(
        F.count(F.lit(1)).alias("total_whales"),
        F.count_if("yes").alias("marked_processed"),
        F.count_if("no").alias("marked_unprocessed"),
        F.count_if(has).alias("actual_pnl_records"),
        F.count_if(F.col("yes") & ~has).alias("marked_but_no_pnl"),
        F.count_if(F.col("no") & has).alias("unmarked_but_has_pnl"),
    )


def processed_without_record(whales: DataFrame, pnl: DataFrame) -> DataFrame:
    """Flagged as processed but no PnL record."""
    return whales.where(F.col("pnl_processed") == F.lit(True)).join(
        pnl.select("wallet_address"), "wallet_address", "left_anti")


def tracking_mismatches(whales: DataFrame, pnl: DataFrame) -> DataFrame:
    """Flagged without record or record without flag, with a YES/NO column."""
    p = pnl.select("wallet_address").distinct().withColumn("_has", F.lit(True))
    j = whales.join(p, "wallet_address", "left")
    has = F.col("_has").isNotNull()
    pp = F.col("pnl_processed")
    return j.where(((pp == F.lit(True)) & ~has) | ((pp == F.lit(False)) & has)).select(
        "wallet_address", "pnl_processed", "transactions_processed",
        F.when(has, "YES").otherwise("NO").alias("has_pnl_record"))


def flags_breakdown(whales: DataFrame, pnl: DataFrame) -> DataFrame:
    """By the two flags, distinct whales and distinct PnL records."""
    p = pnl.select(F.col("wallet_address").alias("pnl_wallet")).distinct()
    j = whales.join(p, whales.wallet_address == p.pnl_wallet, "left")
    return j.groupBy("pnl_processed", "transactions_processed").agg(
        F.count_distinct("wallet_address").alias("whale_count"),
        F.count_distinct("pnl_wallet").alias("pnl_record_count"))


def mismatch_tx_buckets(whales: DataFrame, pnl: DataFrame, transactions: DataFrame) -> DataFrame:
    """Whales flagged without a record, bucketed by how many
    transactions they have (0 / 1-4 / 5+)."""
    miss = processed_without_record(whales, pnl).select("wallet_address")
    txc = transactions.groupBy("wallet_address").agg(F.count("transaction_hash").alias("tx_count"))
    c = miss.join(txc, "wallet_address", "left").withColumn("tx_count", F.coalesce("tx_count", F.lit(0)))
    bucket = (F.when(F.col("tx_count") == 0, "0 transactions")
              .when(F.col("tx_count").between(1, 4), "1-4 transactions")
              .when(F.col("tx_count") >= 5, "5+ transactions"))
    return c.groupBy(bucket.alias("transaction_range")).agg(F.count(F.lit(1)).alias("whale_count"))


def token_holder_counts(tokens: DataFrame, holders: DataFrame) -> DataFrame:
    """Every token with its holder-row count (0 when none)."""
    h = holders.groupBy("token_address").agg(F.count("wallet_address").alias("whale_count"))
    j = tokens.select("token_address", "symbol", "market_cap", "price_change_24h_percent") \
        .join(h, "token_address", "left")
    return j.withColumn("whale_count", F.coalesce("whale_count", F.lit(0)))
