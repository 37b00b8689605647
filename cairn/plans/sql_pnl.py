"""DuckDB oracle text for the FIFO / PnL family.

Independent of the Spark implementation where it matters: the matched cost
of a sell is an interval-overlap join of its consumed range (M_prev, M]
against the lot ranges (B - q, B], not the F(x) window lookup."""

from __future__ import annotations

from cairn.functions.expr import sql_round as R
from cairn.plans.fixtures import SWAPS_FX_SQL, TRADES_FX_SQL

ORDER = '"timestamp", transaction_hash, leg'

# FIFO over any CTE named `legs_in` (wallet_address, token_address, timestamp,
# transaction_hash, leg, side, quantity, price). Produces `tr` (one row per
# buy/sell with pnl, cost, flags).
FIFO_CTES = f"""
ev AS (
  SELECT wallet_address, token_address, token_symbol, "timestamp", transaction_hash, leg, side,
         quantity, price,
         CASE WHEN side = 'to' THEN quantity ELSE 0 END AS bq,
         CASE WHEN side = 'from' THEN quantity ELSE 0 END AS sq
  FROM legs_in WHERE side IN ('to', 'from')),
r1 AS (
  SELECT *, SUM(bq) OVER w AS b, SUM(sq) OVER w AS s FROM ev
  WINDOW w AS (PARTITION BY wallet_address, token_address ORDER BY {ORDER}
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
r2 AS (
  SELECT *, s - GREATEST(0, -MIN(b - s) OVER w) AS m FROM r1
  WINDOW w AS (PARTITION BY wallet_address, token_address ORDER BY {ORDER}
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
r3 AS (
  SELECT *, COALESCE(LAG(m) OVER (PARTITION BY wallet_address, token_address ORDER BY {ORDER}), 0) AS m_prev
  FROM r2),
lots AS (SELECT wallet_address, token_address, b - quantity AS lo, b AS hi, price FROM r3 WHERE side = 'to'),
sc AS (
  SELECT s.wallet_address, s.token_address, s.transaction_hash, s.leg,
         SUM((LEAST(s.m, l.hi) - GREATEST(s.m_prev, l.lo)) * l.price) AS cost
  FROM r3 s JOIN lots l
    ON s.wallet_address = l.wallet_address AND s.token_address = l.token_address
   AND l.lo < s.m AND l.hi > s.m_prev
  WHERE s.side = 'from'
  GROUP BY s.wallet_address, s.token_address, s.transaction_hash, s.leg),
t1 AS (
  SELECT r3.*,
         CASE WHEN side = 'from' THEN m - m_prev ELSE 0 END AS mq,
         CASE WHEN side = 'from' THEN quantity - (m - m_prev) ELSE 0 END AS uq,
         COALESCE(sc.cost, 0) AS cost
  FROM r3 LEFT JOIN sc USING (wallet_address, token_address, transaction_hash, leg)),
t2 AS (
  SELECT *, mq * price - cost AS pnl, mq > 0 AS is_matched, uq > 0 AS is_unmatched,
         CASE WHEN side = 'to' THEN quantity * price ELSE 0 END AS pv,
         CASE WHEN side = 'from' THEN quantity * price ELSE 0 END AS sv,
         mq * price AS mp, uq * price AS up
  FROM t1),
tr AS (
  SELECT *, is_matched AND pnl >= 50 AS is_win, is_matched AND pnl <= -50 AS is_loss,
         CASE WHEN is_matched AND cost > 0
              THEN CAST(pnl AS DOUBLE) / CAST(cost AS DOUBLE) * 100 END AS roi
  FROM t2)"""


def _div(n: str, d: str) -> str:
    return f"(CASE WHEN ({d}) IS NULL OR ({d}) = 0 THEN 0.0 ELSE CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END)"


def wallet_metrics_sql(span_cte: str) -> str:
    """Metrics over `tr` and a `span` CTE (wallet_address, first_trade_at, last_trade_at)."""
    return f""",
dd AS (
  SELECT wallet_address,
         MAX(CASE WHEN is_matched AND peak > 0 THEN CAST(peak - cum AS DOUBLE) / CAST(peak AS DOUBLE) END) AS max_dd
  FROM (SELECT *, GREATEST(0, MAX(cum) OVER w2) AS peak
        FROM (SELECT *, SUM(CASE WHEN is_matched THEN pnl ELSE 0 END) OVER w1 AS cum FROM tr
              WINDOW w1 AS (PARTITION BY wallet_address ORDER BY {ORDER}
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) x
        WINDOW w2 AS (PARTITION BY wallet_address ORDER BY {ORDER}
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) y
  GROUP BY wallet_address),
med AS (
  SELECT wallet_address, AVG(roi) AS median_roi
  FROM (SELECT wallet_address, roi,
               ROW_NUMBER() OVER (PARTITION BY wallet_address ORDER BY roi) AS rn,
               COUNT(*) OVER (PARTITION BY wallet_address) AS n
        FROM tr WHERE roi IS NOT NULL) z
  WHERE rn IN ((n + 1) // 2, (n + 2) // 2)
  GROUP BY wallet_address),
agg AS (
  SELECT wallet_address,
         SUM(pnl) AS pnl, COUNT(*) FILTER (WHERE is_matched) AS matched, COUNT(*) FILTER (WHERE is_unmatched) AS unmatched,
         COUNT(*) FILTER (WHERE is_win) AS win, COUNT(*) FILTER (WHERE is_loss) AS loss,
         SUM(CASE WHEN is_win THEN pnl END) AS win_pnl, SUM(CASE WHEN is_loss THEN pnl END) AS loss_pnl,
         SUM(pv) AS pv, SUM(mp) AS mp, SUM(up) AS up, SUM(sv) AS sv, SUM(cost) AS cost,
         AVG(roi) AS avg_roi,
         AVG(CASE WHEN is_matched THEN CAST(pnl AS DOUBLE) END) AS mean_pnl,
         STDDEV_POP(CASE WHEN is_matched THEN CAST(pnl AS DOUBLE) END) AS sd_pnl,
         COUNT(DISTINCT token_address) AS ntok
  FROM tr GROUP BY wallet_address),
{span_cte},
w0 AS (
  SELECT span.wallet_address, span.first_trade_at, span.last_trade_at,
         COALESCE(pnl, 0) AS pnl, COALESCE(matched, 0) AS matched, COALESCE(unmatched, 0) AS unmatched,
         COALESCE(win, 0) AS win, COALESCE(loss, 0) AS loss,
         COALESCE(win_pnl, 0) AS win_pnl, COALESCE(loss_pnl, 0) AS loss_pnl,
         COALESCE(pv, 0) AS pv, COALESCE(mp, 0) AS mp, COALESCE(up, 0) AS up, COALESCE(sv, 0) AS sv,
         COALESCE(cost, 0) AS cost, COALESCE(avg_roi, 0.0) AS avg_roi,
         COALESCE(median_roi, 0.0) AS median_roi, COALESCE(max_dd, 0.0) AS max_dd,
         mean_pnl, sd_pnl, COALESCE(ntok, 0) AS ntok,
         CASE WHEN span.first_trade_at IS NOT NULL AND span.last_trade_at IS NOT NULL
              THEN date_diff('microsecond', span.first_trade_at, span.last_trade_at) // 86400000000 + 1
              ELSE 0 END AS days
  FROM span LEFT JOIN agg USING (wallet_address) LEFT JOIN dd USING (wallet_address)
       LEFT JOIN med USING (wallet_address)),
w1 AS (
  SELECT *, {_div('win', 'win + loss')} * 100 AS win_rate,
         {_div('matched', 'matched + unmatched')} * 100 AS coverage,
         {_div('matched', 'days')} AS freq,
         CASE WHEN cost > 0 THEN CAST(pnl AS DOUBLE) / CAST(cost AS DOUBLE) * 100 ELSE 0.0 END AS roi,
         pv + sv AS volume
  FROM w0),
w2 AS (
  SELECT *, CASE WHEN matched > 1 AND sd_pnl > 0 THEN mean_pnl / sd_pnl ELSE 0.0 END AS sharpe,
         (win + loss) >= 5 AND coverage >= 70 AND win_rate >= 60 AND pnl > 500 AND roi >= 20 AND days >= 2
           AS eligible
  FROM w1)
SELECT wallet_address,
       CAST(ROUND(pnl, 2) AS DOUBLE) AS total_realized_pnl_usd,
       0.0::DOUBLE AS total_unrealized_pnl_usd,
       {R('win_rate', 2)} AS win_rate_percent,
       {R(_div('win_pnl', 'win'), 2)} AS avg_win_usd,
       {R(_div('ABS(loss_pnl)', 'loss'), 2)} AS avg_loss_usd,
       {R('freq', 3)} AS trade_frequency_per_day,
       CAST(matched + unmatched AS BIGINT) AS total_trades,
       CAST(matched AS BIGINT) AS matched_trades,
       CAST(unmatched AS BIGINT) AS unmatched_trades,
       CAST(win + loss AS BIGINT) AS meaningful_trades,
       CAST(matched - win - loss AS BIGINT) AS neutral_trades,
       {R('coverage', 2)} AS coverage_ratio_percent,
       CAST(win AS BIGINT) AS winning_trades,
       CAST(loss AS BIGINT) AS losing_trades,
       CAST(ntok AS BIGINT) AS tokens_traded_count,
       CAST(ROUND(volume, 2) AS DOUBLE) AS total_volume_usd,
       CAST(ROUND(pv + mp, 2) AS DOUBLE) AS matched_volume_usd,
       CAST(ROUND(up, 2) AS DOUBLE) AS unmatched_volume_usd,
       {R(_div('pv + mp', 'matched * 2'), 2)} AS avg_trade_size_usd,
       CAST(ROUND(cost, 2) AS DOUBLE) AS matched_cost_basis_usd,
       {R('roi', 2)} AS total_roi_percent,
       {R('avg_roi', 2)} AS avg_roi_percent,
       {R('median_roi', 2)} AS median_roi_percent,
       first_trade_at, last_trade_at,
       CAST(days AS BIGINT) AS trading_days,
       {R('max_dd * 100', 2)} AS max_drawdown_percent,
       {R('sharpe', 3)} AS sharpe_ratio,
       eligible AS smart_trader_eligible,
       {R('''CASE WHEN eligible AND volume > 0 THEN
            LEAST(GREATEST(CAST(pnl AS DOUBLE) / 5000, 0.0), 1.0) * 0.25
          + LEAST(GREATEST(roi / 200, 0.0), 1.0) * 0.25
          + LEAST(win_rate / 100, 1.0) * 0.20
          + LEAST(CAST(volume AS DOUBLE) / 50000, 1.0) * 0.15
          + LEAST(freq / 10, 1.0) * 0.10
          + LEAST(GREATEST(sharpe / 3, 0.0), 1.0) * 0.05 ELSE 0.0 END''', 4)} AS smart_trader_score,
       'fifo_cost_basis_matched_min50' AS calculation_method
FROM w2"""


TRADES_SPAN = """span AS (
  SELECT wallet_address, MIN("timestamp") AS first_trade_at, MAX("timestamp") AS last_trade_at
  FROM trades_fx GROUP BY wallet_address HAVING COUNT(*) >= 2)"""

WALLET_PNL_SQL = ("WITH " + TRADES_FX_SQL + ",\nlegs_in AS (SELECT * FROM trades_fx),"
                  + FIFO_CTES + wallet_metrics_sql(TRADES_SPAN))

FIFO_MATCH_SQL = ("WITH " + TRADES_FX_SQL + ",\nlegs_in AS (SELECT * FROM trades_fx)," + FIFO_CTES + """
SELECT wallet_address, token_address, transaction_hash, leg, "timestamp",
       CAST(quantity AS DOUBLE) AS quantity, CAST(price AS DOUBLE) AS price,
       CAST(mq AS DOUBLE) AS matched_quantity, CAST(uq AS DOUBLE) AS unmatched_quantity,
       CAST(ROUND(cost, 6) AS DOUBLE) AS cost_basis, CAST(ROUND(pnl, 6) AS DOUBLE) AS pnl,
       is_win, is_loss
FROM tr WHERE side = 'from'""")

POSITIONS_SQL = ("WITH " + TRADES_FX_SQL + ",\nlegs_in AS (SELECT * FROM trades_fx)," + FIFO_CTES + f"""
SELECT wallet_address, token_address,
       arg_min(token_symbol, ("timestamp", transaction_hash, leg)) AS token_symbol,
       CAST(ROUND(SUM(pnl), 2) AS DOUBLE) AS realized_pnl,
       CAST(COUNT(*) FILTER (WHERE is_matched) AS BIGINT) AS matched_trades,
       CAST(COUNT(*) FILTER (WHERE is_unmatched) AS BIGINT) AS unmatched_trades,
       CAST(ROUND(SUM(pv), 2) AS DOUBLE) AS purchase_volume,
       CAST(ROUND(SUM(mp), 2) AS DOUBLE) AS matched_sale_volume,
       CAST(ROUND(SUM(up), 2) AS DOUBLE) AS unmatched_sale_volume,
       CAST(ROUND(SUM(cost), 2) AS DOUBLE) AS matched_cost_basis,
       {R(_div('SUM(pnl)', 'SUM(cost)') + ' * 100', 2)} AS roi_percent,
       {R('COALESCE(AVG(roi), 0.0)', 2)} AS avg_trade_roi,
       (COUNT(*) FILTER (WHERE is_matched) > 0 OR COUNT(*) FILTER (WHERE is_unmatched) > 0 OR ABS(SUM(pnl)) > 1) AS is_listed
FROM tr GROUP BY wallet_address, token_address""")


# Oracle-side decimal scales only need to be exact for the fixture values
# (at most 2 decimals); DuckDB refuses products beyond scale 38.
SWAP_LEGS_SQL = """legs_raw AS (
  SELECT wallet_address, transaction_hash, "timestamp", 0 AS leg, base_address AS token_address,
         CASE WHEN base_symbol IS NULL OR base_symbol = '' THEN substr(base_address, 1, 8) ELSE base_symbol END
           AS token_symbol, base_type_swap AS side, base_ui_change_amount AS amount, base_nearest_price AS px
  FROM swaps_fx
  UNION ALL
  SELECT wallet_address, transaction_hash, "timestamp", 1, quote_address,
         CASE WHEN quote_symbol IS NULL OR quote_symbol = '' THEN substr(quote_address, 1, 8) ELSE quote_symbol END,
         quote_type_swap, quote_ui_change_amount, quote_nearest_price
  FROM swaps_fx),
legs_in AS (
  SELECT wallet_address, token_address, token_symbol, "timestamp", transaction_hash, leg, side,
         CAST(abs(amount) AS DECIMAL(28,4)) AS quantity, CAST(px AS DECIMAL(24,4)) AS price
  FROM legs_raw
  WHERE token_address IS NOT NULL AND token_address <> '' AND amount IS NOT NULL AND amount <> 0
    AND NOT isnan(amount) AND px IS NOT NULL AND NOT isnan(px) AND px > 0)"""

SWAPS_SPAN = """span AS (
  SELECT wallet_address, MIN("timestamp") AS first_trade_at, MAX("timestamp") AS last_trade_at
  FROM swaps_fx GROUP BY wallet_address HAVING COUNT(*) >= 2)"""

WALLET_PNL_SWAPS_SQL = ("WITH " + SWAPS_FX_SQL + ",\n" + SWAP_LEGS_SQL + "," + FIFO_CTES
                        + wallet_metrics_sql(SWAPS_SPAN))
