"""Registered queries of the lot-level FIFO matches (J9); the SQL is the overlap join itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.plans import fixtures as fx
from cairn.plans.registry import register
from cairn.plans.sql_pnl import FIFO_CTES

_PAIRS = "WITH " + fx.TRADES_FX_SQL + ",\nlegs_in AS (SELECT * FROM trades_fx)," + FIFO_CTES + """,
pairs AS (
  SELECT s.wallet_address, s.token_address, s."timestamp" AS sell_timestamp, s.transaction_hash AS sell_transaction_hash, s.leg AS sell_leg,
         l."timestamp" AS lot_timestamp, l.transaction_hash AS lot_transaction_hash, l.leg AS lot_leg,
         LEAST(s.m, l.b) - GREATEST(s.m_prev, l.b - l.quantity) AS quantity, s.price AS sell_price, l.price AS lot_price
  FROM r3 s JOIN r3 l ON s.wallet_address = l.wallet_address AND s.token_address = l.token_address
   AND l.side = 'to' AND s.side = 'from' AND l.b - l.quantity < s.m AND l.b > s.m_prev)
"""
LOTS_SQL = _PAIRS + """
SELECT wallet_address, token_address, sell_transaction_hash, sell_leg, sell_timestamp, lot_transaction_hash, lot_leg, lot_timestamp,
       CAST(quantity AS DOUBLE) AS quantity, CAST(quantity * lot_price AS DOUBLE) AS cost, CAST(quantity * sell_price AS DOUBLE) AS proceeds,
       CAST(quantity * sell_price - quantity * lot_price AS DOUBLE) AS pnl
FROM pairs"""


def _shown(lots):
    return lots.select("wallet_address", "token_address", "sell_transaction_hash", "sell_leg", "sell_timestamp",
                       "lot_transaction_hash", "lot_leg", "lot_timestamp", *[F.col(c).cast("double").alias(c) for c in ("quantity", "cost", "proceeds", "pnl")])


@register("fifo_lots", LOTS_SQL)
def q_fifo_lots(spark, sf_dir):
    from cairn.operators.fifo_lots import fifo_lots_split
    return _shown(fifo_lots_split(fx.trades_fx(spark, sf_dir)))


@register("fifo_lots_hot", LOTS_SQL)
def q_fifo_lots_hot(spark, sf_dir):
    from cairn.operators.fifo_lots import fifo_lots_split
    return _shown(fifo_lots_split(fx.trades_fx(spark, sf_dir), hot_threshold=0))


@register("holding_periods", _PAIRS + """
SELECT wallet_address, token_address, COUNT(*) AS matches, COUNT(DISTINCT (sell_timestamp, sell_transaction_hash, sell_leg)) AS sells,
       CAST(SUM(quantity) AS DOUBLE) AS quantity, MIN(held) AS min_held_seconds, MAX(held) AS max_held_seconds,
       CAST(SUM(quantity * held) AS DOUBLE) / CAST(SUM(quantity) AS DOUBLE) AS avg_held_seconds
FROM (SELECT *, (epoch_us(sell_timestamp) - epoch_us(lot_timestamp)) // 1000000 AS held FROM pairs) x
GROUP BY wallet_address, token_address""")
def q_holding_periods(spark, sf_dir):
    from cairn.operators.fifo_lots import fifo_lots_split, holding_periods
    return holding_periods(fifo_lots_split(fx.trades_fx(spark, sf_dir)))
