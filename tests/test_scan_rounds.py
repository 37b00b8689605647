"""How often hot wallets are sliced, and that a task's share of the legs is bounded."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from cairn.functions import scan
from cairn.operators import fifo
from cairn.operators.fifo_lots import fifo_lots

SCHEMA = ("wallet_address string, token_address string, token_symbol string, timestamp timestamp_ntz, transaction_hash string, "
          "leg int, side string, quantity decimal(18,0), price decimal(18,2)")


@pytest.fixture()
def legs(spark):
    at = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(f"w{i % 7}", f"t{i % 3}", "S", at + dt.timedelta(minutes=i * 37 % 101), f"x{i:03}", 0,
                                   "from" if i % 5 > 2 else "to", Decimal(1 + i % 9), Decimal(10 + i % 13)) for i in range(120)], SCHEMA)


def test_one_order_is_sliced_once(legs, monkeypatch):
    cuts = []
    was = scan.range_slices
    monkeypatch.setattr(scan, "range_slices", lambda *a: cuts.append(1) or was(*a))
    matched = fifo.fifo_match(legs, ranged=True, slices=3)
    assert len(cuts) == 2  # event order, lot order
    lots = fifo_lots(matched, ranged=True, slices=3)
    assert len(cuts) == 3
    assert sorted(map(tuple, lots.collect())) == sorted(map(tuple, fifo_lots(fifo.fifo_match(legs)).collect()))


def test_partitions_follow_the_number_of_legs(legs, monkeypatch):
    monkeypatch.setattr(fifo, "LEGS_PER_TASK", 4)
    least = int(legs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    assert max(least, 30) > least
    out = fifo.fifo_split(legs)
    assert out.rdd.getNumPartitions() == 30
    monkeypatch.setattr(fifo, "LEGS_PER_TASK", 1_000)
    assert sorted(map(str, out.collect())) == sorted(map(str, fifo.fifo_split(legs).collect()))
