"""Property test: FIFO matching equals a queue simulation for generated
ledgers (many ledgers per example, so one Spark job checks them all)."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.operators.fifo import fifo_match
from test_fifo import SCHEMA, rows_for, simulate

event = st.tuples(st.sampled_from(["to", "from", "to", "from", "x"]),
                  st.integers(min_value=1, max_value=50), st.integers(min_value=1, max_value=2000))
ledgers = st.lists(st.lists(event, min_size=1, max_size=25), min_size=1, max_size=30)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ledgers)
def test_fifo_matches_simulation(spark, books):
    rows, expected = [], {}
    for w, book in enumerate(books):
        evs = [(f"h{i:05d}", 0, side, Decimal(q), Decimal(p) / 8) for i, (side, q, p) in enumerate(book)]
        for k, v in simulate(evs).items():
            expected[(f"w{w}",) + k] = v
        rows += rows_for(evs, wallet=f"w{w}")
    got = {(r.wallet_address, r.transaction_hash, r.leg): (r.matched_quantity, r.unmatched_quantity, r.cost_basis)
           for r in fifo_match(spark.createDataFrame(rows, SCHEMA)).where(F.col("side") == "from").collect()}
    assert got == expected
