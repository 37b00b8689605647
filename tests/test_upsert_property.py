"""Property test of the keyed upsert against a dictionary model:
insert new keys, overwrite update columns of existing keys, last source row
per key wins, and upserting the same batch twice equals upserting it once."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cairn.operators.incremental import upsert

keys = st.sampled_from(["a", "b", "c", "d", "e", "f"])
target_rows = st.dictionaries(keys, st.tuples(st.integers(0, 9), st.booleans()), max_size=6)
source_rows = st.lists(st.tuples(keys, st.integers(10, 99)), max_size=10)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target_rows, source_rows)
def test_upsert_matches_dictionary_model(spark, tgt, src):
    t = spark.createDataFrame([(k, v, f) for k, (v, f) in tgt.items()], "k string, v int, flag boolean")
    s = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(src)], "k string, v int, seq int")
    model = {k: (v, f) for k, (v, f) in tgt.items()}
    for k, v in src:                       # in source order: the last row per key wins
        model[k] = (v, model[k][1] if k in model else False)
    once = upsert(t, s, ["k"], ["v"], {"flag": False}, source_order=["seq"])
    got = {r.k: (r.v, r.flag) for r in once.collect()}
    assert got == model
    twice = upsert(once, s, ["k"], ["v"], {"flag": False}, source_order=["seq"])
    assert {r.k: (r.v, r.flag) for r in twice.collect()} == model
