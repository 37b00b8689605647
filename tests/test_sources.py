"""JSON pages and pushed events: edge cases of FIXTURES.md §4."""

from pyspark.sql import functions as F

from cairn.sources import json_pages as jp


def pages(spark, docs):
    return spark.createDataFrame([(d,) for d in docs], "value string")


def test_token_page_success_false_and_empty_address(spark):
    docs = ['{"success": false, "data": {"tokens": [{"address": "A"}]}}',
            '{"success": true, "data": {"items": [{"address": "B", "liquidity": "12.5"}, {"address": ""},'
            ' {"address": "C", "liquidity": "bad", "extensions": {"website": "w"}}]}}',
            '{"data": {"tokens": [{"address": "D", "holder": 7}]}}',
            '{"success": true}']
    rows = {r.token_address: r for r in jp.normalize_tokens(pages(spark, docs)).collect()}
    assert set(rows) == {"B", "C", "D"}
    assert rows["B"].liquidity == 12.5 and rows["C"].liquidity is None
    assert rows["C"].website == "w" and rows["B"].website is None
    assert rows["D"].holder == 7


def test_holder_rank_counts_dropped_rows(spark):
    docs = ['{"success": true, "data": {"items": [{"owner": "a", "ui_amount": 2}, {"owner": ""},'
            ' {"owner": "c"}]}}']
    rows = {r.wallet_address: r for r in jp.normalize_holders(pages(spark, docs)).collect()}
    assert rows["a"].rank == 1 and rows["c"].rank == 3
    assert rows["c"].ui_amount == 0.0 and rows["c"].decimals == 9


def test_transaction_shapes(spark):
    item = '{"tx_hash": "%s", "block_unix_time": %d, "owner": "o", "base": {"address": "x"}}'
    docs = ['{"data": [%s]}' % (item % ("h1", 0)),
            '{"data": {"items": [%s]}}' % (item % ("h2", 60)),
            '{"data": {"trades": [%s, %s]}}' % (item % ("h3", 120), item % ("", 1))]
    tx = {r.transaction_hash for r in jp.normalize_transactions(pages(spark, docs)).collect()}
    assert tx == {"h1", "h2", "h3"}
    seek = {r.transaction_hash: r.timestamp for r in jp.normalize_seek_by_time(pages(spark, docs)).collect()}
    assert seek["h1"] is None and str(seek["h2"]) == "1970-01-01 00:01:00"


def test_event_payload_edge_cases(spark):
    docs = ["{}", "[]", "[{}]", "not json",
            '[{"signature": "s", "type": "SWAP", "accountData": [{"account": "a"}], "tokenTransfers": [{"mint": "m"}]}]',
            '[{"signature": "s2"}]']
    df = pages(spark, docs).select("value", *jp.extract_event(F.col("value")))
    got = {r.value: (r.transaction_signature, r.webhook_type, r.account_address, r.token_address)
           for r in df.collect()}
    for d in docs[:4]:
        assert got[d] == (None, "UNKNOWN", None, None)
    assert got[docs[4]] == ("s", "SWAP", "a", "m")
    assert got[docs[5]] == ("s2", "UNKNOWN", None, None)


def test_read_json_drop_sets_bad_files_aside(spark):
    import os
    import tempfile
    d = tempfile.mkdtemp(prefix="cairn-drop-")
    for i, body in enumerate(['[{"signature": "a"}]', "{broken", '{"x": 1}', "not json"]):
        with open(os.path.join(d, f"e{i}.json"), "w") as f:
            f.write(body)
    ok, bad = jp.read_json_drop(spark, d)
    assert (ok.count(), bad.count()) == (2, 2)
    seen = ok.select("file").unionByName(bad.select("file"))
    done = spark.createDataFrame(seen.collect(), "file string")
    with open(os.path.join(d, "late.json"), "w") as f:
        f.write('{"late": 1}')
    ok, bad = jp.read_json_drop(spark, d, done)   # only what earlier calls have not seen
    assert [r.value for r in ok.collect()] == ['{"late": 1}'] and bad.count() == 0
