"""Quarantine of landed pages and payloads, and the VARIANT sources, on hand-written documents."""

import json

import pytest
from pyspark.sql import functions as F

from cairn.sources import json_pages as jp
from cairn.sources import quarantine as qu
from cairn.sources import variant_pages as vp

TOKENS = ['{"success":true,"data":{"tokens":[{"address":"a","price":"1.5","holder":"x"},{"address":""},null,{"name":"n"}]}}',
          '{"data":{"items":[{"address":"b"}]}}', '{"success":false,"data":{"tokens":[{"address":"c"}]}}', '{"success":true}', '{"data":{"x":1}}',
          '{"data":{"tokens":[]}}', '{"data":{"tokens":[{"address"', "", None, "[1,2]", "7"]


def pages(spark, docs):
    return spark.createDataFrame(list(enumerate(docs)), "page int, value string")


def test_token_rejects(spark):
    checked = qu.checked_tokens(pages(spark, TOKENS))
    got = {(r["page"], r["level"], r["pos"]): r["reason"] for r in qu.rejects(checked).collect()}
    assert got == {(0, "item", 1): "no address", (0, "item", 2): "no object", (0, "item", 3): "no address", (2, "page", None): "unsuccessful page",
                   (3, "page", None): "no data", (4, "page", None): "no list", (6, "page", None): "malformed document",
                   (7, "page", None): "empty document", (8, "page", None): "empty document", (9, "page", None): "malformed document", (10, "page", None): "malformed document"}
    raw = {(r["page"], r["pos"]): r["raw"] for r in qu.rejects(checked).collect()}
    assert raw[6, None] == TOKENS[6] and json.loads(raw[0, 3]) == {"name": "n"}
    assert [r["bad_fields"] for r in checked.where("reason IS NULL AND page = 0").collect()] == [["holder"]]


def test_accepted_rows_are_the_normalised_ones(spark):
    for check, normalise, docs in ((qu.checked_tokens, jp.normalize_tokens, TOKENS),
                                   (qu.checked_holders, jp.normalize_holders, ['{"data":{"items":[{"owner":"w","ui_amount":"bad"},{"owner":""},{"owner":"v","decimals":3}]}}', "{"]),
                                   (qu.checked_transactions, jp.normalize_transactions,
                                    ['{"data":[{"tx_hash":"h","owner":"o"}]}', '{"data":{"trades":[{"tx_hash":"i"},{"tx_hash":""}]}}', '{"data":{"items":[]}}', '{"data":"x"}'])):
        p = pages(spark, docs)
        assert sorted(qu.accepted(check(p)).collect(), key=str) == sorted(normalise(p.select("value")).collect(), key=str)


def test_history_needs_a_wallet(spark):
    p = pages(spark, ['{"data":[{"tx_hash":"h","owner":"o"},{"tx_hash":"i"},{"owner":"p"}]}'])
    assert [r["reason"] for r in qu.rejects(qu.checked_transactions(p, wallet_needed=True)).orderBy("pos").collect()] == ["no wallet", "no hash"]


def test_land_counts_in_the_same_job(spark, tmp_path):
    checked = qu.checked_tokens(pages(spark, TOKENS))
    ok, bad, counts = qu.land(checked, str(tmp_path / "t"))
    assert counts == {"rows": 13, "accepted": 2, "rejected_items": 3, "rejected_pages": 8, "with_bad_fields": 1}
    assert ok.count() == 2 and bad.count() == 11 and ok.columns == qu.accepted(checked).columns
    assert sorted(bad.collect(), key=str) == sorted(qu.rejects(checked).collect(), key=str)
    ok, bad, counts = qu.land(checked.where("false"), str(tmp_path / "u"))
    assert ok.count() == bad.count() == counts["rows"] == 0


PAYLOADS = [None, "", "{}", "[]", "[{}]", "nope", '[{"signature":"s","type":"T","accountData":[{"account":"a"}],"tokenTransfers":[{"mint":"m"}]}]',
            '[{"signature":"s","accountData":[],"tokenTransfers":null}]', '[{"type":"T"}', "[null]", '"text"', "[[1]]"]


def test_payload_reasons(spark):
    p = spark.createDataFrame(list(enumerate(PAYLOADS)), "id int, raw_payload string")
    got = [r["reason"] for r in qu.checked_payloads(p).orderBy("id").collect()]
    assert got[:8] == ["empty payload", "empty payload", "not an array", "empty array", "no signature", "malformed payload", None, None]
    assert got[8] == "malformed payload" and all(got[9:])


@pytest.mark.parametrize("payload", PAYLOADS)
def test_event_fields_agree(spark, payload):
    p = spark.createDataFrame([(payload,)], "raw_payload string")
    (a,) = p.select(*jp.extract_event(F.col("raw_payload"))).collect()
    (b,) = vp.events_from_variant(p).drop("raw_payload").collect()
    assert tuple(a) == tuple(b)


def test_variant_pages_of_all_shapes(spark):
    item = {"tx_hash": "h", "block_unix_time": 7, "base": {"symbol": "s", "ui_change_amount": "1.5", "fee": {"x": [1]}}, "quote": None, "slot": 5}
    docs = [{"data": [item]}, {"data": {"items": [item]}}, {"success": True, "data": {"trades": [item]}}, {"data": json.dumps([item])}, {"data": json.dumps({"items": [item]})}]
    t = vp.transactions_from_variant(pages(spark, [json.dumps(d) for d in docs] + ["{", "[]", '{"success":false,"data":[{"tx_hash":"z"}]}', '{"data":[{"tx_hash":""},{}]}', None]))
    rows = t.collect()
    assert len(rows) == 5
    for r in rows:
        assert (r["transaction_hash"], r["block_unix_time"], r["base_symbol"], r["base_ui_change_amount"], r["quote_symbol"]) == ("h", 7, "s", 1.5, None)
        assert json.loads(r["extra_fields"]) == {"slot": 5, "base.fee": {"x": [1]}}
    plain = vp.transactions_from_variant(pages(spark, ['{"data":[{"tx_hash":"h"}]}'])).first()
    assert plain["extra_fields"] is None


def test_item_schema_shows_unknown_fields(spark):
    p = pages(spark, ['{"data":[{"tx_hash":"h","slot":5}]}', '{"data":{"items":[{"tx_hash":"h","memo":{"n":"x"}}]}}'])
    assert vp.item_schema(p).first()[0] == "OBJECT<memo: OBJECT<n: STRING>, slot: BIGINT, tx_hash: STRING>"
