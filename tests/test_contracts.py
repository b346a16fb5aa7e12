import json

import pytest

from siltstone.operators import contracts
from siltstone.operators.contracts import Contract, Field, check, is_additive, load_contract, split
from siltstone.plans.declared import CONTRACTS, METRICS, PRODUCTS

QUOTES = CONTRACTS["b3_quotes"]
GOOD = {"ticker": "QUX11", "price": 7.25, "volume": 64, "quote_timestamp": "2031-02-03T04:05:06Z"}


def reasons(spark, contract, texts, strict=False):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, payload string")
    checked = check(df, contract, strict=strict).orderBy("i").select(contracts.REASON)
    return [r[0] for r in checked.collect()]


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"ticker": None}, "null_violation:ticker"),
        ({"price": "seven"}, "type_mismatch:price"),
        ({"price": -0.25}, "constraint_violation:price"),
        ({"volume": None}, None),
        ({"volume": 2.0}, "type_mismatch:volume"),
        ({"volume": True}, None),
        ({"volume": 2**63 - 1}, None),
        ({"volume": 2**63}, "type_mismatch:volume"),
        ({"volume": -(2**70)}, "type_mismatch:volume"),
        ({"price": 0}, None),
        ({"price": 1e300}, None),
        ({"price": -(2**70)}, "constraint_violation:price"),
        ({"quote_timestamp": "no time at all"}, None),
        ({"quote_timestamp": 5}, "type_mismatch:quote_timestamp"),
        ({"ticker": {"a": 1}}, "type_mismatch:ticker"),
        ({"ticker": None, "price": "x"}, "null_violation:ticker"),
    ],
)
def test_quote_rules(spark, change, reason):
    assert reasons(spark, QUOTES, [json.dumps({**GOOD, **change})]) == [reason]


def test_missing_fields_and_malformed_text(spark):
    texts = ['{"price": 1}', json.dumps({k: v for k, v in GOOD.items() if k != "volume"}), '{"ticker":', "[1]", "5", "", None]
    bad = contracts.MALFORMED
    assert reasons(spark, QUOTES, texts) == ["null_violation:ticker", None, bad, bad, bad, bad, bad]


def test_strict_rejects_booleans(spark):
    assert reasons(spark, QUOTES, [json.dumps({**GOOD, "volume": True})], strict=True) == ["type_mismatch:volume"]


def test_other_contracts(spark):
    sale = {
        "opportunity_id": "deal/77", "account_name": "Blue Heron Ltd", "lost_reason": "timing",
        "estimated_value": 0.5, "lost_at": "2031-02-03",
    }
    chunk = {"document_id": "handbook", "source_path": "/b/c.txt", "chunk_index": 12, "chunk_text": "some words", "updated_at": "y"}
    assert reasons(spark, CONTRACTS["crm_lost_sales"], [json.dumps(sale)]) == [None]
    texts = [json.dumps(chunk), json.dumps({**chunk, "document_id": None})]
    assert reasons(spark, CONTRACTS["sharepoint_documents"], texts) == [None, "null_violation:document_id"]


def test_poison_rows_do_not_stop_good_ones(spark):
    df = spark.createDataFrame([('{"other": [1]}',), (json.dumps(GOOD),), ("{}",)], "payload string")
    valid, rejected = split(check(df, QUOTES), QUOTES)
    assert valid.count() == 1 and rejected.count() == 2
    assert valid.first()["price"] == 7.25 and valid.first()["volume"] == 64


def test_unknown_kind_is_not_checked_and_minimum_applies_to_numbers_only(spark):
    odd = Contract("odd", (Field("x", "blob", minimum=3),))
    assert reasons(spark, odd, ['{"x": 1}', '{"x": "a"}', '{"x": 5}']) == ["constraint_violation:x", None, None]


def test_evolution():
    more = Contract("b3_quotes", (*QUOTES.fields, Field("extra", "string")))
    needed = Contract("b3_quotes", (*QUOTES.fields, Field("extra", "string", required=True)))
    fewer = Contract("b3_quotes", QUOTES.fields[1:])
    assert is_additive(QUOTES, more) and not is_additive(QUOTES, needed) and not is_additive(QUOTES, fewer)


def test_yaml_form(tmp_path):
    text = """
metadata: {name: t}
schema:
  topic: a.b
  columns:
    - {name: a, type: decimal, required: true, constraints: {minimum: 0}}
    - {name: b, type: long}
quality: {freshness: {maxStaleness: PT5M}, completeness: {a: 1.0}}
"""
    path = tmp_path / "t.yaml"
    path.write_text(text)
    assert load_contract(str(path)) == Contract(
        "t", (Field("a", "decimal", True, 0), Field("b", "long")), "PT5M", {"a": 1.0}, "a.b"
    )


def test_declared_references():
    assert all(m.product in PRODUCTS for m in METRICS.values())
    assert all(p.key in p.required and p.watermark in p.required for p in PRODUCTS.values())
    assert not any(set(p.required) & set(p.sensitive) for p in PRODUCTS.values())


def test_every_derived_negative_price_is_refused(spark, rows):
    """A value below 1 stands for a negative price; that of 0 must not turn into -0, which a minimum of 0 accepts."""
    from siltstone.plans.queries.ingest import raw_quotes

    events = spark.sql(
        """SELECT id AS event_id, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS ts, 7L AS user_id, 'view' AS event_type, value, '{"k": 4}' AS props
        FROM VALUES (1L, 0.0D), (2L, 0.01D), (3L, 0.99D), (4L, 1.0D) AS t(id, value)"""
    )
    found = check(raw_quotes(events), QUOTES)
    low = "constraint_violation:price"
    assert rows(found, "event_id", contracts.REASON) == [(1, low), (2, low), (3, low), (4, None)]
