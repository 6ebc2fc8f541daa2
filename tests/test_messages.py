import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sluicegate.streaming.messages import (
    USER_FIELDS,
    USER_MESSAGE,
    decode_messages,
    encode_messages,
    message_text,
    split_messages,
)

SCHEMA = "id string, n bigint, x double, moment timestamp_ntz, at timestamp, note string"
MOMENTS = st.datetimes(min_value=datetime(1900, 1, 1), max_value=datetime(2200, 1, 1))
RECORD = st.tuples(
    st.text(min_size=1),
    st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)),
    st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False)),
    st.one_of(st.none(), MOMENTS),
    st.one_of(st.none(), MOMENTS),
    st.one_of(st.none(), st.text()),
)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(RECORD, max_size=8))
def test_decode_undoes_encode(spark, rows, records):
    df = spark.createDataFrame(records, SCHEMA)
    assert rows(decode_messages(encode_messages(df), df.schema)) == rows(df)


def test_message_shape(spark):
    df = spark.createDataFrame([("7", "Zoë")], "id string, first_name string")
    message = encode_messages(df, key="id", carry=["first_name"]).first()
    assert bytes(message["key"]) == b"7" and message["first_name"] == "Zoë"
    assert bytes(message["value"]) == '{"id":"7","first_name":"Zoë"}'.encode()
    assert message_text(encode_messages(df)).first()["value"] == '{"id":"7","first_name":"Zoë"}'


def test_user_message_has_its_fields_in_order():
    assert USER_MESSAGE.names == list(USER_FIELDS) and len(USER_FIELDS) == 12
    assert "dob" in USER_FIELDS


def values(spark, *texts):
    return spark.createDataFrame([(None if t is None else t.encode(),) for t in texts], "value binary")


def test_plain_decoding_is_permissive(spark):
    text = json.dumps({"id": "1", "first_name": "Ada", "unknown": 5})
    found = decode_messages(values(spark, text, "{bad", "[]", None), USER_MESSAGE).collect()
    assert (found[0]["id"], found[0]["first_name"], found[0]["phone"]) == ("1", "Ada", None)
    assert [r["id"] for r in found[1:]] == [None, None, None]


@pytest.mark.parametrize(
    "text, status",
    [
        ('{"id":"a","n":1}', "accepted"),
        ('{"id":"a"}', "accepted"),
        ('{"n":1}', "rejected"),
        ('{"id":null,"n":1}', "rejected"),
        ('{"id":"a","n":"many"}', "rejected"),
        ('{"id":"a","n":1', "rejected"),
        ("{bad", "rejected"),
        ("[]", "rejected"),
        ("null", "rejected"),
        ("", "rejected"),
        (None, "rejected"),
    ],
)
def test_split(spark, text, status):
    schema = spark.createDataFrame([], "id string, n int").schema
    row = split_messages(values(spark, text), schema, required=["id"]).first()
    assert row["status"] == status
    assert row["rejected_text"] == (text if status == "rejected" else None)


@pytest.mark.parametrize(
    "value, status",
    [
        ('"0b7e8a52-7c1e-4b55-9d0f-0c6f3a1d2e4f"', "accepted"),
        ("null", "accepted"),
        ('"0b7e8a52"', "rejected"),
        ('""', "rejected"),
    ],
)
def test_uuids(spark, value, status):
    schema = spark.createDataFrame([], "id string").schema
    row = split_messages(values(spark, f'{{"id":{value}}}'), schema, uuids=["id"]).first()
    assert row["status"] == status


def test_each_message_is_parsed_once(spark, plan):
    schema = spark.createDataFrame([], "id string, n int").schema
    messages = values(spark, "{}")
    split = split_messages(messages, schema, required=["id"])
    decoded = decode_messages(messages, schema)
    for df in (split, split.where("status = 'accepted' and n > 3"), decoded.where("id = 'a' and n > 3")):
        assert plan(df).count("from_json") == 1


def test_split_loses_nothing_and_carries(spark):
    schema = spark.createDataFrame([], "id string").schema
    df = values(spark, '{"id":"a"}', "{", '{"id":"b"}').selectExpr("value", "1 as offset")
    found = split_messages(df, schema, carry=["offset"])
    assert found.columns == ["status", "id", "rejected_text", "offset"]
    assert found.groupBy("status").count().orderBy("status").collect() == [("accepted", 2), ("rejected", 1)]
