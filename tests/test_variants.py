import json

import pytest

from sluicegate.operators.documents import flatten_quotes
from sluicegate.operators.variants import QUOTE, as_variant, first_users, flatten_series, found_fields, with_fields_of


def bodies(spark, *documents):
    return spark.createDataFrame([(d if d is None or isinstance(d, str) else json.dumps(d),) for d in documents], "body string")


def answer(**series):
    return {"data": {"symbol": "A", "type": "stock", "time_series": {k.replace("_", " "): v for k, v in series.items()}}}


AT = "2024-01-01 00:00:0%d"


def test_fields_that_nobody_listed(spark, rows):
    found = flatten_series(
        bodies(
            spark,
            {"data": {"symbol": "A", "type": "s", "time_series": {AT % 0: {"price": 1.5, "volume": 3, "it's \"odd\"": True}}}},
            {"data": {"symbol": "B", "type": "s", "time_series": {AT % 1: {"price": 2, "n": 7}, AT % 2: {"n": 2.5, "symbol": "C", "deep": {"a": [1]}}}}},
        )
    )
    assert found.columns == ["symbol", "type", "last_update_utc", *QUOTE, "deep", 'it\'s "odd"', "n", "symbol_field"]
    got = {r["last_update_utc"].second: r for r in found.collect()}
    assert (got[0]["price"], got[0]["volume"], got[0]['it\'s "odd"'], got[0]["n"]) == (1.5, 3, True, None)
    assert (got[1]["price"], got[1]["n"], got[1]["symbol_field"]) == (2.0, 7.0, None)
    assert (got[2]["n"], got[2]["symbol"], got[2]["symbol_field"], got[2]["deep"]) == (2.5, "B", "C", '{"a":[1]}')


def test_listed_fields_as_by_a_schema(spark, rows):
    """The same rows as of the answers parsed by a fixed schema, also of awkward ones."""
    quote = {"price": 1.25, "change": -1, "change_percent": 0.5, "volume": 9}
    df = bodies(
        spark, {"data": {"symbol": "A", "type": "s", "time_series": {AT % 0: quote, "no moment": quote, AT % 1: {}}}},
        {"data": {"symbol": "B", "type": "s", "time_series": {}}}, {"data": {"symbol": "C"}}, {}, [], "{bad", "", "null", None, 3,
    )
    listed = ["symbol", "type", "last_update_utc", *QUOTE]
    assert rows(flatten_series(df), *listed) == rows(flatten_quotes(df), *listed)


def test_values_that_do_not_fit(spark):
    """A listed field keeps its type; one found in several types is text."""
    df = bodies(spark, {"data": {"symbol": "A", "time_series": {AT % 0: {"price": "dear", "x": 1}, AT % 1: {"price": 1, "x": "one"}, AT % 2: {"x": [2]}}}})
    got = {r["last_update_utc"].second: (r["price"], r["x"]) for r in flatten_series(df).collect()}
    assert got == {0: (None, "1"), 1: (1.0, "one"), 2: (None, "[2]")}


def test_first_users(spark):
    df = bodies(spark, {"results": [{"email": "e", "nat": "FI"}, {"email": "second"}]}, {"results": [{"age": 5}]}, {"results": []}, "x")
    found = first_users(df, {"email": "string", "phone": "string"})
    assert found.columns == ["email", "phone", "age", "nat"]
    assert sorted(map(tuple, found.collect()), key=str) == [("e", None, None, "FI"), (None, None, 5, None)]


def test_no_documents(spark):
    assert flatten_series(bodies(spark)).columns == ["symbol", "type", "last_update_utc", *QUOTE]
    assert found_fields(bodies(spark, "3", "[1]").select(as_variant("body")), "document") == {}
    assert with_fields_of(bodies(spark, "3").select(as_variant("body")), "document", {"a": "string"}).first() == (None,)


def test_one_parse_and_no_python(spark, plan):
    text = plan(flatten_series(bodies(spark, {"data": {"symbol": "A", "time_series": {AT % 0: {"price": 1, "x": 2}}}})))
    assert text.count("parseJson") == 1 and "Python" not in text and "Exchange" not in text


@pytest.mark.parametrize("number, kind", [(1, "bigint"), (1.5, "double"), (True, "boolean"), ("x", "string"), ({}, "string"), ([1], "string"), (2**70, "double")])
def test_types_of_found_fields(spark, number, kind):
    df = bodies(spark, {"f": number}, {"f": None}).select(as_variant("body"))
    assert found_fields(df, "document") == {"f": kind}
