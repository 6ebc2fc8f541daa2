import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluicegate.functions.columns import files_for, utc_second
from sluicegate.operators.documents import assign_ids, flatten_quotes, user_records


def bodies(spark, *texts):
    return spark.createDataFrame([(t if t is None or isinstance(t, str) else json.dumps(t),) for t in texts], "body string")


def response(series, symbol="ASH:LSE"):
    return {"status": "OK", "data": {"symbol": symbol, "type": "stock", "time_series": series}}


QUOTE = {"price": 123456.789, "change": -0.1, "change_percent": 1}


def test_each_entry_is_a_row(spark, rows):
    series = {"2024-10-21 15:59:58": {**QUOTE, "volume": 3_000_000_000}, "2024-10-22 09:30:00": QUOTE}
    found = flatten_quotes(bodies(spark, response(series), response(series, "ELM:LSE")))
    assert found.columns == ["symbol", "type", "last_update_utc", "price", "change", "change_percent", "volume"]
    assert found.count() == 4
    assert rows(found.where("symbol = 'ASH:LSE'")) == [
        ("ASH:LSE", "stock", datetime(2024, 10, 21, 15, 59, 58), 123456.789, -0.1, 1.0, 3_000_000_000),
        ("ASH:LSE", "stock", datetime(2024, 10, 22, 9, 30), 123456.789, -0.1, 1.0, None),
    ]


@pytest.mark.parametrize(
    "body",
    [None, "", "{bad", "[]", "null", "{}", response({}), response(None), {"data": {"symbol": "X", "type": "stock"}}],
)
def test_bodies_without_entries_give_no_rows(spark, body):
    assert flatten_quotes(bodies(spark, body)).isEmpty()


def test_odd_moments_and_values(spark, rows):
    series = {"not a moment": QUOTE, "2024-13-01 00:00:00": QUOTE, "2024-01-01": QUOTE, "2024-01-01 00:00:01": None}
    found = flatten_quotes(bodies(spark, response(series)))
    assert rows(found, "last_update_utc", "price") == [
        (datetime(2024, 1, 1, 0, 0, 1), None),
        (None, 123456.789),
        (None, 123456.789),
        (None, 123456.789),
    ]


def test_long_series(spark):
    series = {f"2024-01-01 {h:02}:{m:02}:{s:02}": QUOTE for h in range(3) for m in range(60) for s in range(60)}
    found = flatten_quotes(bodies(spark, response(series)))
    assert found.select("last_update_utc").distinct().count() == 3 * 3600


def test_moment_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2024-03-10 02:30:00",)], "t string")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert df.select(utc_second(F.col("t"))).first()[0] == datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_no_python_and_no_shuffle_in_the_plans(spark, plan):
    quotes, users = flatten_quotes(bodies(spark, response({}))), user_records(bodies(spark, "{}"))
    filtered = quotes.where("symbol = 'A' and price > 1 and type is not null")
    for df in (quotes, users, filtered, users.where("gender = 'x' and address like '1%'")):
        text = plan(df)
        assert "Python" not in text and "Exchange" not in text
        assert text.count("from_json") == 1


USER = {
    "gender": "female",
    "name": {"title": "Ms", "first": "Ada", "last": "L"},
    "location": {
        "street": {"number": 12, "name": "High St"},
        "city": "York",
        "state": "N",
        "country": "UK",
        "postcode": "YO1",
        "coordinates": {"latitude": "1"},
    },
    "email": "a@example.invalid",
    "login": {"username": "ada"},
    "dob": {"date": "1990-01-01T00:00:00Z", "age": 34},
    "registered": {"date": "2020-01-01T00:00:00Z"},
    "phone": "1",
    "picture": {"medium": "m.jpg"},
}


def test_user_record(spark):
    (row,) = user_records(bodies(spark, {"results": [USER, {**USER, "gender": "second"}], "info": {}})).collect()
    assert row.asDict() == {
        "first_name": "Ada",
        "last_name": "L",
        "gender": "female",
        "address": "12 High St, York, N, UK",
        "post_code": "YO1",
        "email": "a@example.invalid",
        "username": "ada",
        "dob": "1990-01-01T00:00:00Z",
        "registered_date": "2020-01-01T00:00:00Z",
        "phone": "1",
        "picture": "m.jpg",
    }


def test_user_record_with_gaps(spark):
    location = {**USER["location"], "state": None, "postcode": 12345, "street": {"number": None, "name": "x"}}
    (row,) = user_records(bodies(spark, {"results": [{**USER, "location": location}]})).collect()
    assert (row["address"], row["post_code"]) == ("None x, York, None, UK", "12345")


@pytest.mark.parametrize("body", [None, "{bad", "{}", {"results": []}, {"results": None}])
def test_documents_without_results(spark, body):
    assert user_records(bodies(spark, body)).isEmpty()


def test_ids_are_unique_and_stay(spark, lake, tmp_path, rows):
    customers = lake.table("customer").select("c_custkey")
    with_ids = assign_ids(customers, str(tmp_path / "ids"))
    first = rows(with_ids)
    assert len({i for i, _ in first}) == len(first) == customers.count()
    assert rows(with_ids) == first


def test_file_counts(spark):
    df = spark.createDataFrame([(0,), (1,), (1000,), (1001,)], "n bigint")
    assert [r[0] for r in df.select(files_for(F.col("n"), 1000)).collect()] == [0, 1, 1, 2]
