import io
import json
import subprocess
import sys
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.operators.documents import flatten_quotes
from sluicegate.sources.rest import fetch_bodies, http_fetcher, land_bodies, request_frame


@pytest.fixture
def asked(spark):
    symbols = spark.createDataFrame([("ASH:LSE",), ("ELM:LSE",), ("GONE",)], "symbol string")
    return request_frame(symbols, "symbol", "https://example.invalid/q", "MAX")


def stand_in(log=None):
    def fetch(request):
        if log:
            with open(log, "a") as f:
                f.write(request["symbol"] + "\n")
        if request["symbol"] == "GONE":
            raise LookupError("no such symbol")
        series = {"2024-01-01 00:00:00": {"price": 1.5, "change": 0.0, "change_percent": 0.0}}
        return json.dumps({"data": {"symbol": request["symbol"], "type": request["period"], "time_series": series}})

    return fetch


def test_request_frame(spark, asked):
    assert asked.columns == ["endpoint", "symbol", "period"]
    assert asked.count() == 3
    with_host = request_frame(asked.select("symbol"), F.upper("symbol"), "e", "MAX", host="h")
    assert with_host.columns == ["endpoint", "symbol", "period", "host"]


@pytest.mark.parametrize("fetch", [fetch_bodies])
def test_failures_stay_with_their_request(asked, fetch):
    found = {r["symbol"]: r for r in fetch(asked, stand_in()).collect()}
    assert len(found) == 3
    assert found["GONE"]["body"] is None and found["GONE"]["error"] == "LookupError: no such symbol"
    assert found["ASH:LSE"]["error"] is None
    assert asked.columns == ["endpoint", "symbol", "period"]


def test_fetched_quotes_flatten(asked):
    found = flatten_quotes(fetch_bodies(asked, stand_in(), tasks=2, concurrency=2))
    assert sorted(r["symbol"] for r in found.collect()) == ["ASH:LSE", "ELM:LSE"]


def test_what_tasks_run_does_not_need_the_package(tmp_path):
    """Executors may not have it installed: the closures travel by value."""

    class Requests:
        columns = ["symbol"]
        schema = T.StructType([T.StructField("symbol", T.StringType())])

        def mapInPandas(self, run, schema):
            return run

    shipped = [fetch_bodies(Requests(), stand_in()), http_fetcher("K", "H")]
    (tmp_path / "shipped").write_bytes(cloudpickle.dumps(shipped))
    code = """
import pickle, sys
import pandas as pd
run, *others = pickle.load(open("shipped", "rb"))
(answer,) = run([pd.DataFrame({"symbol": ["GONE"]})])
print(answer["error"][0], "sluicegate" in sys.modules)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "LookupError: no such symbol False", done.stderr


@pytest.mark.parametrize("held", [0, 500, 10**9])
def test_more_requests_than_a_task_holds(spark, monkeypatch, held):
    monkeypatch.setattr("sluicegate.sources.rest.HELD_CHARS", held)
    symbols = spark.range(0, 1000, 1, 2).select(F.col("id").cast("string").alias("symbol"))
    fetched = fetch_bodies(request_frame(symbols, "symbol", "e", "MAX"), stand_in())
    assert fetched.where("get_json_object(body, '$.data.symbol') = symbol").count() == 1000


def test_landed_bodies_are_fetched_once(asked, tmp_path):
    log = tmp_path / "calls"
    landed = land_bodies(fetch_bodies(asked, stand_in(str(log))), str(tmp_path / "bodies"))
    assert landed.count() == 3 and flatten_quotes(landed).count() == 2
    assert len(log.read_text().split()) == 3


def test_landed_bodies_stay_as_they_came(spark, tmp_path):
    texts = ["{}", "", None, 'line\nbreak \r "quoted" \\ é 日本 \u2028', "x" * 3_000_000]
    df = spark.createDataFrame([(str(i), t, None) for i, t in enumerate(texts)], "symbol string, body string, error string")
    landed = land_bodies(df, str(tmp_path / "bodies"))
    assert landed.schema == df.schema
    assert [r["body"] for r in landed.orderBy("symbol").collect()] == texts


def test_http_request(monkeypatch):
    seen = {}

    def urlopen(request, timeout):
        seen["request"], seen["timeout"] = request, timeout
        return io.BytesIO('{"data": "é"}'.encode())

    monkeypatch.setattr("urllib.request.urlopen", urlopen)
    monkeypatch.setenv("QUOTE_KEY", "k")
    monkeypatch.setenv("QUOTE_HOST", "h")
    fetch = http_fetcher("QUOTE_KEY", "QUOTE_HOST", timeout=5)
    body = fetch({"endpoint": "https://example.invalid/q", "symbol": "ASH:LSE", "period": "MAX"})
    assert body == '{"data": "é"}' and seen["timeout"] == 5
    url = urlparse(seen["request"].full_url)
    assert parse_qs(url.query) == {"symbol": ["ASH:LSE"], "period": ["MAX"], "language": ["en"]}
    assert dict(seen["request"].header_items()) == {"X-rapidapi-key": "k", "X-rapidapi-host": "h"}
    monkeypatch.delenv("QUOTE_KEY")
    with pytest.raises(KeyError):
        fetch({"endpoint": "e", "symbol": "s", "period": "p"})
