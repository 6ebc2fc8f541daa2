"""Quote requests as rows, fetched by Spark tasks through a fetcher the caller supplies."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.session import land

Fetcher = Callable[[Mapping[str, str]], str]

# The headers and the language the quote service takes.
KEY_HEADER, HOST_HEADER, LANGUAGE = "x-rapidapi-key", "x-rapidapi-host", "en"

HELD_CHARS = 16 * 2**20


def request_frame(
    symbols: DataFrame, symbol: Column | str, endpoint: str, period: str, host: str | None = None
) -> DataFrame:
    """One request per row of ``symbols``. The access key is not a column: it stays with the fetcher."""
    symbol = F.col(symbol) if isinstance(symbol, str) else symbol
    columns = [F.lit(endpoint).alias("endpoint"), symbol.alias("symbol"), F.lit(period).alias("period")]
    if host is not None:
        columns.append(F.lit(host).alias("host"))
    return symbols.select(*columns)


def fetch_bodies(
    requests: DataFrame, fetcher: Fetcher, tasks: int | None = None, concurrency: int = 8
) -> DataFrame:
    """Add ``body`` and ``error`` to each request; one failed request does not fail the job.

    ``tasks`` spreads the requests first; within a task up to ``concurrency`` of them wait on the
    network together, and a task passes its answers on before they grow past ``HELD_CHARS`` by more than
    one such round. Land the result before using it twice (``land_bodies``), or every use fetches again.
    """
    if tasks:
        requests = requests.repartition(tasks)
    names, round_size, held_chars = requests.columns, 2 * concurrency, HELD_CHARS

    def run(batches):
        from concurrent.futures import ThreadPoolExecutor

        def call(request):
            try:
                return fetcher(request), None
            except Exception as e:
                return None, f"{type(e).__name__}: {e}"

        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                asked, answers, chars, passed_on = batch[names].to_dict("records"), [], 0, 0
                for at in range(0, len(asked), round_size):
                    got = list(pool.map(call, asked[at : at + round_size]))
                    answers += got
                    chars += sum(len(body or "") for body, _ in got)
                    done = passed_on + len(answers)
                    if chars >= held_chars or done == len(asked):
                        bodies, errors = zip(*answers)
                        yield batch.iloc[passed_on:done].assign(body=bodies, error=errors)
                        answers, chars, passed_on = [], 0, done

    answer = [T.StructField("body", T.StringType()), T.StructField("error", T.StringType())]
    return requests.mapInPandas(run, T.StructType([*requests.schema.fields, *answer]))


def land_bodies(fetched: DataFrame, path: str) -> DataFrame:
    """Fetch now, keep the answers at ``path``, and go on from there."""
    return land(fetched, path, large_rows=True)


def http_fetcher(key_env: str, host_env: str, timeout: float = 30.0) -> Fetcher:
    """GET with the symbol, the period and the language as parameters, and key and host as headers.

    Key and host are read from the environment of the worker that makes the call.
    """
    key_header, host_header, language = KEY_HEADER, HOST_HEADER, LANGUAGE

    def fetch(request: Mapping[str, str]) -> str:
        import os
        from urllib.parse import urlencode
        from urllib.request import Request, urlopen

        query = urlencode({"symbol": request["symbol"], "period": request["period"], "language": language})
        headers = {key_header: os.environ[key_env], host_header: os.environ[host_env]}
        with urlopen(Request(f"{request['endpoint']}?{query}", headers=headers), timeout=timeout) as answer:
            return answer.read().decode("utf-8")

    return fetch
