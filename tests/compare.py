"""Order-free comparison of a Spark frame with a DuckDB result: names, types and values."""

# The same type in both engines.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def _sorted(rows):
    return sorted(rows, key=lambda t: tuple((v is None, str(v)) for v in t))


def same(df, result):
    expected_types = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == expected_types
    names = sorted(df.columns)
    places = [[d[0] for d in result.description].index(n) for n in names]
    expected = [tuple(row[i] for i in places) for row in result.fetchall()]
    found = [tuple(row) for row in df.select(*names).collect()]
    assert len(found) == len(expected)
    assert _sorted(found) == _sorted(expected)
