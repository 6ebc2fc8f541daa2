import math
import random

import numpy as np
import pytest

from helpers import SF_DIR
from sluicegate.llm import queries, whitening


def brute(rows, k=4, scale=256):
    """Per usable row: its deviation; and of the fit list n, S, covariance."""
    whole = []
    for i, v in rows:
        if v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        whole.append((i, tuple(math.floor(scale * c) for c in v)))
    fit = sorted({x for _, x in whole})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - b) / n for a, b in zip(x, s)] for x in fit])
    return whole, n, s, centred.T @ centred / n


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, n int, x string")
    return whitening.whiten(df, **options).collect()


def check(rows, given, k=4):
    whole, n, s, covariance = brute(given)
    assert len(rows) == len(whole) * min(k, len(s)) and {r["n"] for r in rows} == {n}
    expected = {(i, sum((n * a - b) ** 2 for a, b in zip(x, s))) for i, x in whole}
    assert {(r["vec_id"], int(r["deviation"])) for r in rows} == expected
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    by = {(r["vec_id"], r["component"], int(r["deviation"])): r for r in rows}
    for c in range(min(k, len(s))):
        sign = 0.0
        for i, x in whole:
            plain = (np.array([(n * a - b) / n for a, b in zip(x, s)]) @ vectors[:, c]) / math.sqrt(values[c])
            row = by[i, c + 1, sum((n * a - b) ** 2 for a, b in zip(x, s))]
            sign = sign or (math.copysign(1, plain * row["whitened"]) if abs(plain) > 1e-6 else 0.0)
            assert row["whitened"] * sign == pytest.approx(plain, rel=1e-8, abs=1e-8)
            assert row["explained"] == pytest.approx(values[c] / np.trace(covariance), rel=1e-10)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def awkward(seed=1, n=90, width=7, offset=0.0):
    rng = random.Random(seed)
    rows = [(i, [offset + rng.gauss(0, 1 + d) for d in range(width)]) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(50)]
    return rows + [
        (5, rows[5][1]),
        (None, rows[6][1]),
        (2000, None),
        (2001, [1.0, None] + [0.0] * (width - 2)),
        (2002, [float("nan")] * width),
        (2003, [float("-inf")] + [0.0] * (width - 1)),
        (2004, [offset or -0.0] * width),
    ]


@pytest.mark.parametrize("offset", [0.0, 1e3, -1e7])
def test_equals_brute_force(spark, offset):
    check(found(spark, awkward(offset=offset)), awkward(offset=offset))


def test_query_on_the_table(spark):
    rows = queries.op11_whitening(spark, SF_DIR).collect()
    given = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, given)
    assert all(r["deviation"] == int(r["deviation_exact"]) for r in rows)


def test_sums_are_exact_for_numbers_of_any_size():
    rng = np.random.default_rng(0)
    for reach in (200, 2**20, 2**40, 2**61):
        x = rng.integers(-reach, reach, (50, 3))
        parts = whitening.parts_of(x)
        assert all(sum(int(p[i, j]) << (16 * k) for k, p in enumerate(parts)) == int(x[i, j]) for i in range(50) for j in range(3))
        assert all(np.abs(p).max() <= 2**16 for p in parts)


def test_huge_entries_and_narrow_vectors(spark):
    given = [(i, [(-1.0) ** i * 1e14 * (i + 1), 3e13 * (i * i % 7)]) for i in range(9)]
    check(found(spark, given), given)
    assert all(r["whitened"] is not None for r in found(spark, [(1, [1e300, 1.0]), (2, [0.0, 5.0])]) if r["component"] == 1)


def test_components_without_variance(spark):
    rows = found(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert sorted((r["vec_id"], r["component"]) for r in rows) == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert {(r["n"], r["whitened"], r["explained"], int(r["deviation"])) for r in rows} == {(1, None, 0.0, 0)}
    rows = found(spark, [(i, [float(i), 3.0]) for i in range(5)])
    assert {r["component"]: r["whitened"] is None for r in rows} == {1: False, 2: True}


def test_widths_apart_and_no_rows(spark):
    wide, narrow = awkward(width=7), [(5000 + i, [float(i), float(i * i % 7)]) for i in range(20)] + [(1, [])]
    rows = found(spark, wide + narrow)
    check([r for r in rows if (r["vec_id"] or 0) < 5000], wide)
    assert {r["n"] for r in rows if (r["vec_id"] or 0) >= 5000} == {20}
    assert found(spark, []) == [] and found(spark, [(1, None), (2, [])]) == []


def matrix(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        [5, 4, 3, 2, 1, 0.5, 0],
        [3, 3, 3, 1, 1],
        [1 + 1e-9, 1, 1 - 1e-9, 0.5, 0.1],
        [7, 7 - 1e-13, 2, 2, 2, 2],
        [1e12, 1, 1e-3, 1e-6],
        [0, 0, 0],
        list(np.linspace(1, 2, 40)),
    ],
)
def test_leading_against_a_full_decomposition(values):
    a = matrix(values)
    pairs = whitening.leading(a, 4)
    plain = np.sort(np.linalg.eigvalsh(a))[::-1][:4]
    scale = max(np.abs(a).max(), 1e-300)
    assert np.allclose([e for e, _ in pairs], plain, rtol=0, atol=1e-12 * scale)
    v = np.array([v for _, v in pairs])
    assert np.allclose(v @ v.T, np.eye(len(v)), atol=1e-10)
    assert np.abs(v @ a - np.array([e for e, _ in pairs])[:, None] * v).max() <= 1e-12 * scale


def test_counts_above_a_shift():
    rng = np.random.default_rng(3)
    for _ in range(20):
        values = rng.standard_normal(12)
        a = matrix(values, seed=int(rng.integers(1000)))
        for shift in rng.standard_normal(5):
            assert whitening.inertia_above(a, shift) == (values > shift).sum()
    swap = np.array([[0.0, 1.0], [1.0, 0.0]])
    assert [whitening.inertia_above(swap, s) for s in (-2, 0, 2)] == [2, 1, 0]
