"""Whitening of vectors: exact covariance, leading eigenvalues isolated by slicing the spectrum, projection."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import Passing, column, to_batch, with_fields

#: Bits of one part of a whole number; products of two parts over 2**20 rows are exact in doubles.
PART = 16
ROWS = 1 << 20
EPS = float(np.finfo(np.float64).eps)
SUMS_DDL = "width int, i int, j int, shift int, part long"
SUMS = pa.schema([("width", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("shift", pa.int32()), ("part", pa.int64())])
MOMENTS = pa.schema([("width", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("total", pa.float64())])


# --- exact sums -------------------------------------------------------------------------------


def parts_of(x: np.ndarray) -> list[np.ndarray]:
    """Whole numbers as doubles p0, p1, ... with x = p0 + p1 * 2**16 + ...; small numbers have one part."""
    parts = []
    while len(x) and (np.abs(x) >= 1 << PART).any():
        parts.append((x & ((1 << PART) - 1)).astype(np.float64))
        x = x >> PART
    return [*parts, x.astype(np.float64)]


def _less(x: np.ndarray, centre: list[int] | np.ndarray) -> np.ndarray:
    """x - centre, exact: in unbounded integers where 64 bits might not do."""
    reach = max((abs(int(c)) for c in centre), default=0) + max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if reach < 2**62:
        return x - np.array([int(c) for c in centre], dtype=np.int64)
    return x.astype(object) - np.array([int(c) for c in centre], dtype=object)


def matrices(batch: pa.RecordBatch, name: str = "x") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of a batch as one matrix per width, with the places of their rows."""
    lists = batch.column(name)
    widths = lists.value_lengths().to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        chosen = lists if len(rows) == len(widths) else lists.take(pa.array(rows))
        yield rows, chosen.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), int(width))


def _emit(totals: dict) -> Iterator[pa.RecordBatch]:
    """Sums as rows; each part of a sum is below 2**63 and the shuffle adds them as decimals."""
    for (width, shift), total in totals.items():
        total = np.atleast_2d(total)
        i, j = (a.ravel() for a in np.indices(total.shape))
        n = len(i)
        for begin in range(0, n, 1 << 16):
            at = slice(begin, begin + (1 << 16))
            size = len(i[at])
            columns = {"width": np.full(size, width), "i": i[at], "j": j[at], "shift": np.full(size, shift)}
            yield to_batch(columns | {"part": total.ravel()[at].astype(np.int64)}, SUMS)


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per width the sum of each dimension and, as one more dimension, the number of rows."""
    totals: dict = {}
    for batch in batches:
        for _, x in matrices(batch):
            width = x.shape[1]
            for at in range(0, len(x), ROWS):
                some = x[at : at + ROWS]
                for k, part in enumerate(parts_of(np.hstack([some, np.ones((len(some), 1), dtype=some.dtype)]))):
                    key = (width, PART * k)
                    totals[key] = totals.get(key, 0) + part.sum(axis=0).astype(np.int64)
    yield from _emit(totals)


def _products(centres: dict[int, list[int]]):
    """Per width the sums of products of the dimensions, each less its centre."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for batch in batches:
            for _, x in matrices(batch):
                width = x.shape[1]
                for at in range(0, len(x), ROWS):
                    parts = parts_of(_less(x[at : at + ROWS], centres[width]))
                    for a, left in enumerate(parts):
                        for b, right in enumerate(parts):
                            key = (width, PART * (a + b))
                            totals[key] = totals.get(key, 0) + (left.T @ right).astype(np.int64)
        yield from _emit(totals)

    return run


def _added(found: DataFrame) -> dict[int, dict[tuple[int, int], int]]:
    """Whole sums by width; what comes to the driver is the size of a matrix, whatever the rows."""
    total = F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
    out: dict = {}
    for width, i, j, shift, part in found.groupBy("width", "i", "j", "shift").agg(total).collect():
        of = out.setdefault(width, {})
        of[i, j] = of.get((i, j), 0) + (int(part) << shift)
    return out


# --- leading eigenvalues ----------------------------------------------------------------------


def inertia_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above ``shift``.

    By Sylvester's law it is the number of positive entries of D in L D L^T = matrix - shift * I. Pivots
    are the largest on the diagonal, or a block of two where an entry beside it is much larger.
    """
    a = matrix - shift * np.eye(len(matrix))
    positive, alpha = 0, (1 + np.sqrt(17)) / 8
    while len(a):
        n = len(a)
        diagonal = np.abs(np.diagonal(a))
        r = int(diagonal.argmax())
        off = np.abs(a)
        np.fill_diagonal(off, 0.0)
        s, t = divmod(int(off.argmax()), n)
        if diagonal[r] == 0 and off[s, t] == 0:
            break
        picked = [r] if diagonal[r] >= alpha * off[s, t] else [s, t]
        rest = np.setdiff1d(np.arange(n), picked)
        block, side = a[np.ix_(picked, picked)], a[np.ix_(rest, picked)]
        positive += int(block[0, 0] > 0) if len(picked) == 1 else 1
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
    return positive


def _rayleigh(matrix: np.ndarray, start: np.ndarray, shift: float, found: list[np.ndarray]) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from ``shift``, kept clear of the vectors ``found`` before."""

    def clear(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for u in found:
                v = v - (u @ v) * u
        return v / np.linalg.norm(v)

    scale, eye = np.abs(matrix).max(), np.eye(len(matrix))
    v, value, idle = clear(start), shift, 0
    best = (np.inf, shift, v)
    while idle < 3:
        for nudge in (0.0, EPS, 16 * EPS):
            try:
                v = clear(np.linalg.solve(matrix - (value + nudge * scale) * eye, v))
                break
            except np.linalg.LinAlgError:
                continue
        value = float(v @ matrix @ v)
        left = float(np.linalg.norm(matrix @ v - value * v))
        idle = 0 if left < 0.5 * best[0] else idle + 1
        best = min(best, (left, value, v), key=lambda b: b[0])
        if left <= EPS * scale:
            break
    return best[1], best[2]


def leading(matrix: np.ndarray, k: int) -> list[tuple[float, np.ndarray]]:
    """The ``k`` largest eigenvalues of a symmetric matrix with their unit vectors, numbered by counts.

    For each number an interval is halved until counts show its eigenvalue alone in it (or the interval is as
    narrow as rounding allows: eigenvalues equal to double precision, whose vectors are any that span the
    same space). The iteration starts in its middle. Its result is taken if the counts on both sides of it certify
    the number; otherwise it belongs to another one, and the interval is halved on.
    """
    n = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max()) or 1.0
    slack = 8 * n * EPS * scale
    rng = np.random.default_rng(0)
    out: list[tuple[float, np.ndarray]] = []
    for number in range(1, min(k, n) + 1):
        low, high = -scale - slack, scale + slack
        above_low, above_high = n, 0
        while True:
            while above_low - above_high > 1 and high - low > slack:
                middle = (low + high) / 2
                count = inertia_above(matrix, middle)
                low, high = (middle, high) if count >= number else (low, middle)
                above_low, above_high = (count, above_high) if count >= number else (above_low, count)
            value, vector = _rayleigh(matrix, rng.standard_normal(n), (low + high) / 2, [v for _, v in out])
            if inertia_above(matrix, value + slack) < number <= inertia_above(matrix, value - slack):
                break
            if high - low <= slack / 16:
                raise ArithmeticError(f"eigenvalue {number} could not be certified")
            middle = (low + high) / 2
            low, high = (middle, high) if inertia_above(matrix, middle) >= number else (low, middle)
        out.append((value, vector))
    return out


# --- the operator -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """What one width was fitted to: n distinct vectors, whole sums, a whole centre close to the mean."""

    n: int
    sums: list[int]
    centre: list[int]
    #: Components as columns, each over the root of its eigenvalue.
    scaled: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def left(self) -> list[int]:
        """n times what the mean has beyond the centre."""
        return [s - self.n * c for s, c in zip(self.sums, self.centre)]

    def project(self, x: np.ndarray) -> np.ndarray:
        less = _less(x, self.centre).astype(np.float64) - np.array([r / self.n for r in self.left])
        return less @ self.scaled

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n * x - S)**2 in unbounded integers: of n * d - r, with d and r small."""
        d, r = _less(x, self.centre), self.left
        far = max(int(np.abs(d).max(initial=0)), 1) * max(int(np.abs(d).max(initial=0)), max(map(abs, r), default=0), 1)
        if far * max(d.shape[1], 1) >= 2**62:
            d = d.astype(object)
        squares, cross = (d * d).sum(axis=1), (d * np.array(r, dtype=d.dtype)).sum(axis=1)
        own = sum(v * v for v in r)
        return [self.n * (self.n * int(a) - 2 * int(b)) + own for a, b in zip(squares, cross)]


def whole_vectors(vectors: DataFrame, vector: str, scale: float) -> DataFrame:
    """Each usable vector as ``x``, long whole numbers floor(scale * c), beside the columns it has."""
    c = column(vector).cast("array<double>")
    fine = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    x = F.transform(c, lambda v: F.floor(v * F.lit(float(scale))).cast("long"))
    return vectors.where(c.isNotNull() & F.coalesce(fine, F.lit(False))).withColumn("x", x)


def fit(fitted: DataFrame, components: int) -> dict[int, Whitening]:
    """Exact mean and covariance of the distinct vectors ``x`` per width, and their leading components.

    Two passes over ``fitted``, which is read twice: sums, then products of what lies beyond a whole centre. The
    covariance is the exact rational one rounded once, so it is the same however the rows were dealt.
    """
    sums = _added(fitted.mapInArrow(_sums, SUMS_DDL))
    centres, counted = {}, {}
    for width, of in sums.items():
        n = of[0, width]
        counted[width] = n, [of.get((0, d), 0) for d in range(width)]
        centres[width] = [(2 * s + n) // (2 * n) for s in counted[width][1]]
    if not centres:
        return {}
    found = _added(fitted.where("size(x) > 0").mapInArrow(_products(centres), SUMS_DDL))
    out = {}
    for width, (n, s) in counted.items():
        r = [a - n * c for a, c in zip(s, centres[width])]
        whole = found.get(width, {})
        covariance = np.array(
            [[(n * whole.get((i, j), 0) - r[i] * r[j]) / (n * n) for j in range(width)] for i in range(width)]
        ).reshape(width, width)
        trace = sum(n * whole.get((i, i), 0) - r[i] * r[i] for i in range(width)) / (n * n)
        pairs = leading(covariance, components) if width else []
        values = np.array([e if e > 8 * width * EPS * trace else 0.0 for e, _ in pairs])
        with np.errstate(divide="ignore"):
            factors = np.where(values > 0, 1 / np.sqrt(values), np.nan)
        scaled = np.array([v for _, v in pairs]).reshape(len(pairs), width).T * factors
        out[width] = Whitening(n, s, centres[width], scaled, values, trace)
    return out


def _second_moments(models: dict[int, Whitening]):
    """Per width the sums of the whitened components and of their products."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for batch in batches:
            for _, x in matrices(batch):
                z = models[x.shape[1]].project(x)
                z = np.hstack([z, np.ones((len(z), 1))])
                totals[x.shape[1]] = totals.get(x.shape[1], 0) + z.T @ z
        for width, total in totals.items():
            i, j = (a.ravel() for a in np.indices(total.shape))
            columns = {"width": np.full(len(i), width), "i": i, "j": j, "total": total.ravel()}
            yield to_batch(columns, MOMENTS)

    return run


def identity_error(fitted: DataFrame, models: dict[int, Whitening]) -> float:
    """The largest absolute entry of the whitened components' covariance less the identity, measured over the fit list."""
    found = fitted.mapInArrow(_second_moments(models), "width int, i int, j int, total double")
    entries = {(w, i, j): t for w, i, j, t in found.groupBy("width", "i", "j").agg(F.sum("total")).collect()}
    worst = 0.0
    for width, model in models.items():
        k = model.scaled.shape[1]
        used = [c for c in range(k) if model.values[c] > 0]
        for i in used:
            for j in used:
                mean = entries[width, i, k] * entries[width, j, k] / model.n**2
                worst = max(worst, abs(entries[width, i, j] / model.n - mean - (i == j)))
    return worst


RESULT = [("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.decimal128(38, 0)), ("whitened", pa.float64()), ("explained", pa.float64())]


def _rows(models: dict[int, Whitening]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([("key", batch.column("key").type), *RESULT])
            for rows, x in matrices(batch):
                model = models[x.shape[1]]
                k = model.scaled.shape[1]
                if not k:
                    continue
                z = model.project(x)
                deviation = [Decimal(d) if d < 10**38 else None for d in model.deviations(x)]
                share = model.values / model.trace if model.trace > 0 else np.zeros(k)
                take = pa.array(np.repeat(rows, k))
                repeated = pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(len(x)), k)))
                whitened = pa.array(z.ravel(), mask=np.isnan(z.ravel()))
                columns = [
                    batch.column("key").take(take),
                    pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(x) * k, model.n)),
                    repeated,
                    whitened,
                    pa.array(np.tile(share, len(x))),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def whiten(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0, components: int = 4
) -> DataFrame:
    """Per usable row and component ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Components become x = floor(scale * c). The fit list is each distinct x vector once: ``n`` of them with sums S.
    Sums and products over it are exact whole numbers, worked out per partition and added in a shuffle; the
    driver gets one matrix of the vectors' width squared. The leading eigenvalues are isolated by inertia
    counts, sharpened by Rayleigh quotient iteration and numbered by counts (``leading``). ``deviation`` is the exact sum of
    (n * x - S)**2 as decimal(38,0), NULL beyond 38 digits; ``whitened`` is x - S / n projected on the component, over the root of its
    eigenvalue; ``explained`` the eigenvalue's share of the trace; ``identity_error`` is measured over the fit list.

    A vector that is NULL or holds a NULL or non-finite component is dropped. Entries beyond a long stand at its end.
    Repeated rows and equal vectors under several keys count once in the fit and come out each. A NULL key stays NULL.
    A component without variance beyond rounding (one distinct vector, or fewer dimensions in use) has a NULL ``whitened`` and
    explains 0. Vectors of different widths are fitted apart, ``identity_error`` being the worst of all;
    an empty vector has no component and gives no row. An empty table gives no rows. Further columns are left out.
    """
    usable = whole_vectors(vectors, vector, scale).select(column(key).alias("key"), "x")
    with Passing() as passing:
        fitted = passing.land(usable.select("x").distinct(), "fit-list")
        models = fit(fitted, components)
        error = identity_error(fitted, models) if models else 0.0
    schema = with_fields(
        usable.select("key").schema, "component int, n long, deviation decimal(38,0), whitened double, explained double"
    )
    found = usable.mapInArrow(_rows(models), schema)
    return found.withColumn("identity_error", F.lit(error)).withColumnRenamed("key", key)
