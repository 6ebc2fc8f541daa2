"""Approximate nearest neighbours by cosine: cross-polytope hashes, several probes a table, exact reranking."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluicegate.llm.common import Passing, column, landed, to_batch

#: Over-full buckets up to this many are sent to every task (some 40 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 100_000
SALTS = 16
BUCKET = ["width", "table", "bucket"]
PIECE = [*BUCKET, "block", "part"]


# --- hashing ----------------------------------------------------------------------------------


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of each row, in n log n additions; widths are powers of two."""
    n, h = x.shape[1], 1
    while h < n:
        pairs = x.reshape(len(x), -1, 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


@dataclass(frozen=True)
class Table:
    """One hash table: a bucket is the nearest signed axis after each of several pseudo-rotations.

    A pseudo-rotation is three rounds of random signs and a Hadamard transform. ``axes`` says how many of its axes count.
    """

    axes: tuple[int, ...]
    #: Rotation, round, dimension.
    signs: np.ndarray

    def turned(self, unit: np.ndarray) -> list[np.ndarray]:
        full = self.signs.shape[2]
        padded = np.zeros((len(unit), full))
        padded[:, : unit.shape[1]] = unit
        out = []
        for axes, rounds in zip(self.axes, self.signs):
            x = padded
            for signs in rounds:
                x = hadamard(x * signs)
            out.append(x[:, :axes])
        return out

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        number = np.zeros(len(unit), dtype=np.int64)
        for x in self.turned(unit):
            axis = np.abs(x).argmax(axis=1)
            negative = x[np.arange(len(x)), axis] < 0
            number = number * (2 * x.shape[1]) + 2 * axis + negative
        return number

    def probes(self, unit: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` buckets likeliest to hold a near row, likeliest first (all, where there are fewer).

        A signed axis costs the square of what it falls short of the nearest one; costs of the rotations add up.
        """
        costs, numbers = np.zeros((len(unit), 1)), np.zeros((len(unit), 1), dtype=np.int64)
        for x in self.turned(unit):
            both = np.stack([x, -x], axis=2).reshape(len(x), -1)
            short = np.square(both.max(axis=1, keepdims=True) - both)
            order = np.argsort(short, axis=1, kind="stable")[:, :count]
            short = np.take_along_axis(short, order, axis=1)
            # Of sorted lists the i-th and j-th together have i * j others that cost no more.
            i, j = np.nonzero(np.multiply.outer(np.arange(1, costs.shape[1] + 1), np.arange(1, short.shape[1] + 1)) <= count)
            sums = costs[:, i] + short[:, j]
            joined = numbers[:, i] * both.shape[1] + order[:, j]
            best = np.argsort(sums, axis=1, kind="stable")[:, :count]
            costs, numbers = np.take_along_axis(sums, best, axis=1), np.take_along_axis(joined, best, axis=1)
        return numbers


def build_tables(width: int, bits: int, tables: int, seed: int) -> list[Table]:
    """Tables of 2**bits buckets: rotations of all axes as long as there are bits for them, and one of fewer axes."""
    full = 1 << max(0, (width - 1).bit_length())
    each = full.bit_length()
    axes = [full] * (bits // each) + ([1 << (bits % each - 1)] if bits % each else [])
    rng = np.random.default_rng([seed, width, bits])
    return [Table(tuple(axes), rng.choice([-1.0, 1.0], (len(axes), 3, full))) for _ in range(tables)]


@dataclass(frozen=True)
class Index:
    tables: list[Table]
    probes: int


# --- vectors ----------------------------------------------------------------------------------


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, which rounds nothing, so that no square overflows or vanishes."""
    x = np.asarray(x, dtype=np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt(np.square(x).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of each row of ``a`` with the same of ``b``, worked out alike whatever stands beside it."""
    a, b = scaled(a), scaled(b)
    lengths = np.sqrt(np.einsum("nd,nd->n", a, a)) * np.sqrt(np.einsum("nd,nd->n", b, b))
    return np.einsum("nd,nd->n", a, b) / lengths


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    lists = batch.column("vector")
    widths = lists.value_lengths().to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        yield rows, lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), int(width))


def _packed(x: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(x)]


def _opened(packed: pa.ChunkedArray, width: int) -> np.ndarray:
    data = packed.to_pylist()
    return np.frombuffer(b"".join(data), dtype="<f4" if len(data[0]) == 4 * width else "<f8").reshape(len(data), width)


# --- fitting ----------------------------------------------------------------------------------


SAMPLED = pa.schema([("width", pa.int32()), ("asked", pa.int32()), ("score", pa.float64()), ("tie", pa.int64()), ("vector", pa.list_(pa.float64()))])


def _nearest_of(samples: dict[int, tuple[list, np.ndarray]], k: int):
    """The k nearest of this partition's vectors for each sampled query, by looking at all of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        for batch in batches:
            keys = list(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist()))
            for rows, x in _by_width(batch):
                if x.shape[1] not in samples:
                    continue
                own, asked = samples[x.shape[1]]
                found = asked @ _unit(x).T
                for q, scores in enumerate(found):
                    top = best.setdefault((x.shape[1], q), [])
                    for i in np.argsort(-scores)[: k + 1]:
                        if keys[rows[i]] != own[q]:
                            top.append((-float(scores[i]), keys[rows[i]][0], x[i].astype(float).tolist()))
                    best[x.shape[1], q] = sorted(top)[:k]
        for (width, q), top in best.items():
            columns = {
                "width": [width] * len(top), "asked": [q] * len(top), "score": [-s for s, _, _ in top],
                "tie": [t for _, t, _ in top], "vector": [v for _, _, v in top],
            }
            yield to_batch(columns, SAMPLED)

    return run


def probes_needed(tables: list[Table], asked: np.ndarray, near: np.ndarray, recall: float, most: int) -> int | None:
    """How many probes a table reach this share of the pairs (query, near row); None where ``most`` do not."""
    ranks = np.full(len(asked), most)
    for table in tables:
        listed = table.probes(asked, most)
        hit = listed == table.buckets(near)[:, None]
        ranks = np.minimum(ranks, np.where(hit.any(axis=1), hit.argmax(axis=1), most))
    rank = int(np.sort(ranks)[math.ceil(recall * len(ranks)) - 1])
    return rank + 1 if rank < most else None


def fit_index(
    nodes: DataFrame,
    asked: DataFrame,
    k: int,
    tables: int,
    recall: float,
    sample_queries: int,
    bucket_rows: int,
    most_probes: int,
    seed: int,
) -> dict[int, Index]:
    """Per width as many buckets as its rows ask for and as many probes as find ``recall`` of the true neighbours of a sample.

    The sample is ``sample_queries`` queries a width, chosen by a hash; their neighbours are those of all rows.
    """
    sizes = {w: n for w, n in nodes.groupBy("width").count().collect()}
    order = W.partitionBy("width").orderBy(F.xxhash64("k1", F.lit(seed)), "k1", "k2")
    chosen = asked.withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample_queries)
    samples: dict[int, tuple[list, list]] = {}
    for width, k1, k2, vector in chosen.select("width", "k1", "k2", "vector").collect():
        own, vectors = samples.setdefault(width, ([], []))
        own.append((k1, k2))
        vectors.append(vector)
    units = {w: (own, _unit(np.array(v))) for w, (own, v) in samples.items()}
    found = nodes.select("k1", "k2", "vector").mapInArrow(
        _nearest_of(units, k), "width int, asked int, score double, tie long, vector array<double>"
    )
    nearest = W.partitionBy("width", "asked").orderBy(F.desc("score"), "tie")
    pairs = found.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k).collect()
    out = {}
    for width, (_, asked) in units.items():
        of = [r for r in pairs if r["width"] == width]
        for bits in range(max(1, round(math.log2(max(2, sizes[width] / bucket_rows)))), 0, -1):
            made = build_tables(width, bits, tables, seed)
            if not of:
                out[width] = Index(made, 1)
                break
            near = _unit(np.array([r["vector"] for r in of]))
            probes = probes_needed(made, asked[[r["asked"] for r in of]], near, recall, min(most_probes, 1 << bits))
            if probes is not None:
                out[width] = Index(made, probes)
                break
    return out


# --- searching --------------------------------------------------------------------------------


def _entries(indexes: dict[int, Index], kind: str, seen: Callable):
    """Each vector's buckets, table by table: one for a row of the index, the probes for a query."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _by_width(batch):
                index = indexes.get(x.shape[1])
                if index is None:
                    continue
                for begin in range(0, len(rows), 1024):
                    some, part = rows[begin : begin + 1024], x[begin : begin + 1024]
                    unit = _unit(part)
                    for t, table in enumerate(index.tables):
                        buckets = table.buckets(unit)[:, None] if kind == "row" else table.probes(unit, index.probes)
                        yield seen(batch, some, part, t, buckets)

    return run


COUNTS = "width int, table int, bucket long, n long"


def _counted(batch: pa.RecordBatch, rows: np.ndarray, x: np.ndarray, table: int, buckets: np.ndarray) -> pa.RecordBatch:
    bucket, n = np.unique(buckets, return_counts=True)
    columns = {"width": np.full(len(n), x.shape[1]), "table": np.full(len(n), table), "bucket": bucket, "n": n}
    schema = pa.schema([("width", pa.int32()), ("table", pa.int32()), ("bucket", pa.int64()), ("n", pa.int64())])
    return to_batch(columns, schema)


def _carried(*names: str):
    """Vectors packed as they came (four or eight bytes a component), with the columns ``names`` beside them."""

    def run(batch: pa.RecordBatch, rows: np.ndarray, x: np.ndarray, table: int, buckets: np.ndarray) -> pa.RecordBatch:
        each = buckets.shape[1]
        take = np.repeat(np.arange(len(rows)), each)
        n = len(take)
        columns = [pa.array(np.full(n, x.shape[1]), pa.int32()), pa.array(np.full(n, table), pa.int32()), pa.array(buckets.ravel())]
        columns += [batch.column(name).take(pa.array(rows[take])) for name in names]
        columns.append(pa.array(_packed(x), pa.binary()).take(pa.array(take)))
        return pa.RecordBatch.from_arrays(columns, names=[*BUCKET, *names, "data"])

    return run


FOUND_DDL = "k1 long, k2 long, own long, vec_id long, row long, score double"
FOUND = pa.schema(
    [("k1", pa.int64()), ("k2", pa.int64()), ("own", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.float64())]
)


def search(
    asked: np.ndarray, own: np.ndarray, none: np.ndarray, rows: np.ndarray, ids: list[list[int]], k: int
) -> tuple[np.ndarray, ...]:
    """For each vector of ``asked`` its k nearest ids but ``own`` (unless it has ``none``): places of queries and rows, ids, cosines.

    ``ids`` are those of each row, from the smallest, none twice. A quick product settles which rows can be among the
    nearest; their cosines are then worked out one by one.
    """
    flat = np.array([i for some in ids for i in some], dtype=np.int64)
    lengths = np.array([len(some) for some in ids])
    begin = np.cumsum(lengths) - lengths
    quick = _unit(asked) @ _unit(rows).T
    # A row that has no other id than the query's own is no candidate.
    quick[(lengths == 1) & (flat[begin] == own[:, None]) & ~none[:, None]] = -np.inf
    if len(rows) > k:
        least = np.partition(quick, len(rows) - k, axis=1)[:, len(rows) - k] - 1e-12
        q, r = np.nonzero(quick >= least[:, None])
    else:
        q, r = (a.ravel() for a in np.indices(quick.shape))
    score = np.concatenate(
        [cosines(asked[q[b : b + 65536]], rows[r[b : b + 65536]]) for b in range(0, len(q), 65536)] or [np.empty(0)]
    )
    times = lengths[r]
    inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    vec_id = flat[np.repeat(begin[r], times) + inner]
    q, r, score = (np.repeat(x, times) for x in (q, r, score))
    other = (vec_id != own[q]) | none[q]
    q, r, vec_id, score = q[other], r[other], vec_id[other], score[other]
    order = np.lexsort((vec_id, -score, q))
    q, r, vec_id, score = q[order], r[order], vec_id[order], score[order]
    top = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[top], r[top], vec_id[top], score[top]


def _searched(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(rows) or not len(queries):
            return FOUND.empty_table()
        width = rows.column("width")[0].as_py()
        own = queries.column("own").combine_chunks()
        q, r, vec_id, score = search(
            _opened(queries.column("data"), width),
            own.fill_null(0).to_numpy(),
            own.is_null().to_numpy(zero_copy_only=False),
            _opened(rows.column("data"), width),
            rows.column("ids").to_pylist(),
            k,
        )
        columns = [queries.column(c).combine_chunks().take(pa.array(q)) for c in ("k1", "k2", "own")]
        columns += [pa.array(vec_id), rows.column("k1").combine_chunks().take(pa.array(r)), pa.array(score)]
        return pa.Table.from_arrays(columns, schema=FOUND)

    return run


def _index_rows(rows: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Each distinct vector once, with the k + 1 smallest ids that have it: no more can be among a query's k nearest.

    Ids are reduced without their vectors.
    """
    smallest = W.partitionBy("k1", "k2").orderBy("id")
    first = pairs.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k + 1)
    ids = first.groupBy("k1", "k2").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    vectors = rows.groupBy("k1", "k2").agg(F.first("vector").alias("vector"))
    return vectors.join(ids, ["k1", "k2"]).select("k1", "k2", "vector", F.size("vector").alias("width"), "ids")


def _asking(pairs: DataFrame, is_query: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """What is searched for, ``k1, k2, own``, and the queries that share a search. A vector is searched for once, whatever the
    number of queries that have it; but a query with several vectors searches for each by itself, as it must not
    find the others."""
    asking = pairs.where(is_query(F.col("id")))
    times = asking.groupBy("id").agg((F.count("*") > 1).alias("several"))
    marked = asking.join(times, "id")
    shared = marked.where("not several").select("k1", "k2", "id")
    apart = marked.where("several").select("k1", "k2", F.col("id").alias("own"))
    once = shared.groupBy("k1", "k2").agg(F.when(F.count("*") == 1, F.min("id")).alias("own"))
    return once.unionByName(apart), shared


def nearest(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    tables: int = 2,
    recall: float = 0.97,
    sample_queries: int = 128,
    bucket_rows: int = 1024,
    most_probes: int = 256,
    block_rows: int = 4096,
    query_rows: int = 1024,
    seed: int = 0,
) -> DataFrame:
    """For every row where ``is_query`` (a column of ``key``) holds, the ids of the k nearest other rows that are found, by cosine
    in doubles: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; ties to the smaller id.

    Every row is put into one bucket in each of ``tables`` cross-polytope tables, of some ``bucket_rows`` rows each. A query
    looks into as many buckets a table as find the share ``recall`` of the true neighbours of ``sample_queries`` sampled
    queries, which are searched among all rows; tables that would need more than ``most_probes`` get fewer buckets, at last so few that
    all are looked into. All rows of a bucket are compared, those of a large one in blocks of ``block_rows`` that
    meet its queries in blocks of ``query_rows``; k + 1 ids a query leave a block.

    Equal vectors are one row of the index, with the ids that can be among the nearest, and one query. Vectors that are
    NULL, empty, zero or hold a NULL or non-finite component take no part, nor do NULL ids; vectors of different widths are
    not compared. Rows equal in id and vector count once. Of several vectors under one id each is a candidate, and each that is
    a query is searched for, the nearest k of all going to the id; no row is a candidate for its own id. An empty table gives
    no rows. Further columns are left out.
    """
    x = column(vector)
    double = x.cast("array<double>")
    fine = F.forall(double, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    fine = F.coalesce(fine & F.exists(double, lambda v: v != 0), F.lit(False))
    kind = "float" if dict(vectors.dtypes)[vector] == "array<float>" else "double"
    rows = vectors.where(fine & column(key).isNotNull()).select(
        column(key).cast("long").alias("id"), x.cast(f"array<{kind}>").alias("vector")
    )
    # 128 bits say which vectors are equal.
    rows = rows.select("id", "vector", F.xxhash64(F.lit(1), "vector").alias("k1"), F.xxhash64(F.lit(2), "vector").alias("k2"))
    with Passing() as passing:
        pairs = rows.select("k1", "k2", "id").distinct()
        nodes = passing.land(_index_rows(rows, pairs, k), "vectors")
        asked, shared = _asking(pairs, is_query)
        asked = passing.land(asked.join(nodes.drop("ids"), ["k1", "k2"]), "queries")
        indexes = fit_index(nodes, asked, k, tables, recall, sample_queries, bucket_rows, most_probes, seed)
        best = landed_best(nodes, asked, indexes, k, block_rows, query_rows)
    # Most vectors are asked by one id; those of several are joined back, salted.
    known = best.where("own is not null").select(F.col("own").alias("query_id"), "vec_id", "score")
    salt = F.pmod(F.xxhash64("query_id"), F.lit(SALTS)).cast("int")
    asking = shared.withColumnRenamed("id", "query_id").withColumn("salt", salt)
    several = best.where("own is null").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = several.join(asking, ["k1", "k2", "salt"]).where("vec_id <> query_id").select("query_id", "vec_id", "score")
    place = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = known.unionByName(joined).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def landed_best(
    nodes: DataFrame, asked: DataFrame, indexes: dict[int, Index], k: int, block_rows: int, query_rows: int
) -> DataFrame:
    """The k + 1 nearest of each search."""
    in_index = nodes.select("k1", "vector", "ids")
    in_query = asked.select("k1", "k2", "vector", "own")

    def counts(df: DataFrame, side: str, name: str, most: int) -> DataFrame:
        n = df.select("vector").mapInArrow(_entries(indexes, side, _counted), COUNTS)
        return n.groupBy(*BUCKET).agg(F.sum("n").alias(name)).where(F.col(name) > most)

    over = counts(in_index, "row", "n_rows", block_rows).join(
        counts(in_query, "query", "n_queries", query_rows), BUCKET, "full"
    )
    with Passing() as passing:
        over = passing.land(
            over.select(
                *BUCKET,
                F.coalesce(F.ceil(F.col("n_rows") / block_rows), F.lit(1)).cast("int").alias("blocks"),
                F.coalesce(F.ceil(F.col("n_queries") / query_rows), F.lit(1)).cast("int").alias("parts"),
            ),
            "large-buckets",
        )
        few = over.count() <= BROADCAST_ROWS

        def dealt(df: DataFrame, own: str, count: str, other: str, others: str) -> DataFrame:
            """One of the pieces of its side, and a copy for each piece of the other."""
            df = df.join(F.broadcast(over) if few else over, BUCKET, "left")
            pieces, copies = (F.coalesce(c, F.lit(1)) for c in (count, others))
            return df.withColumns(
                {
                    own: F.pmod(F.xxhash64("k1", F.lit(3)), pieces).cast("int"),
                    other: F.explode(F.sequence(F.lit(0), copies - 1)),
                }
            ).drop("blocks", "parts")

        head = "width int, table int, bucket long, "
        entries = in_index.mapInArrow(
            _entries(indexes, "row", _carried("k1", "ids")), head + "k1 long, ids array<long>, data binary"
        )
        probes = in_query.mapInArrow(
            _entries(indexes, "query", _carried("k1", "k2", "own")), head + "k1 long, k2 long, own long, data binary"
        )
        entries = dealt(entries, "block", "blocks", "part", "parts")
        probes = dealt(probes, "part", "parts", "block", "blocks")
        found = entries.groupBy(*PIECE).cogroup(probes.groupBy(*PIECE)).applyInArrow(_searched(k + 1), FOUND_DDL)
        # A row that is found in several tables is found once.
        scored = found.groupBy("k1", "k2", "own", "vec_id", "row").agg(F.max("score").alias("score"))
        place = W.partitionBy("k1", "k2", "own").orderBy(F.desc("score"), "vec_id")
        best = scored.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k + 1).drop("place", "row")
        return landed(best, "nearest")
