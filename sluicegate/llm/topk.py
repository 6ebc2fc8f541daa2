"""Exact top-k by inner product: columnar branch and bound over blocks of vectors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluicegate.llm.common import ceil_div, column

RESULT = "query_id long, vec_id long, score long"
LONG = 2**63


def usable(vector: str) -> Column:
    """Vectors that take part: not NULL or empty, no component NULL or not finite."""
    x = column(vector).cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce((F.size(x) > 0) & fine, F.lit(False))


def _block(side: str):
    """One row per block: ids, and the components one dimension after another (vertical layout)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        matrix = np.stack(pdf["vector"].to_numpy()).T
        for kind in ("<i1", "<i2", "<i4", "<f8"):
            if (matrix == matrix.astype(kind)).all() if np.abs(matrix).max() < 2**31 else kind == "<f8":
                break
        row = [pdf[c].iloc[0] for c in ("width", "block")]
        data = np.ascontiguousarray(matrix.astype(kind)).tobytes()
        ids = pdf["id"].to_numpy().astype("<i8").tobytes()
        return pd.DataFrame([[*row, ids, kind, data]], columns=["width", side, f"{side}_ids", f"{side}_kind", f"{side}_data"])

    return run


def _open(row, side: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{side}_ids"], dtype="<i8")
    data = np.frombuffer(row[f"{side}_data"], dtype=row[f"{side}_kind"]).reshape(-1, len(ids))
    return ids, data.astype(np.float64)


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, step: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """The k best (rows, scores) of ``vectors`` for each query; both have a dimension per row.

    Scores grow by blocks of ``step`` dimensions. After each block what the remaining dimensions can still
    add is bounded by the product of the remaining lengths (Cauchy-Schwarz). The k-th best lower bound is a
    score that k candidates reach; those whose upper bound lies below it are dropped and the rest
    compacted. Bounds have room for rounding; the scores themselves are sums of whole numbers, exact in
    doubles up to 2**53 and taken in unbounded integers beyond.
    """
    width = len(vectors)
    cuts = [*range(0, width, step), width]
    left_v = np.sqrt(np.stack([np.square(vectors[c:]).sum(axis=0) for c in cuts[1:]]))
    left_q = np.sqrt(np.stack([np.square(queries[c:]).sum(axis=0) for c in cuts[1:]]))
    largest = np.sqrt(np.square(vectors).sum(axis=0).max() * np.square(queries).sum(axis=0).max())
    wide = largest * width >= 2**53
    blocks = [np.ascontiguousarray(vectors[a:b]) for a, b in zip(cuts, cuts[1:])]
    # The first block of dimensions for many queries at once, the others for each one's survivors.
    out = []
    for begin in range(0, queries.shape[1], 128):
        part = queries[:, begin : begin + 128]
        first = part[: cuts[1]].T @ blocks[0]
        for q in range(part.shape[1]):
            score, rows = first[q].copy(), None
            # Rows come sorted by id: those under the query's own are one stretch.
            own = slice(*(int(np.searchsorted(ids, query_ids[begin + q], side=s)) for s in ("left", "right")))
            for b in range(len(blocks)):
                if b:
                    chosen = blocks[b] if rows is None else blocks[b][:, rows]
                    score = score + part[cuts[b] : cuts[b + 1], q] @ chosen
                else:
                    score[own] = -np.inf
                if len(score) <= k:
                    continue
                rest = left_q[b, begin + q] * (left_v[b] if rows is None else left_v[b][rows])
                slack = 1e-9 * largest
                enough = np.partition(score - rest, len(score) - k)[len(score) - k] - slack
                stay = score + rest + slack >= enough
                if stay.sum() < 0.7 * len(score):
                    rows = np.flatnonzero(stay) if rows is None else rows[stay]
                    score = score[stay]
            rows = np.arange(len(score)) if rows is None else rows
            rows, score = rows[np.isfinite(score)], score[np.isfinite(score)]
            if wide:
                whole = [int(x) for x in part[:, q]]
                exact = (sum(x * int(y) for x, y in zip(whole, vectors[:, r])) for r in rows)
                score = np.array([max(-LONG, min(LONG - 1, s)) for s in exact], dtype=object)
            order = sorted(range(len(rows)), key=lambda i: (-score[i], ids[rows[i]])) if wide else np.lexsort((ids[rows], -score))
            order = np.array(order[:k], dtype=np.int64)
            out.append((rows[order], score[order]))
    return out


def _search(k: int, step: int):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                query_ids, queries = _open(row, "q")
                ids, vectors = _open(row, "c")
                found = search_block(query_ids, queries, ids, vectors, k, step)
                yield pd.DataFrame(
                    {
                        "query_id": np.repeat(query_ids, [len(r) for r, _ in found]),
                        "vec_id": np.concatenate([ids[r] for r, _ in found]),
                        "score": [int(s) for _, x in found for s in x],
                    }
                )

    return run


def top_k(
    vectors: DataFrame,
    is_query,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = 64.0,
    k: int = 20,
    block_rows: int = 8192,
    query_rows: int = 1024,
    step: int = 16,
) -> DataFrame:
    """For every row where ``is_query`` (a column of ``key``) holds, its k other rows with the highest inner
    product of floor(scale * component): ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Queries and candidates are dealt into blocks by a hash of their id; each pair of a query block and a
    candidate block is one row, searched on its own by ``search_block``, which sends on k rows per query. Their best k are
    then taken per query, ties going to the smaller id.

    A vector that is NULL, empty or holds a NULL or non-finite component takes no part, nor does a NULL id. Vectors
    of different lengths are not compared. Rows equal in id and vector count once. Of rows with one id each is a candidate, and each that is a query
    is asked for, the best k of all going to the id; no row is a candidate for its own id. A score beyond the range of a long is the end of the range, before ranking. An empty table gives no rows.
    """
    scaled = F.transform(column(vector).cast("array<double>"), lambda x: x * F.lit(float(scale)))
    rows = vectors.where(usable(vector)).select(column(key).cast("long").alias("id"), scaled.alias("vector"))
    rows = rows.where("id is not null and forall(vector, x -> abs(x) < double('infinity'))")
    rows = rows.distinct()
    floor = F.transform("vector", lambda x: F.when(F.abs(x) < 2**52, F.floor(x).cast("double")).otherwise(x))
    rows = rows.select("id", floor.alias("vector"), F.size("vector").alias("width"))
    queries = rows.where(is_query(F.col("id")))
    n = rows.agg(F.count("*"), F.count_if(is_query(F.col("id")))).first()
    c_blocks, q_blocks = ceil_div(n[0], block_rows), ceil_div(n[1], query_rows)

    def blocks(df: DataFrame, side: str, count: int) -> DataFrame:
        schema = f"width int, {side} long, {side}_ids binary, {side}_kind string, {side}_data binary"
        df = df.withColumn("block", F.pmod(F.xxhash64("id", F.lit(side)), F.lit(count)))
        return df.groupBy("width", "block").applyInPandas(_block(side), schema)

    def each(count: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    # Every query block meets every candidate block: the stated queries against all rows, a block pair a row.
    q = blocks(queries, "q", q_blocks).withColumn("c", each(c_blocks))
    c = blocks(rows, "c", c_blocks).withColumn("q", each(q_blocks))
    found = q.join(c, ["width", "q", "c"]).mapInPandas(_search(k, step), RESULT)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
