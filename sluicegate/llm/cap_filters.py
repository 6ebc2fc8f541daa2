"""Near-duplicate vectors by spherical-cap filters from a structured random product code."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import column, landed, to_batch
from sluicegate.llm.components import components

#: Members of one filter that are compared in one task at a time.
BLOCK = 256


@dataclass(frozen=True)
class ProductCode:
    """Directions are one word of each part's code book, side by side, after a random rotation."""

    rotation: np.ndarray
    #: Parts, words of a part, dimensions of a part; words have length 1 / sqrt(parts).
    books: np.ndarray


def build_code(width: int, words: int, parts: int = 4, seed: int = 0) -> ProductCode:
    """A random code of ``words ** parts`` directions for vectors of ``width`` dimensions."""
    rng = np.random.default_rng([seed, width, words])
    each = -(-width // parts)
    full = each * parts
    rotation = np.linalg.qr(rng.standard_normal((full, full)))[0][:width]
    books = rng.standard_normal((parts, words, each))
    books /= np.linalg.norm(books, axis=2, keepdims=True) * np.sqrt(parts)
    return ProductCode(rotation, books)


def _best_sums(a: tuple, b: tuple, caps: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``caps`` largest sums of one number of each list, both from the largest down, with their places.

    The sum of the i-th and j-th largest has i * j others at least as large, so only those with i * j up to
    ``caps`` are looked at: a list is decoded without going through all directions.
    """
    (x, at_x), (y, at_y) = a, b
    i, j = np.nonzero(np.multiply.outer(np.arange(1, x.shape[1] + 1), np.arange(1, y.shape[1] + 1)) <= caps)
    sums = x[:, i] + y[:, j]
    order = np.argsort(-sums, axis=1, kind="stable")[:, :caps]
    places = np.concatenate([at_x[:, i], at_y[:, j]], axis=2)
    return np.take_along_axis(sums, order, axis=1), np.take_along_axis(places, order[:, :, None], axis=1)


def decode_caps(code: ProductCode, unit: np.ndarray, caps: int) -> np.ndarray:
    """Numbers of all directions whose inner product with a row exceeds the row's height, which is set so
    that ``caps`` of them do (all, where the code has fewer)."""
    parts, words, each = code.books.shape
    turned = (unit @ code.rotation).reshape(len(unit), parts, each)
    lists = []
    for p in range(parts):
        sums = turned[:, p] @ code.books[p].T
        order = np.argsort(-sums, axis=1, kind="stable")[:, :caps]
        lists.append((np.take_along_axis(sums, order, axis=1), order[:, :, None]))
    while len(lists) > 1:
        lists = [
            _best_sums(*lists[k : k + 2], caps) if k + 1 < len(lists) else lists[k] for k in range(0, len(lists), 2)
        ]
    number = np.zeros(lists[0][1].shape[:2], dtype=np.int64)
    for p in range(parts):
        number = number * words + lists[0][1][:, :, p]
    return number


def codes_for(rows: int) -> int:
    """Codes that keep recall the same: three up to 60,000 rows, one more for each further power of ten begun."""
    return 3 + max(0, math.ceil(math.log10(max(rows, 1) / 60_000)))


CAPS = pa.schema([("node", pa.int64()), ("label", pa.string()), ("cap", pa.int64())])


def _caps(codes: dict[int, list[ProductCode]], caps: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = np.array(batch.column("node").to_pylist(), dtype=np.int64)
            labels = np.array(batch.column("label").to_pylist(), dtype=object)
            vectors = batch.column("vector").to_pylist()
            widths = np.array([len(v) for v in vectors])
            for width in np.unique(widths):
                of = np.flatnonzero(widths == width)
                for begin in range(0, len(of), 512):
                    some = of[begin : begin + 512]
                    unit = _unit([vectors[i] for i in some])
                    for c, code in enumerate(codes[int(width)]):
                        numbers = decode_caps(code, unit, caps)
                        found = {
                            "node": np.repeat(nodes[some], numbers.shape[1]),
                            "label": np.repeat(labels[some], numbers.shape[1]),
                            "cap": numbers.ravel() * len(codes[int(width)]) + c,
                        }
                        yield to_batch(found, CAPS)

    return run


def _unit(vectors: list) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    x = np.array(vectors, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.square(x).sum(axis=1, keepdims=True))


def _close_pairs(least: float):
    """Links within each group of rows; a partition's rows come sorted by group, a group fits a task.

    Groups are whole when the next one begins; the rows of the one still open wait for the next batch.
    """

    def links(df: pd.DataFrame) -> Iterator[pd.DataFrame]:
        group, label = df["group"].to_numpy(), df["label"].to_numpy()
        block, node = df["block"].to_numpy(), df["node"].to_numpy()
        two = df["two"].to_numpy()
        widths = df["vector"].map(len).to_numpy()
        for width in np.unique(widths):
            of = np.flatnonzero(widths == width)
            x = _unit(df["vector"].iloc[of].tolist())
            g, b, v, t, name = group[of], block[of], node[of], two[of], label[of]
            for lag in range(1, len(of)):
                i = np.flatnonzero(g[lag:] == g[:-lag])
                if not len(i):
                    break
                i = i[(~t[i] | (b[i] != b[i + lag])) & (name[i] == name[i + lag])]
                j = i + lag
                close = np.einsum("nd,nd->n", x[i], x[j]) >= least
                i, j = i[close], j[close]
                if len(i):
                    yield pd.DataFrame({"a": np.minimum(v[i], v[j]), "b": np.maximum(v[i], v[j])})

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting = None
        for batch in batches:
            if waiting is not None and len(waiting):
                batch = pd.concat([waiting, batch], ignore_index=True)
            if not len(batch):
                continue
            open_ = batch["group"] == batch["group"].iloc[-1]
            yield from links(batch[~open_])
            waiting = batch[open_]
        if waiting is not None and len(waiting):
            yield from links(waiting)

    return run


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = 0.93,
    caps: int = 16,
    codes: int | None = None,
    seed: int = 0,
    exact: bool = False,
) -> DataFrame:
    """Per row ``vec_id``, ``n_links`` (other rows linked to it), ``component_id`` (the smallest ``vec_id`` that links
    reach) and ``kept`` (whether that is its own).

    Rows of one label link at a cosine of ``least`` or more, verified in doubles. Candidates lie in one cap
    of a product code: each vector is put into the filters of the ``caps`` directions it lies closest to, in each of ``codes``
    random codes, whose words grow with the number of vectors, so that a filter stays as small, and so do the codes, so that
    recall stays as high (``codes_for``, unless ``codes`` is given). A pair at a cosine of 0.93 shares a filter in 998 of
    1000 cases or more, from two thousand vectors to ten billion (the tests measure it at a width of 64).

    Equal vectors of one label are one node, counted with its copies. Members of a filter meet in blocks, so
    a filter of any size is compared whole and only links leave a task. ``exact`` makes each label one filter: all its vectors are
    compared by the same blocks, no link is missed, and the work is the square of a label's vectors.

    A vector that is NULL, zero or empty, or holds a NULL or non-finite component, and a row without a label,
    link with nothing. Vectors of different lengths do not link. A row with a NULL key comes out with a NULL
    component, kept, and links with nothing. Rows equal in key, label and vector come out once; of rows with one key that differ each is a
    row of its own. Further columns are left out. An empty table gives no rows.
    """
    x = column(vector).cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    fine = fine & F.exists(x, lambda v: v != 0)
    base = vectors.select(
        column(key).cast("long").alias("vec_id"),
        column(label).cast("string").alias("label"),
        F.when(fine, x).alias("vector"),
    )
    keyed = base.where("vec_id is not null").distinct()
    usable = keyed.where("label is not null and vector is not null")
    nodes = usable.groupBy("label", "vector").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    # Numbers of their own: two vectors may have one smallest key.
    nodes = landed(nodes.withColumns({"width": F.size("vector"), "node": F.monotonically_increasing_id()}), "cap-nodes")

    sizes = {r[0]: r[1] for r in nodes.groupBy("width").count().collect()}
    built = {
        w: [build_code(w, max(8, round((16 * n) ** 0.25)), seed=seed + c) for c in range(codes or codes_for(n))]
        for w, n in sizes.items()
    }
    if exact:
        found = nodes.select("node", "label", F.col("width").cast("long").alias("cap"))
    else:
        found = nodes.select("node", "label", "vector").mapInArrow(_caps(built, caps), "node long, label string, cap long")
        found = landed(found, "caps")
    shared = found.groupBy("label", "cap").agg(F.count("*").alias("n")).where("n > 1")
    pieces = F.ceil(F.col("n") / BLOCK)
    members = found.join(shared, ["label", "cap"]).select(
        "node", "label", "cap", (pieces > 1).alias("several"),
        F.pmod(F.xxhash64("node"), pieces).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("other"),
    )
    low, high = F.least("block", "other"), F.greatest("block", "other")
    members = members.select(
        "node", "block", F.xxhash64("label", "cap", low, high).alias("group"), (low != high).alias("two"),
        F.xxhash64("label", F.lit(1)).alias("label"),
    ).join(nodes.select("node", "vector"), "node")
    grouped = members.repartition("group").sortWithinPartitions("group", "block")
    links = grouped.mapInPandas(_close_pairs(least), "a long, b long").distinct()
    links = landed(links, "cap-links")

    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weighed = ends.join(nodes.select(F.col("node").alias("b"), "copies"), "b")
    degree = weighed.groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("near"))
    joined = landed(components(links), "cap-components")
    least_of = joined.join(nodes.select("node", "least_id"), "node").groupBy("component").agg(F.min("least_id").alias("reached"))
    reached = joined.join(least_of, "component").select("node", "reached")
    groups = nodes.join(degree, "node", "left").join(reached, "node", "left").select(
        "label", "vector",
        (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
        F.coalesce("reached", "least_id").alias("component_id"),
    )
    out = keyed.join(groups, ["label", "vector"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    unkeyed = base.where("vec_id is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id")
    )
    return out.unionByName(unkeyed).withColumn("kept", F.coalesce(F.expr("vec_id = component_id"), F.lit(True)))
