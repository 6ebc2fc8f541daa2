"""Near-duplicate documents: ProbMinHash of weighted word shingles, banding, verification, components."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import column, landed, to_batch, with_fields
from sluicegate.llm.components import components

_WORDS = re.compile(r"\w+")
_GOLDEN = 0x9E3779B97F4A7C15
_A, _B, _C = (np.uint64(x) for x in (_GOLDEN, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: What a sum of as many fractions may lack of its value.
ROUNDING = 1e-12
#: Members of a bucket that are compared in one task at a time.
BLOCK = 256


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


class _Keys(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        key = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return key


_KEYS = _Keys()


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _WORDS.findall((text or "").lower())


def shingles(words: list[str], length: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of ``length`` words as sorted 64-bit keys, and how often each comes. A shorter text
    is one shingle; one without words has none."""
    keys = np.fromiter(map(_KEYS.__getitem__, words), dtype=np.uint64, count=len(words))
    n = min(length, len(keys))
    if not n:
        return keys, np.zeros(0, dtype=np.int64)
    h = np.full(len(keys) - n + 1, np.uint64(n))
    for i in range(n):
        h = _mix(h * _A + keys[i : len(keys) - n + 1 + i])
    return np.unique(h, return_counts=True)


def signatures(documents: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """ProbMinHash signatures: two agree at a place with the probability Jaccard similarity.

    The places of a signature are points in time. Each shingle arrives as a Poisson process whose rate
    is its weight, every arrival at a drawn place; a place keeps the shingle that came first. Arrivals
    of a shingle are drawn one by one from hashes of it, and stop as soon as the next one is later than
    the latest time that the document's places hold. Texts without shingles have zeros.
    """
    out = np.zeros((len(documents), size), dtype=np.uint64)
    filled = [i for i, d in enumerate(documents) if len(d[0])]
    if not filled:
        return out
    element = np.concatenate([documents[i][0] for i in filled])
    rate = np.concatenate([documents[i][1] for i in filled]).astype(np.float64)
    doc = np.repeat(np.arange(len(filled)), [len(documents[i][0]) for i in filled])
    best = np.full(len(filled) * size, np.inf)
    kept = np.zeros(len(filled) * size, dtype=np.uint64)
    time = np.zeros(len(element))
    arrival = 0
    while len(element):
        arrival += 1
        h = _mix(element + np.uint64(arrival * _GOLDEN % 2**64))
        wait = -np.log1p(-((h >> np.uint64(11)).astype(np.float64) * 2.0**-53))
        time = time + wait / rate
        place = doc * size + (_mix(h ^ _C) % np.uint64(size)).astype(np.int64)
        np.minimum.at(best, place, time)
        won = best[place] == time
        kept[place[won]] = element[won]
        latest = best.reshape(-1, size).max(axis=1)
        on = time < latest[doc]
        element, rate, doc, time = element[on], rate[on], doc[on], time[on]
    out[filled] = kept.reshape(-1, size)
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two weighted sets with sorted keys: over the keys that both hold, the sum of
    1 / sum over all keys k of max(a_k / a_key, b_k / b_key). With equal weights it is the plain Jaccard."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = a[1][i].astype(np.float64), b[1][j].astype(np.float64)
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    ratio = y / x
    steps, place = np.unique(ratio, return_inverse=True)
    sum_x, sum_y = np.bincount(place, x), np.bincount(place, y)
    # A key whose ratio is above the present one's counts by b's weight, the others by a's.
    below, above = np.cumsum(sum_x), sum_y[::-1].cumsum()[::-1]
    above = np.append(above[1:], 0.0)
    per_step = (only_a + below)[place] / x + (only_b + above)[place] / y
    return float((1 / per_step).sum())


def _pack(weighted: tuple[np.ndarray, np.ndarray]) -> bytes:
    return weighted[0].astype("<u8").tobytes() + weighted[1].astype("<u4").tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 12
    return np.frombuffer(data, "<u8", n), np.frombuffer(data, "<u4", n, 8 * n).astype(np.int64)


SIGNED = pa.schema([("node", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _sign(bands: int, rows: int, length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            nodes, hashes = [], []
            for part in _runs(texts):
                split = [words_of(t) for t in part]
                found = signatures([shingles(w, length) for w in split], bands * rows)
                h = np.zeros((len(part), bands), dtype=np.uint64)
                for r in range(rows):
                    h = _mix(h * _A + found[:, r::rows])
                for w, row in zip(split, h.astype(np.int64).tolist()):
                    joined = " ".join(w).encode("utf-8", "surrogatepass")
                    nodes.append(xxhash.xxh3_128_digest(joined) if w else None)
                    hashes.append(row if w else None)
            out = to_batch({"node": nodes, "bands": hashes}, SIGNED)
            arrays = [*batch.columns[:-1], *out.columns]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], *SIGNED.names])

    return run


def _runs(texts: list, characters: int = 2_000_000) -> Iterator[list]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= characters:
            yield part
            part, size = [], 0
    if part:
        yield part


def _shingle_rows(length: int):
    schema = pa.schema([("node", pa.binary()), ("shingles", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                packed = [_pack(shingles(words_of(t), length)) for t in batch.column(1).to_pylist()]
                yield to_batch({"node": batch.column(0), "shingles": packed}, schema)

    return run


PAIR = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _verify_rows(least: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (map(_unpack, batch.column(i).to_pylist()) for i in (2, 3))
            mask = pa.array([similarity(p, q) >= least - ROUNDING for p, q in zip(x, y)], pa.bool_())
            yield pa.RecordBatch.from_arrays(batch.columns[:2], schema=PAIR).filter(mask)

    return run


def shared_weight(sets: list[tuple[np.ndarray, np.ndarray]], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The sum over all keys of the lesser weight, for each of ``first`` with each of ``second``: a product of
    matrices that have a column for each occurrence of a key, made some thousand columns at a time."""
    keys = np.concatenate([np.repeat(k, w) for k, w in sets])
    weights = np.concatenate([w for _, w in sets])
    ends = np.cumsum(weights)
    occurrence = np.arange(len(keys)) - np.repeat(ends - weights, weights)
    keys = np.where(occurrence == 0, keys, _mix(keys + occurrence.astype(np.uint64) * _B))
    owner = np.repeat(np.arange(len(sets)), [int(w.sum()) for _, w in sets])
    _, place, times = np.unique(keys, return_inverse=True, return_counts=True)
    met = times > 1
    place, owner = (np.cumsum(met) - 1)[place[met[place]]], owner[met[place]]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    total = np.zeros((len(first), len(second)), dtype=np.float32)
    for begin in range(0, int(met.sum()), 4096):
        a, b = np.searchsorted(place, [begin, begin + 4096])
        table = np.zeros((len(sets), 4096), dtype=np.float32)
        table[owner[a:b], place[a:b] - begin] = 1
        total += table[first] @ table[second].T
    return total.astype(np.int64)


def _verify_bucket(least: float):
    """Links from members outside their bucket's largest component to members of any other component; of
    those that become connected in here, no more pairs are compared.

    Where each shingle comes once the shared weight gives the similarity. Elsewhere it rules out: normalised
    weights overlap by at most the shared weight over the smaller total, and two sets with a probability
    Jaccard of J overlap by J or more.
    """

    def run(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_pylist()
        probe = np.array(group.column("probe").to_pylist(), dtype=bool)
        sets = [_unpack(x) for x in group.column("shingles").to_pylist()]
        names = {c: i for i, c in enumerate(dict.fromkeys(group.column("component").to_pylist()))}
        label = np.array([names[c] for c in group.column("component").to_pylist()])
        found: dict[str, list] = {"a": [], "b": []}
        probes, others = np.flatnonzero(probe), np.flatnonzero(~probe)
        total = np.array([w.sum() for _, w in sets])
        plain = np.array([len(k) for k, _ in sets]) == total
        shared = shared_weight(sets, probes, others)
        either = total[probes][:, None] + total[others][None, :] - shared
        less = np.minimum(total[probes][:, None], total[others][None, :])
        both_plain = plain[probes][:, None] & plain[others][None, :]
        able = np.where(both_plain, shared >= least * either - 1e-6, shared >= least * less - 1e-6)
        able &= label[probes][:, None] != label[others][None, :]
        for p, q in zip(*np.nonzero(able)):
            i, j = probes[p], others[q]
            if label[i] != label[j] and similarity(sets[i], sets[j]) >= least - ROUNDING:
                label[label == label[j]] = label[i]
                found["a"].append(nodes[i])
                found["b"].append(nodes[j])
        return pa.Table.from_batches([to_batch(found, PAIR)], schema=PAIR)

    return run


def _unsettled(members: DataFrame, found: DataFrame) -> DataFrame:
    """Block pairs of the buckets that the stars left in several pieces; with two members there was no other pair.

    Members outside the largest piece of their bucket (``probe``) meet all members, so a bucket
    of very many documents and a few strays costs in proportion to its size.
    """
    bucket = ["band", "value"]
    placed = members.where("size > 2").join(found, "node", "left")
    placed = placed.select(*bucket, "node", F.coalesce("component", "node").alias("component"))
    pieces = placed.groupBy(*bucket, "component").agg(F.count("*").alias("n"))
    pieces = pieces.groupBy(*bucket).agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"),
        F.sum("n").alias("n"),
        (F.sum("n") - F.max("n")).alias("outside"),
    )
    placed = placed.join(pieces.where("outside > 0"), bucket)
    probes, blocks = F.ceil(F.col("outside") / BLOCK), F.ceil(F.col("n") / BLOCK)
    place = F.xxhash64("node")
    zero = F.lit(0).cast("long")
    as_probe = placed.where("component <> largest").select(
        *bucket, "node", "component", F.lit(True).alias("probe"),
        F.pmod(place, probes).alias("p"), F.explode(F.sequence(zero, blocks - 1)).alias("q"),
    )
    as_other = placed.select(
        *bucket, "node", "component", F.lit(False).alias("probe"),
        F.explode(F.sequence(zero, probes - 1)).alias("p"), F.pmod(place, blocks).alias("q"),
    )
    return as_probe.unionByName(as_other)


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: float = 0.8,
    length: int = 5,
    bands: int = 16,
    rows: int = 4,
) -> DataFrame:
    """Per row its group: ``doc_id``, ``component_id`` (the smallest ``doc_id`` that links reach), ``kept`` (whether
    it is that document, of two texts under one ``doc_id`` one), ``text_hash`` (the text's ``xxhash64`` in Spark).

    Two documents are linked when their shingles of ``length`` words, weighted by how often they come, have a
    probability Jaccard of ``least`` or more, verified exactly. Candidates share one of ``bands`` bands of
    ``rows`` places: at 0.8 all but 2 of 10,000 pairs do with the defaults.

    Texts of equal words are one node (a 128-bit hash). In each bucket all members are first
    verified against its smallest node; what that leaves unconnected is compared member by member, in
    blocks, so no pair that could connect anything goes untried and none is emitted unless it links. A bucket or
    a group of copies may hold a third of all rows: it is only ever aggregated or dealt in blocks.

    Texts that are NULL or hold no word are in no group: each is its own. So is a row with a NULL key,
    whose ``component_id`` is NULL. Equal rows come out alike, each as often as it came.
    """
    base = docs.select(column(key).alias("doc_id"), F.xxhash64(column(text)).alias("text_hash"), column(text).alias("text"))
    schema = with_fields(base.drop("text").schema, "node binary, bands array<long>")
    signed = landed(base.mapInArrow(_sign(bands, rows, length), schema), "signatures")
    whole = signed.where("node is not null and doc_id is not null")
    nodes = landed(
        whole.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("bands").alias("bands")),
        "nodes",
    )
    members = nodes.select("node", F.posexplode("bands").alias("band", "value"))
    buckets = members.groupBy("band", "value").agg(F.min("node").alias("leader"), F.count("*").alias("size"))
    buckets = buckets.where("size > 1")
    members = landed(members.join(buckets, ["band", "value"]), "buckets")

    stars = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    wanted = members.select("node").distinct().join(nodes.select("node", "first.*"), "node")
    texts = base.join(wanted, (base["doc_id"] == wanted["doc_id"]) & (base["text_hash"] == wanted["text_hash"]))
    texts = texts.groupBy("node").agg(F.min("text").alias("text"))
    sets = landed(texts.mapInArrow(_shingle_rows(length), "node binary, shingles binary"), "shingles")

    paired = stars.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    paired = paired.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    links = landed(paired.select("a", "b", "x", "y").mapInArrow(_verify_rows(least), "a binary, b binary"), "links")
    found = components(links)

    rest = _unsettled(members, found).join(sets, "node")
    more = rest.groupBy("band", "value", "p", "q").applyInArrow(_verify_bucket(least), "a binary, b binary")
    more = landed(more.distinct(), "links")
    if not more.isEmpty():
        found = components(links.unionByName(more))

    grouped = nodes.select("node", "first").join(found, "node", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "node"))
    heads = grouped.groupBy("component").agg(F.min("first").alias("head"))
    grouped = landed(grouped.join(heads, "component").select("node", "head"), "groups")
    out = signed.select("doc_id", "text_hash", "node").join(grouped, "node", "left")
    own = F.struct("doc_id", "text_hash")
    return out.select(
        "doc_id",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("head.doc_id", "doc_id")).alias("component_id"),
        (F.col("doc_id").isNull() | F.col("head").isNull() | (F.col("head") == own)).alias("kept"),
        "text_hash",
    )
