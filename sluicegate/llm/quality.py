"""Quality scores learned from preference pairs (Bradley-Terry), thresholded at a score quantile."""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluicegate.functions.columns import named
from sluicegate.llm.common import column, to_batch, uniform, with_fields, with_text

# Character classes: letters by case, digits, space, line end, then marks by what they are used for.
CLASSES = 16
_MARKS = {c: i for i, group in enumerate((".", ",;:", "!?", "'\"()[]{}", "-_", "|", "#$%&*@^~", "<>=/\\+`"), 5) for c in group}
SHAPES = CLASSES * CLASSES
#: Share of distinct, top and repeated words, word and line lengths, and the like.
STATISTICS = 14


def _class_of(c: str) -> int:
    if c in "\n\r":
        return 4
    if c.isspace():
        return 3
    if c in _MARKS:
        return _MARKS[c]
    kind = unicodedata.category(c)
    if kind[0] == "L":
        return 1 if kind == "Lu" else 0
    return {"N": 2, "P": 13, "S": 14}.get(kind[0], 15)


_TABLE: list[np.ndarray] = []


def _classes() -> np.ndarray:
    if not _TABLE:
        table = np.full(0x110000, 15, dtype=np.uint8)
        for c in range(0x110000):
            if not 0xD800 <= c < 0xE000:
                table[c] = _class_of(chr(c))
        _TABLE.append(table)
    return _TABLE[0]


def features(text: str | None) -> np.ndarray:
    """What a whole text looks like, whatever its language: frequencies of neighbouring character classes
    (square roots, so that rare ones count), and statistics of words and lines. Zeros for no text."""
    out = np.zeros(SHAPES + STATISTICS, dtype=np.float32)
    if not text:
        return out
    kinds = _classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    pairs = np.bincount(kinds[:-1] * np.intp(CLASSES) + kinds[1:], minlength=SHAPES)
    out[:SHAPES] = np.sqrt(pairs / max(1, len(kinds) - 1))
    words = text.split()
    n = len(words)
    if n:
        counts = Counter(words)
        lines = [x for x in text.split("\n") if x]
        top = sum(c for _, c in counts.most_common(5))
        same = sum(map(str.__eq__, words[1:], words))
        letters = int((kinds <= 1).sum())
        out[SHAPES:] = (
            1.0,
            np.log1p(n) / 10,
            len(counts) / n,
            len(counts) / n * np.log1p(n) / 10,
            counts.most_common(1)[0][1] / n,
            top / n,
            same / n,
            letters / len(kinds),
            int((kinds == 1).sum()) / max(1, letters),
            min(len(text) / n, 50) / 50,
            len(set(lines)) / max(1, len(lines)),
            np.log1p(n / max(1, len(lines))) / 10,
            sum(c for c in counts.values() if c > 1) / n,
            np.log1p(max(map(len, words))) / 10,
        )
    return out


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    #: The raw score at the chosen quantile, which maps to ``at``; and how steeply scores rise there.
    threshold: float
    steepness: float
    at: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        # Summed row by row, so that a text scores the same in whatever batch it comes.
        return ((x - self.mean) / self.scale * self.weights).sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        shift = np.log(self.at / (1 - self.at))
        z = (self.raw(x) - self.threshold) * self.steepness + shift
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(
    good: np.ndarray,
    bad: np.ndarray,
    at: float = 0.7,
    quantile: float | None = None,
    pairs: int = 60_000,
    rounds: int = 300,
    penalty: float = 1e-4,
    seed: int = 7,
) -> QualityModel:
    """Bradley-Terry: the log odds that one text beats another are linear in the difference of features.

    Logistic loss over ``pairs`` drawn pairs of a good and a bad text, minimised by accelerated gradient
    steps. The threshold is a quantile of the scores of the texts learned from: ``quantile`` of them all,
    or the level that leaves the same share of good texts below as of bad ones above (0.2 % at least, midway between
    the two). It becomes the score ``at``. Without texts of both kinds nothing is preferred: every score is ``at``.
    """
    width = SHAPES + STATISTICS
    if not len(good) or not len(bad):
        one = np.ones(width)
        return QualityModel(np.zeros(width), one, np.zeros(width), 0.0, 1.0, at)
    x = np.concatenate([good, bad]).astype(np.float64)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = (x - mean) / scale
    rng = np.random.default_rng(seed)
    i, j = rng.integers(0, len(good), pairs), len(good) + rng.integers(0, len(bad), pairs)
    # Gradient through the texts: a pair adds to its winner's and takes from its loser's coefficient.
    w, look = np.zeros(width), np.zeros(width)
    step = 4 / max(1e-9, 2 * np.linalg.norm(x, 2) ** 2 / len(x) * 2)
    momentum = 1.0
    for _ in range(rounds):
        s = x @ look
        miss = 1 / (1 + np.exp(np.clip(s[i] - s[j], -500, 500))) / pairs
        pull = np.bincount(i, miss, len(x)) - np.bincount(j, miss, len(x))
        new = look + step * (x.T @ pull - penalty * look)
        grown = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        look, w, momentum = new + (momentum - 1) / grown * (new - w), new, grown
    raw = x @ w
    won, lost = raw[: len(good)], raw[len(good) :]
    if quantile is None:
        wrong = np.arange(2, 501) / 1000
        low, high = np.quantile(won, wrong), np.quantile(lost, 1 - wrong)
        at_level = int(np.argmax(low >= high)) if (low >= high).any() else len(wrong) - 1
        threshold = float(low[at_level] + high[at_level]) / 2
    else:
        threshold = float(np.quantile(raw, quantile))
    spread = max(1e-9, float(np.median(won) - np.median(lost)))
    return QualityModel(mean, scale, w, threshold, 8 / spread, at)


FEATURES = pa.schema([("quality", pa.int32()), ("features", pa.list_(pa.float32()))])


def _feature_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t).tolist() for t in batch.column(1).to_pylist()]
        yield to_batch({"quality": batch.column(0), "features": rows}, FEATURES)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    train: Column | None = None,
    sample_rows: int = 4000,
    **options,
) -> QualityModel:
    """A model from a bounded sample: at most ``sample_rows`` labelled documents of each kind, by a hash
    of their key. ``train`` is a condition on the labels' columns. Where a key is labelled twice the
    lower label counts; labels other than 0 and 1, and NULL keys, teach nothing."""
    rows = labels.where(F.lit(True) if train is None else train)
    rows = rows.select(column(key).alias("key"), column(label).cast("int").alias("quality"))
    rows = rows.where("key is not null and quality in (0, 1)").groupBy("key").agg(F.min("quality").alias("quality"))
    counts = {r[0]: r[1] for r in rows.groupBy("quality").count().collect()}
    share = F.when(F.col("quality") == 1, 2.0 * sample_rows / counts.get(1, 1)).otherwise(
        2.0 * sample_rows / counts.get(0, 1)
    )
    some = W.partitionBy("quality").orderBy("u", "key")
    drawn = rows.withColumn("u", uniform(F.col("key"))).where(F.col("u") < share)
    drawn = drawn.withColumn("place", F.row_number().over(some)).where(F.col("place") <= sample_rows)
    texts = docs.select(column(key).alias("key"), column(text).alias("text"))
    texts = texts.join(F.broadcast(drawn.select("key", "quality")), "key").select("quality", "text", "key")
    # A key that many documents share weighs as one of them.
    found = texts.groupBy("key").agg(F.min("quality").alias("quality"), F.min("text").alias("text"))
    found = found.select("quality", "text").mapInArrow(_feature_rows, "quality int, features array<float>")
    table = found.toArrow()
    kinds = table.column("quality").to_numpy()
    flat = table.column("features").combine_chunks().flatten().to_numpy()
    x = flat.reshape(len(kinds), SHAPES + STATISTICS)
    order = np.lexsort((*x.T[:8], kinds))
    x, kinds = x[order], kinds[order]
    return fit(x[kinds == 1], x[kinds == 0], **options)


SCORES = pa.schema([("quality_score", pa.float64())])


def score(docs: DataFrame, model: QualityModel, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``keep``, then ``quality_score`` (0 to 1) of each row's whole text.

    NULL and empty texts have features of zero and a score like any other. Equal texts score alike. The
    model, a few vectors of fixed length, is broadcast.
    """
    rows, at = with_text(docs, text, keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = with_fields(rows.select(*named(*keep)).schema, "quality_score double")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = np.concatenate(
                [
                    model.score(np.stack([features(t) for t in part]).astype(np.float64))
                    for part in _runs(batch.column(at).to_pylist())
                ]
            )
            out = to_batch({"quality_score": scores}, SCORES)
            columns = [*batch.columns[: len(keep)], *out.columns]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *out.schema.names])

    return rows.mapInArrow(run, schema)


def _runs(texts: list, rows: int = 512) -> Iterator[list]:
    for i in range(0, len(texts), rows):
        yield texts[i : i + rows]
