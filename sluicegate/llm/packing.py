"""Cost-balanced packing of tokenized documents into sequences of a fixed capacity."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import ceil_div, column, landed, to_batch

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
# A landed piece: whole ones (as long as a sequence) have their checksum, the tails keep their ids.
LANDED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, lane long, ids binary"
LANDED_ARROW = pa.schema(
    [(n, pa.binary() if n == "ids" else pa.int64()) for n in (c.split()[0] for c in LANDED.split(", "))]
)


@lru_cache(maxsize=2)
def _encoder(vocabulary: str):
    """Ids of a ``tokenizers`` file of byte-level BPE, by two libraries.

    The same merges run some five times faster in ``tiktoken``; both give the same ids (the tests
    compare them on every code point). Text that holds a special token's name goes to ``tokenizers``.
    """
    import json

    import tiktoken
    from tokenizers import Tokenizer

    with open(vocabulary, encoding="utf-8") as f:
        model = json.load(f)
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(kept)]
    byte_of = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"] for t in model["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in k): v for k, v in model["model"]["vocab"].items() if k not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(vocabulary)

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode, np.dtype("<u2" if exact.get_vocab_size() <= 1 << 16 else "<u4")


def encode(text: str, vocabulary: str) -> list[int]:
    return _encoder(vocabulary)[0](text)


def _checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _pieces(vocabulary: str, end_id: int, capacity: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind = _encoder(vocabulary)
        lane = TaskContext.get().partitionId() << 32
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array([*encode(text or ""), end_id], dtype=kind)
                whole = len(ids) // capacity * capacity
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    crc, kept = (_checksum(part), None) if start < whole else (None, part.tobytes())
                    rows.append((doc, start, len(part), crc, len(ids), lane, kept))
                    lane += 1
            yield to_batch(dict(zip(LANDED_ARROW.names, zip(*rows))), LANDED_ARROW)

    return run


def assign(
    lengths: list[int], capacity: int, linear: float = 1.0, quadratic: float = 1 / 2048
) -> list[tuple[int, int, int, int, int]]:
    """Places pieces of the given lengths; returns (piece, start in it, length, sequence, offset).

    As few sequences as can hold them are opened. The longest piece left goes whole to the sequence of
    the lowest cost (``linear * n + quadratic * n * n``, summed over its pieces) among those with room
    for it. A piece with room nowhere is cut: the roomiest sequence is filled, and its rest waits its turn.
    """
    left = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(left)
    opened = ceil_div(sum(lengths), capacity)
    room = [capacity] * opened
    cost = [0.0] * opened
    open_ = [(0.0, s) for s in range(opened)]
    narrow: list[tuple[int, int]] = []  # too narrow for the pieces so far, the roomiest first
    placed = []

    def place(piece: int, start: int, n: int, s: int) -> None:
        placed.append((piece, start, n, s, capacity - room[s]))
        room[s] -= n
        cost[s] += linear * n + quadratic * n * n

    while left:
        n, piece, start = heapq.heappop(left)
        n = -n
        while narrow and -narrow[0][0] >= n:
            s = heapq.heappop(narrow)[1]
            heapq.heappush(open_, (cost[s], s))
        while open_ and room[open_[0][1]] < n:
            s = heapq.heappop(open_)[1]
            if room[s]:
                heapq.heappush(narrow, (-room[s], s))
        if open_:
            s = open_[0][1]
            place(piece, start, n, s)
            heapq.heapreplace(open_, (cost[s], s))
        else:
            s = heapq.heappop(narrow)[1]
            taken = room[s]
            place(piece, start, taken, s)
            heapq.heappush(left, (taken - n, piece, start + taken))
    return placed


def _pack_group(capacity: int, linear: float, quadratic: float, kind: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["pack_group"].iloc[0])
        pdf = pdf.sort_values("lane").reset_index(drop=True)
        doc, first, total, ids = (pdf[c].tolist() for c in ("doc_id", "start", "doc_tokens", "ids"))
        rows = []
        for i, start, n, s, offset in assign(pdf["length"].tolist(), capacity, linear, quadratic):
            part = np.frombuffer(ids[i], dtype=kind)[start : start + n]
            # Odd numbers here, even ones for whole pieces; a group has fewer sequences than rows.
            sequence = ((group << 24) + s) * 2 + 1
            rows.append((doc[i], int(first[i]) + start, n, _checksum(part), total[i], sequence, offset))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
        return out.astype({"doc_id": "Int64"})

    return run


def pack(
    docs: DataFrame,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1 / 2048,
    group_rows: int = 8192,
) -> DataFrame:
    """Token spans of every document, packed into sequences of at most ``capacity`` ids.

    One row per piece: ``doc_id``, ``start`` and ``length`` in the document's ids, ``ids_crc32`` of its
    ids as little-endian 32-bit numbers, ``doc_tokens`` with the end id, ``sequence_id`` and ``offset``.
    As many whole sequences as a document fills are its own; the tails, one at most per document, are
    packed by cost within groups of about ``group_rows``, dealt by row and not by key. A group
    leaves less than one sequence of padding.

    The pieces are landed after tokenizing, so that sequence ids, which count rows of a task, stay what
    they are when a task is repeated. NULL and empty texts hold the end id alone; repeated rows and rows
    without a ``doc_id`` are packed like any other; an empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(column(doc_id).cast("long").alias("doc_id"), column(text).alias("text"))
    pieces = landed(rows.mapInArrow(_pieces(vocabulary, end_id, capacity), LANDED), "pieces")
    whole = pieces.where(F.col("ids").isNull()).select(
        *(c.split()[0] for c in PIECES.split(", ")[:5]),
        (F.col("lane") * 2).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    tails = pieces.where(F.col("ids").isNotNull())
    groups = ceil_div(tails.select("lane").count(), group_rows)
    kind = _encoder(vocabulary)[1].str
    packed = (
        tails.drop("ids_crc32")
        .withColumn("pack_group", F.pmod(F.xxhash64("lane"), F.lit(groups)))
        .groupBy("pack_group")
        .applyInPandas(_pack_group(capacity, linear, quadratic, kind), PIECES)
    )
    return whole.unionByName(packed)
