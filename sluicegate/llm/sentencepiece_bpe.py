"""SentencePiece merge-type encoding with seeded merge-dropout, and its decoding."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from sluicegate.llm.common import column, to_batch, with_fields

SPACE = "▁"
#: Units up to this many symbols are merged side by side; longer ones one at a time from a heap.
SIDE_BY_SIDE = 128
#: Texts are encoded in runs of about so many characters.
RUN = 400_000
#: Units are merged side by side with others of about their length.
HEIGHTS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 64, 128)
NEVER = np.int32(2**31 - 1)
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class Pieces:
    """Pieces and merges of a model file: merging two pieces is possible when their text is a piece too,
    better the higher that piece's score is; of equal scores the leftmost goes first."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.size = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(self.size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(self.size)]
        byte = [sp.is_byte(i) for i in range(self.size)]
        id_of = {n: i for i, n in enumerate(names) if not special[i] and not byte[i]}
        self.byte_ids = np.zeros(256, dtype=np.int32)
        self.bytes_of = [b"" if special[i] else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        for i, n in enumerate(names):
            if byte[i]:
                value = int(n[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
        if sum(byte) != 256:
            raise ValueError("the model has no byte fallback, so not every text could be decoded again")
        self.points = np.full(0x110000, -1, dtype=np.int32)
        scores = sorted({-sp.get_score(i) for i in id_of.values()})
        rank_of = {s: r for r, s in enumerate(scores)}
        keys, merged, ranks, inside = [], [], [], set()
        for name, i in id_of.items():
            if len(name) == 1:
                self.points[ord(name)] = i
            for cut in range(1, len(name)):
                left, right = id_of.get(name[:cut]), id_of.get(name[cut:])
                inside.add((name[cut - 1] != SPACE, name[cut] == SPACE))
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    merged.append(i)
                    ranks.append(rank_of[-sp.get_score(i)])
        #: Texts fall apart before a space that follows something else, unless a piece holds such a place.
        self.words_apart = (True, True) not in inside
        self.space = id_of[SPACE]
        # Open addressing: a slot per pair, searched from a hash of it on.
        if len(scores) >= 1 << 23:
            raise ValueError("more scores than a candidate's weight has room for")
        self.bits = max(4, (len(keys) * 6).bit_length())
        slots = 1 << self.bits
        self.keys = np.full(slots, -1, dtype=np.int64)
        self.merged = np.zeros(slots, dtype=np.int32)
        self.ranks = np.zeros(slots, dtype=np.int32)
        for k, m, r, s in zip(keys, merged, ranks, self._slot(np.array(keys, dtype=np.int64)).tolist()):
            while self.keys[s] != -1:
                s = (s + 1) % slots
            self.keys[s], self.merged[s], self.ranks[s] = k, m, r
        self.pairs = {k: (m, r) for k, m, r in zip(keys, merged, ranks)}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _M1) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slots of the pairs that merge, -1 for others."""
        keys = left.astype(np.int64) * self.size + right
        keys[(left < 0) | (right < 0)] = -2
        slot = self._slot(keys)
        there = self.keys.take(slot)
        hit = there == keys
        out = np.where(hit, slot, -1)
        todo = np.flatnonzero(~hit & (there != -1))
        while len(todo):
            slot[todo] = (slot.take(todo) + 1) % len(self.keys)
            there = self.keys.take(slot.take(todo))
            hit = there == keys.take(todo)
            out[todo[hit]] = slot[todo[hit]]
            todo = todo[~hit & (there != -1)]
        return out


@lru_cache(maxsize=2)
def load(model_file: str) -> Pieces:
    return Pieces(model_file)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


def text_key(seed: int, key: object) -> int:
    """What the dropout of one text hangs on: the seed and the text's key."""
    return xxhash.xxh3_64_intdigest(f"{seed}|{key}".encode())


def _kept(keys: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, limit: int) -> np.ndarray:
    """Which candidates are not skipped: decided by a hash of the text's key and the places they span."""
    h = keys + start.astype(np.uint64) * _M1
    h = _mix(h) + middle.astype(np.uint64) * _M2
    h = _mix(h) + end.astype(np.uint64) * _M3
    return (_mix(h) >> np.uint64(11)) >= np.uint64(limit)


def _limit(dropout: float) -> int:
    return min(1 << 53, round(dropout * (1 << 53)))


def agenda(pieces: Pieces, symbols: list[int], key: int, first: int, limit: int) -> list[tuple[int, int]]:
    """Merges of one unit from a heap: the best candidate first, of equals the leftmost, until none is left.

    ``first`` is the place of the unit in its text. Returns (place, piece).
    """
    n = len(symbols)
    symbols, end = list(symbols), list(range(first + 1, first + n + 1))
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[int, int, int, int, int]] = []
    one = np.array([key], dtype=np.uint64)

    def offer(i: int, j: int) -> None:
        found = pieces.pairs.get(symbols[i] * pieces.size + symbols[j]) if min(symbols[i], symbols[j]) >= 0 else None
        if found is None:
            return
        places = (np.array([p], dtype=np.int64) for p in (first + i, first + j, end[j]))
        if not limit or _kept(one, *places, limit)[0]:
            heapq.heappush(heap, (found[1], i, j, end[j], found[0]))

    for i in range(n - 1):
        offer(i, i + 1)
    gone = [False] * n
    while heap:
        _, i, j, stop, piece = heapq.heappop(heap)
        if gone[i] or gone[j] or after[i] != j or end[j] != stop:
            continue
        symbols[i], end[i], gone[j] = piece, end[j], True
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i], i)
        if after[i] >= 0:
            offer(i, after[i])
    return [(first + i, symbols[i]) for i in range(n) if not gone[i]]


def _side_by_side(pieces: Pieces, sym: np.ndarray, key: np.ndarray, first: np.ndarray, limit: int) -> np.ndarray:
    """The same merges for many units at once: each round takes the best candidate of every unit.

    ``sym`` has a unit per column, -1 below its end; ``key`` and ``first`` go with the columns. Returns
    the pieces at the rows they begin in, -2 at rows that were merged away.
    """
    rows, units = sym.shape
    out = np.full((rows, units), -2, dtype=np.int32)
    column_ = np.arange(units)
    # Flat copies: a symbol is at row * width + column. Of the symbol that begins in a row, the row after
    # its end; of the one that ends in a row, its first row.
    sym = sym.ravel().copy()
    after = np.repeat(np.arange(1, rows + 1, dtype=np.int32), units)
    begin = np.repeat(np.arange(rows, dtype=np.int32), units)
    comp = np.full(rows * units, NEVER)
    into = np.zeros(rows * units, dtype=np.int32)
    width = units

    def weigh(i: np.ndarray, j: np.ndarray, u: np.ndarray) -> None:
        """Sets the candidates of the symbols that begin in rows ``i`` and ``j`` of columns ``u``."""
        at, to = i * width + u, j * width + u
        slot = pieces.find(sym.take(at), sym.take(to))
        ok = np.flatnonzero(slot >= 0)
        if limit:
            x, y, v = i.take(ok), j.take(ok), u.take(ok)
            f = first.take(v)
            ok = ok[_kept(key.take(v), f + x, f + y, f + after.take(to.take(ok)), limit)]
        at, slot = at.take(ok), slot.take(ok)
        comp[at] = (pieces.ranks.take(slot) << 8) + i.take(ok)
        into[at] = pieces.merged.take(slot)

    i, u = np.divmod(np.flatnonzero((sym[:-units] >= 0) & (sym[units:] >= 0)), units)
    weigh(i, i + 1, u)
    while len(column_):
        best = comp.reshape(rows, width).min(axis=0)
        going = best != NEVER
        n = int(going.sum())
        if n < 0.6 * width:
            out[:, column_[~going]] = sym.reshape(rows, width)[:, ~going]
            sym, after, begin, comp, into = (
                np.compress(going, x.reshape(rows, width), axis=1).ravel() for x in (sym, after, begin, comp, into)
            )
            column_, key, first, best = (x[going] for x in (column_, key, first, best))
            width = n
            u = np.arange(n)
        else:
            u = np.flatnonzero(going)
            best = best.take(u)
        i = (best & 255).astype(np.int64)
        at = i * width + u
        j = after.take(at).astype(np.int64)
        to = j * width + u
        end = after.take(to).astype(np.int64)
        sym[at] = into.take(at)
        sym[to] = -2
        after[at] = end
        begin[(end - 1) * width + u] = i
        comp[to] = NEVER
        comp[at] = NEVER
        right = np.flatnonzero(end < rows)
        left = np.flatnonzero(i > 0)
        il, ul = i.take(left), u.take(left)
        before = begin.take((il - 1) * width + ul).astype(np.int64)
        comp[before * width + ul] = NEVER
        weigh(
            np.concatenate([i.take(right), before]),
            np.concatenate([end.take(right), il]),
            np.concatenate([u.take(right), ul]),
        )
    return out


def encode(pieces: Pieces, texts: list[str], keys: list[int], dropout: float) -> list[np.ndarray]:
    """Ids of each text. Every character outside the model, and the space mark itself where the text
    holds it, becomes its UTF-8 bytes, so that decoding gives the text back whatever was skipped."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int32)] * len(texts)
    todo = [i for i, t in enumerate(texts) if t]
    if not todo:
        return out
    limit = _limit(dropout)
    points = np.frombuffer("".join(" " + texts[i] for i in todo).encode("utf-32-le"), dtype="<u4")
    sizes = np.array([len(texts[i]) + 1 for i in todo])
    owner = np.repeat(np.arange(len(todo)), sizes)
    begins = np.r_[0, np.cumsum(sizes)]
    place = np.arange(len(points)) - begins[owner]
    sym = pieces.points[points]
    sym[points == ord(SPACE)] = -1
    is_space = points == 32
    sym[is_space] = pieces.space
    new = np.zeros(len(points), dtype=bool)
    if pieces.words_apart:
        new[1:] = is_space[1:] & ~is_space[:-1]
    # No merge joins what is outside the model to anything: a unit of its own.
    new[1:] |= (sym[1:] < 0) | (sym[:-1] < 0)
    new[begins[:-1]] = True
    unit = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    lengths = np.diff(np.r_[heads, len(points)])
    key = np.array([keys[i] for i in todo], dtype=np.uint64)[owner[heads]]
    final = np.full(len(points), -2, dtype=np.int32)
    alone = heads[lengths == 1]
    final[alone] = sym[alone]
    narrow = 1
    for rows in HEIGHTS:
        some = np.flatnonzero((lengths > narrow) & (lengths <= min(rows, SIDE_BY_SIDE)))
        narrow = rows
        if not len(some):
            continue
        inside = np.arange(rows)[:, None] < lengths[some]
        at = np.minimum(heads[some] + np.arange(rows)[:, None], len(sym) - 1)
        found = _side_by_side(pieces, np.where(inside, sym[at], -1), key[some], place[heads[some]], limit)
        final[at[inside]] = found[inside]
    for u in np.flatnonzero(lengths > SIDE_BY_SIDE):
        h, n = heads[u], lengths[u]
        for at, piece in agenda(pieces, sym[h : h + n].tolist(), int(key[u]), int(place[h]), limit):
            final[h + at - int(place[h])] = piece
    left = np.flatnonzero(final != -2)
    ids, whose = final[left], owner[left]
    strange = np.flatnonzero(ids == -1)
    if len(strange):
        spelled = [pieces.byte_ids[list(chr(points[left[i]]).encode("utf-8", "surrogatepass"))] for i in strange]
        times = np.ones(len(ids), dtype=np.int64)
        times[strange] = [len(s) for s in spelled]
        starts = np.r_[0, np.cumsum(times)[:-1]]
        ids, whose = np.repeat(ids, times), np.repeat(whose, times)
        for i, s in zip(strange, spelled):
            ids[starts[i] : starts[i] + len(s)] = s
    ends = np.searchsorted(whose, np.arange(len(todo) + 1))
    for k, i in enumerate(todo):
        out[i] = ids[ends[k] : ends[k + 1]]
    return out


def decode(pieces: Pieces, ids: Iterable[int]) -> str:
    """The text of a list of ids: their bytes, less the space that was put before the text."""
    table = pieces.bytes_of
    text = b"".join([table[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


OUT = pa.schema([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def _runs(texts: list[str | None]) -> Iterator[slice]:
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= RUN:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def encode_texts(
    docs: DataFrame,
    model_file: str,
    key: str = "doc_id",
    text: str = "text",
    dropout: float = 0.1,
    seed: int = 0,
    keep: tuple[str, ...] = (),
    decode_back: bool = False,
) -> DataFrame:
    """The columns of ``keep``, then ``ids`` of each row's whole text and, if asked for, ``decoded`` from them.

    A candidate merge is skipped for good with probability ``dropout`` by a hash of ``seed``, the row's
    ``key`` and the places it spans: the same row gives the same ids on every run, another seed other ones.
    With ``dropout`` 0 the ids are the model's own. A NULL text gives NULL, an empty one no ids; rows
    with equal keys and texts give equal ids, and a NULL key is a key.
    """
    rows = docs.select(column(key).alias("_key"), column(text).alias("_text"), *(column(c) for c in keep))
    schema = with_fields(rows.drop("_key", "_text").schema, "ids array<int>" + ", decoded string" * decode_back)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_file)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ids: list = []
            for part in _runs(texts):
                filled = [t or "" for t in texts[part]]
                found = encode(pieces, filled, [text_key(seed, k) for k in keys[part]], dropout)
                ids += [None if t is None else x for t, x in zip(texts[part], found)]
            offsets = np.r_[0, np.cumsum([0 if x is None else len(x) for x in ids])].astype(np.int32)
            values = pa.array(np.concatenate([x for x in ids if x is not None] or [np.zeros(0, np.int32)]), pa.int32())
            empty = pa.array([x is None for x in ids])
            arrays = [*batch.columns[2:], pa.ListArray.from_arrays(pa.array(offsets), values, mask=empty)]
            names = [*batch.schema.names[2:], "ids"]
            if decode_back:
                arrays.append(pa.array([None if x is None else decode(pieces, x.tolist()) for x in ids], pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(run, schema)


def decode_ids(rows: DataFrame, model_file: str, ids: str = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``keep``, then ``decoded``, the text of each row's ids; NULL for NULL."""
    rows = rows.select(column(ids).alias("_ids"), *(column(c) for c in keep))
    schema = with_fields(rows.drop("_ids").schema, "decoded string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_file)
        for batch in batches:
            texts = [None if x is None else decode(pieces, x) for x in batch.column(0).to_pylist()]
            out = to_batch({"decoded": texts}, pa.schema([OUT.field("decoded")]))
            arrays = [*batch.columns[1:], *out.columns]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[1:], "decoded"])

    return rows.mapInArrow(run, schema)
