"""Scores of whole texts by a smoothed n-gram model over all training texts, as a weighted backoff automaton."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import ceil_div, column, landed, to_batch, with_fields

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Keys of what stands before a text and at its end; words cannot be empty or hold a space.
BEGIN, END = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b" begin", b" end"))

ASKED_DDL = "block long, part int, keys binary, counts binary, follows binary"
ASKED = pa.schema(
    [("block", pa.int64()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("follows", pa.binary())]
)
TOLD_DDL = "block long, n int, part int, totals binary, follows binary, owned binary, tokens long, types long, texts long"
TOLD = pa.schema(
    [
        ("block", pa.int64()),
        ("n", pa.int32()),
        ("part", pa.int32()),
        ("totals", pa.binary()),
        ("follows", pa.binary()),
        ("owned", pa.binary()),
        ("tokens", pa.int64()),
        ("types", pa.int64()),
        ("texts", pa.int64()),
    ]
)
SCORED = pa.schema(
    [
        ("lm_tokens", pa.int64()),
        ("lm_known", pa.int64()),
        ("lm_base", pa.float64()),
        ("lm_score", pa.float64()),
    ]
)


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = (left * _MULTIPLY) ^ right
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


def tokens(texts: pa.ChunkedArray | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of all texts, each text closed by the end token, and the number of each text's tokens.

    Words are runs of bytes other than the six ASCII space characters, with A-Z lower-cased.
    """
    whole = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.combine_chunks().cast(pa.large_string())
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(whole, "")))
    values, owner = split.flatten(), pc.list_parent_indices(split)
    filled = pc.greater(pc.binary_length(values), 0)
    coded = pc.dictionary_encode(values.filter(filled))
    owner = owner.filter(filled).to_numpy(zero_copy_only=False)
    digests = map(xxhash.xxh3_64_intdigest, coded.dictionary.cast(pa.large_binary()).to_pylist())
    keys = np.fromiter(digests, dtype=np.uint64, count=len(coded.dictionary))
    sizes = np.bincount(owner, minlength=len(whole)).astype(np.int64) + 1
    out = np.full(int(sizes.sum()), END)
    # Each text before a word has an end token.
    out[np.arange(len(owner)) + owner] = keys[coded.indices.to_numpy(zero_copy_only=False)]
    return out, sizes


def grams(words: np.ndarray, sizes: np.ndarray, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per length n, the key of the n-gram that ends at each token, and whether there is one.

    One beginning mark stands before a text and counts as a word of the n-grams that begin with it.
    """
    first = np.zeros(len(words), dtype=bool)
    first[np.cumsum(sizes) - sizes] = True
    keys, there = [words], [np.ones(len(words), dtype=bool)]
    before, known = BEGIN, True
    for _ in range(1, order):
        shifted, valid = np.empty_like(words), np.empty_like(first)
        shifted[1:], valid[1:] = keys[-1][:-1], there[-1][:-1]
        shifted[first], valid[first] = before, known
        keys.append(_join(shifted, words))
        there.append(valid)
        before, known = np.uint64(0), False
    return keys, there


def _squeeze(numbers: np.ndarray) -> bytes:
    """As many bytes a number as the largest needs, those of equal weight side by side, so that they compress."""
    whole = numbers.astype("<u8")
    width = max(1, -(-int(whole.max(initial=0)).bit_length() // 8))
    return bytes([width]) + np.ascontiguousarray(whole.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _open(data: bytes) -> np.ndarray:
    width = data[0]
    some = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(width, -1)
    whole = np.zeros((some.shape[1], 8), dtype=np.uint8)
    whole[:, :width] = some.T
    return whole.view("<u8").ravel()


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where the sorted keys pass from one of ``parts`` equal ranges to the next."""
    bounds = np.array([(p << 64) // parts for p in range(1, parts)], dtype=np.uint64)
    return np.r_[0, np.searchsorted(keys, bounds), len(keys)]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and each key's place among them."""
    codes, found = pd.factorize(keys)
    order = np.argsort(found)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    return found[order], rank[codes]


class _Block:
    """The n-grams of a block's texts: per length the distinct keys, and where each token's n-gram is among them.

    The beginning mark is a word more, which no token is. Lengths are worked out when they are asked for.
    """

    def __init__(self, block: pa.Table, order: int) -> None:
        self.number = block.column("block")[0].as_py()
        self.words, self.sizes = tokens(block.column("text"))
        self._grams, self.there = grams(self.words, self.sizes, order)
        self.first = np.zeros(len(self.words), dtype=bool)
        self.first[np.cumsum(self.sizes) - self.sizes] = True
        self._levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.begin = -1

    def level(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct n-grams' keys, in order, and each token's place among them (-1 where no n-gram ends)."""
        if n not in self._levels:
            keys, there = self._grams[n - 1], self.there[n - 1]
            distinct, place = _distinct(np.append(keys, BEGIN) if n == 1 else keys[there])
            if n == 1:
                self.begin, place = int(place[-1]), place[:-1]
            whole = np.full(len(self.words), -1, dtype=np.int32)
            whole[there] = place
            self._levels[n] = distinct, whole
        return self._levels[n]

    def contexts(self, n: int) -> np.ndarray:
        """For each token, the place of the n-gram before it: what it is read from. -1 where the text has none so long."""
        place = self.level(n)[1]
        before = np.full(len(self.words), -1, dtype=np.int32)
        before[1:] = place[:-1]
        before[self.first] = self.begin if n == 1 else -1
        return before

    def by_gram(self, n: int, of_tokens: np.ndarray) -> np.ndarray:
        """Per distinct n-gram what holds for the tokens it ends at, where that is the same for all of them."""
        distinct, place = self.level(n)
        out = np.zeros(len(distinct), dtype=of_tokens.dtype)
        there = self.there[n - 1]
        out[place[there]] = of_tokens[there]
        return out

    def told(self, found: pa.Table, n: int, name: str) -> np.ndarray:
        """What the ranges told of the distinct n-grams, in the order of their keys."""
        some = [(p, d) for m, p, d in zip(*(found.column(c).to_pylist() for c in ("n", "part", name))) if m == n]
        return np.concatenate([_open(d) for _, d in sorted(some)]) if some else np.zeros(0, dtype=np.uint64)


def _ask(n: int, order: int, parts: int):
    """Distinct n-grams of a block, cut by range of their keys, with their counts in its training texts and, where longer
    n-grams have been counted, how many of those that this block accounts for continue them."""

    def run(block: pa.Table, found: pa.Table | None = None) -> pa.Table:
        if not len(block):
            return ASKED.empty_table()
        own = _Block(block, min(n + 1, order))
        copies = np.array(block.column("copies").to_pylist(), dtype=np.float64)
        train = np.where(block.column("train").to_pylist(), copies, 0.0)
        (keys, place), there = own.level(n), own.there[n - 1]
        counts = np.bincount(place[there], np.repeat(train, own.sizes)[there], len(keys))
        if n == 1:
            counts[own.begin] = train.sum()
        follows = np.zeros(len(keys))
        if n < order:
            longer = own.told(found, n + 1, "owned")
            context = own.by_gram(n + 1, own.contexts(n))
            follows = np.bincount(context[longer > 0], minlength=len(keys))
        cuts = _cuts(keys, parts)
        rows: dict[str, list] = {f.name: [] for f in ASKED}
        for p in range(parts):
            a, b = cuts[p], cuts[p + 1]
            if b > a:
                steps = np.diff(keys[a:b], prepend=np.uint64(0))
                for name, value in zip(rows, (own.number, p, _squeeze(steps), _squeeze(counts[a:b]), _squeeze(follows[a:b]))):
                    rows[name].append(value)
        return pa.Table.from_batches([to_batch(rows, ASKED)], schema=ASKED)

    return run


def _first(run):
    """The longest n-grams, which follow nothing; as a function of the block alone."""

    def first(block: pa.Table) -> pa.Table:
        return run(block)

    return first


def _tell(n: int):
    """Sums over all blocks of the n-grams of one range, told to each block in its own order; and which of an n-gram's
    blocks, one of those that have it in training, accounts for it."""

    def run(asked: pa.Table) -> pa.Table:
        part = asked.column("part")[0].as_py()
        blocks = asked.column("block").to_pylist()
        each = [np.cumsum(_open(k), dtype=np.uint64) for k in asked.column("keys").to_pylist()]
        counts, follows = (np.concatenate([_open(x) for x in asked.column(c).to_pylist()]).astype(np.float64) for c in ("counts", "follows"))
        distinct, place = _distinct(np.concatenate(each))
        totals, after = np.bincount(place, counts), np.bincount(place, follows)
        trained = np.flatnonzero(counts > 0)
        # Written from the last to the first: the first one stays.
        owner = np.full(len(distinct), -1, dtype=np.int64)
        owner[place[trained[::-1]]] = trained[::-1]
        owned = np.zeros(len(place))
        owned[owner[owner >= 0]] = 1
        words = distinct != BEGIN
        sums = (int(totals[words].sum()), int((totals[words] > 0).sum()), int(totals[~words].sum())) if n == 1 else (0, 0, 0)
        cuts = np.cumsum([len(k) for k in each])[:-1]
        rows: dict[str, list] = {f.name: [] for f in TOLD}
        for i, mine in enumerate(zip(*(np.split(x, cuts) for x in (totals[place], after[place], owned)))):
            given = sums if i == 0 else (0, 0, 0)
            for name, value in zip(rows, (blocks[i], n, part, *map(_squeeze, mine), *given)):
                rows[name].append(value)
        return pa.Table.from_batches([to_batch(rows, TOLD)], schema=TOLD)

    return run


@dataclass(frozen=True)
class Automaton:
    """A weighted backoff automaton over the n-grams that some texts pass through.

    State 0 is the empty one; the others are the n-grams seen in training that something can be read from, in order of length and
    key, each with a failure arc to the state of its tail. The weight of that arc is the state's own: discount * distinct
    continuations / count, the chance its discounted arcs leave over. The arc by which a state reads a word is the n-gram of
    both, in order of length and key; its chance is the discounted frequency and what the failure arc adds to it. State 0 has an arc for
    every word, those never seen included.
    """

    fail: np.ndarray
    weight: np.ndarray
    #: Length of each state's n-gram.
    length: np.ndarray
    #: By the length of the n-gram less one, the chance of each distinct n-gram as an arc; NaN where it was not seen.
    arcs: list[np.ndarray]

    def read(self, state: np.ndarray, grams: list[np.ndarray]) -> np.ndarray:
        """log10 of the chance with which each state reads its word: along failure arcs until there is an arc.

        ``grams`` has, by length, the n-gram that each word is the end of: the arc it is read by from a state one shorter.
        """
        total, state = np.zeros(len(state)), state.copy()
        open_ = np.arange(len(state))
        for n in range(len(self.arcs), 0, -1):
            here = open_[self.length[state[open_]] == n - 1]
            chance = self.arcs[n - 1][grams[n - 1][here]]
            there = ~np.isnan(chance)
            total[here[there]] += np.log10(chance[there])
            lost = here[~there]
            total[lost] += np.log10(self.weight[state[lost]])
            state[lost] = self.fail[state[lost]]
            state[here[there]] = -1
            open_ = open_[state[open_] >= 0]
        return total


def build(
    own: _Block, totals: list[np.ndarray], follows: list[np.ndarray], stats: tuple[int, int], discount: float
) -> tuple[Automaton, np.ndarray]:
    """The automaton of a block, and the state before each of its tokens: the longest seen n-gram that ends there."""
    tokens_, types = stats
    arcs = [(totals[0] + 0.5) / (tokens_ + 0.5 * (types + 1))]
    fail, weight, length = [np.zeros(1, dtype=np.int32)], [np.ones(1)], [np.zeros(1, dtype=np.int8)]
    state = np.zeros(len(own.words), dtype=np.int32)
    before: np.ndarray | None = None
    for n in range(1, len(totals)):
        seen = follows[n - 1] > 0
        number = np.where(seen, np.cumsum(seen) - 1 + sum(map(len, fail)), -1).astype(np.int32)
        # The tail of an n-gram ends at the same token and is one shorter.
        tail = np.zeros(len(seen), dtype=np.int32) if before is None else before[own.by_gram(n, own.level(n - 1)[1])]
        fail.append(tail[seen])
        left = np.divide(discount * follows[n - 1], totals[n - 1], out=np.ones(len(seen)), where=seen)
        weight.append(left[seen])
        length.append(np.full(int(seen.sum()), n, dtype=np.int8))
        context = own.contexts(n)
        known = context >= 0
        known[known] = seen[context[known]]
        state[known] = number[context[known]]
        # An arc is an n-gram one longer: its context is the state it leaves, its tail the arc that the failure arc leads to.
        count, of = totals[n], own.by_gram(n + 1, context)
        lower = arcs[-1][own.by_gram(n + 1, own.level(n)[1])]
        taken = count > 0
        chance = np.full(len(count), np.nan)
        of = of[taken]
        chance[taken] = (count[taken] - discount) / totals[n - 1][of] + left[of] * lower[taken]
        arcs.append(chance)
        before = number
    return Automaton(np.concatenate(fail), np.concatenate(weight), np.concatenate(length), arcs), state


def _score_block(order: int, stats: tuple[int, int], discount: float, keep: list[str]):
    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        own = _Block(block, order)
        totals = [own.told(found, n, "totals").astype(np.float64) for n in range(1, order + 1)]
        follows = [own.told(found, n, "follows").astype(np.float64) for n in range(1, order + 1)]
        automaton, state = build(own, totals, follows, stats, discount)
        grams_ = [own.level(n)[1] for n in range(1, order + 1)]
        word = grams_[0]
        starts = np.cumsum(own.sizes) - own.sizes
        columns = {
            "lm_tokens": own.sizes,
            "lm_known": np.add.reduceat((totals[0][word] > 0).astype(np.int64), starts),
            "lm_base": np.add.reduceat(np.log10(automaton.arcs[0])[word], starts),
            "lm_score": np.add.reduceat(automaton.read(state, grams_), starts),
        }
        batch = to_batch(columns, SCORED)
        arrays = [*(block.column(c).combine_chunks() for c in keep), *batch.columns]
        return pa.Table.from_arrays(arrays, names=[*keep, *SCORED.names])

    return run


def score(
    docs: DataFrame,
    train: Column,
    text: str = "text",
    key: str = "doc_id",
    keep: tuple[str, ...] = (),
    order: int = 2,
    discount: float = 0.75,
    block_bytes: int = 6_000_000,
    range_bytes: int = 16_000_000,
    many: int = 1000,
) -> DataFrame:
    """The columns of ``keep``, then ``lm_tokens``, ``lm_known``, ``lm_base``, ``lm_score`` and ``lm_train_tokens``.

    All n-grams up to ``order`` of all rows where ``train`` holds are counted (NULL: not), none is pruned.
    Absolute discounting: each arc of a seen context loses ``discount`` of its count, and its failure arc leads to the context's tail
    with what that leaves over (``Automaton``), down to add-half frequencies of words. ``lm_base`` is the sum over those
    alone; both are log10 probabilities of the whole text, whose tokens are read from left to right.

    No task holds the model. Texts are dealt into blocks of about ``block_bytes``. From the longest n-grams down, a block sends its
    distinct ones with its training counts, cut into as many ranges of their keys as have ``range_bytes`` of text; each range adds up over all blocks
    and answers every block in the order it asked, without keys. Of each n-gram one block is told to account for it, so
    that the distinct continuations of its context are added up, with the next shorter n-grams, from whole numbers. One length at
    a time is on its way. N-grams are 64-bit hashes. NULL texts count as empty ones, which hold the end token alone;
    repeated rows count as often as they come, and those equal in key and text that come more than ``many`` times are scored once.
    Very long texts are one block each. Columns beyond ``keep`` are left out. Over an empty table there is nothing to score.
    """
    rows = docs.select(
        F.coalesce(column(text), F.lit("")).alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
        column(key).alias("_key"),
        *(column(c).alias(f"keep_{i}") for i, c in enumerate(keep)),
    )
    kept = [f"keep_{i}" for i in range(len(keep))]
    rows = rows.withColumns({"h1": F.xxhash64(F.lit(1), "_key", "text"), "h2": F.xxhash64(F.lit(2), "_key", "text")}).drop("_key")
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    blocks, parts = ceil_div(size, block_bytes), ceil_div(size, range_bytes)
    one = F.lit(1).cast("long").alias("copies")
    equal = landed(rows.groupBy("h1", "h2", "train").agg(F.count("*").alias("copies")).where(F.col("copies") > many), "equal-rows")
    several = not equal.isEmpty()
    single, apart = rows, None
    if several:
        same = ["h1", "h2", "train"]
        apart = rows.join(equal.select(*same), same)
        single = rows.join(equal.select(*same), same, "left_anti")
        texts = apart.groupBy(*same).agg(F.first("text").alias("text"))
        once = texts.join(equal, same).select("text", "train", "copies", "h1", "h2", *(F.lit(None).cast(rows.schema[k].dataType).alias(k) for k in kept))
        single = single.select("text", "train", one, "h1", "h2", *kept).unionByName(once)
    else:
        single = single.select("text", "train", one, "h1", "h2", *kept)
    dealt = single.withColumn("block", F.pmod(F.col("h1"), F.lit(blocks)))
    texts = dealt.select("block", "text", "train", "copies")

    told: list[DataFrame] = []
    for n in range(order, 0, -1):
        run = _ask(n, order, parts)
        if told:
            found = told[-1].select("block", "n", "part", "owned")
            asked = texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(run, ASKED_DDL)
        else:
            asked = texts.groupBy("block").applyInArrow(_first(run), ASKED_DDL)
        told.append(landed(asked.groupBy("part").applyInArrow(_tell(n), TOLD_DDL), f"told-{n}"))
    sums = told[-1].agg(F.sum("tokens"), F.sum("types")).first()
    stats = (sums[0] or 0, sums[1] or 0)
    schema = with_fields(
        dealt.select("h1", "h2", "train", "copies", *kept).schema, "lm_tokens long, lm_known long, lm_base double, lm_score double"
    )
    answers = reduce(DataFrame.unionByName, (t.select("block", "n", "part", "totals", "follows") for t in told))
    carried = ["h1", "h2", "train", "copies", *kept]
    scored = (
        dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score_block(order, stats, discount, carried), schema)
    )
    if several:
        scored = landed(scored, "scored")
        again = scored.where(F.col("copies") > 1).select("h1", "h2", "train", *SCORED.names)
        back = apart.select("h1", "h2", "train", *kept).join(again, ["h1", "h2", "train"])
        scored = scored.where("copies = 1").select(*kept, *SCORED.names).unionByName(back.select(*kept, *SCORED.names))
    names = [F.col(k).alias(c) for k, c in zip(kept, keep)]
    return scored.select(*names, *SCORED.names, F.lit(stats[0]).cast("long").alias("lm_train_tokens"))
