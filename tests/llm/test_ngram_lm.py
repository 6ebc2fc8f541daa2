import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from helpers import SF_DIR, WORDS, awkward, documents
from sluicegate.llm import ngram_lm
from sluicegate.llm.queries import op6_ngram_lm


def plain_score(texts, train, order, discount):
    """The same by dictionaries and recursion: tokens, known ones, base, score of each text."""

    def words(t):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", lower), " end"]

    counts, follows = Counter(), Counter()
    for t, used in zip(texts, train):
        if used:
            line = [" begin", *words(t)]
            counts.update(tuple(line[i : i + n]) for n in range(1, order + 1) for i in range(len(line) - n + 1))
    for gram in counts:
        follows[gram[:-1]] += 1
    total = sum(c for g, c in counts.items() if len(g) == 1 and g != (" begin",))
    types = sum(1 for g in counts if len(g) == 1 and g != (" begin",))

    def chance(context, word):
        if not context:
            return (counts[(word,)] + 0.5) / (total + 0.5 * (types + 1))
        lower = chance(context[1:], word)
        seen = counts[context]
        if not seen:
            return lower
        return max(counts[(*context, word)] - discount, 0) / seen + discount * follows[context] / seen * lower

    for t in texts:
        line = [" begin", *words(t)]
        base = sum(math.log10(chance((), w)) for w in line[1:])
        score = sum(math.log10(chance(tuple(line[max(0, i - order + 1) : i]), line[i])) for i in range(1, len(line)))
        yield len(line) - 1, sum(counts[(w,)] > 0 for w in line[1:]), base, score


def rows_for():
    rng = random.Random(1)
    made = [(100 + i, " ".join(rng.choice(WORDS[:8]) for _ in range(rng.randrange(30)))) for i in range(120)]
    return made + awkward() + [(300, "Ash ÉLAN ash ash\x0bASH\x1cash\t"), (301, "É é"), (302, "Z" * 50_000)]


def close(a, b):
    return abs(a - b) <= 1e-9 * max(1, abs(b))


@pytest.mark.parametrize(
    "order, discount, block, many", [(1, 0.5, 500, 1000), (2, 0.75, 700, 1), (3, 0.7, 10**6, 1000), (3, 0.4, 300, 1), (4, 0.75, 900, 1000)]
)
def test_equals_dictionaries(spark, order, discount, block, many):
    rows = rows_for()
    used = [i is not None and zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    df = ngram_lm.score(documents(spark, rows), train, keep=("doc_id", "text"), order=order, discount=discount, block_bytes=block, range_bytes=4000, many=many)
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    plain = list(plain_score([t for _, t in rows], used, order, discount))
    expected = sorted(((i, t or "", *p) for (i, t), p in zip(rows, plain)), key=repr)
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert (g[0], g[1] or "", g[2], g[3]) == e[:4] and close(g[4], e[4]) and close(g[5], e[5])
    assert {g[6] for g in got} == {sum(p[0] for p, u in zip(plain, used) if u)}


def test_nothing_to_learn_from_or_to_score(spark):
    df = documents(spark, [(1, "a b"), (2, None)])
    got = {r.doc_id: r for r in ngram_lm.score(df, F.lit(False), keep=("doc_id",)).collect()}
    assert got[1].lm_known == got[2].lm_known == 0 and got[1].lm_score == got[2].lm_score == 0
    assert ngram_lm.score(df.limit(0), F.lit(True), keep=("doc_id",)).collect() == []


def automaton(train, probes, order, discount):
    """The automaton of a single block that holds all there is, and the state before each token of the probes."""
    texts = train + probes
    columns = {"block": [0] * len(texts), "text": texts, "train": [True] * len(train) + [False] * len(probes), "copies": [1] * len(texts)}
    block, told = pa.table(columns), None
    for n in range(order, 0, -1):
        asked = ngram_lm._ask(n, order, 3)(block, told)
        parts = [asked.filter(pa.compute.equal(asked.column("part"), p)) for p in range(3)]
        more = [ngram_lm._tell(n)(p) for p in parts if len(p)]
        told = pa.concat_tables(([told] if told else []) + more)
    own = ngram_lm._Block(block, order)
    sums = tuple(sum(told.column(c).to_pylist()) for c in ("tokens", "types"))
    totals, follows = ([own.told(told, n, c).astype(float) for n in range(1, order + 1)] for c in ("totals", "follows"))
    made, state = ngram_lm.build(own, totals, follows, sums, discount)
    return made, own, state, int(own.sizes[: len(train)].sum())


@pytest.mark.parametrize("order", [1, 2, 3])
def test_chances_out_of_every_state_sum_to_one(order):
    """Over the words seen in training, the end, and one word that stands for all never seen."""
    train = ["a b a c", "a b", "c a b b", ""]
    vocabulary = ["a", "b", "c", "never", ngram_lm.END]
    # After each probe every word in turn; the end closes a text, so it comes by itself.
    contexts = ["", "a", "b", "c", "a b", "b a", "a c", "c a", "b b", "never", "a never", "never a", "c c"]
    probes = [f"{c} {w}".strip() for c in contexts for w in vocabulary[:4]] + contexts
    made, own, state, at = automaton(train, probes, order, 0.6)
    assert len(made.fail) == {1: 1, 2: 5, 3: 12}[order] and all(made.fail[1:] < np.arange(1, len(made.fail)))
    chances = 10 ** made.read(state, [own.level(n)[1] for n in range(1, order + 1)])
    starts = (np.cumsum(own.sizes) - own.sizes)[len(train) :]
    for i, c in enumerate(contexts):
        k = len(c.split())
        assert abs(sum(chances[starts[j] + k] for j in [*range(4 * i, 4 * i + 4), 4 * len(contexts) + i]) - 1) < 1e-12


def test_each_state_has_a_failure_weight_of_its_own():
    made, own, state, at = automaton(["a b", "a b", "c b", "d b", "d e"], ["a x c x d x"], 2, 0.75)
    before = state[at:][1::2][:3]
    # After a: b twice; after c: b once; after d: b and e.
    assert made.weight[before].tolist() == [0.75 / 2, 0.75, 1.5 / 2] and (made.fail[before] == 0).all()
    assert made.length[before].tolist() == [1, 1, 1]


def test_the_state_is_the_longest_seen_n_gram():
    made, own, state, at = automaton(["a b c", "b d"], ["a b d", "d a b", "x b c"], 3, 0.75)
    # Before a: the beginning; then "a" after it; then "a b"; then "b d", which the end follows in training.
    assert made.length[state[at:]].tolist() == [1, 2, 2, 2, 1, 1, 1, 2, 1, 0, 1, 2]


def test_texts_seen_twice_stand_out():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    once, twice = ([" ".join(rng.choice(vocabulary) for _ in range(200)) for _ in range(20)] for _ in range(2))
    train = once + twice + twice
    scores = [s / n for n, _, _, s in plain_score(train, [True] * len(train), 3, 0.75)]
    assert min(scores[20:]) > max(scores[:20]) + 0.2


def test_query_counts_triples(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in op6_ngram_lm(spark, SF_DIR).collect()}
    assert set(got) == set(texts)
    plain = plain_score(list(texts.values()), [not got[i].held_out for i in texts], 3, 0.75)
    for i, (_, known, base, score) in zip(texts, plain):
        assert got[i].n_known == known and close(got[i].base_score, base) and close(got[i].score, score)
