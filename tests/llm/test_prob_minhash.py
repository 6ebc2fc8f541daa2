import random

import numpy as np
import pytest

from helpers import WORDS, Groups, awkward, documents, sentence
from sluicegate.llm import prob_minhash as pm


def slow_similarity(a, b):
    x, y = (dict(zip(s[0].tolist(), s[1].tolist())) for s in (a, b))
    every = set(x) | set(y)
    both = set(x) & set(y)
    return sum(1 / sum(max(x.get(k, 0) / x[d], y.get(k, 0) / y[d]) for k in every) for d in both)


def rows_for():
    rng = random.Random(8)
    rows = awkward()
    for g in range(12):
        base = sentence(rng, rng.randrange(8, 160)).split()
        for _ in range(rng.randrange(1, 9)):
            words = list(base)
            for _ in range(rng.randrange(0, max(1, len(words) // 20) + 2)):
                words[rng.randrange(len(words))] = rng.choice(WORDS) + "z"
            rows.append((100 + len(rows), " ".join(words)))
    rows += [(900, "tick tock " * 40), (901, "tick tock " * 42), (902, "tick tock " * 90)]
    return rows


def brute(rows, least=0.8):
    sets = [pm.shingles(pm.words_of(t)) for _, t in rows]
    plain = Groups()
    for i, (doc, _) in enumerate(rows):
        if doc is None:
            continue
        plain.find(doc)
        for j in range(i):
            if rows[j][0] is not None and len(sets[i][0]) and slow_similarity(sets[i], sets[j]) >= least - 1e-12:
                plain.join(doc, rows[j][0])
    return sorted((i, plain.find(i), plain.find(i) == i) for i, _ in rows if i is not None)


def found(spark, docs, **options):
    df = pm.near_duplicates(documents(spark, docs), **options)
    return [tuple(r)[:3] for r in df.collect()]


@pytest.mark.parametrize("block, bands, rows_", [(256, 16, 4), (2, 30, 1)])
def test_equals_brute_force(spark, monkeypatch, block, bands, rows_):
    monkeypatch.setattr(pm, "BLOCK", block)
    rows = rows_for()
    got = found(spark, rows, bands=bands, rows=rows_)
    assert sorted(r for r in got if r[0] is not None) == brute(rows)
    assert [r for r in got if r[0] is None] == [(None, None, True)] * 2


def test_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None)]) == [(1, 1, True)]


def test_similarity_is_the_probability_jaccard():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = (
            (np.sort(rng.choice(40, n, replace=False)).astype(np.uint64), rng.integers(1, 6, n)) for n in rng.integers(1, 30, 2)
        )
        assert abs(pm.similarity(a, b) - (slow_similarity(a, b) if set(a[0]) & set(b[0]) else 0)) < 1e-12


def test_signatures_estimate_it():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 2**63, 300)).astype(np.uint64)
    a = (keys[:200], rng.integers(1, 5, 200))
    b = (keys[60:260], np.r_[a[1][60:], rng.integers(1, 5, 60)])
    size = 4096
    x, y, z, none = pm.signatures([a, b, (keys[:1], np.array([3])), (keys[:0], np.zeros(0, int))], size)
    assert abs((x == y).mean() - pm.similarity(a, b)) < 4 * (0.25 / size) ** 0.5
    assert (z == keys[0]).all() and (none == 0).all()
    alone = pm.signatures([a], size)[0]
    assert (alone == x).all()


def test_two_texts_under_one_key_leave_one(spark):
    text = sentence(random.Random(1), 60)
    got = found(spark, [(1, text), (1, text + " more"), (2, text)])
    assert sorted(got) == [(1, 1, False), (1, 1, True), (2, 1, False)]


def test_shared_weight():
    rng = np.random.default_rng(2)
    sets = [(np.sort(rng.choice(50, n, replace=False)).astype(np.uint64), rng.integers(1, 4, n)) for n in rng.integers(1, 40, 12)]
    first, second = np.arange(5), np.arange(5, 12)
    found = pm.shared_weight(sets, first, second)
    for i, a in enumerate(first):
        for j, b in enumerate(second):
            x, y = (dict(zip(s[0].tolist(), s[1].tolist())) for s in (sets[a], sets[b]))
            assert found[i, j] == sum(min(x[k], y[k]) for k in set(x) & set(y))
