import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import SF_DIR, awkward, documents
from sluicegate.llm import periodic_runs, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=24, times=3):
    """All runs by trying each period at each place; the smallest period of a stretch by trying them all."""
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                stretch = words[i : i + length]
                if not any(all(stretch[k] == stretch[k + p] for k in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found(spark, texts):
    df = documents(spark, list(enumerate(texts)))
    rows = periodic_runs.collapse_runs(df).collect()
    assert [r["doc_id"] for r in rows] == list(range(len(texts)))
    return [([tuple(x) for x in r["runs"]], r["collapsed"], r["n_words"]) for r in rows]


def check(spark, texts):
    for text, (runs, rest, n) in zip(texts, found(spark, texts)):
        words = WORD.findall(text or "")
        assert n == len(words) and runs == brute(words) and rest == collapsed(words, runs), text


def repetitive(rng):
    """Words of a small alphabet with repeats of repeats laid in."""
    words = []
    while len(words) < rng.randrange(20, 260):
        block = [rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13, 17, 33, 40]))]
        if words and rng.random() < 0.4:
            at = rng.randrange(len(words))
            block = words[at : at + rng.randrange(1, 50)]
        words += block * rng.choice([1, 1, 2, 3, 4, 9, 30])
        if rng.random() < 0.5:
            words += words[-len(block) :][: rng.randrange(1, len(block) + 1)]
    return words[:400]


def test_against_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(repetitive(rng)) for _ in range(150)]
    assert sum(bool(brute(t.split())) for t in texts) > 100
    check(spark, texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=12), st.integers(1, 30)), max_size=5))
def test_any_repeats_of_two_words(blocks):
    words = [w for block, times in blocks for w in list(block) * times][:300]
    codes = periodic_runs.np.array([ord(w) for w in words], dtype="int32")
    begin = periodic_runs.np.zeros(len(codes), dtype="int64")
    assert periodic_runs.find_runs(codes, begin, begin + len(codes), 24, 3) == brute(words)


def test_blanks_and_awkward_rows(spark):
    odd = "a\x0bb\x0cc\rd e\x1cf g\x85h\ti\n\n j "
    check(spark, [*(t for _, t in awkward()), odd, " ".join([odd] * 12), "x " * 24, "x " * 23, " " * 40])


def test_runs_do_not_cross_texts(spark):
    check(spark, ["x " * 12, "x " * 12, "x " * 30, "", "x " * 12] * 3)


def test_periods_of_a_long_text(spark):
    rng = random.Random(8)
    for period in (1, 6, 700, 1999):
        words = [f"w{rng.randrange(50)}" for _ in range(300)]
        block = [f"w{rng.randrange(50)}" for _ in range(period)]
        text = " ".join(words + (block * (20000 // period + 1))[: 3 * period + 9000] + words)
        ((runs, rest, n),) = found(spark, [text])
        assert max(q for _, _, q in runs) == period and len(rest.split()) < n - 2 * period


def test_no_rows_and_odd_keys(spark):
    assert found(spark, []) == []
    df = spark.createDataFrame([(None, "x " * 30, 1, 2), (None, "x " * 30, 1, 2)], "doc_id long, text string, runs int, n_words int")
    rows = periodic_runs.collapse_runs(df, keep=("runs", "doc_id", "text")).toDF("a", "b", "c", "n", "r", "d").collect()
    assert [(r["a"], r["b"], r["d"], len(r["r"])) for r in rows] == [(1, None, "x", 1)] * 2
    with pytest.raises(ValueError):
        periodic_runs.collapse_runs(df, times=2)


def digest(doc_id, text):
    """The contract, word by word."""
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = None
    for r in runs:
        if best is None or (r[1] * best[2], -r[0], -r[2]) > (best[1] * r[2], -best[0], -best[2]):
            best = r
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    exact = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    sha = (hashlib.sha256(t.encode()).hexdigest() for t in (lines, collapsed(words, runs)))
    return (doc_id, len(runs), *exact, *sha)


def test_query_against_brute_force(spark):
    rows = {tuple(r) for r in queries.op13_periodic_runs(spark, SF_DIR).collect()}
    given_ = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    short = [(i, t) for i, t in given_ if len(t or "") < 20000]
    assert len(short) > 0.9 * len(given_) and len(rows) == len(given_)
    assert {digest(i, t) for i, t in short} <= rows


def test_best_run_and_repeats_of_the_query(spark, tmp_path):
    rng = random.Random(6)
    given_ = [(i, " ".join(repetitive(rng))) for i in range(200)] + [(1000, None), (1001, ""), (1001, " \n")]
    spark.createDataFrame(given_, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = sorted(tuple(r) for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect())
    assert rows == sorted(digest(i, t) for i, t in given_)
