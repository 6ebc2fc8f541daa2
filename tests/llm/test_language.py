import random

import pytest
from pyspark.sql import functions as F

from helpers import SF_DIR, awkward, documents
from sluicegate.llm import language
from sluicegate.llm.queries import op8_language


def naive(model, text, which, raw):
    """Phrases by looking for substrings of what the language learned."""
    folded = []
    for c in text:
        code = model.letters.get(c.lower(), language.OTHER) if c.isalpha() else language.GAP
        if code != language.GAP or not folded or folded[-1] != language.GAP:
            folded.append(code)
    total = 0
    for begin in range(0, len(folded), language.STRETCH):
        part, i = folded[begin : begin + language.STRETCH], 0
        total += 1
        at, phrase = 0, ()
        for c in part:
            if is_inside(phrase + (c,), raw):
                phrase += (c,)
                continue
            total += 1
            phrase = (c,) if is_inside((c,), raw) else ()
            total += not phrase
    return total


def is_inside(phrase, raw):
    return any(raw[i : i + len(phrase)] == phrase for i in range(len(raw) - len(phrase) + 1))


def folded(model, texts):
    out = []
    for t in texts:
        part = []
        for c in t.lower():
            code = model.letters.get(c, language.OTHER) if c.isalpha() else language.GAP
            if code != language.GAP or not part or part[-1] != language.GAP:
                part.append(code)
        out += [*part, language.GAP]
    return tuple(c for c in out if c != language.OTHER)


def test_phrases_are_longest_matches():
    rng = random.Random(2)
    samples = {"aa": ["abra cadabra abrac", "bada  bar"], "bb": ["xyzzy, zyx", "yx 12 xz"]}
    model = language.build_model(samples)
    texts = ["".join(rng.choice("abcdrxyz ,éq") for _ in range(rng.randrange(60))) for _ in range(40)] + ["", "a" * 3000]
    counts, has_letter = language.phrase_counts(model, texts)
    for k, name in enumerate(model.languages):
        raw = folded(model, samples[name])
        for i, t in enumerate(texts):
            # A letter never learned breaks a phrase and is one of its own.
            assert counts[k, i] == (naive(model, t, k, raw) if t else 0)
    assert list(has_letter) == [any(c.isalpha() for c in t) for t in texts]


def test_automaton_holds_every_substring_and_no_other():
    rng = random.Random(1)
    codes = [rng.randrange(3) for _ in range(60)]
    arcs = language.suffix_automaton(codes, 3)
    inside = {tuple(codes[i:j]) for i in range(60) for j in range(i, 61)}
    for _ in range(3000):
        word = tuple(rng.randrange(3) for _ in range(rng.randrange(1, 8)))
        state = 1
        for c in word:
            state = arcs[state, c] if state else 0
        assert (state != 0) == (word in inside)


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = op8_language(spark, "/root/testdata/sf0.01").join(df, "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.96
    assert found.where("score < 0 or score > 1").isEmpty()


def test_awkward_rows(spark):
    model = language.learn(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    rows = awkward() + [(600, "THE AND OF " * 40_000)]
    got = language.identify(documents(spark, rows), model, keep=("doc_id", "text", "lang")).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got))) == sorted(map(repr, rows))
    for r in got:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.lang_score <= 1
    assert language.identify(documents(spark, []), model).collect() == []


def test_nothing_learned(spark):
    model = language.learn(documents(spark, [(1, None)]))
    assert [tuple(r) for r in language.identify(documents(spark, [(1, "words")]), model).collect()] == [("und", 0.0)]
    one = language.build_model({"xx": ["some words"]})
    assert language.judge(one, ["words", None]) == (["xx", "und"], [1.0, 0.0])


def test_too_many_languages_are_refused(spark):
    df = spark.range(1001).select("id", F.lit("text").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError):
        language.learn(df, key="id")


def test_languages_that_share_a_rare_script():
    """Languages of one large script beside many of a common one: each has letters of its own, and none is cut."""
    rng = random.Random(5)
    syllables = [chr(0xAC00 + i) for i in range(900)]
    common = "".join(chr(c) for c in range(0x61, 0x250) if chr(c).isalpha() and chr(c).lower() == chr(c))

    def text(letters, n):
        return "".join(rng.choice(letters) + (" " if rng.random() < 0.2 else "") for _ in range(n))

    letters = {f"latin{i:02}": rng.sample(common, 40) for i in range(20)}
    letters |= {f"large{i}": syllables[i * 150 : i * 150 + 300] for i in range(5)}
    letters |= {f"small{i}": [chr(0x0905 + 8 * i + j) for j in range(16)] for i in range(3)}
    samples = {k: [text(x, 200) for _ in range(64)] for k, x in letters.items()}
    model = language.build_model(samples)
    assert set(model.letters) == {c for texts in samples.values() for t in texts for c in t if c != " "}
    assert language.judge(model, [text(x, 60) for x in letters.values()])[0] == list(letters)
    raw = folded(model, samples["large1"])
    texts = [text(syllables, 80) for _ in range(5)]
    counts, _ = language.phrase_counts(model, texts)
    assert counts[model.languages.index("large1")].tolist() == [naive(model, t, 1, raw) for t in texts]
