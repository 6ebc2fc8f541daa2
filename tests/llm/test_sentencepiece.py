import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import SF_DIR, awkward, documents
from sluicegate.llm import sentencepiece_bpe as bpe

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [t or "" for _, t in awkward()] + [
    "  a  b   ", "\n\n x\t", "a" * 500, "    " * 50, "ab " * 300, "▁▁", "x▁y", "".join(map(chr, range(1, 3000))), "x" * 127, "x" * 129,
]


@pytest.fixture(scope="module")
def pieces():
    return bpe.load(MODEL)


def coded(pieces, texts, dropout, seed=1):
    return [x.tolist() for x in bpe.encode(pieces, texts, [bpe.text_key(seed, i) for i in range(len(texts))], dropout)]


def test_without_dropout_the_ids_are_the_models_own(pieces):
    texts = [t for t in TEXTS if bpe.SPACE not in t]
    assert coded(pieces, texts, 0.0) == sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(texts)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.7, 1.0])
def test_decodes_losslessly_and_like_the_heap(pieces, monkeypatch, dropout):
    ids = coded(pieces, TEXTS, dropout)
    assert [bpe.decode(pieces, x) for x in ids] == TEXTS
    monkeypatch.setattr(bpe, "SIDE_BY_SIDE", 1)
    assert coded(pieces, TEXTS[:10] + TEXTS[-10:], dropout)[:10] == ids[:10]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6), st.sampled_from([0.0, 0.2]))
def test_any_text_comes_back(texts, dropout):
    pieces = bpe.load(MODEL)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert [bpe.decode(pieces, x) for x in coded(pieces, texts, dropout)] == texts


def test_dropout_hangs_on_seed_and_key(pieces):
    text = ["seeded merge dropout gives varied segmentations"] * 8
    first, again, other = (coded(pieces, text, 0.3, s) for s in (1, 1, 2))
    assert first == again and first != other and len(set(map(tuple, first))) > 4
    share = sum(map(len, coded(pieces, text, 1.0))) / sum(map(len, first))
    assert share > 1.5


def test_frames(spark):
    rows = awkward()
    df = documents(spark, rows)
    out = bpe.encode_texts(df, MODEL, seed=3, keep=("doc_id", "text"), decode_back=True)
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert sorted(map(repr, ((r[0], r[1]) for r in got))) == sorted(map(repr, rows))
    assert all(r[3] == r[1] and (r[2] is None) == (r[1] is None) for r in got)
    back = bpe.decode_ids(out.select("doc_id", "text", "ids"), MODEL, keep=("text",))
    assert all(r[0] == r[1] for r in back.collect())
    assert bpe.encode_texts(df.limit(0), MODEL, keep=("doc_id",)).collect() == []


def test_query_is_lossless(spark):
    from sluicegate.llm.queries import op4_sentencepiece

    df = op4_sentencepiece(spark, SF_DIR)
    assert df.where("not lossless or size(ids) <> n_ids").isEmpty() and df.count() == 200
