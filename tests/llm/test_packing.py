import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helpers import SF_DIR, awkward, documents
from sluicegate.llm import packing

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(VOCABULARY)


def check(rows, pieces, capacity):
    """Every id in one piece, checksums right, sequences gapless and within their capacity; returns the padding."""
    expected = {}
    for doc, text in rows:
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]
        expected.setdefault(doc, []).append(ids)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sum(p.length for p in pieces) == sum(len(ids) for many in expected.values() for ids in many)
    for doc, many in expected.items():
        for ids in many:
            if sum(len(x) == len(ids) for x in many) == 1:
                mine = sorted(by_doc[doc, len(ids)], key=lambda p: p.start)
                assert [p.start for p in mine] == [0, *np.cumsum([p.length for p in mine])[:-1]]
                for p in mine:
                    part = np.array(ids[p.start : p.start + p.length], dtype="<u4")
                    assert zlib.crc32(part.tobytes()) == p.ids_crc32
    padding = 0
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1]]
        total = sum(n for _, n in places)
        assert 0 < total <= capacity
        padding += 0 if total & (total - 1) == 0 else capacity - total
    return padding


@pytest.mark.parametrize("capacity, group", [(64, 8192), (64, 4), (2048, 8192)])
def test_every_id_in_one_place(spark, capacity, group):
    rows = awkward()
    out = packing.pack(documents(spark, rows), VOCABULARY, capacity=capacity, group_rows=group)
    padding = check(rows, out.collect(), capacity)
    assert padding < capacity * (len(rows) / group + 1)


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert check(rows, packing.pack(df, VOCABULARY).collect(), 2048) < 2048


def test_no_rows(spark):
    assert packing.pack(documents(spark, []), VOCABULARY).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_assignment(lengths):
    placed = packing.assign(lengths, 100)
    assert sum(p[2] for p in placed) == sum(lengths)
    room = {}
    for piece, start, n, s, offset in placed:
        assert offset == room.get(s, 0) and n > 0
        room[s] = offset + n
    assert all(n <= 100 for n in room.values()) and len(room) <= -(-sum(lengths) // 100) if lengths else not placed
    for i, n in enumerate(lengths):
        spans = sorted((p[1], p[2]) for p in placed if p[0] == i)
        assert [a for a, _ in spans] == [0, *np.cumsum([b for _, b in spans])[:-1]] and sum(b for _, b in spans) == n


def test_costs_are_balanced():
    """Much closer together than when documents fill sequences in the order they come in."""
    rng = random.Random(0)
    lengths = [rng.randrange(20, 900) for _ in range(4000)]

    def spread(pieces):
        cost = {}
        for n, s in pieces:
            cost[s] = cost.get(s, 0) + n + n * n / 2048
        return np.array(list(cost.values())).std()

    in_order, at = [], 0
    for n in lengths:
        while n:
            taken = min(n, 2048 - at % 2048)
            in_order.append((taken, at // 2048))
            n, at = n - taken, at + taken
    assert spread((p[2], p[3]) for p in packing.assign(lengths, 2048)) < 0.5 * spread(in_order)


def test_both_libraries_give_the_same_ids_for_every_code_point():
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    encode = packing._encoder(VOCABULARY)[0]
    for begin in range(0, len(points), 4096):
        texts = [f"a{c}b1{c}2 {c}{c} .{c}!'{c}s  {c}  x" for c in map(chr, points[begin : begin + 4096])]
        expected = [e.ids for e in TOKENIZER.encode_batch_fast(texts, add_special_tokens=False)]
        assert [encode(t) for t in texts] == expected
    for text in ("", " " * 5000, "a" * 20000, "\n " * 5000, "x<|endoftext|>y <|endoftext|>"):
        assert encode(text) == TOKENIZER.encode(text, add_special_tokens=False).ids
