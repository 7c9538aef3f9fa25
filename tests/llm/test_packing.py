import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from hourgrid.llm import packing
from hourgrid.llm.queries import ENCODER

SCHEMA = "doc_id bigint, text string"


def ids_of(text):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*whole.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_are_those_of_the_tokenizer(spark):
    encode = packing.Encoder(*ENCODER)
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()
    odd = ["", " ", "a" * 9000, "x  y\n\n z", "日本語 テキスト", "<|endoftext|> it's 12345", "a <|endoftext|> b", "<|endoftext|>" * 3, "<|endoftext" + "x" * 5000, "  é\U0001f600"]
    for text in [r.text for r in rows] + odd:
        assert encode(text).tolist() == ids_of(text)[:-1]


def test_added_tokens_are_read_as_such():
    assert packing.Encoder(*ENCODER)("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]


def check_places(got, capacity):
    """Sequences are filled without gap or overlap."""
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(places)


def test_pieces_and_places(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_PIECES", 200)
    rng = random.Random(1)
    texts = {i: " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.choice([3, 20, 60, 300]))) for i in range(500)}
    got = packing.pack(spark.createDataFrame(list(texts.items()), SCHEMA), ENCODER, capacity=64).collect()
    sequences = check_places(got, 64)
    total = sum(r.length for r in got)
    assert sequences <= 1.06 * total / 64 + 4
    own = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.piece)):
        own.setdefault(r.doc_id, []).append(r)
    for i, text in texts.items():
        ids = ids_of(text)
        assert [r.piece for r in own[i]] == list(range(len(own[i])))
        assert sum(r.length for r in own[i]) == len(ids)
        assert all(r.length == 64 for r in own[i][1:])
        for r in own[i]:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "a word"), (3, "same"), (3, "same"), (4, "long text " * 20_000)]
    schema = "doc_id bigint, text string, piece string, offset string"
    got = packing.pack(spark.createDataFrame([(*r, "x", "y") for r in rows], schema), ENCODER).collect()
    check_places(got, 2048)
    assert [r.length for r in got if r.doc_id in (1, 2)] == [1, 1]
    assert {r.ids_crc32 for r in got if r.doc_id in (1, 2)} == {zlib.crc32(bytes(4))}
    assert len([r for r in got if r.doc_id == 3]) == 2 and len([r for r in got if r.doc_id is None]) == 1
    assert sum(r.length for r in got if r.doc_id == 4) == len(ids_of(rows[-1][1]))
    assert packing.pack(spark.createDataFrame([], SCHEMA), ENCODER).count() == 0


def test_fullest_closes_first():
    bins = packing.BestFit(10, 2)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)
    assert bins.place(8) == (2, 0)
    assert bins.place(5) == (3, 0)  # closes sequence 2, which has 2 left
    assert bins.place(2) == (0, 6) and bins.place(10) == (4, 0)
    assert bins.place(2) == (0, 8) and bins.place(5) == (3, 5) and bins.count == 0


def test_cut():
    assert packing.cut(5, 5) == [(0, 5)] and packing.cut(6, 5) == [(0, 1), (1, 5)] and packing.cut(1, 5) == [(0, 1)]
    assert packing.cut(12, 5) == [(0, 2), (2, 5), (7, 5)]
