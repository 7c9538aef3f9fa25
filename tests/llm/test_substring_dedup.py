import random

import brute
import pytest

from hourgrid.llm import substring_dedup

SCHEMA = "doc_id bigint, text string"


def found(spark, rows, window=50, schema=SCHEMA):
    got = substring_dedup.remove_repeated_passages(spark.createDataFrame(rows, schema), window).collect()
    return [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got]


@pytest.mark.parametrize("period,cover", substring_dedup.COVERS.items())
def test_covers_reach_every_difference(period, cover):
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("seed,window", [(1, 50), (2, 50), (3, 12), (4, 2)])
def test_same_as_all_windows(spark, monkeypatch, seed, window):
    monkeypatch.setattr(substring_dedup, "HELD_ENTRIES", 40)
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(window - 1, 3 * window))] for _ in range(8)]
    texts = {}
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(0, 4)):
            parts += [rng.choice(vocabulary) for _ in range(rng.randrange(0, window))]
            passage = rng.choice(passages)
            start = rng.randrange(0, 5)
            parts += passage[start:] if rng.random() < 0.5 else passage
        texts[i] = " ".join(parts)
    for i in range(60, 70):
        texts[i] = texts[rng.randrange(60)]
    want = brute.without_repeats(texts, window)
    got = found(spark, list(texts.items()), window)
    assert {i: (n, gone, kept) for i, n, gone, kept in got} == {
        i: (n, n - len(kept), " ".join(kept)) for i, (n, kept) in want.items()
    }


def test_edge_cases(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    long = " ".join(f"x{i}" for i in range(40_000))
    rows = [(1, passage), (1, passage), (2, f"new {passage} end"), (3, None), (4, ""), (5, " \n "), (6, "few words")]
    rows += [(7, "few words"), (None, passage), (None, "own text"), (8, long), (9, f"a {long}"), (10, passage.upper())]
    want = [(1, 60, 0, passage)] * 2 + [(2, 62, 60, "new end"), (3, 0, 0, ""), (4, 0, 0, ""), (5, 0, 0, "")]
    want += [(6, 2, 0, "few words"), (7, 2, 0, "few words"), (None, 60, 0, passage), (None, 2, 0, "own text")]
    want += [(8, 40_000, 0, long), (9, 40_001, 40_000, "a"), (10, 60, 0, passage.upper())]
    assert sorted(found(spark, rows), key=str) == sorted(want, key=str)
    assert found(spark, []) == []


def test_clashing_columns(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    schema = "doc_id bigint, text string, owner string, rank string, found string, copies string"
    assert sorted(found(spark, [(1, passage, *"abcd"), (2, passage, *"abcd")], schema=schema)) == [(1, 60, 0, passage), (2, 60, 60, "")]
