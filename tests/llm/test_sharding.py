import random
import zlib

import numpy as np
import pytest

from hourgrid.llm import sharding

SCHEMA = "doc_id bigint, text string"


def test_cuts_are_minimax(monkeypatch):
    for seed in range(60):
        rng = np.random.default_rng(seed)
        n, shards = int(rng.integers(1, 60)), int(rng.integers(1, 9))
        hashes = np.unique(rng.integers(0, 1 << sharding.BITS, n))
        if seed % 3 == 0:
            hashes = np.unique(hashes >> 40)  # all in the first cells
        weight = rng.integers(1, 100, len(hashes))
        if seed % 4 == 0:
            weight[len(weight) // 2] = 3000

        def split(start, width, hashes=hashes, weight=weight):
            inner = np.maximum(width - sharding.STEP_BITS, 0)
            out = {}
            for s, w, b in zip(start, width, inner, strict=True):
                for h, x in zip(hashes, weight, strict=True):
                    if s <= h < s + (1 << int(w)):
                        key = (int(h) >> int(b) << int(b), int(b))
                        old = out.get(key, (0, 0))
                        out[key] = old[0] + int(x), old[1] + 1
            rows = [(*k, *v) for k, v in out.items()]
            return tuple(np.array(c, np.int64) for c in zip(*rows, strict=True))

        capacity, cuts = sharding.find_cuts(sharding.Order(split), shards)
        number = np.searchsorted(np.array(cuts, np.int64), hashes, "right")
        sizes = np.bincount(number, weight, minlength=shards)
        # The best maximum over all contiguous partitions.
        best = np.concatenate([[0], np.cumsum(weight)]).astype(float)
        prefix = best.copy()
        for _ in range(shards - 1):
            best = np.array([min(max(best[j], prefix[i] - prefix[j]) for j in range(i + 1)) for i in range(len(prefix))])
        assert capacity == best[-1] == sizes.max() and len(sizes) == shards


def sharded(spark, rows, shards=4, schema=SCHEMA):
    return sharding.shard(spark.createDataFrame(rows, schema), shards).collect()


def check(got, rows, shards):
    texts, own = {}, {}
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, []).append(t)
    for r in got:
        text = by_id[r.doc_id][0] or ""
        assert r.size == len(text.encode()) + 1 and r.text_crc32 == zlib.crc32(text.encode())
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        assert texts.setdefault(text, r.shard) == r.shard
        own.setdefault(r.shard, []).append(r.slot)
    for slots in own.values():
        assert sorted(slots) == list(range(len(slots)))


@pytest.mark.parametrize("seed", [1, 2])
def test_shards_are_even(spark, seed):
    rng = random.Random(seed)
    rows = [(i, "word " * rng.randrange(0, 50) + str(i % 700)) for i in range(1500)]
    got = sharded(spark, rows, 8)
    check(got, rows, 8)
    sizes = [0] * 8
    for r in got:
        sizes[r.shard] += r.size
    assert max(sizes) < 1.1 * sum(sizes) / 8 and min(sizes) > 0.85 * sum(sizes) / 8


def test_a_large_group_of_copies(spark):
    rows = [(i, "same " * 40) for i in range(500)] + [(1000 + i, f"text {i} " * 20) for i in range(1000)]
    got = sharded(spark, rows, 4)
    check(got, rows, 4)
    assert len({r.shard for r in got}) == 4


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "x"), (3, "é" * 100_000), (4, "a"), (5, "a")]
    got = sharded(spark, rows, 4)
    check(got, rows, 4)
    assert len(got) == 6 and len({r.shard for r in got if r.doc_id in (1, 2)}) == 1
    twice = [(1, "b")] * 3
    assert sorted(r.slot for r in sharded(spark, twice)) == [0, 1, 2]
    assert sharded(spark, []) == []
    names = "h string, weight string, row string, shard string, part string"
    assert len(sharded(spark, [(1, "a", *"vwxyz")], schema=f"{SCHEMA}, {names}")) == 1
