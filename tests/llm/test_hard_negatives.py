import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourgrid.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, label int, embedding array<float>, q string, place int, block string, score double"
EXTRA = ("x", 7, "y", 0.5)


def brute(rows, every=100):
    fit = [
        (i, y, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, y, v in rows
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = set()
    for at, (i, y, v) in enumerate(fit):
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, z) for k, (j, z, w) in enumerate(fit) if k != at]
        for p, j, _ in sorted(s for s in scored if s[2] == y)[:5]:
            fits = sorted(s for s in scored if s[2] != y and 80 * -p <= 100 * -s[0] <= 100 * -p)[:5]
            out |= {(i, j, r + 1, n, -p, -s) for r, (s, n, _) in enumerate(fits)}
    return out


def mined(spark, rows, every=100):
    table = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)
    got = hn.mine(hn.scaled(table), F.col("vec_id") % every == 0).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def clusters(n, dims, seed, labels=4):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = draw.randrange(6)
        rows.append((i, draw.randrange(labels), [x + draw.gauss(0, 0.2) for x in centres[c]]))
    return rows


@pytest.mark.parametrize("dims", [1, 3, 20])
def test_equals_brute_force(spark, monkeypatch, dims):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hn, "PACK_ROWS", 8)
    monkeypatch.setattr(hn, "CHUNK_ROWS", 4)
    rows = clusters(600, dims, dims)
    want = brute(rows, 20)
    assert len(want) > 100 and mined(spark, rows, 20) == want


def test_bounds_leave_out_blocks_where_vectors_have_clusters(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 32)
    rows = spark.createDataFrame([(*r, *EXTRA) for r in clusters(2000, 16, 5)], SCHEMA)
    vectors = hn.scaled(rows)
    blocks = hn.stage(hn.blocks_of(vectors, F.col("vec_id") % 50 == 0, hn.dimension_sums(vectors)), "blocks")
    anchors = hn.stage(hn.anchors_of(blocks, 5), "anchors")
    read = sum(r.n for r in hn.chosen(anchors, blocks, True).select("n").collect())
    assert anchors.count() <= read < 0.5 * anchors.count() * blocks.count()


def test_nulls_ties_repeats_and_unfit_values(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 0, [1.0, 0.0])] + [(i, i % 2, [1.0, 0.0]) for i in range(1, 30)]
    rows += [(30, None, [1.0, 1.0]), (31, 0, None), (32, 1, [nan, 0.0]), (33, 1, [0.0, inf]), (34, 0, [None, 1.0])]
    rows += [(None, 0, [9.0, 9.0]), (35, 1, []), (36, 0, [0.9]), (37, 1, [0.9, 0.1, 5.0]), (100, 5, [1.0, 1.0])]
    assert mined(spark, rows) == brute(rows)
    # A row that comes twice is one row; two contents of one id are two rows.
    assert mined(spark, rows + rows[:5]) == brute(rows)
    other = rows + [(3, 0, [0.95, 0.0]), (200, 1, [-1.0, 0.5])]
    assert mined(spark, other) == brute(other)


def test_scores_below_zero_have_no_negatives(spark):
    rows = [(0, 0, [1.0]), (1, 0, [-1.0]), (2, 1, [-1.0]), (3, 1, [-0.9])]
    assert mined(spark, rows) == brute(rows) == set()


def test_large_values_are_cut_and_whole_scores_stay_exact(spark):
    rows = [(0, 0, [3e38, 4096.0]), (1, 0, [3e38, 4096.0]), (2, 1, [1e30, 4095.0]), (3, 1, [4000.0, 4000.0])]
    cut = [(i, y, [min(x, 4096.0) for x in v]) for i, y, v in rows]
    assert mined(spark, rows) == brute(cut) and brute(cut)


def test_empty_tables(spark):
    for rows in ([], [(0, None, [1.0])], [(0, 1, [1.0])], [(0, 1, []), (1, 1, []), (2, 2, [])]):
        assert mined(spark, rows) == brute(rows)


def test_curve_visits_neighbours():
    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    place = hn.hilbert_index(cells, 3)
    assert sorted(place) == list(range(512))
    walk = cells[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()
