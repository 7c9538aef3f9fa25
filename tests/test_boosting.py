import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourgrid.operators import boosting, model, sampler
from hourgrid.operators.boosting import Feature
from hourgrid.spec import DemandSpec

SCHEMA = "a double, b double, c string, y double, held boolean"
SPEC = DemandSpec(target="y", categorical=("c",))


def table(n, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        a = None if i % 17 == 0 else float("nan") if i % 19 == 0 else draw.randrange(40) / 4
        b, c = draw.gauss(0, 1), draw.choice(["x", "y", "z", "w", None, "it's", "q\\"])
        y = (a if a and a == a else -2) * (2 if c in ("x", "z") else -1) + (3 if b > 0.5 else 0) + draw.gauss(0, 0.5)
        rows.append((a, b, c, y, i % 4 == 3))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(table(1500), SCHEMA).repartition(6).persist()


def grown(frame, *params, held=True, **how):
    features = boosting.fit_features(frame, ["a", "b"], ["c"])
    blocks = boosting.binned_blocks(frame, features, "y", F.col("held") if held else None)
    return features, boosting.grow(blocks, features, params, 1, **how)


def shape(trees):
    return [(t.feature, t.left_bins, t.left, t.right, t.rows) for t in trees]


def test_scores_of_the_table_are_those_of_the_fit(frame):
    """Nulls, NaN, quotes and values that were not seen go the same way in both."""
    params = model.BoostingParams(num_leaves=12, n_estimators=7, min_data_in_leaf=4, learning_rate=0.4)
    features, (got,) = grown(frame, params, patience=7)
    fitted = model.DemandModel(tuple(model.node_rows(got.trees, features)), got.prior, ("a", "b", "c"))
    scored = model.score(fitted, frame.where("held"), spec=SPEC).agg(F.avg(F.abs(F.col("y") - F.col("pred_model")))).first()[0]
    assert scored == pytest.approx(got.mae[-1], rel=1e-9)
    assert len(got.mae) == len(got.trees) == 7 and got.mae[-1] < got.mae[0]


def test_one_task_and_many_tasks_grow_the_same_trees(frame, monkeypatch):
    params = model.BoostingParams(num_leaves=20, n_estimators=4, min_data_in_leaf=3, bagging_fraction=1.0, feature_fraction=0.7)
    _, (alone,) = grown(frame, params)
    monkeypatch.setattr(boosting, "TASK_ROWS", 200)
    monkeypatch.setattr(boosting, "CHECKPOINT", 2)
    _, (passes,) = grown(frame, params)
    assert shape(alone.trees) == shape(passes.trees)
    monkeypatch.setattr(boosting, "DIRECT_TASKS", 2)
    _, (tree_sums,) = grown(frame, params)
    assert shape(alone.trees) == shape(tree_sums.trees)
    for one, two in zip(alone.trees, passes.trees, strict=True):
        assert one.value == pytest.approx(two.value) and one.gain == pytest.approx(two.gain)


def test_limits_of_a_tree(frame):
    wide = model.BoostingParams(num_leaves=9, n_estimators=3, min_data_in_leaf=60)
    deep = model.BoostingParams(num_leaves=50, n_estimators=3, min_data_in_leaf=1, max_depth=3)
    _, trees = grown(frame, wide, deep)
    for got, params in zip(trees, (wide, deep), strict=True):
        for tree in got.trees:
            leaves = [i for i, f in enumerate(tree.feature) if f < 0]
            assert 2 <= len(leaves) <= params.num_leaves
            assert min(tree.rows[i] for i in leaves) >= params.min_data_in_leaf
            assert params.max_depth < 0 or max(tree.depth) <= params.max_depth
            assert sum(tree.rows[i] for i in leaves) == tree.rows[0]
    # Best first: a leaf budget of k+1 gives the tree of budget k and one split more, the largest that was left.
    sizes = [model.BoostingParams(num_leaves=k, n_estimators=1, min_data_in_leaf=5) for k in (2, 3, 4, 5, 6)]
    _, steps = grown(frame, *sizes)
    gains = [sorted(g for g in s.trees[0].gain if g) for s in steps]
    for small, large in itertools.pairwise(gains):
        assert len(large) == len(small) + 1 and not set(np.round(small, 6)) - set(np.round(large, 6))


def test_patience_costs_no_tree_more(frame):
    """Trees grown = trees of the best count + patience, whether a set is grown alone or beside others."""
    params = [model.BoostingParams(num_leaves=31, learning_rate=r, n_estimators=60, min_data_in_leaf=1) for r in (1.0, 0.5, 0.05)]
    _, together = grown(frame, *params, patience=5)
    for p, got in zip(params, together, strict=True):
        best = boosting.best_count(got.mae)
        assert len(got.trees) == min(best + 5, 60) == len(got.mae)
        _, (own,) = grown(frame, p, patience=5)
        assert own.mae == pytest.approx(got.mae)
        assert model.best_iteration(got.mae, 5) == best


def test_category_split_is_the_best_of_all_subsets(spark):
    draw = random.Random(4)
    rows = [(0.0, 0.0, "abcdefg"[i % 7], draw.gauss((i % 7) * 13 % 5, 1), False) for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA)
    features = [Feature("c", values=tuple("gfedcba"))]
    blocks = boosting.binned_blocks(frame, features, "y")
    (got,) = boosting.grow(blocks, features, [model.BoostingParams(num_leaves=2, n_estimators=1, min_data_in_leaf=1)], 1)

    def squared(values):
        mean = sum(values) / len(values)
        return sum((v - mean) ** 2 for v in values)

    best = min(
        squared([r[3] for r in rows if r[2] in some]) + squared([r[3] for r in rows if r[2] not in some])
        for k in range(1, 7) for some in itertools.combinations("abcdefg", k)
    )
    assert got.trees[0].gain[0] == pytest.approx(squared([r[3] for r in rows]) - best)


def test_rows_and_features_are_sampled_by_the_seed(frame):
    some = model.BoostingParams(num_leaves=6, n_estimators=6, min_data_in_leaf=5, bagging_fraction=0.5, feature_fraction=0.34)
    _, (one,) = grown(frame, some)
    _, (two,) = grown(frame, some)
    assert shape(one.trees) == shape(two.trees)
    assert all(len({f for f in t.feature if f >= 0}) <= 1 for t in one.trees)
    assert {t.rows[0] for t in one.trees} != {one.trees[0].rows[0]} and all(400 < t.rows[0] < 725 for t in one.trees)
    _, (whole,) = grown(frame, some, bagging=False)
    assert {t.rows[0] for t in whole.trees} == {1125}


def test_tables_without_rows_values_or_splits(spark):
    params = model.BoostingParams(n_estimators=3, min_data_in_leaf=1)
    empty = spark.createDataFrame([], SCHEMA)
    _, (none,) = grown(empty, params)
    assert none == boosting.Grown(0.0)
    held = spark.createDataFrame([(1.0, 1.0, "x", 5.0, True)], SCHEMA)
    assert grown(held, params, patience=2)[1][0].trees == []
    nulls = spark.createDataFrame([(None, None, None, float(i), False) for i in range(4)] + [(1.0, 1.0, "x", None, False)], SCHEMA)
    features, (flat,) = grown(nulls, params)
    assert flat.prior == 1.5 and all(t.feature == [-1] for t in flat.trees) and len(flat.trees) == 3
    fitted = model.DemandModel(tuple(model.node_rows(flat.trees, features)), flat.prior, ("a", "b", "c"))
    assert [r.pred_model for r in model.score(fitted, nulls, spec=SPEC).collect()] == [1.5] * 5
    assert {r.importance for r in model.importance(fitted).collect()} == {0.0}


def test_edges_and_categories(spark):
    rows = spark.range(10_000).select((F.col("id") % 7).cast("double").alias("few"), F.col("id").cast("double").alias("many"),
                                      F.concat(F.lit("v"), F.col("id") % 30).alias("c"))
    few, many, c = boosting.fit_features(rows, ["few", "many"], ["c"], max_bins=16, max_categories=12)
    assert few.edges == (0, 1, 2, 3, 4, 5) and few.bins == 8
    assert len(many.edges) == 15 and all(abs(e - 625 * (i + 1)) < 50 for i, e in enumerate(many.edges))
    assert len(c.values) == 12 and c.bins == 13


# The sampler


LOG = "trial int, rate double, leaves int, val_mae double"
RANGES = {"rate": (0.01, 0.3), "leaves": (15, 255)}


def brute(rows, draws):
    rows = sorted((r for r in rows if r[3] is not None), key=lambda r: (r[3], r[0]))
    cut = math.ceil(len(rows) * sampler.GOOD_SHARE)
    found = {}
    for at, (name, (low, high)) in enumerate(RANGES.items(), 1):
        f = math.log if name == "rate" else float
        u = [(f(r[at]) - f(low)) / (f(high) - f(low)) for r in rows]
        good, other = u[:cut], u[cut:]
        width = lambda k: (k + 1) ** -0.2 / 4

        def density(x, own):
            h = width(len(own))
            return (1 + sum(math.exp(-(((x - v) / h) ** 2) / 2) / (h * math.sqrt(2 * math.pi)) for v in own)) / (len(own) + 1)

        places = {min(max(v + width(cut) * z, 0.0), 1.0) for v in good for z in sampler.OFFSETS}
        best = sorted(places, key=lambda x: (-round(math.log(density(x, good) / density(x, other)), 9), x))[:draws]
        best += best[-1:] * (draws - len(best))
        found[name] = [math.exp(f(low) + x * (f(high) - f(low))) if name == "rate" else round(low + x * (high - low)) for x in best]
    return list(zip(*found.values()))


def test_draws_follow_the_densities(spark):
    draw = random.Random(2)
    rows = [(i, draw.uniform(0.01, 0.3), draw.randrange(15, 256), draw.choice([1.0, 2.0, draw.random()])) for i in range(17)]
    rows += [(90, 0.2, 20, None)]
    for some, draws in ((rows, 3), (rows[:1], 2), (rows[:1], 15)):
        got = sampler.suggest(spark.createDataFrame(some, LOG), RANGES, ("rate",), ("leaves",), draws).collect()
        want = brute(some, draws)
        assert [r.draw for r in got] == list(range(1, draws + 1))
        assert [r.leaves for r in got] == [w[1] for w in want]
        assert [r.rate for r in got] == pytest.approx([w[0] for w in want])
    assert sampler.suggest(spark.createDataFrame([], LOG), RANGES).collect() == []


def test_draws_stay_near_good_trials(spark):
    rows = [(i, 0.02 if i < 5 else 0.25, 30 if i < 5 else 200, 1.0 if i < 5 else 9.0) for i in range(20)]
    (got,) = sampler.suggest(spark.createDataFrame(rows, LOG), RANGES, ("rate",), ("leaves",)).collect()
    assert got.rate < 0.06 and got.leaves < 110
