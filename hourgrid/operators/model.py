"""Gradient-boosted trees over feature rows: encoding, trials with early stopping, search, final fit, scoring."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid.operators import baseline, boosting, sampler
from hourgrid.operators.boosting import Feature, Grown
from hourgrid.spec import DemandSpec
from hourgrid.staging import stage

PREDICTION = "pred_model"

# Seed, number of trials, patience in trees, and the search ranges.
SEED = 42
N_TRIALS = 18
PATIENCE = 50
SEARCH_RANGES = {
    "num_leaves": (15, 255),
    "max_depth": (3, 12),
    "learning_rate": (0.01, 0.3),
    "n_estimators": (100, 1000),
    "min_data_in_leaf": (10, 200),
    "feature_fraction": (0.5, 1.0),
    "bagging_fraction": (0.5, 1.0),
}
LOG_UNIFORM = ("learning_rate",)
WHOLE = ("num_leaves", "max_depth", "n_estimators", "min_data_in_leaf")

#: Trials drawn at random before the model-based draws, and draws that are made at once from then on.
STARTUP_TRIALS, DRAWS = 10, 4
# Rows of the overall mean that are added to each value's own in the target means.
SMOOTHING = 20.0

PARAMS_SCHEMA = (
    "num_leaves int, max_depth int, learning_rate double, n_estimators int, min_data_in_leaf int, "
    "feature_fraction double, bagging_fraction double"
)
TRIAL_SCHEMA = f"trial int, {PARAMS_SCHEMA}, best_iteration int, val_mae double, val_rmse double"
#: A leaf has no feature. A numeric node sends values up to `threshold`, and nulls, to the left; a text node sends `categories` to the
#: left, or with `others_left` all but them.
NODE_SCHEMA = (
    "tree int, node int, depth int, feature string, threshold double, categories array<string>, others_left boolean, "
    "left int, right int, gain double, value double, n_rows bigint"
)


@dataclass(frozen=True)
class BoostingParams:
    """Parameters under the names of the stored JSON, so an existing parameter file can be read.

    Trees grow leaf by leaf up to `num_leaves`; a `max_depth` of 0 or less sets no bound.
    """

    num_leaves: int = 31
    max_depth: int = -1
    learning_rate: float = 0.1
    n_estimators: int = 100
    min_data_in_leaf: int = 20
    feature_fraction: float = 1.0
    bagging_fraction: float = 1.0


@dataclass(frozen=True)
class Encoder:
    """Smoothed target means of the text columns: `means` has feature, value and mean; unknown values get `prior`."""

    means: DataFrame
    prior: float

    def columns(self, df: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
        """`df` with a number in place of each text column, under the name `<column>_mean`.

        The means are joined per column; whether they are broadcast is left to the planner, which checks their size.
        """

        def joined(rows: DataFrame, column: str) -> DataFrame:
            own = self.means.where(F.col("feature") == column).select(
                F.col("value").alias("_value"), F.col("mean").alias(f"{column}_mean")
            )
            return rows.join(own, rows[column].eqNullSafe(own["_value"]), "left").drop("_value")

        encoded = reduce(joined, spec.categorical, df)
        return encoded.fillna(self.prior, [f"{c}_mean" for c in spec.categorical])


@dataclass(frozen=True)
class DemandModel:
    """The trees as rows of `NODE_SCHEMA`, the mean they start from, and the columns they may use.

    With an encoder the text columns are used as target means, else as sets of values.
    """

    nodes: tuple[tuple, ...]
    prior: float
    columns: tuple[str, ...]
    encoder: Encoder | None = None

    def table(self) -> DataFrame:
        return SparkSession.active().createDataFrame(list(self.nodes), NODE_SCHEMA)

    @property
    def n_trees(self) -> int:
        return 1 + max((n[0] for n in self.nodes), default=-1)


def target_means(df: DataFrame, prior: float, spec: DemandSpec = DemandSpec(), smoothing: float = SMOOTHING) -> DataFrame:
    """(feature, value, mean): the mean target of each value, drawn to the overall mean by `smoothing` rows of it.

    Sums are partial before the shuffle and the result stays distributed, so the same encoding serves ten stations and
    ten million.
    """
    values = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in spec.categorical)))
    sums = df.select(values.alias("v"), F.col(spec.target).alias("y")).groupBy("v.feature", "v.value").agg(
        F.sum("y").alias("total"), F.count("y").alias("n")
    )
    mean = (F.col("total") + smoothing * prior) / (F.col("n") + smoothing)
    return sums.select("feature", "value", mean.alias("mean"))


def fit_encoder(df: DataFrame, spec: DemandSpec = DemandSpec(), smoothing: float = SMOOTHING) -> Encoder:
    """Target means of the training rows; one number comes to the driver."""
    prior = float(df.agg(F.avg(spec.target)).first()[0] or 0.0)
    return Encoder(stage(target_means(df, prior, spec, smoothing), "means"), prior)


def node_rows(trees: Sequence[boosting.Tree], features: Sequence[Feature]) -> list[tuple]:
    """Trees as rows of `NODE_SCHEMA`, with values of the columns in place of bins."""
    rows = []
    for t, tree in enumerate(trees):
        for node in range(len(tree.feature)):
            name = threshold = categories = others = left = right = None
            if tree.feature[node] >= 0:
                feature, bins = features[tree.feature[node]], set(tree.left_bins[node])
                name, left, right = feature.name, tree.left[node], tree.right[node]
                if feature.is_category:
                    others = 0 in bins
                    categories = [v for b, v in enumerate(feature.values, 1) if (b in bins) != others]
                else:
                    threshold = feature.edges[max(bins) - 1] if max(bins) else -math.inf
            rows.append((
                t, node, tree.depth[node], name, threshold, categories, others, left, right, tree.gain[node], tree.value[node],
                tree.rows[node],
            ))
    return rows


def fit_many(
    train: DataFrame,
    params: Sequence[BoostingParams],
    spec: DemandSpec = DemandSpec(),
    seed: int = SEED,
    encoding: str = "sets",
    bagging: bool = True,
    columns: Sequence[str] | None = None,
) -> list[DemandModel]:
    """A model for each parameter set; all grow from the same passes over the rows.

    `encoding`: text columns as "sets" of values, where values beyond the most frequent `boosting.MAX_CATEGORIES` stand
    together, or as target "means", which keep any number of values apart.
    """
    if encoding not in ("sets", "means"):
        raise ValueError(f"encoding must be sets or means, got {encoding!r}")
    used = list(columns or spec.feature_columns)
    text = [c for c in used if c in spec.categorical]
    numeric = [c for c in used if c not in text]
    encoder = None
    if encoding == "means":
        encoder = fit_encoder(train, spec)
        train, numeric, text = encoder.columns(train, spec), [*numeric, *(f"{c}_mean" for c in text)], []
    features = boosting.fit_features(train, numeric, text)
    blocks = boosting.binned_blocks(train, features, spec.target)
    grown = boosting.grow(blocks, features, params, seed, bagging=bagging)
    names = tuple(f.name for f in features)
    return [DemandModel(tuple(node_rows(g.trees, features)), g.prior, names, encoder) for g in grown]


def fit(train: DataFrame, params: BoostingParams = BoostingParams(), spec: DemandSpec = DemandSpec(), **how) -> DemandModel:
    """One model that scores feature rows."""
    return fit_many(train, [params], spec, **how)[0]


def fit_default(train_val: DataFrame, spec: DemandSpec = DemandSpec(), seed: int = SEED, **overrides) -> DemandModel:
    """The comparator before tuning."""
    return fit(train_val, BoostingParams(**overrides), spec, seed=seed)


def fit_final(
    train_val: DataFrame,
    params: BoostingParams,
    spec: DemandSpec = DemandSpec(),
    seed: int = SEED,
    bagging: bool = False,
) -> DemandModel:
    """Refit on train and validation with the best parameters; `n_estimators` is the early-stopped tree count.

    Rows are sampled per tree only in the trials, unless `bagging` asks for it here as well.
    """
    return fit(train_val, params, spec, seed=seed, bagging=bagging)


def best_iteration(curve: Sequence[float], patience: int = PATIENCE) -> int:
    """Tree count with the smallest error, ending the search after `patience` trees without a smaller one."""
    best = 0
    for i, error in enumerate(curve):
        if error < curve[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def best_iterations(curves: DataFrame, key: str, order: str, error: str, patience: int = PATIENCE) -> DataFrame:
    """(key, best_iteration): the same over a table of curves, one row per tree in the given order."""
    along = Window.partitionBy(key).orderBy(order)
    earlier = F.min(error).over(along.rowsBetween(Window.unboundedPreceding, -1))
    steps = curves.withColumns({"_at": F.row_number().over(along), "_earlier": earlier})
    better = steps.where(F.col("_earlier").isNull() | (F.col(error) < F.col("_earlier")))
    better = better.withColumn("_next", F.lead("_at").over(Window.partitionBy(key).orderBy("_at")))
    ends = better.where(F.col("_next").isNull() | (F.col("_next") - F.col("_at") > patience))
    return ends.groupBy(key).agg(F.min("_at").alias("best_iteration"))


def sample_params(
    n_trials: int = N_TRIALS, seed: int = SEED, ranges: dict[str, tuple[float, float]] | None = None
) -> list[BoostingParams]:
    """Seeded random draws: whole numbers uniform, rates uniform or log-uniform."""
    bounds = {**SEARCH_RANGES, **(ranges or {})}
    rng = random.Random(seed)

    def draw(name: str) -> float:
        low, high = bounds[name]
        if name in WHOLE:
            return rng.randint(int(low), int(high))
        if name in LOG_UNIFORM:
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        return rng.uniform(low, high)

    return [BoostingParams(**{name: draw(name) for name in SEARCH_RANGES}) for _ in range(n_trials)]


def next_params(
    trials: DataFrame, ranges: dict[str, tuple[float, float]] | None = None, draws: int = 1
) -> DataFrame:
    """The next `draws` parameter sets that the trial log suggests, one row each (`draw` from 1)."""
    return sampler.suggest(trials, {**SEARCH_RANGES, **(ranges or {})}, LOG_UNIFORM, WHOLE, draws=draws)


def trial_row(number: int, params: BoostingParams, grown: Grown) -> tuple:
    count = boosting.best_count(grown.mae) if grown.mae else 0
    errors = (grown.mae[count - 1], grown.rmse[count - 1]) if count else (None, None)
    return (number, *(getattr(params, f.name) for f in fields(params)), count, *errors)


def search(
    train: DataFrame,
    validation: DataFrame,
    spec: DemandSpec = DemandSpec(),
    n_trials: int = N_TRIALS,
    patience: int = PATIENCE,
    seed: int = SEED,
    ranges: dict[str, tuple[float, float]] | None = None,
    startup: int = STARTUP_TRIALS,
    draws: int = DRAWS,
) -> DataFrame:
    """Bounded search on a chronological validation set: one row per trial.

    The first `startup` trials are random; then `draws` at a time follow the densities of good and bad trials so far
    (`startup=n_trials` is a plain random search). Rows are binned once, and trials of one batch grow side by side.
    """
    spark = train.sparkSession
    text = list(spec.categorical)
    features = boosting.fit_features(train, spec.numeric_features, text)
    columns = [*spec.feature_columns, spec.target]
    rows = train.select(*columns, F.lit(False).alias("held")).union(validation.select(*columns, F.lit(True)))
    blocks = boosting.binned_blocks(rows, features, spec.target, F.col("held"))
    log: list[tuple] = []
    batch = sample_params(min(startup, n_trials), seed, ranges)
    while batch:
        grown = boosting.grow(blocks, features, batch, seed, patience)
        log += [trial_row(len(log) + i, p, g) for i, (p, g) in enumerate(zip(batch, grown, strict=True))]
        table = spark.createDataFrame(log, TRIAL_SCHEMA)
        left = min(draws, n_trials - len(log))
        batch = all_params(next_params(table, ranges, left)) if left > 0 else []
    return spark.createDataFrame(log, TRIAL_SCHEMA)


def best_params(trials: DataFrame) -> DataFrame:
    """The winning trial's parameters, with the tree count corrected to the early-stopped one."""
    return trials.orderBy("val_mae", "trial").limit(1).select(
        "num_leaves",
        "max_depth",
        "learning_rate",
        F.col("best_iteration").alias("n_estimators"),
        "min_data_in_leaf",
        "feature_fraction",
        "bagging_fraction",
    )


def all_params(table: DataFrame) -> list[BoostingParams]:
    return [BoostingParams(**{f.name: row[f.name] for f in fields(BoostingParams)}) for row in table.collect()]


def params_of(row_table: DataFrame) -> BoostingParams:
    """Parameters from a one-row table."""
    return all_params(row_table.limit(1))[0]


def _tree_sql(nodes: dict[int, tuple], inputs: dict[str, str], node: int = 0) -> str:
    """One tree as nested conditions."""
    _, _, _, feature, threshold, categories, others, left, right, _, value, _ = nodes[node]
    if feature is None:
        return f"{value!r}D"
    x = inputs[feature]
    if categories is None:
        fits = f"{x} <= " + ("double('-Infinity')" if threshold == -math.inf else f"{threshold!r}D")
    else:
        listed = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in categories)
        inside = f"coalesce({x} IN ({listed}), false)" if listed else "false"
        fits = f"NOT {inside}" if others else inside
    return f"CASE WHEN {fits} THEN {_tree_sql(nodes, inputs, left)} ELSE {_tree_sql(nodes, inputs, right)} END"


def score(model: DemandModel, df: DataFrame, column: str = PREDICTION, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Add the prediction: the trees as one expression over the columns, without a Python worker.

    Null and NaN count as the smallest number, as in the fit.
    """
    rows = model.encoder.columns(df, spec) if model.encoder else df
    taken = set(rows.columns)
    inputs: dict[str, str] = {}
    prepared = []
    texts = {n[3] for n in model.nodes if n[5] is not None}
    for name in sorted({n[3] for n in model.nodes if n[3] is not None}):
        short = f"x{len(inputs)}"
        while short in taken:
            short += "_"
        inputs[name] = short
        number = F.col(name).cast("double")
        number = F.when(number.isNull() | F.isnan(number), float("-inf")).otherwise(number)
        prepared.append((F.col(name).cast("string") if name in texts else number).alias(short))
    by_tree: dict[int, dict[int, tuple]] = {}
    for n in model.nodes:
        by_tree.setdefault(n[0], {})[n[1]] = n
    total = " + ".join([f"{model.prior!r}D", *(_tree_sql(nodes, inputs) for _, nodes in sorted(by_tree.items()))])
    if inputs:
        # Whole-stage code would put all trees into one method, which may not exceed 64 KB. A projection with a function on
        # arrays stays out of it and is compiled in small methods, one or more a tree.
        given = ", ".join(inputs.values())
        total = f"CASE WHEN NOT exists(array(struct({given})), x -> x IS NULL) THEN {total} END"
    chosen = [F.col(f"`{c}`") for c in df.columns]
    return rows.select(*rows.columns, *prepared).select(*chosen, F.expr(total).alias(column))


def prediction_table(
    models: dict[str, DemandModel], test: DataFrame, spec: DemandSpec = DemandSpec()
) -> DataFrame:
    """Keys, actual value, one column per model, and the two baselines."""
    scored = test
    for column, model in models.items():
        scored = score(model, scored, column, spec)
    chosen = [*spec.keys, spec.target, *models]
    return baseline.with_baselines(scored, spec).select(
        *chosen, baseline.naive_column(), baseline.rolling_column(spec)
    )


def attach_predictions(df: DataFrame, predictions: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Join a stored prediction table back to rows by series and time."""
    columns = [c for c in predictions.columns if c.startswith("pred_")]
    return df.join(predictions.select(spec.series_id, spec.ts, *columns), [spec.series_id, spec.ts], "inner")


def importance(model: DemandModel) -> DataFrame:
    """Total gain of the splits on each feature, smallest first; a feature without a split has 0."""
    names = SparkSession.active().createDataFrame([(c,) for c in model.columns], "feature string")
    gains = model.table().where("feature is not null").groupBy("feature").agg(F.sum("gain").alias("importance"))
    return names.join(gains, "feature", "left").fillna(0.0, ["importance"]).orderBy("importance", "feature")


def save(model: DemandModel, path: str) -> None:
    """Tree rows, what they start from, and target means if any, each in its own folder under `path`."""
    model.table().coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
    rest = [(model.prior, list(model.columns), model.encoder.prior if model.encoder else None)]
    rest = SparkSession.active().createDataFrame(rest, "prior double, columns array<string>, encoder_prior double")
    rest.coalesce(1).write.mode("overwrite").parquet(f"{path}/prior")
    if model.encoder:
        model.encoder.means.write.mode("overwrite").parquet(f"{path}/means")


def load(path: str) -> DemandModel:
    spark = SparkSession.active()
    rest = spark.read.parquet(f"{path}/prior").first()
    nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/trees").orderBy("tree", "node").collect()
    encoder = None
    if rest.encoder_prior is not None:
        encoder = Encoder(spark.read.parquet(f"{path}/means"), rest.encoder_prior)
    return DemandModel(tuple(map(tuple, nodes)), rest.prior, tuple(rest.columns), encoder)
