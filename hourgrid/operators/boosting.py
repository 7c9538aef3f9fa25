"""Gradient-boosted trees grown leaf by leaf, as passes of Spark over binned rows.

Rows are cut once into blocks of small whole numbers (`binned_blocks`): numeric features by quantile edges, text features by
category. A pass adds up, in every task, the residuals and rows of each asked leaf, feature and bin; only these sums come
to the driver, whose size depends on leaves and bins and not on rows. The driver picks splits from them:

* best first: the leaf with the largest gain is split next until the leaf budget is used (`Grower`). All leaves that may be
  split next are asked for in one pass, so a tree takes as many passes as it is deep, not as many as it has leaves;
* the larger of two children is the parent less the smaller one, so only the smaller one is counted;
* a category split sends a set of values to the left: values are ordered by their mean residual in the leaf, and for
  squared error one of the cuts of this order is the best of all subsets.

Scores of all rows, training and validation, are part of the state and grow tree by tree; nothing is fitted twice. Several
parameter sets are grown side by side and share every pass. The state is cached by Spark and written to the shared folder
every `CHECKPOINT` trees, so a lost executor repeats a few trees of its own rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.staging import ensure_checkpoint_dir, stage

MAX_BINS = 64
#: Values of a text feature that get a bin of their own, the most frequent first; the others share one.
MAX_CATEGORIES = 1024
#: Rows of a block, and least rows of a task: a pass over fewer takes less time than the start of a task.
BLOCK_ROWS, TASK_ROWS = 50_000, 100_000
#: Trees between two checkpoints, tasks whose sums the driver adds up itself, and trees that wait for the next stored scores.
CHECKPOINT, DIRECT_TASKS, PENDING = 25, 16, 8
LEAST_GAIN = 1e-9
BLOCK = "block bigint, rows int, bins binary, target binary, held binary"


@dataclass(frozen=True)
class Feature:
    """Bins of a column. Numeric: 0 for null, then one up to and including each edge, then one above the last.
    Text: 0 for null and all other values, then one for each value."""

    name: str
    edges: tuple[float, ...] = ()
    values: tuple[str, ...] | None = None

    @property
    def is_category(self) -> bool:
        return self.values is not None

    @property
    def bins(self) -> int:
        return 1 + (len(self.values) if self.is_category else len(self.edges) + 1)

    def codes(self, column: pa.Array) -> np.ndarray:
        if self.is_category:
            found = pc.index_in(column, value_set=pa.array(self.values, column.type))
            return pc.add(pc.fill_null(found, -1), 1).to_numpy(zero_copy_only=False).astype(np.uint16)
        x = pc.cast(column, pa.float64()).to_numpy(zero_copy_only=False)
        codes = np.searchsorted(np.asarray(self.edges, float), x, "left") + 1
        return np.where(np.isnan(x), 0, codes).astype(np.uint16)


def fit_features(
    rows: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    max_bins: int = MAX_BINS,
    max_categories: int = MAX_CATEGORIES,
) -> list[Feature]:
    """Edges and categories of the training rows; a numeric feature of few values has a bin for each.

    The driver sees at most `max_bins` edges or `max_categories` values of a feature.
    """
    x = {c: F.col(c).cast("double") for c in numeric}
    found: dict[str, Feature] = {}
    if numeric:
        distinct = rows.agg(*(F.approx_count_distinct(x[c], 0.02).alias(c) for c in numeric)).first()
        cuts = [i / max_bins for i in range(1, max_bins)]

        def edges(c: str) -> Column:
            if distinct[c] <= max_bins:
                return F.sort_array(F.collect_set(x[c]))
            return F.percentile_approx(x[c], cuts, 200 * max_bins)

        for c, values in zip(numeric, rows.agg(*(edges(c).alias(c) for c in numeric)).first(), strict=True):
            ordered = sorted({v for v in values or () if v == v})
            # Nothing lies above the largest of all values.
            found[c] = Feature(c, tuple(ordered[:-1] if distinct[c] <= max_bins else ordered))
    for c in categorical:
        counted = rows.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("v")).count()
        top = counted.orderBy(F.desc("count"), "v").limit(max_categories).collect()
        found[c] = Feature(c, values=tuple(r.v for r in top))
    return [found[c] for c in (*numeric, *categorical)]


def binned_blocks(rows: DataFrame, features: Sequence[Feature], target: str, held: Column | None = None) -> DataFrame:
    """Rows with a target as blocks, written to the shared folder; `held` marks validation rows."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = np.stack([f.codes(batch.column(i)) for i, f in enumerate(features)], axis=1)
            y = batch.column(len(features)).to_numpy(zero_copy_only=False).astype(float)
            out = batch.column(len(features) + 1).to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_pydict({
                "block": [task << 32 | number],
                "rows": pa.array([len(y)], pa.int32()),
                "bins": [np.ascontiguousarray(codes.T).tobytes()],
                "target": [y.tobytes()],
                "held": [out.tobytes()],
            })
            number += 1

    columns = [F.col(f.name).cast("string" if f.is_category else "double").alias(f"f{i}") for i, f in enumerate(features)]
    mark = F.coalesce(held, F.lit(False)) if held is not None else F.lit(False)
    wanted = rows.where(F.col(target).isNotNull()).select(*columns, F.col(target).cast("double").alias("y"), mark.alias("held"))
    return stage(wanted.mapInArrow(cut, BLOCK), "blocks")


@dataclass
class Tree:
    """Nodes as parallel lists; node 0 is the root, a leaf has feature -1. `left_bins` are the bins that go to the left."""

    feature: list[int] = field(default_factory=list)
    left_bins: list[tuple[int, ...]] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)

    def add(self, value: float, rows: int, depth: int) -> int:
        for column, x in (
            (self.feature, -1), (self.left_bins, ()), (self.left, -1), (self.right, -1), (self.gain, 0.0),
            (self.value, value), (self.rows, rows), (self.depth, depth),
        ):
            column.append(x)
        return len(self.feature) - 1

    def router(self, width: int) -> Router:
        """`width`: most bins of a feature."""
        goes_left = np.zeros((len(self.feature), width), bool)
        for node, bins in enumerate(self.left_bins):
            goes_left[node, list(bins)] = True
        return Router(np.array(self.feature), goes_left, np.array(self.left), np.array(self.right))


@dataclass(frozen=True)
class Router:
    feature: np.ndarray
    goes_left: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins (features x rows)."""
        node = np.zeros(bins.shape[1], np.int64)
        moving = np.arange(bins.shape[1]) if self.feature[0] >= 0 else np.empty(0, np.int64)
        while len(moving):
            at = node[moving]
            lefts = self.goes_left[at, bins[self.feature[at], moving]]
            node[moving] = at = np.where(lefts, self.left[at], self.right[at])
            moving = moving[self.feature[at] >= 0]
        return node


@dataclass(frozen=True)
class Layout:
    """Where the bins of each feature stand in one row of sums."""

    features: tuple[Feature, ...]

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum([f.bins for f in self.features])]).astype(np.int64)

    @property
    def width(self) -> int:
        return max(f.bins for f in self.features)


@dataclass
class Split:
    gain: float
    feature: int
    left_bins: tuple[int, ...]
    left_rows: int
    left_sum: float


def best_splits(sums: np.ndarray, layout: Layout, allowed: Iterable[int], least_rows: int) -> list[Split | None]:
    """The split of largest gain of each leaf, from its (bins x (rows, residuals)) sums; ties go to the first feature and cut."""
    starts = layout.starts
    best: list[Split | None] = [None] * len(sums)
    for f in allowed:
        part = sums[:, starts[f] : starts[f + 1]]
        n, g = part[..., 0], part[..., 1]
        if layout.features[f].is_category:
            # Empty values stand last and so go to the right.
            order = np.argsort(np.where(n > 0, g / np.maximum(n, 1), np.inf), axis=1, kind="stable")
            n, g = np.take_along_axis(n, order, 1), np.take_along_axis(g, order, 1)
        low_n, low_g = np.cumsum(n, 1)[:, :-1], np.cumsum(g, 1)[:, :-1]
        all_n, all_g = n.sum(1, keepdims=True), g.sum(1, keepdims=True)
        high_n, high_g = all_n - low_n, all_g - low_g
        # A cut after an empty bin is the cut before it.
        fits = (low_n >= max(least_rows, 1)) & (high_n >= max(least_rows, 1)) & (n[:, :-1] > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(fits, low_g**2 / low_n + high_g**2 / high_n - all_g**2 / all_n, -np.inf)
        if not gain.shape[1]:
            continue
        at = gain.argmax(1)
        for leaf, cut in enumerate(at):
            won, known = gain[leaf, cut], best[leaf]
            # Sums in another order differ in their last digits; such differences decide nothing.
            if won > LEAST_GAIN and (known is None or won > known.gain * (1 + 1e-10)):
                bins = order[leaf, : cut + 1] if layout.features[f].is_category else np.arange(cut + 1)
                best[leaf] = Split(
                    float(won), f, tuple(int(b) for b in np.sort(bins)), round(low_n[leaf, cut]), float(low_g[leaf, cut])
                )
    return best


class Grower:
    """One tree, best first: `wanted` are the leaves whose sums the next pass has to bring."""

    def __init__(self, params, layout: Layout, allowed: Sequence[int]):
        self.layout, self.allowed, self.least = layout, allowed, params.min_data_in_leaf
        self.budget = params.num_leaves
        self.depth = params.max_depth if params.max_depth > 0 else 1 << 30
        self.tree = Tree()
        self.tree.add(0.0, 0, 0)
        self.wanted = [0]
        self.sums: dict[int, np.ndarray] = {}
        self.best: dict[int, Split] = {}
        self.siblings: dict[int, tuple[int, int]] = {}

    def receive(self, sums: np.ndarray) -> None:
        """Sums of the wanted leaves; decides what is wanted next."""
        tree, new = self.tree, {}
        for leaf, own in zip(self.wanted, sums, strict=True):
            new[leaf] = own
            if leaf in self.siblings:
                parent, other = self.siblings.pop(leaf)
                new[other] = self.sums[parent] - own
        for parent in {p for p in range(len(tree.feature)) if tree.feature[p] >= 0}:
            self.sums.pop(parent, None)
        if 0 in new:
            rows, total = new[0][: self.layout.starts[1]].sum(0)
            tree.rows[0], tree.value[0] = round(rows), float(total / max(rows, 1))
        self.sums |= new
        open_ = [leaf for leaf in new if self._may_split(leaf)]
        if open_:
            found = best_splits(np.stack([new[leaf] for leaf in open_]), self.layout, self.allowed, self.least)
            self.best |= {leaf: s for leaf, s in zip(open_, found, strict=True) if s}
        self.wanted = [small for node in self._picked()[1] if (small := self._expand(node)) is not None]

    def _may_split(self, leaf: int) -> bool:
        return self.tree.depth[leaf] < self.depth and self.tree.rows[leaf] >= 2 * max(self.least, 1)

    def _picked(self) -> tuple[list[int], list[int]]:
        """Nodes that are split, by falling gain, and those of them whose children are not known yet."""
        heap = [(-self.best[0].gain, 0)] if 0 in self.best else []
        picked, unknown = [], []
        while heap and len(picked) < self.budget - 1:
            _, node = heapq.heappop(heap)
            picked.append(node)
            if self.tree.feature[node] < 0:
                unknown.append(node)
                continue
            for child in (self.tree.left[node], self.tree.right[node]):
                if child in self.best:
                    heapq.heappush(heap, (-self.best[child].gain, child))
        return picked, unknown

    def _expand(self, node: int) -> int | None:
        """Add the children; the one to count, if one of them may be split further."""
        tree, split = self.tree, self.best[node]
        total = tree.value[node] * tree.rows[node]
        rest = tree.rows[node] - split.left_rows
        depth = tree.depth[node] + 1
        tree.feature[node], tree.left_bins[node], tree.gain[node] = split.feature, split.left_bins, split.gain
        tree.left[node] = tree.add(split.left_sum / split.left_rows, split.left_rows, depth)
        tree.right[node] = tree.add((total - split.left_sum) / rest, rest, depth)
        small, large = sorted((tree.left[node], tree.right[node]), key=lambda c: tree.rows[c])
        if not (self._may_split(small) or self._may_split(large)):
            return None
        self.siblings[small] = node, large
        return small

    def without_sums(self) -> Grower:
        self.sums = {}
        return self

    def finished(self, rate: float) -> Tree:
        """The tree of the picked splits only, with values times the learning rate."""
        picked, out, source = set(self._picked()[0]), Tree(), self.tree

        def copy(node: int) -> int:
            at = out.add(float(source.value[node] * rate), source.rows[node], source.depth[node])
            if node in picked:
                out.feature[at], out.left_bins[at], out.gain[at] = (
                    source.feature[node], source.left_bins[node], source.gain[node]
                )
                out.left[at], out.right[at] = copy(source.left[node]), copy(source.right[node])
            return at

        copy(0)
        return out


@dataclass
class Grown:
    """Trees of one parameter set, and after each tree the mean absolute and root of the mean squared validation error."""

    prior: float
    trees: list[Tree] = field(default_factory=list)
    mae: list[float] = field(default_factory=list)
    rmse: list[float] = field(default_factory=list)


def best_count(curve: Sequence[float]) -> int:
    """Number of trees of smallest error, the first of equals."""
    return min(range(len(curve)), key=lambda i: (curve[i], i)) + 1


def grow(
    blocks: DataFrame,
    features: Sequence[Feature],
    trials: Sequence,
    seed: int,
    patience: int | None = None,
    bagging: bool = True,
) -> list[Grown]:
    """Trees for each parameter set of `trials`, all from the same passes.

    With `patience`, a set ends once so many trees brought no smaller validation error: exactly the trees of its best
    count and `patience` more are grown, or all `n_estimators`. Rows are sampled per tree by `bagging_fraction`, features
    by `feature_fraction`, both repeatable from the seed. Without training rows there are no trees and the prior is 0.
    """
    layout = Layout(tuple(features))
    prior, state = _first_state(blocks, layout, trials)
    grown = [Grown(prior) for _ in trials]
    active, done, old = set(range(len(trials))) if state else set(), 0, None
    while active:
        growers = {}
        for k in active:
            draw = np.random.default_rng([seed, done, k])
            count = max(1, round(trials[k].feature_fraction * len(features)))
            allowed = sorted(draw.choice(len(features), count, replace=False).tolist())
            growers[k] = Grower(trials[k], layout, allowed)
        first = True
        while asked := {k: growers[k] for k in active if growers[k].wanted}:
            shares = {k: trials[k].bagging_fraction if bagging else 1.0 for k in asked}
            answers = state.answers(asked, shares, (seed, done), first and patience is not None)
            if first and old is not None and old.rows is not state.rows:
                old.drop()
            for k, (answer, errors) in answers.items():
                if first and patience is not None and done:
                    _note(grown[k], errors)
                    if done >= trials[k].n_estimators or done - best_count(grown[k].mae) >= patience:
                        active.discard(k)
                        continue
                if state.alone:
                    growers[k] = answer
                else:
                    growers[k].receive(answer)
            first = False
        if not active:
            break
        moves = {}
        for k in active:
            tree = growers[k].finished(trials[k].learning_rate)
            grown[k].trees.append(tree)
            moves[k] = tree.router(layout.width), np.array(tree.value)
        done += 1
        if patience is None:
            active = {k for k in active if done < trials[k].n_estimators}
        if active:
            old, state = state, state.advanced(moves, done % CHECKPOINT == 0)
    if state:
        state.drop()
    return grown


def _note(grown: Grown, errors: np.ndarray) -> None:
    rows, absolute, squared = map(float, errors)
    grown.mae.append(absolute / max(rows, 1))
    grown.rmse.append((squared / max(rows, 1)) ** 0.5)


@dataclass(frozen=True)
class Rows:
    """A block of rows and their scores so far, by trial."""

    number: int
    bins: np.ndarray
    target: np.ndarray
    held: np.ndarray
    scores: dict[int, np.ndarray]

    def moved(self, moves: dict[int, tuple[Router, np.ndarray]]) -> Rows:
        scores = {
            k: s + moves[k][1][moves[k][0].leaves(self.bins)] for k, s in self.scores.items() if k in moves
        }
        return Rows(self.number, self.bins, self.target, self.held, scores)

    def used(self, k: int, share: float, seed: tuple[int, int]) -> np.ndarray:
        """The training rows, or a share of them that is the same in every pass over a tree."""
        if share >= 1:
            return np.flatnonzero(~self.held)
        draw = np.random.default_rng([*seed, k, self.number & 0xFFFFFFFF, self.number >> 32])
        return np.flatnonzero(~self.held & (draw.random(len(self.target)) < share))

    def sums(self, grower: Grower, rows: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """(wanted leaves, bins, (rows, residuals)) of the given rows."""
        starts, slot = grower.layout.starts, np.full(len(grower.tree.feature), -1)
        size, wanted = int(starts[-1]), grower.wanted
        slot[wanted] = np.arange(len(wanted))
        bins = self.bins[:, rows]
        place = slot[grower.tree.router(grower.layout.width).leaves(bins)]
        asked = place >= 0
        place, bins, rest = place[asked] * size, bins[:, asked], rest[rows][asked]
        sums = np.zeros((len(wanted) * size, 2))
        for f in range(len(bins)):
            at = place + (starts[f] + bins[f])
            sums[:, 0] += np.bincount(at, minlength=len(sums))
            sums[:, 1] += np.bincount(at, rest, len(sums))
        return sums.reshape(len(wanted), size, 2)

    def errors(self, k: int) -> np.ndarray:
        """Validation rows, sum of absolute and of squared errors."""
        off = (self.target - self.scores[k])[self.held]
        return np.array([len(off), np.abs(off).sum(), (off * off).sum()])


@dataclass(frozen=True)
class State:
    """All rows with their scores, cached by Spark. `alone`: every trial's rows lie in one task, which then grows
    its tree to the end by itself, as the driver would with the sums of many tasks."""

    rows: RDD
    alone: bool
    #: Trees whose values are not in the scores yet.
    moves: tuple[dict[int, tuple[Router, np.ndarray]], ...] = ()

    def answers(
        self, growers: dict[int, Grower], shares: dict[int, float], seed: tuple[int, int], errors: bool
    ) -> dict[int, tuple]:
        """For each trial the sums its grower wants (or the grower at its end, if alone) and its validation errors."""
        alone, moves = self.alone, self.moves

        def of_task(blocks: Iterable[Rows]) -> Iterator[list[tuple]]:
            blocks, out = [reduce(Rows.moved, moves, b) for b in blocks], []
            for k in blocks[0].scores if blocks else ():
                if k not in growers:
                    continue
                grower, wrong = growers[k], sum(b.errors(k) for b in blocks) if errors else None
                own = [(b, b.used(k, shares[k], seed), b.target - b.scores[k]) for b in blocks]
                answer = sum(b.sums(grower, used, rest) for b, used, rest in own)
                if alone:
                    grower.receive(answer)
                    while grower.wanted:
                        grower.receive(sum(b.sums(grower, used, rest) for b, used, rest in own))
                    answer = grower.without_sums()
                out.append((k, (answer, wrong)))
            yield out

        parts = self.rows.mapPartitions(of_task)
        if alone:
            return dict(pair for part in parts.collect() for pair in part)

        def merged(a: list[tuple], b: list[tuple]) -> list[tuple]:
            one, two = dict(a), dict(b)
            for k, (x, w) in two.items():
                one[k] = (one[k][0] + x, one[k][1] + w if errors else None) if k in one else (x, w)
            return list(one.items())

        if self.rows.getNumPartitions() > DIRECT_TASKS:
            return dict(parts.treeReduce(merged))
        return dict(reduce(merged, parts.collect()))

    def advanced(self, moves: dict[int, tuple[Router, np.ndarray]], write: bool) -> State:
        """The state after one more tree of each trial in `moves`; the others are left out.

        A tree that takes one pass is added again in each of the next few, which costs less than storing the scores.
        """
        moves = (*self.moves, moves)
        if self.alone and not write and len(moves) < PENDING:
            return State(self.rows, self.alone, moves)
        rows = self.rows.map(lambda b: reduce(Rows.moved, moves, b)).persist(StorageLevel.MEMORY_AND_DISK)
        if write:
            rows.checkpoint()
        return State(rows, self.alone)

    def drop(self) -> None:
        self.rows.unpersist()


def _first_state(blocks: DataFrame, layout: Layout, trials: Sequence) -> tuple[float, State | None]:
    """Mean training target, and all rows with that score."""
    width = len(layout.features)

    def arrays(rows: Iterable) -> Iterator[Rows]:
        """Small blocks of a task become one, under the number of the first."""
        number, held, count = 0, [], 0
        for row in rows:
            if held and count + row.rows > BLOCK_ROWS:
                yield joined(number, held)
                held, count = [], 0
            number, count = number if held else row.block, count + row.rows
            bins = np.frombuffer(row.bins, np.uint16).reshape(width, row.rows)
            held.append((bins, np.frombuffer(row.target, float), np.frombuffer(row.held, bool)))
        if held:
            yield joined(number, held)

    def joined(number: int, parts: list[tuple]) -> Rows:
        bins, target, held = zip(*parts, strict=True)
        return Rows(number, np.concatenate(bins, axis=1), np.concatenate(target), np.concatenate(held), {})

    spark = blocks.sparkSession
    ensure_checkpoint_dir(spark)
    size = blocks.agg(F.sum("rows")).first()[0] or 0
    rows = blocks.rdd
    rows = rows.coalesce(max(1, min(rows.getNumPartitions(), -(-size // TASK_ROWS)))).mapPartitions(arrays)
    sums = rows.map(lambda b: (float(b.target[~b.held].sum()), int((~b.held).sum()))).collect()
    total, n = sum(s for s, _ in sums), sum(n for _, n in sums)
    if not n or not width or not trials:
        return (total / n if n else 0.0), None
    prior, tasks = total / n, rows.getNumPartitions()
    # A small table leaves cores idle: then the trials are spread over copies of it.
    lanes = max(1, min(len(trials), spark.sparkContext.defaultParallelism // tasks))

    def scored(lane: int) -> RDD:
        own = range(lane, len(trials), lanes)
        return rows.map(lambda b: replace(b, scores={k: np.full(len(b.target), prior) for k in own}))

    state = spark.sparkContext.union([scored(lane) for lane in range(lanes)]).persist(StorageLevel.MEMORY_AND_DISK)
    return prior, State(state, tasks == 1)
