"""The trees of Spark ML's ``GBTClassifier`` for many seeds at once, on rows kept as bin numbers.

Spark ML starts several jobs for each level of each tree of each fit, and cannot go on with a fit. Here thresholds come from Spark
ML, and rows and features are drawn by its generators, so a seed gets the trees that ``GBTClassifier`` fits on the same
partitions, up to the order in which sums are added. Matrices of up to ``TASK_BYTES`` are sent to one task per seed, which
grows all of its trees. Larger ones stay spread over the executors, and one job counts a level of all seeds.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

# A seed's rows with their bins, margins and sums in one task; beyond, the rows stay where they are.
TASK_BYTES, BYTES_PER_ROW = 384 << 20, 24
# Rows of one record, and rounds after which margins are written to the checkpoint folder.
BLOCK_ROWS, ROUNDS_KEPT = 65_536, 40
# Scores of one round are counted in so many bins for its area under the curve.
BINS = 8192
# Variances up to this part of the mean square are rounding. Spark ML's own bound is the absolute one.
ROUNDING, EPSILON = 1e-12, 2.0**-52
# Features are counted together while the combinations of their bins are no more than this.
TOGETHER = 1024
# Rows and conversions of a bin are counted in one sum, the conversions in the upper bits.
ONE = float(1 << 26)
U64 = (1 << 64) - 1


# Draws: Spark's XORShiftRandom, started anywhere in its sequence, and java.util.Random.


def _murmur(data: bytes, h: int) -> int:
    def turned(x: int, by: int) -> int:
        return (x << by | x >> 32 - by) & 0xFFFFFFFF

    for i in range(0, len(data), 4):
        k = turned(int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
        h = (turned(h ^ k, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def hashed_seed(seed: int) -> int:
    """State of ``XORShiftRandom`` after a seed was set."""
    data = (seed & U64).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _step(states: np.ndarray, spare: np.ndarray) -> None:
    for shift, by in ((np.left_shift, 21), (np.right_shift, 35), (np.left_shift, 4)):
        shift(states, np.uint64(by), out=spare)
        np.bitwise_xor(states, spare, out=states)


@cache
def _jump(power: int) -> np.ndarray:
    """``2 ** power`` steps as a table by byte and value: steps are linear in the bits."""
    images = np.uint64(1) << np.arange(64, dtype=np.uint64)
    if power == 0:
        _step(images, images.copy())
    else:
        images = _jumped(power - 1, _jumped(power - 1, images))
    table = np.zeros((8, 256), np.uint64)
    for byte in range(8):
        for bit in range(8):
            table[byte, 1 << bit : 2 << bit] = table[byte, : 1 << bit] ^ images[8 * byte + bit]
    return table


def _jumped(power: int, states: np.ndarray) -> np.ndarray:
    values = states.astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.bitwise_xor.reduce(_jump(power)[np.arange(8), values], axis=1)


def drawn(seed: int, offset: int, count: int, share: float) -> np.ndarray:
    """Which of ``count`` rows from ``offset`` on ``XORShiftRandom(seed).nextDouble() < share`` takes."""
    if share >= 1:
        return np.ones(count, bool)
    states = np.array([hashed_seed(seed)], np.uint64)
    for power in range((2 * offset).bit_length()):
        if 2 * offset >> power & 1:
            states = _jumped(power, states)
    run = 6  # every lane draws for 2 ** run rows, two steps each
    lanes = -(-count >> run)
    while len(states) < lanes:
        states = np.concatenate([states, _jumped(run + len(states).bit_length(), states)])
    states, bound = states[:lanes].copy(), np.uint64(math.ceil(share * 2**53))
    spare, taken = np.empty_like(states), np.empty((1 << run, lanes), bool)
    for row in taken:
        _step(states, spare)
        high = (states & np.uint64((1 << 26) - 1)) << np.uint64(27)
        _step(states, spare)
        np.less(high + (states & np.uint64((1 << 27) - 1)), bound, out=row)
    return taken.T.ravel()[:count]


class JavaRandom:
    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def _next(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & (1 << 48) - 1
        value = self.state >> 16
        return value - (1 << 32) if value >> 31 else value

    def next_long(self) -> int:
        return ((self._next() << 32) + self._next()) & U64


def chosen(features: int, count: int, seed: int) -> list[int]:
    """``SamplingUtils.reservoirSampleAndCount`` of the feature numbers."""
    kept, state = list(range(count)), hashed_seed(seed)
    for place in range(count, features):
        parts = []
        for bits in (26, 27):
            state ^= state << 21 & U64
            state ^= state >> 35
            state ^= state << 4 & U64
            parts.append(state & (1 << bits) - 1)
        at = int(((parts[0] << 27) + parts[1]) * 2.0**-53 * (place + 1))
        if at < count:
            kept[at] = place
    return kept


# Growing: a tree by the sums of its nodes.


@dataclass(frozen=True)
class Growth:
    """What every tree of a fit is grown with."""

    features: int
    per_node: int
    depth: int
    min_rows: int
    positive_weight: float
    learning_rate: float
    row_share: float
    metrics: tuple[str, ...]

    def weight(self, round_: int) -> float:
        return self.learning_rate if round_ else 1.0


@dataclass
class Tree:
    """Nodes by heap number from 1 on: feature of the split (-1 without one), last bin that goes left, value."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = 2 << depth
        return cls(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size))


@dataclass
class Sums:
    """Rows, conversions and weighted targets by node, feature and bin; weighted squares of the targets by node."""

    cells: np.ndarray
    squares: np.ndarray

    def rest(self, part: Sums) -> Sums:
        cells = self.cells - part.cells
        cells[2][cells[0] == 0] = 0.0
        return Sums(cells, self.squares - part.squares)


@dataclass(frozen=True)
class Layout:
    """How the bins of a seed are counted: features of few bins together, by each combination of their bins."""

    cuts: tuple[int, ...]
    groups: tuple[tuple[int, ...], ...]

    @classmethod
    def of(cls, cuts: Sequence[int]) -> Layout:
        groups: list[list[int]] = []
        for f in sorted(range(len(cuts)), key=lambda f: -cuts[f]):
            fits = (g for g in groups if math.prod(cuts[x] + 1 for x in [*g, f]) <= TOGETHER)
            if (group := next(fits, None)) is None:
                groups.append(group := [])
            group.append(f)
        return cls(tuple(cuts), tuple(map(tuple, groups)))

    def sums(self, counted: np.ndarray, nodes: int) -> Sums:
        """What ``Rows.count`` of some nodes gave, by feature."""
        cells, at = np.zeros((3, nodes, len(self.cuts), max(self.cuts) + 1)), 0
        for group in self.groups:
            shape = (3, nodes, *(self.cuts[f] + 1 for f in group))
            joint = counted[at : at + math.prod(shape)].reshape(shape)
            at += joint.size
            for place, f in enumerate(group):
                cells[:, :, f, : self.cuts[f] + 1] = joint.sum(axis=tuple(2 + x for x in range(len(group)) if x != place))
        return Sums(cells, counted[at:])


Wish = tuple[Tree, int, list[int]]


def grown(growth: Growth, layout: Layout, seed: int) -> Generator[Wish, np.ndarray, Tree]:
    """Grows one tree: yields it so far, a level and the nodes of that level whose counts it is then sent."""
    tree, draws, splits = Tree.empty(growth.depth), JavaRandom(seed), np.array(layout.cuts)
    extra = growth.positive_weight - 1
    sums = layout.sums((yield tree, 0, [1]), 1)
    known = {1: Sums(sums.cells[:, 0], sums.squares[0])}
    group = [1]
    rows, ones, total = known[1].cells[:, 0].sum(axis=-1)
    tree.value[1] = total / (rows + extra * ones) if rows else 0.0
    for level in range(growth.depth):
        cells = np.stack([known[node].cells for node in group], axis=1)
        left = np.cumsum(cells, axis=-1)
        whole = left[..., -1:]
        n, o, s = left[..., :-1]
        weight, all_weight = n + extra * o, whole[0] + extra * whole[1]
        other, s_other = all_weight - weight, whole[2] - s
        fits = (n >= growth.min_rows) & (whole[0] - n >= growth.min_rows) & (np.arange(n.shape[-1]) < splits[:, None])
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(fits, (s * s / weight + s_other * s_other / other - whole[2] ** 2 / all_weight) / all_weight, -np.inf)
        at = gain.argmax(axis=-1)
        best = np.take_along_axis(gain, at[..., None], -1)[..., 0]
        below, smaller = [], []
        for place, node in enumerate(group):
            order = chosen(growth.features, growth.per_node, draws.next_long()) if growth.per_node < growth.features else range(growth.features)
            # The first of equal gains, in the order of the draw.
            feature = max(order, key=lambda f: best[place, f])
            here = all_weight[place, feature, 0]
            if not best[place, feature] > ROUNDING * known[node].squares / here:
                continue
            cut = at[place, feature]
            tree.feature[node], tree.cut[node] = feature, cut
            tree.value[2 * node] = s[place, feature, cut] / weight[place, feature, cut]
            tree.value[2 * node + 1] = s_other[place, feature, cut] / other[place, feature, cut]
            told = s[place, feature, cut] * tree.value[2 * node] + s_other[place, feature, cut] * tree.value[2 * node + 1]
            if known[node].squares - told <= ROUNDING * known[node].squares:
                # Nothing varies below any more.
                continue
            below += [2 * node, 2 * node + 1]
            smaller.append(2 * node + int(2 * n[place, feature, cut] > whole[0, place, feature, 0]))
        if not smaller or level + 1 == growth.depth:
            break
        sums = layout.sums((yield tree, level + 1, smaller), len(smaller))
        found = {node: Sums(sums.cells[:, i], sums.squares[i]) for i, node in enumerate(smaller)}
        found |= {node ^ 1: known[node // 2].rest(found[node]) for node in smaller}
        known, group = found, []
        # The child that was added last is split first. A child whose targets are all equal stays a leaf.
        for node in reversed(below):
            rows, ones, total = known[node].cells[:, 0].sum(axis=-1)
            weight = rows + extra * ones
            if known[node].squares / weight - (total / weight) ** 2 > max(EPSILON, ROUNDING * known[node].squares / weight):
                group.append(node)
        if not group:
            break
    return tree


# Rows: a run of them, of one seed.


def down(node: np.ndarray, bins: np.ndarray, tree: Tree, level: int) -> None:
    """Rows in split nodes of a level go to their children."""
    for at in range(1 << level, 2 << level):
        if tree.feature[at] >= 0:
            right = bins[tree.feature[at]] > int(tree.cut[at])
            node += (node == at) * (right + node.dtype.type(at))


def leaves(bins: np.ndarray, tree: Tree) -> np.ndarray:
    """Value of the leaf of each row."""
    node = np.ones(bins.shape[1], np.min_scalar_type(len(tree.value)))
    for level in range(len(tree.value).bit_length() - 2):
        down(node, bins, tree, level)
    return tree.value[node]


@dataclass
class Rows:
    """Rows of a partition from ``offset`` on: bins by feature, labels, sums of the trees so far."""

    part: int
    offset: int
    held_out: bool
    bins: np.ndarray
    label: np.ndarray
    margin: np.ndarray
    taken: np.ndarray = field(init=False)
    node: np.ndarray = field(init=False)

    def begin(self, growth: Growth, seed: int, round_: int) -> None:
        """Draw the rows of a round, at the root of its tree."""
        self.taken = drawn(seed + round_ + self.part + 1, self.offset, len(self.label), growth.row_share)
        self.node = np.ones(len(self.label), np.min_scalar_type(2 << growth.depth))

    def count(self, growth: Growth, layout: Layout, round_: int, nodes: Sequence[int]) -> np.ndarray:
        """Rows, conversions and weighted targets of the drawn rows by node and cell, group by group, and last the weighted
        squares by node. The target is the label in the first round, then the slope of the loss."""
        place = np.full(2 << growth.depth, len(nodes), np.uint16)
        place[nodes] = np.arange(len(nodes))
        slot = place[self.node]
        at = np.flatnonzero(self.taken & (slot < len(nodes)))
        label, slot = self.label[at], slot[at].astype(np.intp)
        sign = 2.0 * label - 1
        target = 4 * sign / (1 + np.exp(2 * sign * self.margin[at])) if round_ else sign
        weighted = np.where(label, growth.positive_weight, 1.0) * target
        counted, found = 1.0 + label * ONE, []
        for group in layout.groups:
            cell, size = slot.copy(), len(nodes)
            for f in group:
                cell *= layout.cuts[f] + 1
                cell += self.bins[f][at]
                size *= layout.cuts[f] + 1
            both = np.bincount(cell, counted, size)
            ones = np.floor(both / ONE)
            found += [both - ones * ONE, ones, np.bincount(cell, weighted, size)]
        return np.concatenate([*found, np.bincount(slot, weighted * target, len(nodes))])

    def learn(self, growth: Growth, tree: Tree, round_: int) -> None:
        self.margin = self.margin + growth.weight(round_) * leaves(self.bins, tree)

    def measure(self, growth: Growth) -> np.ndarray:
        """Conversions and other rows by step of the score, and last the log-loss and the rows it is of."""
        step = np.floor((self.margin / (1 + np.abs(self.margin)) + 1) / 2 * (BINS - 1)).astype(np.intp)
        every, ones = np.bincount(step, minlength=BINS), np.bincount(step, self.label, BINS)
        loss = np.logaddexp(0, np.where(self.label, -2, 2) * self.margin).sum() if "logloss" in growth.metrics else 0.0
        return np.concatenate([ones, every - ones, [loss, len(self.label)]])


def measures(found: np.ndarray) -> dict[str, float | None]:
    """Area under the curve, scores in one step as ties, and log-loss."""
    ones, zeros, (loss, rows) = found[:BINS], found[BINS:-2], found[-2:]
    pairs = ones.sum() * zeros.sum()
    won = (ones * (np.cumsum(zeros) - zeros + zeros / 2)).sum()
    return {"auc": float(won / pairs) if pairs else None, "logloss": float(loss / rows) if rows else None}


# Fits: all rounds of one seed in a task, or of all seeds in lockstep.

# The measures so far, and the number of rounds to keep with whether the fit is over.
Stop = Callable[[list[dict[str, float | None]]], tuple[int, bool]]


def fit_in_task(rows: list[Rows], growth: Growth, layout: Layout, seed: int, rounds: int, stop: Stop | None) -> list[Tree]:
    """All trees of one seed, those up to the best round where ``stop`` is given."""
    seen: list[dict[str, float | None]] = []
    learned, held_out = ([r for r in rows if r.held_out == h] for h in (False, True))
    trees: list[Tree] = []
    for round_ in range(rounds):
        for part in learned:
            part.begin(growth, seed, round_)
        grower, counted = grown(growth, layout, seed + round_), None
        while True:
            try:
                tree, level, nodes = grower.send(counted)
            except StopIteration as end:
                trees.append(end.value)
                break
            counted = 0.0
            for part in learned:
                if level:
                    down(part.node, part.bins, tree, level - 1)
                counted = counted + part.count(growth, layout, round_, nodes)
        for part in rows:
            part.learn(growth, trees[-1], round_)
        if stop is not None:
            told = sum((part.measure(growth) for part in held_out), np.zeros(2 * BINS + 2))
            seen.append(measures(told))
            best, over = stop(seen)
            if over:
                return trees[:best]
    return trees if stop is None else trees[: stop(seen)[0]]


@dataclass
class Bins:
    """Thresholds by seed and feature. A code counts the thresholds of any seed below a value; it tells the bin of each seed."""

    thresholds: list[list[np.ndarray]]
    steps: list[np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        self.steps = [np.unique(np.concatenate(of_feature)) for of_feature in zip(*self.thresholds)]

    def layout(self, place: int) -> Layout:
        return Layout.of([len(t) for t in self.thresholds[place]])

    def table(self, place: int) -> np.ndarray | None:
        """Bin by feature and code, of the seed at a place; None where codes are bins."""
        if all(len(own) == len(every) for own, every in zip(self.thresholds[place], self.steps)):
            return None
        made = np.zeros((len(self.steps), max(map(len, self.steps), default=0) + 1), np.min_scalar_type(max(map(len, self.thresholds[place]))))
        for f, (own, every) in enumerate(zip(self.thresholds[place], self.steps)):
            made[f, 1 : len(every) + 1] = np.searchsorted(own, every, "right")
        return made

    def codes(self, column: pa.Array) -> np.ndarray:
        """Codes by feature of lists of values."""
        values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(self.steps))
        made = np.empty(values.shape[::-1], np.min_scalar_type(max(map(len, self.steps), default=0)))
        for f, every in enumerate(self.steps):
            made[f] = np.searchsorted(every, values[:, f], "left")
        return made


def binned(codes: np.ndarray, table: np.ndarray | None) -> np.ndarray:
    return codes if table is None else np.stack([of_feature[code] for of_feature, code in zip(table, codes)])


def thresholds(rows: DataFrame, estimator: GBTClassifier, seeds: Sequence[int]) -> tuple[Bins, int]:
    """Thresholds as Spark ML finds them, and the number of features it draws for a node. Bad labels and values are refused."""
    jvm = rows.sparkSession.sparkContext._jvm
    estimator._transfer_params_to_java()
    java, ml, old = estimator._java_obj, jvm.org.apache.spark.ml, jvm.org.apache.spark.mllib.tree.configuration
    data = getattr(getattr(ml.util, "DatasetUtils$"), "MODULE$").extractInstances(java, rows._jdf, jvm.scala.Option.apply(2))
    no_categories = getattr(getattr(jvm.scala.collection.immutable, "Map$"), "MODULE$").empty()
    strategy = java.getOldBoostingStrategy(no_categories, old.Algo.Classification()).treeStrategy()
    getattr(strategy, "algo_$eq")(old.Algo.Regression())
    found = ml.tree.impl.DecisionTreeMetadata.buildMetadata(data, strategy, 1, java.getFeatureSubsetStrategy())
    asked = [found.numSplits(f) for f in range(found.numFeatures())]
    # Small tables are not sampled for their thresholds, so those are the same for every seed.
    alike = found.numExamples() <= max(found.maxBins() ** 2, 10_000)
    made: list[list[np.ndarray]] = []
    for seed in seeds:
        if made and alike:
            made.append(made[0])
            continue
        for f, number in enumerate(asked):
            found.setNumSplits(f, number)
        splits = getattr(getattr(ml.tree.impl, "RandomForest$"), "MODULE$").findSplits(data, found, seed)
        made.append([np.array([split.threshold() for split in of_feature], float) for of_feature in splits])
    return Bins(made), found.numFeaturesPerNode()


# Part, offset, held out, codes by feature, labels.
Record = tuple[int, int, bool, np.ndarray, np.ndarray]


def records(rows: DataFrame, bins: Bins, features: str, label: str, held_out: bool) -> RDD:
    """The rows of a partition in records of about ``BLOCK_ROWS``, each with its place in the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, offset, kept = TaskContext.get().partitionId(), 0, []

        def record() -> pa.RecordBatch:
            codes, labels = (np.concatenate(x, axis=-1).tobytes() for x in zip(*kept))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "offset": [offset], "codes": [codes], "labels": [labels]})

        for batch in batches:
            kept.append((bins.codes(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False) == 1))
            if (count := sum(len(x) for _, x in kept)) >= BLOCK_ROWS:
                yield record()
                offset, kept = offset + count, []
        if sum(len(x) for _, x in kept):
            yield record()

    told = rows.select(vector_to_array(features), label).mapInArrow(run, "part int, offset long, codes binary, labels binary")
    width = len(bins.steps)
    kind = np.min_scalar_type(max(map(len, bins.steps), default=0))

    def read(row) -> Record:
        labels = np.frombuffer(row.labels, bool)
        return row.part, row.offset, held_out, np.frombuffer(row.codes, kind).reshape(width, len(labels)), labels

    return told.rdd.map(read)


@dataclass
class Fit:
    """Trees by seed, with the bins that they split."""

    bins: Bins
    growth: Growth
    trees: list[list[Tree]]

    def scores(self, df: DataFrame, features: str, key: str) -> DataFrame:
        """``key`` and the probabilities of all seeds (``score_0``, ``score_1``, ...) of each row."""
        bins, growth, trees = self.bins, self.growth, self.trees

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = [bins.table(place) for place in range(len(trees))]
            for batch in batches:
                codes, made = bins.codes(batch.column(1)), [batch.column(0)]
                for table, own in zip(tables, trees):
                    rows, margin = binned(codes, table), np.zeros(batch.num_rows)
                    for round_, tree in enumerate(own):
                        margin += growth.weight(round_) * leaves(rows, tree)
                    made.append(pa.array(1 - 1 / (1 + np.exp(2 * margin))))
                yield pa.RecordBatch.from_arrays(made, [key, *names])

        names = [f"score_{place}" for place in range(len(trees))]
        schema = StructType([df.schema[key], *(StructField(name, DoubleType()) for name in names)])
        return df.select(key, vector_to_array(features)).mapInArrow(run, schema)


def fit(
    train: DataFrame,
    held_out: DataFrame | None,
    estimator: GBTClassifier,
    positive_weight: float,
    seeds: Sequence[int],
    rounds: Sequence[int],
    metrics: Sequence[str] = (),
    stop: Stop | None = None,
) -> Fit:
    """One fit per seed on written matrices, of at most so many rounds each; with ``held_out`` until ``stop`` ends it."""
    bins, per_node = thresholds(train, estimator, seeds)
    growth = Growth(
        len(bins.steps), per_node, estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), positive_weight, estimator.getStepSize(),
        estimator.getSubsamplingRate(), tuple(metrics),
    )
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    made = records(train, bins, features, label, False)
    count = train.count()
    if held_out is not None:
        made, count = made.union(records(held_out, bins, features, label, True)), count + held_out.count()
    tables = [bins.table(place) for place in range(len(seeds))]
    bytes_per_bin = np.min_scalar_type(max(len(cuts) for of_seed in bins.thresholds for cuts in of_seed)).itemsize
    if count * (growth.features * bytes_per_bin + BYTES_PER_ROW) <= TASK_BYTES:
        trees = fit_by_seed(made, growth, bins, tables, seeds, rounds, stop)
    else:
        trees = fit_in_lockstep(made, growth, bins, tables, seeds, rounds, stop)
    return Fit(bins, growth, trees)


def fit_by_seed(made: RDD, growth: Growth, bins: Bins, tables, seeds, rounds, stop: Stop | None) -> list[list[Tree]]:
    """One task per seed, which holds the bins of all rows."""
    layouts = [bins.layout(place) for place in range(len(seeds))]
    told = made.context.broadcast(tables)

    def deal(record: Record) -> Iterator[tuple[int, Record]]:
        part, offset, held_out, codes, label = record
        return ((place, (part, offset, held_out, binned(codes, table), label)) for place, table in enumerate(told.value))

    def run(place: int, dealt: Iterator[tuple[int, Record]]) -> Iterator[tuple[int, list[Tree]]]:
        rows = [Rows(*record, np.zeros(len(record[-1]))) for _, record in dealt]
        rows.sort(key=lambda r: (r.held_out, r.part, r.offset))
        yield place, fit_in_task(rows, growth, layouts[place], seeds[place], rounds[place], stop)

    found = dict(made.flatMap(deal).partitionBy(len(seeds), int).mapPartitionsWithIndex(run).collect())
    told.unpersist()
    return [found[place] for place in range(len(seeds))]


def fit_in_lockstep(made: RDD, growth: Growth, bins: Bins, tables, seeds, rounds, stop: Stop | None) -> list[list[Tree]]:
    """The rows stay in the executors with the margins of all seeds. A job counts one level of the trees of all seeds; the
    first one of a round also adds up the last round's trees and measures them on the held-out rows."""
    context = made.context
    tasks = max(2 * context.defaultParallelism, made.getNumPartitions())
    told, every = context.broadcast(tables), len(seeds)

    def placed(record: Record) -> tuple[int, Record]:
        return record[0] + record[1] // BLOCK_ROWS, record

    def started(entry: tuple[int, Record]) -> tuple[Record, np.ndarray]:
        return entry[1], np.zeros((every, len(entry[1][-1])))

    def asked(state: RDD, round_: int, wishes: dict[int, Wish], measured: list[int]) -> dict:
        def run(entries: Iterator[tuple[Record, np.ndarray]]) -> Iterator[tuple[tuple[bool, int], np.ndarray]]:
            sums: dict[tuple[bool, int], np.ndarray] = {}

            def add(key: tuple[bool, int], found: np.ndarray) -> None:
                sums[key] = sums[key] + found if key in sums else found

            for (part, offset, held_out, codes, label), margins in entries:
                if held_out:
                    for place in measured:
                        add((True, place), Rows(part, offset, True, codes, label, margins[place]).measure(growth))
                    continue
                for place, (tree, level, nodes) in wishes.items():
                    rows = Rows(part, offset, False, binned(codes, told.value[place]), label, margins[place])
                    rows.begin(growth, seeds[place], round_)
                    for above in range(level):
                        down(rows.node, rows.bins, tree, above)
                    add((False, place), rows.count(growth, layouts[place], round_, nodes))
            return iter(sums.items())

        reducers = min(context.defaultParallelism, len(wishes) + len(measured))
        return dict(state.mapPartitions(run).reduceByKey(lambda a, b: a + b, reducers).collect())

    def learned(state: RDD, round_: int, trees: dict[int, Tree]) -> RDD:
        def run(entry: tuple[Record, np.ndarray]) -> tuple[Record, np.ndarray]:
            record, margins = entry
            margins = margins.copy()
            for place, tree in trees.items():
                margins[place] += growth.weight(round_) * leaves(binned(record[3], told.value[place]), tree)
            return record, margins

        return state.map(run)

    layouts = [bins.layout(place) for place in range(every)]
    grown_trees: list[list[Tree]] = [[] for _ in seeds]
    seen: list[list] = [[] for _ in seeds]
    open_ = [place for place in range(every) if rounds[place] > 0]
    state = made.map(placed).partitionBy(tasks, int).map(started).persist(StorageLevel.MEMORY_AND_DISK)
    before, kept, round_ = None, None, 0
    while open_:
        growers = {place: grown(growth, layouts[place], seeds[place] + round_) for place in open_ if round_ < rounds[place]}
        wishes = {place: next(grower) for place, grower in growers.items()}
        measured = open_ if stop is not None and round_ else []
        found = asked(state, round_, wishes, measured)
        if before is not None:
            before.unpersist()
        if state.isCheckpointed():
            if kept:
                _drop(context, kept)
            kept = state.getCheckpointFile()
        for place in list(open_):
            over = round_ >= rounds[place]
            if measured:
                seen[place].append(measures(found.get((True, place), np.zeros(2 * BINS + 2))))
                best, waited = stop(seen[place])
                if over := over or waited:
                    grown_trees[place] = grown_trees[place][:best]
            if over:
                open_.remove(place)
        growers = {place: grower for place, grower in growers.items() if place in open_}
        trees: dict[int, Tree] = {}
        while growers:
            wishes = {}
            for place, grower in list(growers.items()):
                try:
                    wishes[place] = grower.send(found[False, place])
                except StopIteration as end:
                    trees[place] = end.value
                    grown_trees[place].append(end.value)
                    del growers[place]
            if wishes:
                found = asked(state, round_, wishes, [])
        if open_:
            before, state = state, learned(state, round_, trees).persist(StorageLevel.MEMORY_AND_DISK)
            round_ += 1
            if round_ % ROUNDS_KEPT == 0:
                state.checkpoint()
    state.unpersist()
    told.unpersist()
    if kept:
        _drop(context, kept)
    return grown_trees


def _drop(context, path: str) -> None:
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(context._jsc.hadoopConfiguration()).delete(found, True)
