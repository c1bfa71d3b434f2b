"""Second-order boosted regression trees with leaf and split penalties, grown on histograms.

Features are cut at their quantiles into at most 255 bins once. A tree grows level by level: each task sums gradients and rows
per (node, feature, bin) over its part of the rows, Spark adds these sums up, and the driver, which sees nodes x
features x bins and never a row, picks the best split of every node. The margins of all rows are written again after every
``REFRESH`` trees; in between, tasks add the few new trees to what they read, so a lost executor costs one short stage.

With squared loss the gradient of a row is its prediction less its label and the second derivative 1. For sums G over n rows
a node scores ``t(G)^2 / (n + l2)``, where t moves G towards 0 by ``l1``; a split must gain at least ``split_penalty`` over
its node and leave ``min_weight`` rows on both sides, and a leaf says ``-rate * t(G) / (n + l2)``. Splits that gain the same
(to nine digits) go to the first feature and the lowest cut, so the order of sums has no say.

Missing values (null, NaN) go to the side of a split where they gain more, to the left if there were none. Rows without a
label are not used. Rows are drawn for a tree by a hash of their key, features by the seed, so fits repeat; rows that agree in all
key columns are drawn together. Without rows the model says 0.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.session import stage

BINS, MISSING = 64, 255
REFRESH = 10
SAME_GAIN = 1e-9


@dataclass(frozen=True)
class Settings:
    trees: int = 100
    depth: int = 6
    rate: float = 0.3
    row_share: float = 1.0
    feature_share: float = 1.0
    min_weight: float = 1.0
    split_penalty: float = 0.0
    l1: float = 0.0
    l2: float = 1.0
    bins: int = BINS
    seed: int = 42


# Hyperparameters of the plain model and of the first of the three base models.
PLAIN = Settings(trees=100, depth=5, rate=0.1, row_share=0.8, feature_share=0.8)
PENALISED = Settings(
    trees=200, depth=6, rate=0.05, row_share=0.8, feature_share=0.8, min_weight=3, split_penalty=0.1, l1=0.1, l2=1.0
)


@dataclass
class Tree:
    """Node k has the children 2k + 1 and 2k + 2. A leaf has feature -1; bins up to ``cut`` go left."""

    feature: list[int]
    cut: list[int]
    missing_left: list[bool]
    value: list[float]

    @classmethod
    def of_depth(cls, depth: int) -> Tree:
        size = (1 << (depth + 1)) - 1
        return cls([-1] * size, [0] * size, [True] * size, [0.0] * size)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row of a matrix of bins."""
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.missing_left)
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while (inner := feature[at] >= 0).any():
            here, row = at[inner], rows[inner]
            bin = bins[row, feature[here]]
            right = np.where(bin == MISSING, ~left[here], bin > cut[here])
            at[inner] = 2 * here + 1 + right
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes(bins)]


@dataclass
class Model:
    features: list[str]
    cuts: list[list[float]]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def bins(self, values: np.ndarray) -> np.ndarray:
        """A matrix of values (NaN for missing) as bins."""
        out = np.empty(values.shape, np.uint8)
        for k, cuts in enumerate(self.cuts):
            column = values[:, k]
            out[:, k] = np.where(np.isnan(column), MISSING, np.searchsorted(cuts, column))
        return out

    def predict(self, values: np.ndarray) -> np.ndarray:
        bins = self.bins(values)
        return sum((tree.predict(bins) for tree in self.trees), np.full(len(bins), self.base))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Model:
        held = json.loads(text)
        return cls(**{**held, "trees": [Tree(**tree) for tree in held["trees"]]})


def drawn(keys: np.ndarray, tree: int, share: float) -> np.ndarray:
    """Which rows a tree sees: a mix of 64 bits of the row's key and the tree's number, below a limit."""
    if share >= 1:
        return np.ones(len(keys), bool)
    mixed = keys.view(np.uint64) + np.uint64(((tree + 1) * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return (mixed ^ (mixed >> np.uint64(31))) < np.uint64(int(share * (1 << 64)))


def _soft(sums: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(sums) * np.maximum(np.abs(sums) - l1, 0)


def _score(sums: np.ndarray, weight: np.ndarray, settings: Settings) -> np.ndarray:
    below = weight + settings.l2
    return np.divide(_soft(sums, settings.l1) ** 2, below, out=np.zeros_like(sums), where=below > 0)


def leaf_value(sums: float, weight: float, settings: Settings) -> float:
    below = weight + settings.l2
    return float(-settings.rate * _soft(np.float64(sums), settings.l1) / below) if below > 0 else 0.0


def best_split(histogram: np.ndarray, settings: Settings) -> tuple[int, int, bool] | None:
    """(place of the feature, cut, missing values left) from sums of gradients and rows, shaped (features, bins, 2).

    The last bin holds the missing values.
    """
    known, missing = histogram[:, :-1], histogram[:, -1]
    total = histogram[0].sum(axis=0)
    before = np.cumsum(known, axis=1)[:, :-1]
    found: tuple[float, tuple[int, int, bool]] | None = None
    for to_left in (True, False):
        left = before + missing[:, None] if to_left else before
        right = total - left
        gain = _score(left[..., 0], left[..., 1], settings) + _score(right[..., 0], right[..., 1], settings)
        gain -= _score(total[None, :1], total[None, 1:], settings)
        able = (np.minimum(left[..., 1], right[..., 1]) >= max(settings.min_weight, 1)) & (gain > 0)
        gain = np.where(able & (gain >= settings.split_penalty), gain, -np.inf)
        best = gain.max(initial=-np.inf)
        if best > -np.inf and (found is None or best > found[0] * (1 + SAME_GAIN)):
            place, cut = np.argwhere(gain >= best * (1 - SAME_GAIN))[0].tolist()
            found = float(best), (place, cut, to_left)
    return found and found[1]


def features_of_tree(count: int, tree: int, settings: Settings) -> np.ndarray:
    """The places of the features that a tree may use, in order."""
    kept = max(1, int(count * settings.feature_share))
    random = np.random.default_rng((settings.seed, tree))
    return np.sort(random.choice(count, kept, replace=False))


def _matrix(data: pa.Array, features: int) -> np.ndarray:
    return np.frombuffer(b"".join(data.to_pylist()), np.uint8).reshape(-1, features)


def quantile_cuts(rows: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """At most ``bins`` - 1 cuts of every feature at its quantiles, which are values of the feature."""
    if not 2 <= bins <= MISSING:
        raise ValueError(f"bins must lie between 2 and {MISSING}")
    steps = [k / bins for k in range(1, bins)]
    sketches = [F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), steps, 10_000) for c in features]
    found = rows.agg(*(s.alias(f"cut_{k}") for k, s in enumerate(sketches))).first()
    return [sorted(set(cuts or [])) for cuts in found]


def binned(rows: DataFrame, model: Model, label: str, keys: Sequence[str]) -> DataFrame:
    """(key, label, margin, bins) of the rows with a label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = model.bins(_values(batch, 2))
            data, width = bins.tobytes(), bins.shape[1]
            cells = [data[at : at + width] for at in range(0, len(data), width)]
            margin = pa.array(np.full(len(bins), model.base))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], margin, pa.array(cells, pa.binary())], names)

    names = ["key", "label", "margin", "bins"]
    read = rows.select(
        F.xxhash64(*keys).alias("key"), F.col(label).cast("double").alias("label"), *_doubles(model.features)
    )
    known = read.where(F.col("label").isNotNull() & ~F.isnan("label"))
    return known.mapInArrow(run, "key long, label double, margin double, bins binary")


def _doubles(features: Sequence[str]) -> list:
    return [F.col(c).cast("double").alias(f"f_{k}") for k, c in enumerate(features)]


def _values(batch: pa.RecordBatch, first: int) -> np.ndarray:
    columns = [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns[first:]]
    return np.column_stack(columns) if columns else np.empty((batch.num_rows, 0))


def level_histogram(
    rows: DataFrame, recent: list[Tree], tree: Tree, number: int, level: int, used: np.ndarray, settings: Settings, features: int
) -> np.ndarray:
    """Sums of gradients and rows of the nodes of a level, shaped (nodes, used features, bins and missing, 2)."""
    first, width = (1 << level) - 1, settings.bins + 1
    nodes = 1 << level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(used), nodes * width))
        for batch in batches:
            keys, label, margin = (batch.column(k).to_numpy() for k in range(3))
            taken = drawn(keys, number, settings.row_share)
            bins = _matrix(batch.column(3), features)[taken]
            gradient = margin[taken] - label[taken]
            for grown in recent:
                gradient = gradient + grown.predict(bins)
            node = tree.nodes(bins) - first
            here = node >= 0
            node, gradient, bins = node[here] * width, gradient[here], np.minimum(bins[here], width - 1)
            for k, feature in enumerate(used):
                cell = node + bins[:, feature]
                sums[0, k] += np.bincount(cell, gradient, nodes * width)
                sums[1, k] += np.bincount(cell, minlength=nodes * width)
        cells = np.flatnonzero(sums[1].ravel())
        columns = [pa.array(cells), pa.array(sums[0].ravel()[cells]), pa.array(sums[1].ravel()[cells])]
        yield pa.RecordBatch.from_arrays(columns, ["cell", "gradient", "weight"])

    parts = rows.mapInArrow(run, "cell long, gradient double, weight double")
    total = parts.groupBy("cell").agg(F.sum("gradient").alias("gradient"), F.sum("weight").alias("weight")).toArrow()
    flat = np.zeros((len(used) * nodes * width, 2))
    flat[total["cell"].to_numpy()] = np.column_stack([total["gradient"].to_numpy(), total["weight"].to_numpy()])
    return flat.reshape(len(used), nodes, width, 2).transpose(1, 0, 2, 3)


def grow(histogram_of, number: int, features: int, settings: Settings) -> Tree:
    """One tree; ``histogram_of(tree, level, used)`` gives the sums of a level. Nodes that do not split become leaves."""
    used, tree = features_of_tree(features, number, settings), Tree.of_depth(settings.depth)
    open_nodes = [0]
    for level in range(settings.depth + 1):
        if not open_nodes:
            break
        if level == settings.depth:  # sums of the last level follow from one feature
            used = used[:1]
        sums, first, following = histogram_of(tree, level, used), (1 << level) - 1, []
        for node in open_nodes:
            histogram = sums[node - first]
            split = best_split(histogram, settings) if level < settings.depth else None
            if split:
                place, tree.cut[node], tree.missing_left[node] = split
                tree.feature[node] = int(used[place])
                following += [2 * node + 1, 2 * node + 2]
            else:
                tree.value[node] = leaf_value(*histogram[0].sum(axis=0), settings)
        open_nodes = following
    return tree


def with_margins(rows: DataFrame, trees: list[Tree], features: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin, bins = batch.column(2).to_numpy(), _matrix(batch.column(3), features)
            for tree in trees:
                margin = margin + tree.predict(bins)
            yield batch.set_column(2, "margin", pa.array(margin))

    return rows.mapInArrow(run, rows.schema)


def fit(
    rows: DataFrame, features: Sequence[str], label: str, settings: Settings = PLAIN, keys: Sequence[str] = ("symbol", "datetime")
) -> Model:
    """Train on all rows with a label; ``keys`` identify a row for the draws."""
    mean = rows.where(~F.isnan(F.col(label).cast("double"))).agg(F.avg(F.col(label).cast("double"))).first()[0]
    model = Model(list(features), quantile_cuts(rows, features, settings.bins), float(mean or 0.0))
    if mean is None or not features:
        return model
    held, recent = stage(binned(rows, model, label, keys), "binned").persist(), []
    for number in range(settings.trees):

        def histogram_of(tree: Tree, level: int, used: np.ndarray) -> np.ndarray:
            return level_histogram(held, recent, tree, number, level, used, settings, len(features))

        tree = grow(histogram_of, number, len(features), settings)
        model.trees.append(tree)
        recent.append(tree)
        if len(recent) == REFRESH and number + 1 < settings.trees:
            refreshed = stage(with_margins(held, recent, len(features)), "margins").persist()
            held.unpersist()
            held, recent = refreshed, []
    held.unpersist()
    return model


def predict(model: Model, rows: DataFrame, output: str = "prediction") -> DataFrame:
    """The rows with their prediction, added where they are; a clashing column is refused."""
    if output.lower() in {c.lower() for c in rows.columns}:
        raise ValueError(f"the input has a column {output}")
    shared = rows.sparkSession.sparkContext.broadcast(model)
    width, names = len(rows.columns), [*rows.columns, output]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = shared.value.predict(_values(batch, width))
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(said)], names)

    schema = rows.select("*", F.lit(None).cast("double").alias(output)).schema
    return rows.select("*", *_doubles(model.features)).mapInArrow(run, schema)
