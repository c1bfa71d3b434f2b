"""Boosted trees against a row-by-row version, and their penalties."""

import numpy as np
import pytest

from voltide.operators import boosting

FEATURES = ["a", "b", "c", "d"]
SCHEMA = "id long, " + ", ".join(f"{c} double" for c in FEATURES) + ", label double"


def sample(n=500, seed=3, missing=0.1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(2)
    x[:, 2] = rng.integers(0, 5, n)
    y = np.where(x[:, 0] > 0.2, 1.5, -0.5) + 0.3 * x[:, 2] * (x[:, 1] > 0) + rng.normal(0, 0.1, n)
    x[rng.random((n, 4)) < missing] = np.nan
    return x, y


def frame_of(spark, x, y, partitions=5):
    rows = [
        (i, *(None if np.isnan(v) else float(v) for v in row), None if np.isnan(t) else float(t))
        for i, (row, t) in enumerate(zip(x, y, strict=True))
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def plain(keys, bins, y, base, settings):
    """Every split of every node is tried on the rows themselves."""

    def score(g):
        return max(abs(g.sum()) - settings.l1, 0) ** 2 / (len(g) + settings.l2) if len(g) else 0.0

    margin, trees = np.full(len(y), base), []
    for number in range(settings.trees):
        taken = boosting.drawn(keys, number, settings.row_share)
        used = boosting.features_of_tree(bins.shape[1], number, settings)
        tree = boosting.Tree.of_depth(settings.depth)

        def build(node, rows, level):
            g = (margin - y)[rows]
            options = []
            for to_left in (True, False) if level < settings.depth else ():
                for f in used:
                    for cut in range(settings.bins - 1):
                        b = bins[rows, f]
                        left = np.where(b == boosting.MISSING, to_left, b <= cut)
                        gain = score(g[left]) + score(g[~left]) - score(g)
                        if min(left.sum(), (~left).sum()) >= settings.min_weight and gain >= settings.split_penalty and gain > 0:
                            options.append((gain, not to_left, f, cut, left))
            if not options:
                pull = np.sign(g.sum()) * max(abs(g.sum()) - settings.l1, 0)
                tree.value[node] = -settings.rate * pull / (len(g) + settings.l2)
                return
            best = max(o[0] for o in options)
            _, to_right, f, cut, left = min((o for o in options if o[0] >= best * (1 - 1e-9)), key=lambda o: o[1:4])
            tree.feature[node], tree.cut[node], tree.missing_left[node] = int(f), cut, not to_right
            build(2 * node + 1, rows[left], level + 1)
            build(2 * node + 2, rows[~left], level + 1)

        build(0, np.flatnonzero(taken), 0)
        margin = margin + tree.predict(bins)
        trees.append(tree)
    return margin, trees


SETTINGS = {
    "drawn": boosting.Settings(trees=12, depth=3, rate=0.3, row_share=0.8, feature_share=0.8, bins=8),
    "penalised": boosting.Settings(trees=4, depth=4, rate=0.3, min_weight=7, split_penalty=2.0, l1=1.5, l2=3.0, bins=8),
    "no penalty": boosting.Settings(trees=2, depth=2, rate=1.0, l2=0.0, bins=8),
}


@pytest.mark.parametrize("name", SETTINGS)
def test_equals_row_by_row_version(spark, name):
    settings = SETTINGS[name]
    x, y = sample()
    rows = frame_of(spark, x, y)
    model = boosting.fit(rows, FEATURES, "label", settings, keys=["id"])
    keys = dict(rows.selectExpr("id", "xxhash64(id) AS key").collect())
    margin, trees = plain(np.array([keys[i] for i in range(len(y))]), model.bins(x), y, model.base, settings)
    assert [(t.feature, t.cut, t.missing_left) for t in trees] == [(t.feature, t.cut, t.missing_left) for t in model.trees]
    assert model.base == pytest.approx(y.mean(), abs=1e-12)
    said = {r.id: r.prediction for r in boosting.predict(model, rows).collect()}
    np.testing.assert_allclose([said[i] for i in range(len(y))], margin, atol=1e-9)
    again = boosting.Model.from_json(model.to_json())
    np.testing.assert_array_equal(again.predict(x), model.predict(x))


def test_cuts_are_quantiles(spark):
    x, y = sample(missing=0.0)
    cuts = boosting.quantile_cuts(frame_of(spark, x, y), FEATURES, 4)
    for k in (0, 1, 3):
        below = [(x[:, k] <= cut).mean() for cut in cuts[k]]
        np.testing.assert_allclose(below, [0.25, 0.5, 0.75], atol=0.02)
    assert set(cuts[2]) <= {0.0, 1.0, 2.0, 3.0, 4.0}


def test_penalties_shrink_to_the_mean(spark):
    x, y = sample(200)
    heavy = boosting.Settings(trees=3, depth=3, split_penalty=1e6, l1=1e6)
    model = boosting.fit(frame_of(spark, x, y), FEATURES, "label", heavy, keys=["id"])
    assert all(t.feature[0] == -1 and t.value[0] == 0 for t in model.trees)
    np.testing.assert_allclose(model.predict(x), y.mean())


def test_no_rows_no_labels_and_clashes(spark):
    settings = boosting.Settings(trees=2, depth=2)
    empty = spark.createDataFrame([], SCHEMA)
    assert boosting.fit(empty, FEATURES, "label", settings, keys=["id"]).predict(np.zeros((2, 4))).tolist() == [0, 0]
    x, y = sample(60)
    unlabelled = np.concatenate([y, np.full(40, np.nan)])
    more = np.concatenate([x, np.zeros((40, 4))])
    rows = frame_of(spark, more, unlabelled)
    model = boosting.fit(rows, FEATURES, "label", settings, keys=["id"])
    assert model.base == pytest.approx(y.mean())
    assert boosting.predict(model, rows).count() == 100
    with pytest.raises(ValueError):
        boosting.predict(model, rows, "Label")


def test_constant_and_missing_features(spark):
    x, y = sample(80)
    x[:, 0], x[:, 1] = 1.0, np.nan
    model = boosting.fit(frame_of(spark, x, y), FEATURES, "label", boosting.Settings(trees=3, depth=2), keys=["id"])
    assert not {0, 1} & {f for t in model.trees for f in t.feature}
