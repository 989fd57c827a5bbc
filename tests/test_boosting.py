"""Boosting on histograms against a plain recursive version, and several fits at once against one by one."""

import pickle

import numpy as np
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from jobtide.ml import demand
from jobtide.ml.boosting import BoostedTrees, DemandParams, _mixed, fit_boosted


def plain(x, y, p, sampled, chosen):
    """One function per tree: exact greedy splits over all values, L1 and L2 penalties, leaves of at least that weight."""

    def weight(g, h):
        return -p.step_size * np.sign(g) * max(abs(g) - p.alpha, 0) / (h + p.reg_lambda)

    def score(g, h):
        return max(abs(g) - p.alpha, 0) ** 2 / (h + p.reg_lambda)

    def grow(rows, gradient, columns, depth):
        g, h = gradient[rows].sum(), len(rows)
        best = (1e-6, None, None)
        if depth < p.max_depth:
            for column in columns:
                for cut in np.unique(x[rows, column])[:-1]:
                    left = rows[x[rows, column] <= cut]
                    gl, hl = gradient[left].sum(), len(left)
                    if min(hl, h - hl) >= p.min_child_weight:
                        found = score(gl, hl) + score(g - gl, h - hl) - score(g, h)
                        if found > best[0] + 1e-9:
                            best = (found, column, cut)
        if best[1] is None:
            return lambda point: weight(g, h)
        _, column, cut = best
        sides = [grow(rows[mask], gradient, columns, depth + 1) for mask in (x[rows, column] <= cut, x[rows, column] > cut)]
        return lambda point: sides[int(point[column] > cut)](point)

    total = np.full(len(y), y.mean())
    for tree in range(p.max_iter):
        function = grow(np.flatnonzero(sampled(tree)), total - y, chosen(tree), 0)
        total += np.array([function(point) for point in x])
    return total


def table(spark, rows=300, columns=5, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (rows, columns)) / 4
    y = np.round(3 * x[:, 0] - 2 * (x[:, 1] > 1) + x[:, 2] * x[:, 3] + rng.normal(0, 0.3, rows), 3)
    names = [f"f{i}" for i in range(columns)]
    data = [(i, *map(float, row), float(t)) for i, (row, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, ", ".join(["id int", *[f"{n} double" for n in names], "target double"])).repartition(5), names, x, y


@pytest.mark.parametrize("alpha, reg_lambda", [(0.0, 0.0), (0.1, 1.0), (5.0, 20.0)])
def test_equals_plain_version(spark, alpha, reg_lambda):
    df, names, x, y = table(spark)
    p = DemandParams(max_iter=4, max_depth=3, step_size=0.4, alpha=alpha, reg_lambda=reg_lambda)
    model = fit_boosted(df, names, "target", p)[0]
    rows = df.select("id", F.xxhash64(*names, "target").alias("row")).orderBy("id").toPandas()
    hashes = rows["row"].to_numpy().view(np.uint64)
    rng = np.random.default_rng(p.seed)
    columns = [np.sort(rng.permutation(len(names))[: int(0.8 * len(names))]) for _ in range(p.max_iter)]
    want = plain(x, y, p, lambda t: _mixed(hashes, t, p.seed) < p.subsample, lambda t: columns[t])
    got = model.transform(df).orderBy("id").toPandas()["predicted"].to_numpy()
    assert got == pytest.approx(want, abs=1e-9)


def test_penalties_shrink_the_leaves(spark):
    df, names, x, y = table(spark)
    spread = [
        np.abs(fit_boosted(df, names, "target", DemandParams(max_iter=3, alpha=a, reg_lambda=r))[0].value).max()
        for a, r in ((0.0, 0.0), (0.0, 50.0), (60.0, 0.0))
    ]
    assert spread[0] > spread[1] > 0 and spread[0] > spread[2]


def test_fits_at_once_equal_separate_fits(spark):
    df, names, x, y = table(spark, 400)
    p = DemandParams(max_iter=8, max_depth=4)
    limits = [150, 260, 400]
    together = fit_boosted(df, names, "target", p, [F.col("id") < n for n in limits])
    for n, model in zip(limits, together):
        alone = fit_boosted(df.where(F.col("id") < n), names, "target", p)[0]
        for part in ("feature", "threshold", "value", "gain"):
            assert getattr(model, part) == pytest.approx(getattr(alone, part), abs=1e-9)
    assert np.var(y - together[-1].predict(x)) < 0.7 * np.var(y)


def test_validation_equals_folds_one_by_one(spark):
    df, names, x, y = table(spark, 240, 4)
    weekly = df.withColumns({"week": F.date_add(F.lit("2024-01-01").cast("date"), 7 * (F.col("id") % 30)), "skill": F.lit("s")})
    p = DemandParams(max_iter=5, max_depth=3)
    final, errors, summary = demand.train_and_validate(weekly, p, folds=4, columns=names)
    got = {r.fold: (r.mae, r.rmse, r.r2) for r in errors.collect()}
    for fold, (train, valid) in enumerate(demand.time_folds(weekly, 4)):
        alone = demand.regression_errors(demand.train_demand(train, p, names).transform(valid)).first()
        assert got[fold] == pytest.approx(tuple(alone), abs=1e-9)
    values = {r.metric: r.value for r in summary.collect()}
    assert values["cv_mae_mean"] == pytest.approx(np.mean([v[0] for v in got.values()]))
    assert values["cv_mae_std"] == pytest.approx(np.std([v[0] for v in got.values()]))
    alone = demand.train_demand(weekly, p, names)
    assert (alone.feature == final.feature).all() and alone.value == pytest.approx(final.value)


def test_nulls_constant_columns_and_storage(spark, tmp_path):
    rows = [(i, None if i % 3 else 1.0, 5.0, float(i % 2), None if i == 7 else float(i % 2) * 10) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, target double")
    model = fit_boosted(df, ["a", "b", "c"], "target", DemandParams(max_iter=30, features_per_tree=1.0))[0]
    out = {r.id: r.predicted for r in model.transform(df).collect()}
    assert len(out) == 60 and all(abs(v - 10 * (i % 2)) < 3 for i, v in out.items())
    assert model.importance()["c"] > 0 == model.importance()["b"] and sum(model.importance().values()) == pytest.approx(1)
    model.save(spark, str(tmp_path / "m"))
    again = BoostedTrees.load(spark, str(tmp_path / "m"))
    assert again.columns == model.columns and again.base == model.base
    assert all((getattr(again, k) == getattr(model, k)).all() for k in ("feature", "threshold", "value", "gain"))
    with pytest.raises(ValueError):
        fit_boosted(df.limit(0), ["a"], "target")


@pytest.mark.parametrize("values_per_task", [16_000_000, 200])
def test_the_driver_sees_splits_only(spark, monkeypatch, values_per_task):
    """Histograms stay in the tasks: a level brings the driver a few numbers per fit and node, from one task or many."""
    df, names, x, y = table(spark, 400)
    seen, collect = [], RDD.collect

    def counted(self):
        found = collect(self)
        seen.append(len(pickle.dumps(found)))
        return found

    monkeypatch.setattr(RDD, "collect", counted)
    monkeypatch.setattr("jobtide.ml.boosting.VALUES_PER_TASK", values_per_task)
    p = DemandParams(max_iter=2, max_depth=5)
    fit_boosted(df, names, "target", p, [F.col("id") < 300, F.lit(True)])
    assert len(seen) == 10 and max(seen) < 2 * 2**4 * 500
