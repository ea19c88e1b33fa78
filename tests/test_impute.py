import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortine.operators import impute, mice, quantiles
from cohortine.operators.neural import NeuralImputer

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(10, 3, 300)
    b = 2 * a + rng.normal(0, 0.5, 300)
    c = a - b + rng.normal(0, 0.5, 300)
    data = np.column_stack([a, b, c])
    holes = rng.random(data.shape) < 0.15
    rows = [
        (i, *[None if h else float(v) for v, h in zip(r, hs)])
        for i, (r, hs) in enumerate(zip(data, holes))
    ]
    return spark.createDataFrame(rows, "id int, a double, b double, c double")


def values(df, columns=COLUMNS):
    rows = df.orderBy("id").collect()
    return np.array([[np.nan if r[c] is None else r[c] for c in columns] for r in rows])


def test_simple_strategies(spark):
    rows = [(1, 1.0, 5, "x"), (2, 2.0, 5, None), (3, None, 3, "y"), (4, 3.0, 3, "z"), (5, 10.0, None, "w")]
    df = spark.createDataFrame(rows, "id int, x double, y int, s string").withColumn(
        "empty", F.lit(None).cast("double")
    )
    columns = ["x", "y", "empty"]
    expected = {"mean": (4.0, 4.0), "median": (2.5, 4.0), "most_frequent": (1.0, 3.0)}
    for strategy, (x, y) in expected.items():
        out = impute.SimpleImputer(strategy, columns).fit_transform(df).orderBy("id").collect()
        assert (out[2].x, out[4].y) == (x, y)
        assert [r.s for r in out] == ["x", None, "y", "z", "w"]
        # A column without any value stays missing.
        assert {r.empty for r in out} == {None}
    audit = impute.missing_audit(df, impute.SimpleImputer("mean", columns).fit_transform(df), columns)
    assert {tuple(r) for r in audit.collect()} == {("x", 1, 0, 1), ("y", 1, 0, 1), ("empty", 5, 5, 0)}


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, 3.0)], "id int, x double")
    assert [r.x for r in impute.SimpleImputer("mean", ["x"]).fit_transform(df).orderBy("id").collect()] == [
        1.0, 2.0, 3.0,
    ]


def test_fit_and_transform_are_separate(spark):
    fitted = impute.SimpleImputer("mean", ["x"])
    with pytest.raises(RuntimeError, match="must be fitted"):
        fitted.transform(spark.createDataFrame([(1.0,)], "x double"))
    fitted.fit(spark.createDataFrame([(1.0,), (3.0,)], "x double"))
    assert fitted.transform(spark.createDataFrame([(None,)], "x double")).first().x == 2.0
    with pytest.raises(ValueError, match="Unknown strategy"):
        impute.SimpleImputer("best")


@pytest.mark.parametrize("probability", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_exact_quantiles_with_narrowing(spark, monkeypatch, probability):
    monkeypatch.setattr(quantiles, "SMALL_BRACKET", 20)
    rng = np.random.default_rng(2)
    smooth = rng.normal(size=20_001)
    # A third of the values are equal, and two more values make up most of the rest.
    tied = np.where(np.arange(20_001) % 3 == 0, 1.5, np.where(np.arange(20_001) % 2, -1.0, 4.0))
    tied[:50] = rng.normal(size=50)
    df = spark.createDataFrame(
        [(float(s), float(t)) for s, t in zip(smooth, tied)], "smooth double, tied double"
    )
    found = quantiles.exact_quantiles(df, ["smooth", "tied"], probability)
    assert found["smooth"] == pytest.approx(np.quantile(smooth, probability), rel=1e-12)
    assert found["tied"] == pytest.approx(np.quantile(tied, probability), rel=1e-12)


def test_quantile_between_two_heavy_values(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SMALL_BRACKET", 5)
    df = spark.range(1000).select(F.when(F.col("id") < 500, 1.0).otherwise(2.0).alias("x"))
    assert quantiles.exact_quantiles(df, ["x"], 0.5) == {"x": 1.5}


@pytest.mark.parametrize("width", [3, 12, 13, 30])
def test_chained_jobs_grow_with_columns(spark, width):
    """One path for every width: as many jobs per round as incomplete columns, and one more."""
    rng = np.random.default_rng(width)
    base = rng.normal(size=(120, 2))
    data = base @ rng.normal(size=(2, width)) + 0.1 * rng.normal(size=(120, width))
    data[rng.random(data.shape) < 0.1] = np.nan
    columns = [f"c{i}" for i in range(width)]
    rows = [(i, *[None if v != v else float(v) for v in r]) for i, r in enumerate(data)]
    schema = "id int, " + ", ".join(f"{c} double" for c in columns)
    df = spark.createDataFrame(rows, schema)
    context = spark.sparkContext
    context.setJobGroup(f"width{width}", "")
    imputer = mice.ChainedImputer(columns=columns, max_iter=2, tol=0.0).fit(df)
    jobs = len(context.statusTracker().getJobIdsForGroup(f"width{width}"))
    context.setLocalProperty("spark.jobGroup.id", None)
    # A regression is one query, of two jobs under adaptive execution.
    assert jobs <= 2 * (2 * width + 4)
    found = values(imputer.transform(df), columns)
    assert not np.isnan(found).any()
    np.testing.assert_array_equal(found[~np.isnan(data)], data[~np.isnan(data)])


def test_chained_matches_row_by_row_regressions(panel):
    """Ordinary least squares on completed rows, done directly in NumPy."""
    data = values(panel)
    missing = np.isnan(data)
    filled = np.where(missing, np.nanmean(data, axis=0), data)
    order = sorted(range(3), key=lambda j: (missing[:, j].sum(), j))
    imputer = mice.ChainedImputer(columns=COLUMNS)
    found = values(imputer.fit_transform(panel))
    for _ in range(imputer.rounds):
        for j in order:
            others = [k for k in range(3) if k != j]
            design = np.column_stack([np.ones(len(data)), filled[:, others]])
            known = ~missing[:, j]
            weights = np.linalg.lstsq(design[known], data[known, j], rcond=None)[0]
            filled[~known, j] = (design @ weights)[~known]
    assert not np.isnan(found).any()
    np.testing.assert_array_equal(found[~missing], data[~missing])
    np.testing.assert_allclose(found, filled, rtol=0.02, atol=0.05)


def test_chained_handles_new_rows_and_empty_columns(spark, panel):
    df = panel.withColumn("d", F.lit(None).cast("double"))
    imputer = mice.ChainedImputer(columns=[*COLUMNS, "d"]).fit(df)
    fresh = spark.createDataFrame(
        [(1, None, None, None, None)], "id int, a double, b double, c double, d double"
    )
    row = imputer.transform(fresh).first()
    assert None not in (row.a, row.b, row.c) and row.d is None


def test_neural(spark, panel):
    imputer = NeuralImputer(encoding_dim=8, epochs=15, columns=COLUMNS)
    with pytest.raises(RuntimeError, match="must be fitted"):
        imputer.transform(panel)
    data, found = values(panel), values(imputer.fit_transform(panel))
    assert not np.isnan(found).any()
    np.testing.assert_array_equal(found[~np.isnan(data)], data[~np.isnan(data)])
    assert min(imputer.history) < imputer.history[0]
    again = NeuralImputer(encoding_dim=8, epochs=15, columns=COLUMNS)
    np.testing.assert_allclose(
        values(again.fit(panel.repartition(3)).transform(panel)), found, rtol=1e-6
    )
    with pytest.raises(ValueError, match="at least 10 complete-case rows"):
        NeuralImputer(columns=COLUMNS).fit(panel.limit(5))


def test_neural_at_its_defaults_beats_the_mean(spark):
    """On linear data: clearly better than the mean, and near chained regressions."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(3000, 2))
    truth = base @ rng.normal(size=(2, 6)) + 0.3 * rng.normal(size=(3000, 6))
    holes = rng.random(truth.shape) < 0.1
    names = [f"c{i}" for i in range(6)]
    rows = [
        (i, *[None if h else float(v) for v, h in zip(r, hs)])
        for i, (r, hs) in enumerate(zip(truth, holes))
    ]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in names))

    def error(imputer):
        away = (values(imputer.fit_transform(df), names) - truth) / truth.std(axis=0)
        return np.sqrt((away[holes] ** 2).mean())

    mean = error(impute.SimpleImputer("mean", names))
    chained = error(mice.ChainedImputer(columns=names))
    neural = error(NeuralImputer(columns=names))
    assert neural < 0.7 * mean and neural < 1.5 * chained


def test_factory():
    assert isinstance(impute.get_imputer("simple", strategy="mean"), impute.SimpleImputer)
    assert isinstance(impute.get_imputer("mice", max_iter=2), mice.ChainedImputer)
    assert isinstance(impute.get_imputer("neural", epochs=1), NeuralImputer)
    with pytest.raises(ValueError, match="Unknown method 'magic'"):
        impute.get_imputer("magic")


@pytest.mark.parametrize("held", [1 << 20, 64])
def test_chained_state_is_condensed_with_the_same_moments(spark, monkeypatch, held):
    monkeypatch.setattr(mice, "_HELD_CELLS", held)
    rng = np.random.default_rng(5)
    values = rng.normal(size=(3000, 3)) @ rng.normal(size=(3, 3))
    # Few patterns for most rows, none observed in some.
    missing = np.array([[0, 0, 0], [1, 0, 0], [0, 1, 1], [1, 1, 1]], bool)[np.arange(3000) % 4]
    filled = np.column_stack([np.ones(3000), np.where(missing, 0.0, values)])
    state = spark.createDataFrame(
        [(f.tolist(), m.tolist()) for f, m in zip(filled, missing)], mice._STATE
    )
    small = mice._condensed(state, 3).collect()
    if held > 64:
        assert len(small) <= 4 + 3 + 2 + 1
    rows = np.array([r.filled for r in small])
    flags = np.array([r.missing for r in small])
    steps = [mice._Step(0, 0.3, np.array([0, 0.5, -1])), mice._Step(2, -0.2, np.array([1, 0.25, 0]))]
    for target in range(3):
        for known, flag in ((filled.copy(), missing), (rows.copy(), flags)):
            mice._apply_steps(known[:, 1:], flag, steps, known[:, 0])
            known = known[~flag[:, target]]
            moments = known.T @ known
            if flag is missing:
                expected = moments
        assert moments == pytest.approx(expected, rel=1e-9, abs=1e-9)
