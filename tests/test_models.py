import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortine.operators import (
    autoencoder,
    concordance,
    cox,
    quantiles,
    scans,
    signals,
    summaries,
    survival,
)


def frame(spark, rows):
    return spark.createDataFrame(rows, "USUBJID string, TRTA string, AVAL double, CNSR int")


@pytest.fixture(scope="module")
def textbook(spark):
    # Six subjects of one arm, and an arm whose only subject has the event.
    times = [(1.0, 0), (2.0, 1), (3.0, 0), (3.0, 0), (4.0, 1), (5.0, 1)]
    rows = [(f"a{i}", "A", t, c) for i, (t, c) in enumerate(times)] + [("b", "B", 2.0, 0)]
    return frame(spark, rows)


def test_km_curve(textbook):
    rows = survival.km_curve(textbook).orderBy("arm", "time").collect()
    a = [r for r in rows if r.arm == "A"]
    assert [r.time for r in a] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    assert [r.n_risk for r in a] == [6, 6, 5, 4, 2, 1]
    expected = [1.0, 5 / 6, 5 / 6, 5 / 12, 5 / 12, 5 / 12]
    assert [r.survival for r in a] == pytest.approx(expected)
    variance = 1 / (6 * 5) + 2 / (4 * 2)
    spread = 1.959963984540054 * math.sqrt(variance) / math.log(5 / 12)
    centre = math.log(-math.log(5 / 12))
    assert a[3].ci_lower == pytest.approx(math.exp(-math.exp(centre - spread)))
    assert a[3].ci_upper == pytest.approx(math.exp(-math.exp(centre + spread)))
    assert (a[0].ci_lower, a[0].ci_upper) == (1.0, 1.0)
    b = [r for r in rows if r.arm == "B"]
    assert [(r.time, r.survival, r.ci_lower) for r in b] == [(0.0, 1.0, 1.0), (2.0, 0.0, None)]


def test_km_summary_and_table(textbook):
    curve = survival.km_curve(textbook)
    rows = {r.arm: r for r in survival.km_summary(curve).collect()}
    assert (rows["A"].n_subjects, rows["A"].n_events, rows["A"].median_survival) == (6, 3, 3.0)
    assert rows["A"].median_ci_upper is None
    assert rows["B"].median_survival == 2.0
    assert survival.survival_table(curve, "B").count() == 2
    with pytest.raises(KeyError, match="Arm 'C' not found"):
        survival.survival_table(curve, "C")


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(5)
    n = 200
    z = rng.normal(size=(n, 2))
    arm = rng.integers(0, 2, n)
    time = np.ceil(rng.exponential(20, n) * np.exp(-0.6 * z[:, 0] - 0.4 * arm))
    censor = (rng.random(n) < 0.3).astype(int)
    time[: n // 3] = 7.0  # a third of the subjects leave on one day
    rows = [
        (f"s{i}", "A" if arm[i] else "B", float(time[i]), int(censor[i]), *map(float, z[i]))
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "USUBJID string, TRTA string, AVAL double, CNSR int, z0 double, z1 double"
    )


def test_logrank(sample):
    rows = sample.collect()
    observed = expected = variance = 0.0
    for t in {r.AVAL for r in rows if r.CNSR == 0}:
        n = sum(r.AVAL >= t for r in rows)
        n1 = sum(r.AVAL >= t and r.TRTA == "A" for r in rows)
        d = sum(r.AVAL == t and r.CNSR == 0 for r in rows)
        observed += sum(r.AVAL == t and r.CNSR == 0 and r.TRTA == "A" for r in rows)
        expected += d * n1 / n
        if n > 1:
            variance += d * n1 / n * (1 - n1 / n) * (n - d) / (n - 1)
    result = survival.logrank_test(sample, "A", "B")
    assert result["test_statistic"] == pytest.approx((observed - expected) ** 2 / variance)
    assert 0 <= result["p_value"] <= 1
    assert result["summary"].startswith("Log-rank test: chi2=")
    assert survival.chi_square_p(3.841458820694124) == pytest.approx(0.05)


def efron(beta, rows, names):
    """Partial log-likelihood by direct sums over risk sets."""
    x = np.array([[r[c] for c in names] for r in rows])
    x = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    time = np.array([r.AVAL for r in rows])
    event = np.array([r.CNSR == 0 for r in rows])
    eta = x @ beta
    total = 0.0
    for t in np.unique(time[event]):
        tied = event & (time == t)
        d = tied.sum()
        risk, dead = np.exp(eta[time >= t]).sum(), np.exp(eta[tied]).sum()
        total += eta[tied].sum() - sum(math.log(risk - k / d * dead) for k in range(d))
    return total, x


@pytest.mark.parametrize("penalizer", [0.0, 0.1])
def test_cox_is_at_the_maximum(spark, sample, penalizer):
    names = ["z0", "z1"]
    model = cox.fit_cox(sample, names, penalizer=penalizer)
    rows = sample.collect()
    spread = np.array([[r[c] for c in names] for r in rows]).std(axis=0, ddof=1)
    beta = model.coefficients * spread

    def objective(b):
        return efron(b, rows, names)[0] - len(rows) * penalizer / 2 * b @ b

    assert model.log_likelihood == pytest.approx(efron(beta, rows, names)[0], rel=1e-9)
    h = 1e-4
    for k in range(2):
        step = np.eye(2)[k] * h
        slope = (objective(beta + step) - objective(beta - step)) / (2 * h)
        assert abs(slope) < 1e-2
        curve = [objective(beta + s) for s in (-step, 0 * step, step)]
        assert curve[1] >= max(curve[0], curve[2])
    hessian = np.array(
        [
            [
                sum(
                    sa * sb * objective(beta + h * (sa * np.eye(2)[a] + sb * np.eye(2)[b]))
                    for sa in (1, -1)
                    for sb in (1, -1)
                )
                / (4 * h * h)
                for b in range(2)
            ]
            for a in range(2)
        ]
    )
    errors = np.sqrt(np.diag(np.linalg.inv(-hessian))) / spread
    np.testing.assert_allclose(model.errors, errors, rtol=1e-3)
    assert model.aic == pytest.approx(-2 * model.log_likelihood + 4)
    table = model.summary(spark).collect()
    assert [r.covariate for r in table] == names
    assert all(r.hr_lower < r.hazard_ratio < r.hr_upper and 0 <= r.p_value <= 1 for r in table)
    assert 0.5 < model.concordance < 1
    assert model.fit_statistics(spark).first().n_rows == 200


def test_cox_survival(sample):
    model = cox.fit_cox(sample.select("USUBJID", "AVAL", "CNSR", "z0"))
    assert model.covariates == ["z0"]
    times = [1.0, 7.0, 30.0]
    few = model.predict_survival(sample, times)
    assert few.count() == 600
    risks = {r.USUBJID: r.partial_hazard for r in model.with_risk(sample).collect()}
    steps = [(r.time, r.hazard) for r in model.hazard.collect()]
    events = sample.where("CNSR = 0").select("AVAL").distinct().count()
    assert len(steps) == len({t for t, _ in steps}) == events
    for r in few.collect():
        total = sum(h for t, h in steps if t <= r.time)
        assert r.survival == pytest.approx(math.exp(-total * risks[r.USUBJID]))


def test_whole_curves(spark, sample):
    """One curve per covariate pattern, at every time, as of the last step."""
    grouped = sample.withColumn("z0", F.round("z0"))
    unknown = sample.limit(1).selectExpr(
        *[f"{'NULL' if c == 'z0' else c} AS {c}" if c != "USUBJID" else "'gap' AS USUBJID" for c in sample.columns]
    ).withColumn("z0", F.lit(None).cast("double"))
    everyone = grouped.unionByName(unknown)
    model = cox.fit_cox(grouped, ["z0"])
    found = model.survival_curves(everyone)
    assert found.members.count() == 201
    n_patterns = grouped.select("z0").distinct().count()
    times = {r.AVAL for r in grouped.select("AVAL").distinct().collect()}
    assert found.patterns.count() == n_patterns
    assert found.curves().count() == n_patterns * len(times)
    assert model.predict_survival(everyone).count() == n_patterns * len(times)
    steps = [(r.time, r.hazard) for r in model.hazard.collect()]
    risks = {r.USUBJID: r.partial_hazard for r in model.with_risk(grouped).collect()}
    some = grouped.limit(3)
    rows = found.of(some).collect()
    assert len(rows) == 3 * len(times)
    for r in rows[:: 7]:
        total = sum(h for t, h in steps if t <= r.time)
        assert r.survival == pytest.approx(math.exp(-total * risks[r.USUBJID]))
    assert found.of(unknown).count() == 0


def test_step_function_as_of(spark):
    hazard = spark.createDataFrame([(1.0, 0.5), (3.0, 0.25)], "time double, hazard double")
    times = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,), (99.0,)], "time double")
    got = {r.time: r.cumulative_hazard for r in cox.cumulative_hazard(hazard, times).collect()}
    assert got == {0.0: 0.0, 1.0: 0.5, 2.0: 0.5, 3.0: 0.75, 99.0: 0.75}


def brute_cox(rows, beta):
    """Value, gradient and Hessian by direct sums, by differences of the value."""

    def value(b):
        total = 0.0
        for t in {r[0] for r in rows if r[1]}:
            risk = sum(math.exp(np.dot(b, r[2])) for r in rows if r[0] >= t)
            tied = [r for r in rows if r[0] == t and r[1]]
            dead = sum(math.exp(np.dot(b, r[2])) for r in tied)
            total += sum(np.dot(b, r[2]) for r in tied)
            total -= sum(math.log(risk - k / len(tied) * dead) for k in range(len(tied)))
        return total

    h, eye = 1e-4, np.eye(len(beta))
    gradient = [(value(beta + h * e) - value(beta - h * e)) / (2 * h) for e in eye]
    hessian = [
        [
            sum(sa * sb * value(beta + h * (sa * a + sb * b)) for sa in (1, -1) for sb in (1, -1))
            / (4 * h * h)
            for b in eye
        ]
        for a in eye
    ]
    return value(beta), np.array(gradient), np.array(hessian)


@pytest.mark.parametrize("times", ["spread", "tied", "hot", "one"])
def test_cox_sums_over_partitions(spark, times):
    """A time that lies in several partitions gives the same sums as in one."""
    rng = np.random.default_rng(11)
    time = {
        "spread": rng.permutation(90).astype(float),
        "tied": rng.integers(1, 6, 90).astype(float),
        "hot": np.where(np.arange(90) < 60, 3.0, rng.integers(1, 6, 90)).astype(float),
        "one": np.full(90, 2.0),
    }[times]
    rows = [(float(t), int(rng.random() < 0.6), rng.normal(size=2)) for t in time]
    df = spark.createDataFrame(
        [(t, 1 - e, float(z[0]), float(z[1])) for t, e, z in rows],
        "AVAL double, CNSR int, a double, b double",
    ).repartition(7)
    beta = np.array([0.3, -0.2])
    value, gradient, hessian = brute_cox(rows, beta)
    got = {r.term: r.value for r in cox.cox_components(df, {"a": 0.3, "b": -0.2}).collect()}
    assert got["loglik"] == pytest.approx(value)
    np.testing.assert_allclose([got["g:a"], got["g:b"]], gradient, atol=1e-4)
    np.testing.assert_allclose(got["h:b:a"], hessian[1][0], atol=1e-2)
    np.testing.assert_allclose([got["h:a:a"], got["h:b:b"]], np.diag(hessian), atol=1e-2)
    hazard = {r.time: r.hazard for r in cox.cox_hazard(df, {"a": 0.3, "b": -0.2}).collect()}
    for t in {r[0] for r in rows if r[1]}:
        risk = sum(math.exp(beta @ r[2]) for r in rows if r[0] >= t)
        assert hazard.pop(t) == pytest.approx(sum(r[1] for r in rows if r[0] == t) / risk)
    assert not hazard


def test_cox_evaluation_moves_no_rows(spark, sample):
    base = cox._ordered(sample.selectExpr("AVAL AS time", "1 - CNSR AS event", "z0"))
    base.count()
    _, parts = cox._with_risk(base, np.array([0.1]), None)
    plan = parts._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert "Exchange" not in plan and plan.count("InMemoryTableScan") == 1
    base.unpersist()


def test_cox_evaluation_is_two_jobs(spark, sample):
    base = cox._ordered(sample.selectExpr("AVAL AS time", "1 - CNSR AS event", "z0"))
    base.count()
    context = spark.sparkContext
    context.setLocalProperty("spark.jobGroup.id", "evaluation")
    cox._evaluate(base, np.array([0.1]))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("evaluation")) == 2
    base.unpersist()


def test_cox_reports_how_it_ended(sample):
    model = cox.fit_cox(sample, ["z0", "z1"])
    assert model.converged and model.gradient < 1e-2
    with pytest.warns(UserWarning, match="not converged"):
        stopped = cox.fit_cox(sample, ["z0", "z1"], max_iter=0)
    assert not stopped.converged and stopped.steps == 0


@pytest.mark.parametrize("kind", ["rounded", "plain", "hot time", "hot score", "hot both", "one time"])
def test_concordance(sample, kind):
    hot = F.col("USUBJID").substr(-1, 1).cast("int") < 7
    score, time = F.round("z0", 0 if kind == "rounded" else 3), F.col("AVAL")
    if kind in ("hot score", "hot both"):
        score = F.when(hot, 0.25).otherwise(score)
    if kind in ("hot time", "hot both"):
        time = F.when(hot, 5.0).otherwise(time)
    scored = sample.withColumns({"score": score, "AVAL": F.lit(2.0) if kind == "one time" else time})
    rows = scored.collect()
    comparable = concordant = tied = 0
    for a in rows:
        for b in rows:
            if a.CNSR == 0 and (b.AVAL > a.AVAL or (b.AVAL == a.AVAL and b.CNSR == 1)):
                comparable += 1
                concordant += a.score > b.score
                tied += a.score == b.score
    found = concordance.concordance(scored, "score").first()
    assert (found.comparable, found.concordant, found.tied) == (comparable, concordant, tied)
    assert found.concordance == pytest.approx((concordant + tied / 2) / comparable)


def test_counts_below_pass_64_bits():
    big = np.array([4_000_000_000] * 2)
    pairs = concordance.count_below(np.array([0, 1]), np.array([1.0, 2.0]), big, big)
    assert pairs == 16_000_000_000_000_000_000
    assert concordance.count_below(*[np.zeros(0, np.int64)] * 4) == 0


def test_concordance_without_pairs(sample):
    empty = concordance.concordance(sample.where("CNSR = 1"), "z0").first()
    assert (empty.comparable, empty.concordance) == (0, None)


def test_running_totals(spark):
    df = spark.range(500).select(
        (F.col("id") % 2).alias("g"), (F.col("id") * 3).alias("t"), F.lit(1).alias("one")
    )
    for blocks in (1, 4, 50):
        placed = scans.with_blocks(df, "t", blocks)
        up = scans.running_totals(placed, ["g"], "t", {"n": "one"})
        assert {r.n - (r.t // 3 // 2 + 1) for r in up.collect()} == {0}
        down = scans.running_totals(
            placed, [], "t", {"n": "one"}, inclusive=False, descending=True
        )
        assert {r.n - (499 - r.t // 3) for r in down.collect()} == {0}


@pytest.fixture(scope="module")
def safety(spark):
    rows = []
    for i in range(40):
        for k in range(i % 5):
            rows.append((f"u{i}", "Y", "Cardiac disorders", 1 + k % 5, "N", "Y"))
    rows += [("u39", "Y", "Nervous system disorders of one kind", 5, "Y", "N")] * 30
    rows += [("u39", "Y", "Nervous system disorders of other kind", 5, "Y", "N")] * 2
    rows += [("u1", "", "Cardiac disorders", 1, "Y", "Y"), ("gone", "Y", "Cardiac disorders", 1, "Y", "Y")]
    adae = spark.createDataFrame(
        rows,
        "USUBJID string, TRTEMFL string, AEBODSYS string, ATOXGR int, ASER string, AEREL string",
    )
    adsl = spark.createDataFrame([(f"u{i}",) for i in range(40)] + [("u0",)], "USUBJID string")
    return adae, adsl


def test_features(safety):
    rows = {r.USUBJID: r for r in signals.subject_features(*safety).collect()}
    assert len(rows) == 40 and "gone" not in rows
    assert rows["u0"].TOTAL_TEAE == 0.0
    assert rows["u1"].TOTAL_TEAE == 1.0 and rows["u1"].SERIOUS_N == 0.0
    # Two names that agree in their first 20 characters are one feature.
    assert rows["u39"].SOC_NERVOUS_SYSTEM_DISOR == 32.0
    assert rows["u39"].SOC_CARDIAC_DISORDERS == 4.0 and rows["u39"].GRADE_5_N == 32.0
    extra = signals.subject_features(*safety, grade3plus=True)
    assert "GRADE_3PLUS_N" in extra.columns


def test_scaling_keeps_constant_columns(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0)], "USUBJID string, x double, y double")
    scale = signals.scaling(df)
    assert scale == {"x": (2.0, 1.0), "y": (5.0, 1.0)}
    assert sorted(tuple(r)[1:] for r in signals.scaled(df, scale).collect()) == [(-1.0, 0.0), (1.0, 0.0)]


def test_flags_use_the_interpolated_threshold(spark):
    scores = spark.createDataFrame([(f"u{i}", float(i)) for i in range(41)], f"USUBJID string, {signals.SCORE} double")
    flagged, threshold = signals.flag_scores(scores, 0.05)
    assert threshold == pytest.approx(38.0)
    assert flagged.where(signals.FLAG).count() == 2
    summary = signals.signal_summary(flagged, threshold).first()
    assert (summary.n_subjects, summary.n_anomalies, summary.anomaly_rate) == (41, 2, 4.9)


def test_detector(safety):
    detector = signals.SignalDetector(epochs=15, contamination=0.05)
    with pytest.raises(RuntimeError, match="trained first"):
        detector.reconstruct(*safety)
    rows = detector.fit_detect(*safety).collect()
    errors = [r[signals.SCORE] for r in rows]
    assert errors == sorted(errors, reverse=True) and len(rows) == 40
    assert rows[0].USUBJID == "u39"
    assert all(r[signals.FLAG] == (r[signals.SCORE] > detector.threshold) for r in rows)
    adae, adsl = safety
    same = {r.USUBJID: r[signals.SCORE] for r in detector.reconstruct(adae, adsl).collect()}
    assert same["u39"] == pytest.approx(errors[0])
    # New data without one of the body systems is scored on the fitted features.
    fewer = adae.where(~F.col("AEBODSYS").startswith("Nervous"))
    assert detector.reconstruct(fewer, adsl).count() == 40


SHAPES = {
    "dense": autoencoder.Shape.dense(3, 5, 3),
    "normalised": autoencoder.Shape(
        3, (autoencoder.Layer(6, normalise=True), autoencoder.Layer(4), autoencoder.Layer(3, False, True))
    ),
}


@pytest.mark.parametrize("shape", SHAPES.values(), ids=SHAPES)
def test_gradient(shape):
    """Against differences; rows that are not valid take no part."""
    net = autoencoder.Network.fresh(shape, seed=1)
    rng = np.random.default_rng(0)
    net.weights += rng.normal(size=len(net.weights)) / 10
    x, y = rng.normal(size=(2, 9, 3)), rng.normal(size=(2, 9, 3))
    valid = np.ones((2, 9))
    valid[1, 6:] = 0
    weights = np.stack([net.weights, net.weights * 1.1])
    stats = np.stack([net.stats] * 2)
    masks = [(rng.random((2, 9, layer.units)) > 0.3) / 0.7 for layer in shape.layers[:-1]] + [None]

    def loss(weights):
        out, notes = autoencoder.run_forward(shape, weights, stats, x, valid, masks)
        error = (out - y) * valid[:, :, None]
        return (error**2).sum(axis=(1, 2)), notes, 2 * error

    _, notes, delta = loss(weights)
    gradient = autoencoder.run_backward(shape, weights, delta, notes, valid)
    for i in range(shape.n_weights):
        step = np.zeros(shape.n_weights)
        step[i] = 1e-6
        change = (loss(weights + step)[0] - loss(weights - step)[0]) / 2e-6
        np.testing.assert_allclose(gradient[:, i], change, atol=2e-4)
    # Rows beyond the valid ones may hold anything.
    x[1, 6:] = 99.0
    _, notes, delta = loss(weights)
    np.testing.assert_allclose(
        autoencoder.run_backward(shape, weights, delta, notes, valid), gradient, atol=1e-9
    )


def test_replicas_side_by_side_train_as_alone():
    """Several replicas in one block take the steps that each would take by itself."""
    shape = autoencoder.Shape(2, (autoencoder.Layer(5, normalise=True), autoencoder.Layer(2, False)))
    net = autoencoder.Network.fresh(shape, 3)
    zeros = np.zeros_like(net.weights)
    state = autoencoder._State(net.weights, zeros, zeros, net.stats, 7)
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(2, 3, 40, 2)).astype(np.float32)
    valid = np.ones((3, 40), np.float32)
    options = (16, 0.01, (1, 0), range(2))
    both = autoencoder.train_part(shape, state, x, y, valid, *options)
    for i in range(3):
        one = slice(i, i + 1)
        alone = autoencoder.train_part(shape, state, x[one], y[one], valid[one], *options)
        np.testing.assert_allclose(both.weights[i], alone.weights[0], rtol=1e-4, atol=1e-6)
        np.testing.assert_allclose(both.stats[i], alone.stats[0], rtol=1e-4, atol=1e-6)
    assert both.steps == 7 + 2 * 3


def test_dropout_masks_follow_the_counter():
    shape = autoencoder.Shape(2, (autoencoder.Layer(50, dropout=0.5), autoencoder.Layer(2, False)))
    net = autoencoder.Network.fresh(shape, 3)
    zeros = np.zeros_like(net.weights)
    state = autoencoder._State(net.weights, zeros, zeros, net.stats)
    x = np.ones((1, 8, 2), np.float32)
    options = (shape, state, x, x, np.ones((1, 8), np.float32), 8, 0.01)
    first = autoencoder.train_part(*options, (1, 0), range(1)).weights
    np.testing.assert_array_equal(first, autoencoder.train_part(*options, (1, 0), range(1)).weights)
    for key, epochs in (((2, 0), range(1)), ((1, 1), range(1)), ((1, 0), range(1, 2))):
        assert not np.array_equal(first, autoencoder.train_part(*options, key, epochs).weights)


def test_replicas_grow_with_the_rows_and_equal_rows_spread(spark):
    assert [autoencoder.replicas_for(n) for n in (1, 2048, 2049, 10**9)] == [1, 1, 2, 488_282]
    rows = spark.range(20_000).select(
        F.lit(1.0).alias("x"), F.lit(False).alias("hold"), F.xxhash64("id").alias("slot")
    )
    dealt = autoencoder.deal(rows, ["x"], ["x"], "hold", F.col("slot"), 40, 4)
    parts = dealt.collect()
    import pickle

    assert sorted(r.part for r in parts) == list(range(10)) and dealt.rdd.getNumPartitions() == 10
    sizes = np.concatenate([np.bincount(pickle.loads(r.data)[0])[4 * r.part :] for r in parts])
    assert len(sizes) == 40 and sizes.sum() == 20_000 and sizes.max() < 1.3 * 500
    dealt.unpersist()


def test_many_parts_share_few_tasks_evenly(spark):
    cores = spark.sparkContext.defaultParallelism
    many = 10**6 * autoencoder.PARTS_PER_TASK
    assert autoencoder.tasks_for(spark, 3) == 3 and autoencoder.tasks_for(spark, many) == 10**6
    rows = spark.range(10_000).select(
        F.lit(1.0).alias("x"), F.lit(False).alias("hold"), F.xxhash64("id").alias("slot")
    )
    dealt = autoencoder.deal(rows, ["x"], ["x"], "hold", F.col("slot"), 400, 2)
    tasks = dealt.groupBy(F.spark_partition_id()).agg(F.count("part").alias("parts")).collect()
    assert len(tasks) == 4 * cores < 200
    sizes = [r.parts for r in tasks]
    assert sum(sizes) == 200 and max(sizes) - min(sizes) <= 1
    dealt.unpersist()


def test_rows_of_replicas_lie_together_and_inputs_stay():
    shape = SHAPES["normalised"]
    net = autoencoder.Network.fresh(shape, 5)
    rng = np.random.default_rng(2)
    weights, stats = (np.repeat(v[None], 4, axis=0) for v in (net.weights, net.stats))
    x, delta = rng.normal(size=(2, 4, 7, 3))
    valid = np.ones((4, 7))
    before = [v.copy() for v in (x, delta, weights, stats)]
    out, notes = autoencoder.run_forward(shape, weights, stats, x, valid)
    assert all(v.transpose(1, 0, 2).flags.c_contiguous for v in (out, notes[0][1], notes[0][2]))
    autoencoder.run_backward(shape, weights, delta, notes, valid)
    for old, new in zip(before, (x, delta, weights, stats)):
        np.testing.assert_array_equal(old, new)


@pytest.fixture(scope="module")
def training(spark):
    return spark.range(200, numPartitions=6).select(
        *[F.sin(F.col("id") * (k + 1)).alias(f"x{k}") for k in range(2)],
        *[(2 * F.sin(F.col("id") * (k + 1))).alias(f"y{k}") for k in range(2)],
        (F.col("id") % 10 == 0).alias("hold"),
        F.xxhash64("id").alias("slot"),
    )


def fit(df, **options):
    names = (["x0", "x1"], ["y0", "y1"], "hold", F.col("slot"), autoencoder.Shape.dense(2, 8, 2))
    return autoencoder.train(df, *names, epochs=6, patience=6, seed=1, learning_rate=0.03, **options)


def test_training_does_not_depend_on_partitions(training, monkeypatch):
    network, history = fit(training, batch_size=8, replicas=4)
    other, again = fit(training.repartition(3), batch_size=8, replicas=4)
    np.testing.assert_allclose(network.weights, other.weights, rtol=1e-6)
    np.testing.assert_allclose(history, again, rtol=1e-6)
    assert min(history) < 0.5 * history[0]
    monkeypatch.setattr(autoencoder, "_FAN_IN", 2)
    tree, _ = fit(training, batch_size=8, replicas=4)
    np.testing.assert_allclose(network.weights, tree.weights, rtol=1e-6)


def test_more_updates_per_pass_learn_more(training):
    many, few = fit(training, batch_size=8)[1], fit(training, batch_size=1000)[1]
    assert min(many) < min(few)


def test_pass_sums(spark, training):
    net = autoencoder.Network.fresh(autoencoder.Shape.dense(2, 3, 2), seed=3)
    gradient, loss, rows = autoencoder.pass_sums(training, ["x0", "x1"], ["y0", "y1"], net)
    table = training.toPandas()
    whole = net.gradient(table[["x0", "x1"]].to_numpy(), table[["y0", "y1"]].to_numpy())
    np.testing.assert_allclose(gradient, whole[0])
    assert (loss, rows) == (pytest.approx(whole[1]), 200)


def test_more_systems_than_a_pivot_takes(spark):
    limit = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "5")
    try:
        adae = spark.range(60).selectExpr(
            "concat('u', id % 3) AS USUBJID", "'Y' AS TRTEMFL", "concat('System ', id) AS AEBODSYS"
        )
        adsl = adae.select("USUBJID").distinct()
        features = signals.subject_features(adae, adsl)
        assert len(features.columns) == 62
        row = features.where("USUBJID = 'u1'").first()
        assert (row.TOTAL_TEAE, row.SOC_SYSTEM_1, row.SOC_SYSTEM_2) == (20.0, 1.0, 0.0)
        some = signals.subject_features(adae, adsl, ["System 1", "System 99"])
        assert some.columns[2:] == ["SOC_SYSTEM_1", "SOC_SYSTEM_99"]
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", limit)


def test_survival_leaves_out_nan_and_null(spark):
    rows = [("A", 1.0, 0), ("A", 2.0, 1), ("B", 1.5, 0), ("B", 3.0, 0)]
    dirty = rows + [("A", float("nan"), 0), ("B", None, 1), (None, 1.0, 0), ("A", 1.0, None)]
    schema = "TRTA string, AVAL double, CNSR int"
    clean, df = spark.createDataFrame(rows, schema), spark.createDataFrame(dirty, schema)
    key = ["arm", "time"]
    curve = survival.km_curve(df).orderBy(*key).collect()
    assert curve == survival.km_curve(clean).orderBy(*key).collect()
    parts = survival.with_p_value(survival.logrank_components(df, "A", "B")).first()
    assert parts.chi_square == survival.logrank_components(clean, "A", "B").first().chi_square
    assert parts.p_value == pytest.approx(survival.chi_square_p(parts.chi_square))


def test_random_columns(spark):
    df = spark.range(20_000).select(
        autoencoder.uniform([F.col("id")], "u", 1).alias("u"),
        autoencoder.normal([F.col("id")], "n", 1).alias("n"),
    )
    row = df.agg(F.min("u"), F.max("u"), F.avg("u"), F.avg("n"), F.stddev("n")).first()
    assert 0 < row[0] and row[1] < 1
    assert row[2] == pytest.approx(0.5, abs=0.02)
    assert row[3] == pytest.approx(0.0, abs=0.03) and row[4] == pytest.approx(1.0, abs=0.03)


def test_intermediate_tables_go(spark, sample):
    import os

    from cohortine import session

    session.ensure_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")

    def tables():
        return {name for name in os.listdir(folder) if name.startswith("table-")}

    before = tables()
    with session.scratch(spark):
        survival.km_curve(sample).collect()
        cox.fit_cox(sample, ["z0"])
        assert tables() > before
    assert tables() == before
    kept = session.materialise(sample)
    assert tables() != before
    session.release(kept)
    assert tables() == before


def test_grouped_medians(spark):
    rng = np.random.default_rng(2)
    groups = {"a": rng.normal(size=101), "b": rng.integers(0, 4, 60) / 3, "c": [5.25], "d": [1.0, 2.0]}
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows + [("e", None), (None, 1.0)], "g string, v double")
    got = {r.g: r.median for r in quantiles.grouped_medians(df, "g", "v").collect()}
    assert got == {g: pytest.approx(np.median(values)) for g, values in groups.items()}


def test_summaries_without_age_or_time(spark):
    df = spark.createDataFrame([("A", "M", 0), ("B", "F", 1)], "TRTA string, SEX string, CNSR int")
    ages = summaries.demographics_summary(df).collect()
    assert {(r.n, r.age_median, r.age_mean) for r in ages} == {(1, None, None)}
    times = summaries.time_to_event_summary(df).collect()
    assert {(r.n, r.median_aval, r.max_aval) for r in times} == {(1, None, None)}
