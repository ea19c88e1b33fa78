"""Cox proportional hazards regression.

The rows are range-partitioned once, latest time first, and sorted. Each evaluation of
the partial likelihood then takes two narrow passes over these partitions, one job each: the
first sums the weights of each partition, the second adds up the likelihood with the totals of
the partitions before it, inside each task. No row is shuffled between Newton steps; only
sums of p x p numbers per partition reach the driver.

A time that spreads over several partitions (a hot day) is put together on the driver
from each partition's sums: only the first and the last time of a partition can.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null, numeric_columns
from ..session import materialise, release
from .concordance import concordance
from .scans import running_totals, with_blocks

#: Parts that the rows of one time are dealt into, so that a hot time can be split.
_SALTS = 16


class _Shape:
    """Places of the sums in one flat line: d, eta, x[p], then weight moments, tied, all."""

    def __init__(self, p: int):
        self.p = p
        self.pairs = [(a, b) for a in range(p) for b in range(a + 1)]
        self.moments = 1 + p + len(self.pairs)
        self.width = 2 + p + 2 * self.moments

    def lines(self, event: np.ndarray, z: np.ndarray, beta: np.ndarray) -> np.ndarray:
        """The contribution of every row."""
        eta = z @ beta
        w = np.exp(eta)[:, None]
        products = [z[:, a] * z[:, b] for a, b in self.pairs]
        moments = w * np.column_stack([np.ones(len(z)), z, *products])
        e = event[:, None]
        return np.column_stack([event, event * eta, e * z, e * moments, moments])

    def all_moments(self, lines: np.ndarray) -> np.ndarray:
        return lines[..., -self.moments :]

    def matrix(self, flat: np.ndarray) -> np.ndarray:
        """Symmetric matrices from their lower triangles, one per line."""
        out = np.zeros((*flat.shape[:-1], self.p, self.p))
        for i, (a, b) in enumerate(self.pairs):
            out[..., a, b] = out[..., b, a] = flat[..., i]
        return out

    def likelihood(self, lines: np.ndarray, risk: np.ndarray) -> np.ndarray:
        """Value, gradient and Hessian over times, from their sums and risk-set moments.

        Efron's handling of ties: of d tied events, the l-th (from 0) meets the risk set
        less l/d of the tied ones.
        """
        p = self.p
        keep = lines[:, 0] > 0
        lines, risk = lines[keep], risk[keep]
        d = np.rint(lines[:, 0]).astype(np.int64)
        tied = lines[:, 2 + p : 2 + p + self.moments]
        at = np.repeat(np.arange(len(d)), d)
        f = (np.arange(len(at)) - np.repeat(np.cumsum(d) - d, d)) / d[at]
        phi = risk[at, 0] - f * tied[at, 0]

        def per_time(values: np.ndarray) -> np.ndarray:
            return np.bincount(at, weights=values, minlength=len(d))

        c0, c1 = per_time(1 / phi), per_time(f / phi)
        e0, e1, e2 = (per_time(f**k / phi**2) for k in range(3))
        r1, t1 = risk[:, 1 : 1 + p], tied[:, 1 : 1 + p]
        value = float(lines[:, 1].sum() - np.log(phi).sum())
        gradient = (lines[:, 2 : 2 + p] - r1 * c0[:, None] + t1 * c1[:, None]).sum(axis=0)
        r2, t2 = self.matrix(risk[:, 1 + p :]), self.matrix(tied[:, 1 + p :])
        hessian = -np.tensordot(c0, r2, 1) + np.tensordot(c1, t2, 1)
        cross = np.einsum("n,na,nb->ab", e1, r1, t1)
        hessian += np.einsum("n,na,nb->ab", e0, r1, r1) - cross - cross.T
        hessian += np.einsum("n,na,nb->ab", e2, t1, t1)
        return np.concatenate([[value], gradient, [hessian[a, b] for a, b in self.pairs]])


def _arrays(batch: pa.RecordBatch, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    columns = [batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(2 + p)]
    return columns[0], columns[1], np.column_stack(columns[2:])


def _totals(base: DataFrame, beta: np.ndarray) -> dict[int, np.ndarray]:
    """Weight moments of the rows of each partition."""
    shape = _Shape(len(beta))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(shape.moments), 0
        for batch in batches:
            if batch.num_rows:
                _, event, z = _arrays(batch, shape.p)
                total += shape.all_moments(shape.lines(event, z, beta)).sum(axis=0)
                rows += batch.num_rows
        if rows:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([total], pa.list_(pa.float64()))], names=["part", "sums"]
            )

    rows = base.mapInArrow(run, "part long, sums array<double>").collect()
    return {row["part"]: np.array(row["sums"]) for row in rows}


def _grouped(
    batches: Iterator[pa.RecordBatch], shape: _Shape, beta: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Times (falling) and their sums; a time's rows are added up over batches."""
    open_time, open_line = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        time, event, z = _arrays(batch, shape.p)
        starts = np.flatnonzero(np.append(True, time[1:] != time[:-1]))
        lines = np.add.reduceat(shape.lines(event, z, beta), starts, axis=0)
        times = time[starts]
        if open_time is not None:
            if open_time == times[0]:
                lines[0] += open_line
            else:
                times = np.append(open_time, times)
                lines = np.vstack([open_line, lines])
        if len(times) > 1:
            yield times[:-1], lines[:-1]
        open_time, open_line = times[-1], lines[-1]
    if open_time is not None:
        yield np.array([open_time]), open_line[None, :]


_SUMS = "part long, time double, sums array<double>"


def _with_risk(
    base: DataFrame, beta: np.ndarray, inner, added: bool = False
) -> tuple[dict[int, np.ndarray], DataFrame]:
    """Rows of ``inner(times, lines, risk)`` over the times inside each partition.

    ``inner`` returns the times and lists of its rows, which have the part -1. With ``added`` it
    returns sums in place of them, which come out added up, one row per partition.

    The first and the last time of a partition come out as rows of kind ``edge`` with
    their sums and the moments of the partition's later times.
    """
    shape = _Shape(len(beta))
    totals = _totals(base, beta)
    parts = sorted(totals)
    before = np.cumsum([np.zeros(shape.moments)] + [totals[k] for k in parts], axis=0)
    carries = dict(zip(parts, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        later = np.zeros(shape.moments)
        waiting = None  # a group is only known to be the last when no other follows
        edges = []
        sums_here = 0.0

        def settle(times: np.ndarray, lines: np.ndarray, after: np.ndarray):
            nonlocal sums_here
            out = inner(times, lines, carries[part] + after + shape.all_moments(lines))
            if added:
                sums_here = sums_here + out
            else:
                yield rows_of([-1] * len(out[0]), *out)

        def rows_of(parts: list[int], times, lists) -> pa.RecordBatch:
            columns = [
                pa.array(parts, pa.int64()),
                pa.array(times, pa.float64()),
                pa.array(lists, pa.list_(pa.float64())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["part", "time", "sums"])

        first = True
        for times, lines in _grouped(batches, shape, beta):
            sums = np.cumsum(shape.all_moments(lines), axis=0)
            after = later + sums - shape.all_moments(lines)
            later = later + sums[-1]
            if waiting is not None:
                yield from settle(*waiting)
                waiting = None
            if first:
                edges.append((times[0], lines[0], after[0]))
                times, lines, after, first = times[1:], lines[1:], after[1:], False
            if len(times) > 1:
                yield from settle(times[:-1], lines[:-1], after[:-1])
            if len(times):
                waiting = (times[-1:], lines[-1:], after[-1:])
        if waiting is not None:
            edges.append(tuple(w[0] for w in waiting))
        if np.ndim(sums_here):
            yield rows_of([-1], [0.0], [sums_here])
        if edges:
            lists = [np.concatenate([line, after]) for _, line, after in edges]
            yield rows_of([part] * len(edges), [t for t, _, _ in edges], lists)

    return carries, base.mapInArrow(run, _SUMS)


def _edges(shape: _Shape, carries: dict[int, np.ndarray], rows) -> tuple[np.ndarray, ...]:
    """Times at partition edges, put together: times, sums, risk-set moments."""
    by_time: dict[float, list] = {}
    for row in sorted(rows, key=lambda r: r["part"]):
        by_time.setdefault(row["time"], []).append((row["part"], np.array(row["sums"])))
    times = sorted(by_time, reverse=True)
    lines = np.zeros((len(times), shape.width))
    risk = np.zeros((len(times), shape.moments))
    for i, time in enumerate(times):
        part, sums = by_time[time][0]
        lines[i] = np.sum([s[: shape.width] for _, s in by_time[time]], axis=0)
        risk[i] = carries[part] + sums[shape.width :] + shape.all_moments(lines[i])
    return np.array(times), lines, risk


def _evaluate(base: DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log partial likelihood, gradient and Hessian at ``beta``."""
    shape = _Shape(len(beta))

    def inner(times, lines, risk) -> np.ndarray:
        return shape.likelihood(lines, risk)

    carries, parts = _with_risk(base, beta, inner, added=True)
    # One job: a line of sums and at most two edges per partition.
    rows = parts.collect()
    total = np.zeros(1 + shape.p + len(shape.pairs))
    for row in rows:
        if row["part"] < 0:
            total += np.array(row["sums"])
    _, lines, risk = _edges(shape, carries, [row for row in rows if row["part"] >= 0])
    if len(lines):
        total += shape.likelihood(lines, risk)
    hessian = shape.matrix(total[1 + shape.p :])
    return float(total[0]), total[1 : 1 + shape.p], hessian


def _hazard(base: DataFrame, beta: np.ndarray) -> DataFrame:
    """Breslow step d / risk at every event time."""
    shape = _Shape(len(beta))

    def inner(times, lines, risk):
        keep = lines[:, 0] > 0
        return times[keep], (lines[keep, 0] / risk[keep, 0])[:, None].tolist()

    carries, parts = _with_risk(base, beta, inner)
    inside = parts.where("part < 0").select("time", F.col("sums")[0].alias("hazard"))
    times, lines, risk = _edges(shape, carries, parts.where("part >= 0").collect())
    rows = [
        (float(t), float(line[0] / r[0])) for t, line, r in zip(times, lines, risk) if line[0] > 0
    ]
    at_edges = base.sparkSession.createDataFrame(rows, "time double, hazard double")
    return inside.unionAll(at_edges)


@dataclass
class CoxModel:
    """Fitted coefficients with the centring used and the baseline hazard."""

    covariates: list[str]
    coefficients: np.ndarray
    errors: np.ndarray
    means: np.ndarray
    log_likelihood: float
    aic: float
    concordance: float
    n_rows: int
    hazard: DataFrame  # time, hazard: Breslow steps at event times
    times: DataFrame  # time: all distinct times of the rows used
    converged: bool
    steps: int
    gradient: float  # largest element of the penalised gradient at the coefficients
    level: float = 0.95

    def summary(self, spark) -> DataFrame:
        """One row per covariate: coefficient, hazard ratio, limits, p-value."""
        z = NormalDist().inv_cdf(0.5 + self.level / 2)
        rows = []
        for name, b, se in zip(self.covariates, self.coefficients, self.errors):
            p = math.erfc(abs(b / se) / math.sqrt(2))
            limits = [math.exp(b - z * se), math.exp(b + z * se)]
            rows.append((name, float(b), float(se), math.exp(b), *limits, p))
        return spark.createDataFrame(
            rows,
            "covariate string, coef double, se double, hazard_ratio double, "
            "hr_lower double, hr_upper double, p_value double",
        )

    def fit_statistics(self, spark) -> DataFrame:
        """One row: concordance index, AIC, log-likelihood, rows used, and how the fit ended."""
        row = (float(self.concordance), float(self.aic), float(self.log_likelihood), self.n_rows)
        return spark.createDataFrame(
            [(*row, self.converged, self.steps, self.gradient)],
            "concordance double, aic double, log_likelihood double, n_rows long, "
            "converged boolean, steps int, gradient double",
        )

    def with_risk(self, df: DataFrame, name: str = "partial_hazard") -> DataFrame:
        """Add exp of the centred linear predictor."""
        eta = F.lit(0.0)
        for c, b, m in zip(self.covariates, self.coefficients, self.means):
            eta = eta + float(b) * (nan_to_null(df, c).cast("double") - float(m))
        return df.withColumn(name, F.exp(eta))

    def survival_curves(self, df: DataFrame, id_col: str = "USUBJID") -> SurvivalCurves:
        """Whole curves, one per distinct covariate pattern, at every time the model saw."""
        values = [nan_to_null(df, c).cast("double").alias(f"z{i}") for i, c in enumerate(self.covariates)]
        names = [f"z{i}" for i in range(len(values))]
        members = df.select(F.col(id_col), F.xxhash64(*values).alias("pattern"), *values)
        risk = F.lit(0.0)
        for name, b, m in zip(names, self.coefficients, self.means):
            risk = risk + float(b) * (F.col(name) - float(m))
        patterns = (
            members.select("pattern", *names)
            .na.drop()
            .distinct()
            .select("pattern", F.exp(risk).alias("partial_hazard"))
        )
        baseline = cumulative_hazard(self.hazard, self.times)
        return SurvivalCurves(baseline, patterns, members.select(id_col, "pattern"), id_col)

    def predict_survival(
        self,
        df: DataFrame,
        times: Sequence[float] | None = None,
        id_col: str = "USUBJID",
    ) -> DataFrame:
        """Survival probability in long form.

        For the few ``times`` of a list: per (subject, time). Without: at every time the model saw, per (pattern, time), which
        :meth:`survival_curves` relates to subjects; subjects times times is never built.
        """
        if times is None:
            return self.survival_curves(df, id_col).curves()
        asked = df.sparkSession.createDataFrame([(float(t),) for t in times], "time double")
        points = cumulative_hazard(self.hazard, asked.distinct()).collect()
        risks = self.with_risk(df).select(id_col, "partial_hazard")
        lines = F.array(
            *[
                F.struct(F.lit(time).alias("time"), F.lit(total).alias("cumulative_hazard"))
                for time, total in sorted(map(tuple, points))
            ]
        )
        survival = F.exp(-F.col("cumulative_hazard") * F.col("partial_hazard"))
        return risks.select(id_col, "partial_hazard", F.inline(lines)).select(
            id_col, "time", survival.alias("survival")
        )


def cumulative_hazard(hazard: DataFrame, times: DataFrame) -> DataFrame:
    """``time`` and ``cumulative_hazard`` of a step function, as of each of the ``times``.

    Steps and times are put on one line, cut into blocks, and summed within blocks plus what
    earlier blocks carry, so the number of times and steps may be large.
    """
    steps = hazard.select("time", F.col("hazard").alias("step"), F.lit(False).alias("asked"))
    asked = times.select("time", F.lit(0.0).alias("step"), F.lit(True).alias("asked"))
    line = (
        steps.unionByName(asked)
        .groupBy("time")
        .agg(F.sum("step").alias("step"), F.max("asked").alias("asked"))
    )
    line = materialise(line)
    summed = running_totals(with_blocks(line, "time"), [], "time", {"cumulative_hazard": "step"})
    return summed.where("asked").select("time", "cumulative_hazard")


@dataclass
class SurvivalCurves:
    """Curves of subjects, factored: a baseline, patterns of covariates, and who has which.

    ``baseline`` has ``time`` and ``cumulative_hazard``; ``patterns`` has ``pattern`` and
    ``partial_hazard`` (none for subjects with a missing covariate); ``members`` has the
    subject and its ``pattern``.
    """

    baseline: DataFrame
    patterns: DataFrame
    members: DataFrame
    id_col: str

    def curves(self, patterns: DataFrame | None = None) -> DataFrame:
        """``pattern``, ``time``, ``survival`` of all or of the given patterns."""
        chosen = self.patterns
        if patterns is not None:
            chosen = chosen.join(patterns.select("pattern").distinct(), "pattern", "left_semi")
        survival = F.exp(-F.col("cumulative_hazard") * F.col("partial_hazard"))
        return chosen.crossJoin(self.baseline).select("pattern", "time", survival.alias("survival"))

    def of(self, subjects: DataFrame) -> DataFrame:
        """Curves of the subjects wanted: id, ``time``, ``survival``."""
        wanted = self.members.join(subjects.select(self.id_col).distinct(), self.id_col, "left_semi")
        return wanted.join(self.curves(wanted), "pattern").select(self.id_col, "time", "survival")


def _ordered(complete: DataFrame) -> DataFrame:
    """Rows in range partitions of falling time, kept for the passes of the fit.

    Kept partitions that are lost are computed again from the materialised rows.
    """
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS))
    return (
        complete.withColumn("__salt", salt)
        .repartitionByRange(F.desc("time"), F.desc("__salt"))
        .sortWithinPartitions(F.desc("time"), F.desc("__salt"))
        .drop("__salt")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )


def cox_components(
    df: DataFrame,
    coefficients: dict[str, float],
    duration: str = "AVAL",
    censor: str = "CNSR",
) -> DataFrame:
    """Log partial likelihood, gradient and Hessian at fixed coefficients.

    One row per number: ``term`` (``loglik``, ``g:a``, ``h:a:b``) and ``value``, for the
    covariates as they are, neither centred nor scaled.
    """
    names = list(coefficients)
    complete = materialise(_complete(df, names, duration, censor))
    base = _ordered(complete)
    value, gradient, hessian = _evaluate(base, np.array(list(coefficients.values()), dtype=float))
    base.unpersist()
    release(complete)
    rows = [("loglik", value)]
    rows += [(f"g:{a}", float(g)) for a, g in zip(names, gradient)]
    rows += [
        (f"h:{a}:{b}", float(hessian[i, j]))
        for i, a in enumerate(names)
        for j, b in enumerate(names)
        if j <= i
    ]
    return df.sparkSession.createDataFrame(rows, "term string, value double")


def cox_hazard(
    df: DataFrame,
    coefficients: dict[str, float],
    duration: str = "AVAL",
    censor: str = "CNSR",
) -> DataFrame:
    """Breslow hazard steps (``time``, ``hazard``) at fixed coefficients."""
    complete = materialise(_complete(df, list(coefficients), duration, censor))
    base = _ordered(complete)
    hazard = materialise(_hazard(base, np.array(list(coefficients.values()), dtype=float)))
    base.unpersist()
    release(complete)
    return hazard


def model_at(
    df: DataFrame,
    coefficients: dict[str, float],
    duration: str = "AVAL",
    censor: str = "CNSR",
) -> CoxModel:
    """A model with given coefficients, of another study say, and this one's baseline hazard.

    The covariates are taken as they are, neither centred nor scaled; errors are unknown.
    """
    names = list(coefficients)
    beta = np.array(list(coefficients.values()), dtype=float)
    complete = materialise(_complete(df, names, duration, censor))
    base = _ordered(complete)
    value, gradient, _ = _evaluate(base, beta)
    hazard = materialise(_hazard(base, beta))
    times = materialise(complete.select("time").distinct())
    n, p = complete.count(), len(names)
    base.unpersist()
    release(complete)
    nothing = np.full(p, np.nan)
    aic, steepest = -2 * value + 2 * p, float(np.abs(gradient).max())
    return CoxModel(
        names, beta, nothing, np.zeros(p), value, aic, float("nan"), n, hazard, times, False, 0, steepest
    )


def _complete(df: DataFrame, covariates: Sequence[str], duration: str, censor: str) -> DataFrame:
    """``time``, ``event`` and covariates ``z0``, ``z1``, ... of the complete rows."""
    return df.select(
        nan_to_null(df, duration).cast("double").alias("time"),
        (1 - F.col(censor)).cast("int").alias("event"),
        *[nan_to_null(df, c).cast("double").alias(f"z{a}") for a, c in enumerate(covariates)],
    ).na.drop()


def fit_cox(
    df: DataFrame,
    covariates: Sequence[str] | None = None,
    duration: str = "AVAL",
    censor: str = "CNSR",
    penalizer: float = 0.1,
    max_iter: int = 30,
    tol: float = 1e-7,
) -> CoxModel:
    """Fit by Newton's method on complete rows, with Efron's handling of ties.

    Covariates default to all numeric columns but time and censoring flag. The
    objective is the partial log-likelihood minus ``n * penalizer / 2`` times the
    squared coefficients of the standardised covariates.
    """
    if covariates is None:
        covariates = [c for c in numeric_columns(df) if c not in (duration, censor)]
    covariates = list(covariates)
    p = len(covariates)
    if p == 0:
        raise ValueError("fit_cox needs at least one covariate")
    complete = materialise(_complete(df, covariates, duration, censor))
    row = complete.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f"z{a}").alias(f"m{a}") for a in range(p)],
        *[F.stddev_samp(f"z{a}").alias(f"s{a}") for a in range(p)],
    ).first()
    n = row["n"]
    means = np.array([row[f"m{a}"] for a in range(p)], dtype=float)
    spreads = np.array([row[f"s{a}"] or 1.0 for a in range(p)], dtype=float)
    centred = complete.withColumns(
        {f"z{a}": (F.col(f"z{a}") - float(means[a])) / float(spreads[a]) for a in range(p)}
    )
    base = _ordered(centred)

    beta = np.zeros(p)
    value, gradient, hessian = _evaluate(base, beta)
    converged = False
    for steps in range(max_iter + 1):
        penalised_gradient = gradient - n * penalizer * beta
        curvature = hessian - n * penalizer * np.eye(p)
        step = np.linalg.lstsq(-curvature, penalised_gradient, rcond=None)[0]
        if float(penalised_gradient @ step) / 2 < tol:
            converged = True
            break
        if steps == max_iter:
            break
        objective = value - n * penalizer / 2 * beta @ beta
        for _ in range(20):
            trial = beta + step
            outcome = _evaluate(base, trial)
            if outcome[0] - n * penalizer / 2 * trial @ trial >= objective - 1e-9 * abs(objective):
                break
            step = step / 2
        else:
            break  # no step improves the objective: stay where the fit is best
        beta, (value, gradient, hessian) = trial, outcome
    if not converged:
        warnings.warn(f"the Cox fit has not converged after {steps} steps", stacklevel=2)
    variance = np.linalg.pinv(-curvature)
    hazard = materialise(_hazard(base, beta))
    score = F.lit(0.0)
    for a in range(p):
        score = score + float(beta[a]) * F.col(f"z{a}")
    ranked = base.select("time", (1 - F.col("event")).alias("CNSR"), score.alias("score"))
    index = concordance(ranked, "score", "time", "CNSR").first()["concordance"]
    times = materialise(complete.select("time").distinct())
    base.unpersist()
    release(complete)
    return CoxModel(
        covariates,
        beta / spreads,
        np.sqrt(np.diag(variance)) / spreads,
        means,
        value,
        -2 * value + 2 * p,
        float("nan") if index is None else index,
        n,
        hazard,
        times,
        converged,
        steps,
        float(np.abs(penalised_gradient).max()),
    )
