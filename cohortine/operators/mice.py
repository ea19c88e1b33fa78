"""Chained-equation imputation, one regression after another.

The state is a table of two arrays: a constant and the centred values, with every missing
cell at its current estimate, and which cells are missing. A regression takes one
narrow pass over it: every task adds up the moment matrix of its rows, and one number
per matrix cell reaches the driver. The estimates found in a round are written into the
state once, at its end, so a pass never repeats the work of earlier rounds. The number
of jobs is (incomplete columns + 1) per round, whatever the patterns of missing cells.

An estimate is linear in the row's constant and observed values, by the same weights for all
rows with the same missing cells. So many such rows are replaced, once and before the rounds, by
the triangle of their QR decomposition: at most one row per observed value and one for the
constant, with the same moments now and after every regression. Rows whose pattern is rare
stay as they are; the state never has more rows than the input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import nan_to_null
from ..session import materialise, release
from .impute import clean, resolve_columns

_STATE = "filled array<double>, missing array<boolean>"
#: Cells that a task holds when it condenses rows.
_HELD_CELLS = 1 << 20


@dataclass
class _Step:
    """Regression of one column on all others, in mean-centred units."""

    target: int
    intercept: float
    weights: np.ndarray  # weight 0 at the target itself


def _bayesian_ridge(moments: np.ndarray, target: int) -> _Step:
    """Ridge regression with noise and weight precision found by evidence
    maximisation (MacKay 1992), from the moment matrix of (1, columns)."""
    size = moments.shape[0] - 1
    others = [i for i in range(size) if i != target]
    n = moments[0, 0]
    if n == 0 or not others:
        return _Step(target, 0.0, np.zeros(size))
    mean = moments[0, 1:] / n
    scatter = moments[1:, 1:] - n * np.outer(mean, mean)
    gram = scatter[np.ix_(others, others)]
    cross = scatter[others, target]
    total = max(scatter[target, target], 0.0)
    tiny = 1e-6
    noise = 1.0 / (total / n + np.finfo(float).eps)
    prior = 1.0
    # Solve in unit-diagonal scale: the columns' units may differ widely.
    previous = None
    weights = np.zeros(len(others))
    for _ in range(300):
        ridge = gram + np.eye(len(others)) * (prior / noise)
        scale = 1.0 / np.sqrt(np.maximum(np.diag(ridge), np.finfo(float).tiny))
        inverse = np.linalg.pinv(ridge * np.outer(scale, scale)) * np.outer(scale, scale)
        weights = inverse @ cross
        residual = max(total - 2 * weights @ cross + weights @ gram @ weights, 0.0)
        effective = float(np.trace(gram @ inverse))
        prior = (effective + 2 * tiny) / (weights @ weights + 2 * tiny)
        noise = (n - effective + 2 * tiny) / (residual + 2 * tiny)
        if previous is not None and np.abs(previous - weights).sum() < 1e-3:
            break
        previous = weights
    full = np.zeros(size)
    full[others] = weights
    return _Step(target, float(mean[target] - mean @ full), full)


def _apply_steps(
    values: np.ndarray, missing: np.ndarray, steps: Sequence[_Step], constant: np.ndarray
) -> np.ndarray:
    """Run the regressions in turn over ``values``, changing its missing cells in place."""
    for step in steps:
        rows = missing[:, step.target]
        if rows.any():
            estimate = step.intercept * constant[rows] + values[rows] @ step.weights
            values[rows, step.target] = estimate
    return values


def _matrices(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Constants with values, and missing flags, of a batch of the state, one line per row."""
    filled = batch.column(0).flatten().to_numpy(zero_copy_only=False)
    missing = batch.column(1).flatten().to_numpy(zero_copy_only=False)
    return filled.reshape(-1, size + 1).copy(), missing.reshape(-1, size)


def _state_batch(filled: np.ndarray, missing: np.ndarray) -> pa.RecordBatch:
    arrays = []
    for matrix in (filled, missing):
        offsets = pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1])
        arrays.append(pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel())))
    return pa.RecordBatch.from_arrays(arrays, names=["filled", "missing"])


def _triangles(filled: np.ndarray, missing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of every pattern of missing cells replaced by fewer ones with the same moments.

    The missing cells must stand at the column means, which are zero.
    """
    patterns, which = np.unique(np.packbits(missing, axis=1), axis=0, return_inverse=True)
    order = np.argsort(which.ravel(), kind="stable")
    ends = np.cumsum(np.bincount(which.ravel(), minlength=len(patterns)))
    rows, flags = [], []
    for part in np.split(order, ends[:-1]):
        flag = missing[part[0]]
        known = np.concatenate([[True], ~flag])
        block = filled[part]
        if len(part) > known.sum():
            triangle = np.linalg.qr(block[:, known], mode="r")
            block = np.zeros((len(triangle), filled.shape[1]))
            block[:, known] = triangle
        rows.append(block)
        flags.append(np.repeat(flag[None], len(block), axis=0))
    return np.concatenate(rows), np.concatenate(flags)


def _condensed(state: DataFrame, size: int) -> DataFrame:
    """The first state in as few rows as its patterns of missing cells allow, in bounded memory."""
    most = max(_HELD_CELLS // (size + 1), 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(_matrices(batch, size))
            n += batch.num_rows
            if n >= most:
                held = [_triangles(*(np.concatenate(part) for part in zip(*held)))]
                n = len(held[0][0])
                if 2 * n > most:  # most patterns are rare here
                    yield _state_batch(*held[0])
                    held, n = [], 0
        if held:
            yield _state_batch(*_triangles(*(np.concatenate(part) for part in zip(*held))))

    # Within the tasks first, so that a frequent pattern is a few rows when it is shuffled.
    once = state.mapInArrow(run, _STATE)
    return once.repartition("missing").mapInArrow(run, _STATE)


def _moments(state: DataFrame, size: int, target: int, steps: Sequence[_Step]) -> np.ndarray:
    """Moment matrix of (1, values) over the rows that have ``target``, after ``steps``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            rows, missing = _matrices(batch, size)
            known = ~missing[:, target]
            rows = rows[known]
            _apply_steps(rows[:, 1:], missing[known], steps, rows[:, 0])
            total += rows.T @ rows
        cells = total.ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)],
            names=["cell", "value"],
        )

    sums = (
        state.mapInArrow(run, "cell int, value double")
        .groupBy("cell")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    flat = np.zeros((size + 1) ** 2)
    for row in sums:
        flat[row["cell"]] = row["value"]
    return flat.reshape(size + 1, size + 1)


def _advance(state: DataFrame, size: int, steps: Sequence[_Step]) -> DataFrame:
    """The state after a round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, missing = _matrices(batch, size)
            _apply_steps(rows[:, 1:], missing, steps, rows[:, 0])
            yield _state_batch(rows, missing)

    return state.mapInArrow(run, _STATE)


class ChainedImputer:
    """Impute each incomplete column by regression on all other columns, in rounds.

    Rounds start from the column means and visit the columns from fewest to most
    missing values. They stop after ``max_iter`` rounds, or once no standardised
    regression weight changes by more than ``tol``. The result is deterministic.
    """

    def __init__(
        self, max_iter: int = 10, tol: float = 1e-3, columns: Sequence[str] | None = None
    ):
        self.max_iter = max_iter
        self.tol = tol
        self.columns = columns
        self.fitted: list[str] | None = None
        self.rounds = 0

    def fit(self, df: DataFrame) -> ChainedImputer:
        columns = resolve_columns(df, self.columns)
        data = clean(df, columns).select(*[F.col(c).cast("double").alias(c) for c in columns])
        row = data.agg(
            F.count(F.lit(1)).alias("__n"),
            *[F.count(c).alias(f"__n_{c}") for c in columns],
            *[F.avg(c).alias(c) for c in columns],
        ).first()
        # A column without any value takes no part and stays NULL.
        self.fitted = [c for c in columns if row[f"__n_{c}"] > 0]
        self.means = np.array([row[c] for c in self.fitted], dtype=float)
        missing = {i: row["__n"] - row[f"__n_{c}"] for i, c in enumerate(self.fitted)}
        incomplete = sorted((i for i in missing if missing[i] > 0), key=lambda i: (missing[i], i))
        size = len(self.fitted)
        self.steps: list[_Step] = []
        if not incomplete:
            return self
        first = data.select(
            F.array(
                F.lit(1.0),
                *[
                    F.coalesce(F.col(c) - float(m), F.lit(0.0))
                    for c, m in zip(self.fitted, self.means)
                ],
            ).alias("filled"),
            F.array(*[F.col(c).isNull() for c in self.fitted]).alias("missing"),
        )
        state = materialise(_condensed(first, size))
        previous: dict[int, np.ndarray] = {}
        for self.rounds in range(1, self.max_iter + 1):
            change = 0.0
            found: list[_Step] = []
            for target in incomplete:
                matrix = _moments(state, size, target, found)
                step = _bayesian_ridge(matrix, target)
                found.append(step)
                spread = np.sqrt(np.maximum(np.diag(matrix)[1:] / max(matrix[0, 0], 1), 1e-300))
                standard = step.weights * spread / spread[target]
                change = max(change, np.abs(standard - previous.get(target, 0.0)).max(initial=0.0))
                previous[target] = standard
            self.steps += found
            if change < self.tol or self.rounds == self.max_iter:
                break
            following = materialise(_advance(state, size, found))
            release(state)
            state = following
        release(state)
        return self

    def _filler(self):
        columns, steps, means = list(self.fitted), list(self.steps), self.means
        schema = T.StructType([T.StructField(c, T.DoubleType()) for c in columns])

        @F.pandas_udf(schema)
        def fill(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            for part in parts:
                values = np.column_stack([np.asarray(s, dtype=float) for s in part]) - means
                missing = np.isnan(values)
                values[missing] = 0.0
                _apply_steps(values, missing, steps, np.ones(len(values)))
                yield pd.DataFrame(values + means, columns=columns)

        return fill

    def transform(self, df: DataFrame) -> DataFrame:
        if self.fitted is None:
            raise RuntimeError("ChainedImputer must be fitted before calling transform().")
        if not self.steps:
            return df
        # A new row starts at the means like the fitted ones, so it runs through the steps
        # of all rounds: a fixed number of vector operations for a whole batch.
        fill = self._filler()
        inputs = [nan_to_null(df, c).cast("double") for c in self.fitted]
        filled = df.withColumn("__filled", fill(*inputs))
        # Observed cells are kept as they are, not passed through the centring.
        return filled.withColumns(
            {
                c: F.coalesce(nan_to_null(df, c).cast("double"), F.col("__filled")[c])
                for c in self.fitted
            }
        ).drop("__filled")

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)
