"""Data-parallel training of small networks with batch normalisation and dropout.

Rows are dealt into replicas by a hash that is unique per row, so equal rows spread like any
others. The number of replicas grows with the rows, one for every ``ROWS_PER_REPLICA`` of them,
and replicas of a small network are kept some to a part and take their steps side by
side, as one more axis of every array; a task holds several parts. A job starts all replicas from the same broadcast
state, lets them take Adam steps over their own mini-batches for one or more epochs, and
averages weights, moments and batch statistics by rows, in a tree before they reach the
driver. While the held-out loss falls fast, a job runs several epochs.

Dropout masks and the order of rows come from a counter-based generator keyed by seed and
part, with the epoch as its counter, so a part that is computed again gives the same state. The
result depends on the number of replicas, not on how rows or work are partitioned.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: One replica for so many rows; replicas of one part hold this many weights together.
ROWS_PER_REPLICA, PART_WEIGHTS, PART_REPLICAS = 2048, 1 << 16, 16
#: Parts of a task at most, one after another; a task each would mostly start and end tasks.
PARTS_PER_TASK = 16
#: Batch normalisation: added to variances, and what running statistics keep per step.
EPSILON, MOMENTUM = 1e-3, 0.97
#: Epochs of one job at most, and the fall of the loss per epoch above which it may have more.
MOST_EPOCHS, FAST = 4, 0.01
#: The loss must fall by this share within the jobs of the patience.
GAIN = 0.005
_FAN_IN = 64
_LOSS_ROWS = 512
_STATE = "state binary, train_n long, steps long, hold_loss double, train_loss double, hold_n long"


@dataclass(frozen=True)
class Layer:
    """A dense layer, then ReLU, batch normalisation and dropout as asked for."""

    units: int
    relu: bool = True
    normalise: bool = False
    dropout: float = 0.0


@dataclass(frozen=True)
class Shape:
    """Inputs and layers, and where the parts of each layer lie in the flat vectors."""

    inputs: int
    layers: tuple[Layer, ...]

    @staticmethod
    def dense(*sizes: int) -> Shape:
        """ReLU in between, linear at the end."""
        last = len(sizes) - 2
        return Shape(sizes[0], tuple(Layer(n, i < last) for i, n in enumerate(sizes[1:])))

    def places(self) -> list[tuple[int, int, int, int]]:
        """Of every layer its inputs and units, and where its weights and statistics begin."""
        out, fan_in, at, stat = [], self.inputs, 0, 0
        for layer in self.layers:
            out.append((fan_in, layer.units, at, stat))
            at += (fan_in + 1 + 2 * layer.normalise) * layer.units
            stat += 2 * layer.normalise * layer.units
            fan_in = layer.units
        return out

    @property
    def n_weights(self) -> int:
        fan_in, units, at, _ = self.places()[-1]
        return at + (fan_in + 1 + 2 * self.layers[-1].normalise) * units

    @property
    def n_stats(self) -> int:
        return self.places()[-1][3] + 2 * self.layers[-1].normalise * self.layers[-1].units


def _layer_parts(weights: np.ndarray, fan_in: int, units: int, at: int, normalise: bool):
    """Matrix, bias, gain and shift of a layer, with the axis of replicas in front."""
    m, end = len(weights), at + fan_in * units
    matrix = weights[:, at:end].reshape(m, fan_in, units)
    # Copied, so that those of all replicas lie together as rows of a block do.
    rest = [
        weights[:, end + i * units : end + (i + 1) * units].copy()[:, None, :]
        for i in range(3 if normalise else 1)
    ]
    return matrix, rest[0], *(rest[1:] if normalise else (None, None))


def _rows_first(m: int, n: int, units: int, dtype: np.dtype) -> np.ndarray:
    """Empty block of ``m`` replicas of ``n`` rows, in memory row by row.

    The same row of all replicas lies together, so that a parameter of each replica meets long
    runs and sums over rows add whole runs. What is computed from such a block lies like it.
    """
    return np.empty((n, m, units), dtype).transpose(1, 0, 2)


def _product(x: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    out = _rows_first(*x.shape[:2], matrix.shape[2], np.result_type(x, matrix))
    return np.matmul(x, matrix, out=out)


def run_forward(
    shape: Shape,
    weights: np.ndarray,
    stats: np.ndarray,
    x: np.ndarray,
    valid: np.ndarray | None = None,
    masks: Sequence[np.ndarray | None] | None = None,
) -> tuple[np.ndarray, list[tuple]]:
    """Outputs, and per layer what the way back needs. All arrays have an axis of replicas first.

    With ``valid`` (weights of the rows) normalisation uses the batch's own statistics, which
    come last in the notes of a layer; without, the running ones.
    """
    notes = []
    for i, (layer, (fan_in, units, at, stat)) in enumerate(zip(shape.layers, shape.places())):
        matrix, bias, gain, shift = _layer_parts(weights, fan_in, units, at, layer.normalise)
        h = _product(x, matrix)
        h += bias
        if layer.relu:
            np.maximum(h, 0, out=h)
        hat = inverse = mean = variance = None
        y = h
        if layer.normalise:
            if valid is None:
                mean = stats[:, None, stat : stat + units]
                variance = stats[:, None, stat + units : stat + 2 * units]
                centred = h - mean
            else:
                share = valid / np.maximum(valid.sum(axis=1, keepdims=True), 1)
                mean = share[:, None, :] @ h
                centred = h - mean
                variance = share[:, None, :] @ (centred * centred)
            inverse = 1 / np.sqrt(variance + np.asarray(EPSILON, h.dtype))
            hat = np.multiply(centred, inverse, out=centred)
            y = gain * hat
            y += shift
        mask = masks[i] if masks is not None else None
        if mask is not None:
            y = np.multiply(y, mask, out=y if layer.normalise else None)
        notes.append((x, h, hat, inverse, mask, mean, variance, matrix, gain))
        x = y
    return x, notes


def run_backward(
    shape: Shape, weights: np.ndarray, delta: np.ndarray, notes: list[tuple], valid: np.ndarray
) -> np.ndarray:
    """Gradient of the weights from that of the outputs (zero in rows that are not valid)."""
    m = len(weights)
    gradient = np.empty((m, shape.n_weights), delta.dtype)
    share = None
    delta = np.array(delta, order="K")  # changed in place from here on
    for layer, place, note in reversed(list(zip(shape.layers, shape.places(), notes))):
        fan_in, units, at, _ = place
        x, h, hat, inverse, mask, _, _, matrix, gain = note
        end = at + fan_in * units
        if mask is not None:
            delta *= mask
        if layer.normalise:
            if share is None:
                share = (valid / np.maximum(valid.sum(axis=1, keepdims=True), 1))[:, None, :]
            part = delta * hat
            gradient[:, end + units : end + 2 * units] = part.sum(axis=1)
            gradient[:, end + 2 * units : end + 3 * units] = delta.sum(axis=1)
            delta *= gain
            # Rows that are not valid have no part in the statistics.
            total = delta.sum(axis=1, keepdims=True)
            along = np.multiply(delta, hat, out=part).sum(axis=1, keepdims=True)
            np.multiply(hat, along, out=part)
            part += total
            part *= share.transpose(0, 2, 1)
            delta -= part
            delta *= inverse
        if layer.relu:
            delta *= (h > 0).astype(delta.dtype)
        into = gradient[:, at:end].reshape(m, fan_in, units)
        np.matmul(x.transpose(0, 2, 1), delta, out=into)
        gradient[:, end : end + units] = delta.sum(axis=1)
        if at:
            delta = _product(delta, matrix.transpose(0, 2, 1))
    return gradient


@dataclass
class Network:
    """A shape with its weights and the running statistics of its normalised layers."""

    shape: Shape
    weights: np.ndarray
    stats: np.ndarray

    @staticmethod
    def fresh(shape: Shape, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        weights, stats = np.zeros(shape.n_weights), np.zeros(shape.n_stats)
        for layer, (fan_in, units, at, stat) in zip(shape.layers, shape.places()):
            bound, end = np.sqrt(6.0 / (fan_in + units)), at + fan_in * units
            weights[at:end] = rng.uniform(-bound, bound, fan_in * units)
            if layer.normalise:
                weights[end + units : end + 2 * units] = 1.0
                stats[stat + units : stat + 2 * units] = 1.0
        return Network(shape, weights, stats)

    def output(self, x: np.ndarray) -> np.ndarray:
        return run_forward(self.shape, self.weights[None], self.stats[None], x[None])[0][0]

    def gradient(self, x: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
        """Summed gradient and summed loss (row mean of squared errors), all rows as one batch."""
        valid = np.ones((1, len(x)))
        out, notes = run_forward(self.shape, self.weights[None], self.stats[None], x[None], valid)
        error = out - target[None]
        delta = 2.0 * error / target.shape[1]
        parts = run_backward(self.shape, self.weights[None], delta, notes, valid)
        return parts[0], float((error**2).mean(axis=2).sum())


def uniform(key: Sequence[Column], salt: str, seed: int) -> Column:
    """Pseudo-random number in (0, 1) fixed by a row's key, a salt and a seed."""
    spread = F.xxhash64(*key, F.lit(salt), F.lit(seed))
    return (F.pmod(spread, F.lit(2**52)) + F.lit(0.5)) / F.lit(float(2**52))


def normal(key: Sequence[Column], salt: str, seed: int) -> Column:
    """Standard normal pseudo-random number (Box-Muller) fixed by a row's key."""
    radius = F.sqrt(-2.0 * F.log(uniform(key, salt + ":radius", seed)))
    return radius * F.cos(2.0 * np.pi * uniform(key, salt + ":angle", seed))


@dataclass
class _State:
    """Weights with the running moments of their gradients, and batch statistics."""

    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    stats: np.ndarray
    steps: int = 0


def replicas_for(rows: int) -> int:
    """Replicas that train on so many rows."""
    return max(1, -(-rows // ROWS_PER_REPLICA))


def _replicas_per_part(shape: Shape) -> int:
    return max(1, min(PART_REPLICAS, PART_WEIGHTS // shape.n_weights))


def tasks_for(spark: SparkSession, parts: int) -> int:
    """Tasks of a job over so many parts: a few per core, and more only for very many parts."""
    few = 4 * spark.sparkContext.defaultParallelism
    return min(parts, max(few, -(-parts // PARTS_PER_TASK)))


def deal(
    df: DataFrame,
    inputs: Sequence[str],
    targets: Sequence[str],
    hold: str,
    slot: Column,
    replicas: int,
    together: int,
) -> DataFrame:
    """One row per part: the packed rows of ``together`` replicas, dealt by ``slot`` and sorted.

    Parts are dealt evenly over :func:`tasks_for` of them. Kept in memory or on disk; lost parts are computed again from ``df``, which should be
    materialised.
    """
    p, q = len(inputs), len(targets)
    replica = F.pmod(F.col("__slot"), F.lit(replicas))
    dealt = (
        df.select(slot.alias("__slot"), F.col(hold).alias("__hold"), *_arrays(inputs, targets))
        .withColumn("__replica", replica.cast("int"))
        .withColumn("__part", F.expr(f"__replica div {together}").cast("int"))
        .repartitionById(tasks_for(df.sparkSession, -(-replicas // together)), "__part")
        .sortWithinPartitions("__part", "__replica", "__slot", "__x", "__y")
        .select("__part", "__replica", "__hold", "__x", "__y")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            parts = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                if end == start:
                    continue
                if held and parts[start] != last:
                    yield packed(last, held)
                    held = []
                last = int(parts[start])
                held.append(batch.slice(start, end - start))
        if held:
            yield packed(last, held)

    def packed(part: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        def joined(i: int) -> np.ndarray:
            return np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held])

        def matrix(i: int, width: int) -> np.ndarray:
            flat = np.concatenate([b.column(i).flatten().to_numpy() for b in held])
            return flat.astype(np.float32).reshape(-1, width)

        data = joined(1), joined(2).astype(bool), matrix(3, p), matrix(4, q)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([pickle.dumps(data)], pa.binary())],
            names=["part", "data"],
        )

    return dealt.mapInArrow(pack, "part int, data binary").persist(StorageLevel.MEMORY_AND_DISK)


def _arrays(inputs: Sequence[str], targets: Sequence[str]) -> list[Column]:
    return [
        F.array(*[F.col(c).cast("double") for c in names]).alias(alias)
        for alias, names in (("__x", inputs), ("__y", targets))
    ]


def pass_sums(
    df: DataFrame, inputs: Sequence[str], targets: Sequence[str], network: Network
) -> tuple[np.ndarray, float, int]:
    """Summed gradient, summed loss and rows of one pass at fixed weights.

    Only for networks without normalisation, whose gradient is a sum over rows.
    """
    if network.shape.n_stats:
        raise ValueError("the gradient of a normalised network is no sum over rows")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, loss, rows = np.zeros(len(network.weights)), 0.0, 0
        for batch in batches:
            x, y = (batch[list(c)].to_numpy(dtype=float) for c in (inputs, targets))
            step, more = network.gradient(x, y)
            total, loss, rows = total + step, loss + more, rows + len(batch)
        places = np.arange(-2, len(total))
        yield pd.DataFrame({"place": places, "value": [float(rows), loss, *total]})

    sums = (
        df.select(*dict.fromkeys([*inputs, *targets]))
        .mapInPandas(run, "place long, value double")
        .groupBy("place")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    values = {row["place"]: row["value"] for row in sums}
    gradient = np.array([values.get(i, 0.0) for i in range(len(network.weights))])
    return gradient, values.get(-1, 0.0), int(values.get(-2, 0))


def _side_by_side(replica: np.ndarray, x: np.ndarray, y: np.ndarray):
    """Rows (sorted by replica) as one block per replica, filled up; and which rows are real."""
    starts = np.flatnonzero(np.diff(replica, prepend=replica[:1] - 1))
    counts = np.diff(starts, append=len(replica))
    m, n = len(starts), int(counts.max(initial=0))
    blocks = [np.zeros((m, n, values.shape[1]), np.float32) for values in (x, y)]
    valid = np.zeros((m, n), np.float32)
    for i, (start, count) in enumerate(zip(starts, counts)):
        for block, values in zip(blocks, (x, y)):
            block[i, :count] = values[start : start + count]
        valid[i, :count] = 1
    return *blocks, valid, counts


def _kept_units(rng: np.random.Generator, m: int, n: int, layer: Layer) -> np.ndarray | None:
    """Dropout mask of a batch: 0, or what makes up for the units dropped."""
    if not layer.dropout:
        return None
    mask = _rows_first(m, n, layer.units, np.float32)
    kept = rng.random((m, n, layer.units), np.float32) >= layer.dropout
    return np.divide(kept, np.float32(1 - layer.dropout), out=mask)


def _adam(weights, first, second, gradient, steps, rate: float, on, buffers) -> None:
    """One step in place; ``on`` is 0 for replicas that stay, None where all move."""
    one, two = buffers
    np.subtract(gradient, first, out=one)
    one *= np.float32(0.1) if on is None else on * 0.1
    first += one
    np.multiply(gradient, gradient, out=one)
    one -= second
    one *= np.float32(0.001) if on is None else on * 0.001
    second += one
    t = np.maximum(steps, 1)[:, None]
    np.divide(second, (1 - 0.999**t).astype(np.float32), out=two)
    np.sqrt(two, out=two)
    two += np.float32(1e-8)
    np.divide(first, (1 - 0.9**t).astype(np.float32), out=one)
    one *= np.float32(rate) if on is None else on * np.float32(rate)
    one /= two
    weights -= one


def train_part(
    shape: Shape, state: _State, x, y, valid, batch_size: int, rate: float, key: Sequence[int], epochs: range
) -> _State:
    """Adam steps of the replicas of one part; arrays of the result have one row per replica."""
    m, n = valid.shape
    weights, first, second, stats = (
        np.repeat(v.astype(np.float32)[None], m, axis=0)
        for v in (state.weights, state.first, state.second, state.stats)
    )
    steps = np.full(m, state.steps)
    # Row by row, so that the rows of a batch lie together once they are in the order of an epoch.
    rows_x, rows_y = (np.ascontiguousarray(v.transpose(1, 0, 2)) for v in (x, y))
    buffers = np.empty_like(weights), np.empty_like(weights)
    for epoch in epochs:
        rng = np.random.Generator(np.random.Philox(key=list(key), counter=[0, 0, 0, epoch]))
        order = rng.permutation(n)
        dealt_x, dealt_y, dealt_valid = rows_x[order], rows_y[order], valid[:, order]
        for start in range(0, n, batch_size):
            batch = slice(start, start + batch_size)
            bx, by = (v[batch].transpose(1, 0, 2) for v in (dealt_x, dealt_y))
            real = dealt_valid[:, batch]
            counts = real.sum(axis=1)
            masks = [_kept_units(rng, m, bx.shape[1], layer) for layer in shape.layers]
            out, notes = run_forward(shape, weights, stats, bx, real, masks)
            size = (np.maximum(counts, 1) * y.shape[2])[:, None, None]
            delta = 2 * (out - by) * real[:, :, None] / size
            gradient = run_backward(shape, weights, delta, notes, real)
            # A replica without a row in this batch stays as it is.
            live = counts > 0
            steps += live
            on = None if live.all() else live[:, None].astype(np.float32)
            _adam(weights, first, second, gradient, steps, rate, on, buffers)
            share = np.float32(1 - MOMENTUM) if on is None else on * np.float32(1 - MOMENTUM)
            for layer, (_, units, _, stat), note in zip(shape.layers, shape.places(), notes):
                if layer.normalise:
                    seen = np.concatenate([note[5][:, 0], note[6][:, 0]], axis=1)
                    kept = stats[:, stat : stat + 2 * units]
                    kept += share * (seen - kept)
    return _State(weights, first, second, stats, int(steps.max(initial=state.steps)))


def _job(
    dealt: DataFrame, shape: Shape, state: _State, tasks: int, batch_size: int, rate: float,
    seed: int, epochs: range, with_train_loss: bool,
):
    """Row-weighted sum of the replicas' states, and losses at the starting weights."""
    shared = dealt.sparkSession.sparkContext.broadcast(state)
    width = 3 * shape.n_weights + shape.n_stats

    def losses(start: _State, x: np.ndarray, y: np.ndarray) -> float:
        each = np.empty(len(x))
        # Some rows at a time, which stay in the processor's cache.
        for at in range(0, len(x), _LOSS_ROWS):
            some = slice(at, at + _LOSS_ROWS)
            out, _ = run_forward(shape, start.weights[None], start.stats[None], x[None, some])
            each[some] = ((out[0] - y[some]) ** 2).mean(axis=1, dtype=np.float64)
        return float(each.sum())

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start: _State = shared.value
        total, rows = np.zeros(width), [0, 0, 0.0, 0.0, 0]
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                replica, held, x, y = pickle.loads(data.as_py())
                free = ~held
                hold_loss = losses(start, x[held], y[held])
                train_loss = losses(start, x[free], y[free]) if with_train_loss else 0.0
                n, steps = int(free.sum()), start.steps
                if n and len(epochs):
                    bx, by, valid, counts = _side_by_side(replica[free], x[free], y[free])
                    own = train_part(
                        shape, start, bx, by, valid, batch_size, rate, (seed, part), epochs
                    )
                    flat = np.concatenate([own.weights, own.first, own.second, own.stats], axis=1)
                    total += counts @ flat.astype(np.float64)
                    steps = own.steps
                rows = _added(rows, [n, steps, hold_loss, train_loss, int(held.sum())])
        yield _packed_state(total, rows)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(width), [0, 0, 0.0, 0.0, 0]
        for batch in batches:
            for row in batch.to_pylist():
                state, *numbers = row.values()
                total += np.frombuffer(state)
                rows = _added(rows, numbers)
        yield _packed_state(total, rows)

    partials = dealt.mapInArrow(partial, _STATE)
    while tasks > _FAN_IN:
        tasks = -(-tasks // _FAN_IN)
        partials = partials.repartition(tasks).mapInArrow(combine, _STATE)
    collected = partials.collect()
    shared.unpersist()
    total, rows = np.zeros(width), [0, 0, 0.0, 0.0, 0]
    for row in collected:
        total += np.frombuffer(row[0])
        rows = _added(rows, row[1:])
    return total, *rows


def _added(rows: Sequence, more: Sequence) -> list:
    """Rows, most steps, held-out loss, training loss, held-out rows of two parts."""
    return [
        rows[0] + more[0], max(rows[1], more[1]),
        rows[2] + more[2], rows[3] + more[3], rows[4] + more[4],
    ]


def _packed_state(state: np.ndarray, rows: Sequence) -> pa.RecordBatch:
    values = [pa.array([state.tobytes()], pa.binary())]
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())
    values += [pa.array([v], kind) for v, kind in zip(rows, kinds)]
    names = ["state", "train_n", "steps", "hold_loss", "train_loss", "hold_n"]
    return pa.RecordBatch.from_arrays(values, names=names)


def train(
    df: DataFrame,
    inputs: Sequence[str],
    targets: Sequence[str],
    hold: str,
    slot: Column,
    shape: Shape,
    epochs: int,
    patience: int,
    seed: int,
    learning_rate: float = 0.003,
    batch_size: int = 32,
    replicas: int | None = None,
) -> tuple[Network, list[float]]:
    """Fit the network; returns the best weights and the held-out losses, one per job.

    ``df`` should be materialised, and ``slot`` a hash of something unique per row. Rows with
    ``hold`` true are not trained on; training stops when their loss has not fallen by
    the share ``GAIN`` in ``patience`` jobs, which are of one epoch then. Without held-out rows the training loss decides. ``replicas`` is
    :func:`replicas_for` the rows unless given.
    """
    start = Network.fresh(shape, seed)
    zeros = np.zeros_like(start.weights)
    state = _State(start.weights, zeros, zeros, start.stats)
    n_rows, n_held = df.agg(F.count(F.lit(1)), F.count_if(hold)).first()
    if n_rows == n_held:
        raise ValueError("there are no rows to train on")
    replicas = replicas or replicas_for(n_rows)
    together = _replicas_per_part(shape)
    best, best_loss, mark, waited = start, np.inf, np.inf, 0
    history: list[float] = []
    done, stride, since = 0, 1, 0
    cuts = np.cumsum([len(zeros)] * 3)
    tasks = tasks_for(df.sparkSession, -(-replicas // together))
    dealt = deal(df, inputs, targets, hold, slot, replicas, together)
    try:
        while True:
            todo = range(done, min(done + stride, epochs))
            total, train_n, steps, hold_loss, train_loss, hold_n = _job(
                dealt, shape, state, tasks, batch_size, learning_rate, seed, todo, not n_held
            )
            loss = hold_loss / hold_n if hold_n else train_loss / train_n
            history.append(loss)
            if loss < best_loss:
                best, best_loss = Network(shape, state.weights, state.stats), loss
            waited += 1
            if loss < mark * (1 - GAIN):
                mark, waited = loss, 0
            if waited >= patience or not len(todo):
                break
            if since:
                fall = (history[-2] - loss) / max(abs(history[-2]), 1e-300) / since
                stride = min(2 * stride, MOST_EPOCHS) if fall > FAST else 1
            done, since = todo.stop, len(todo)
            state = _State(*np.split(total / train_n, cuts), steps)
    finally:
        dealt.unpersist()
    return best, history


def reconstructor(network: Network, names: Sequence[str]):
    """Pandas UDF from the input columns to a struct of reconstructed columns."""
    names = list(names)
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])

    @F.pandas_udf(schema)
    def reconstruct(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for part in parts:
            x = np.column_stack([np.asarray(s, dtype=float) for s in part])
            yield pd.DataFrame(network.output(x), columns=names)

    return reconstruct
