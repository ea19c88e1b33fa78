"""Quality classifier: Bradley-Terry ranking from preference pairs.

A document of label 1 is preferred to one of label 0. The score of a document is linear
in plain text statistics; the weights maximise the likelihood that the preferred
document of each pair wins, a logistic loss on feature differences. The cut is a
quantile of the scores of all labelled ids: the share of label 0 among them.

The weights are fitted on the driver from a bounded sample of labelled rows
(``max_labelled``, ``max_pairs``). One pass over all documents, whole and without a shuffle,
then gives each its raw score, which is kept. The cut comes from the kept scores of all
labelled ids, and places all of them between 0 and 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quantiles import exact_quantiles
from ..session import materialise, release
from .base import code_points, slices, utf8


def _classes() -> np.ndarray:
    """For each of 256 byte values, which of the byte classes it belongs to."""
    groups = (
        b"#*$%&<>{}[]^~=\\_@+`", b"|", b"!?", b".,;:", b"0123456789",
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n", b"()-'\"/",
    )
    table = np.zeros((256, len(groups) + 1))
    for k, group in enumerate(groups):
        table[list(group), k] = 1
    table[128:, -1] = 1
    return table


_CLASSES = _classes()


def text_features(text: bytes) -> np.ndarray:
    """Fixed statistics of one whole text; all zero for a text without a word."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(N_FEATURES)
    data = np.frombuffer(text, np.uint8)
    shares = np.bincount(data, minlength=256) @ _CLASSES / len(data)
    lengths = np.fromiter(map(len, words), np.int64, n)
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    counts = np.bincount(ids)
    triples = (ids[:-2] * 0x1F123BB5 + ids[1:-1]) * 0x1F123BB5 + ids[2:]
    lines = [line for line in text.split(b"\n") if line.strip()]
    first = np.fromiter((w[0] for w in words), np.uint8, n)
    last = np.fromiter((w[-1] for w in words), np.uint8, n)
    second = np.fromiter((w[1] if len(w) > 1 else 0 for w in words), np.uint8, n)
    upper = (first >= 65) & (first <= 90)
    plain_last = ((last | 32) >= 97) & ((last | 32) <= 122) | (last >= 128)
    raw = [
        *shares,
        (ids[1:] == ids[:-1]).mean() if n > 1 else 0.0,
        1 - len(np.unique(triples)) / len(triples) if n > 2 else 0.0,
        1 - len(set(lines)) / max(len(lines), 1),
        counts.max() / n,
        1 - len(counts) / n,
        (upper & (second >= 65) & (second <= 90)).mean(),
        upper.mean(),
        1 - plain_last.mean(),
        (lengths <= 3).mean(),
        (lengths >= 12).mean(),
    ]
    sizes = [
        np.log1p(n) / 10,
        np.log1p(code_points(data).sum() / n) / 3,
        np.log1p(n / max(len(lines), 1)) / 5,
        np.log1p(lengths.max()) / 5,
        lengths.std() / 10,
    ]
    raw_values = np.array(raw)
    return np.concatenate([raw_values, np.sqrt(raw_values), sizes, [1.0]])


N_FEATURES = len(text_features(b"a b"))


def fit_pairs(differences: np.ndarray, l2: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights w that maximise the sum of log sigmoid(w . d), less an l2 penalty.

    Newton steps on a concave function, halved while they do not improve it.
    """
    n, d = differences.shape
    w = np.zeros(d)

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, -differences @ w).mean() + 0.5 * l2 * w @ w)

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(differences @ w, -30, 30)))
        gradient = -(differences.T @ p) / n + l2 * w
        hessian = (differences.T * (p * (1 - p))) @ differences / n + l2 * np.eye(d)
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while loss(w - size * step) > now and size > 1e-6:
            size /= 2
        after = loss(w - size * step)
        if now - after < 1e-10:
            break
        w, now = w - size * step, after
    return w


@dataclass(frozen=True)
class QualityModel:
    """Score = sigmoid(w . standardised features - cut), moved so that the cut is at 0.3."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    #: Without labels of both kinds nothing is known, and nothing is rejected.
    known: bool = True
    threshold: float = 0.3

    def raw(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.known:
            return np.full(len(features), 0.5)
        shift = np.log(self.threshold / (1 - self.threshold))
        x = np.clip(self.raw(features) - self.cut, -30, 30) + shift
        return 1 / (1 + np.exp(-x))


def fit_model(
    features: np.ndarray, labels: np.ndarray, max_pairs: int = 40_000, seed: int = 7
) -> QualityModel:
    """Fit on labelled rows; the pairs are drawn evenly over the rows of each label.

    The cut is that of these rows alone; :func:`learn_quality` puts :func:`full_cut` there.
    """
    good, bad = features[labels == 1], features[labels == 0]
    if not len(good) or not len(bad):
        none = np.zeros(N_FEATURES)
        return QualityModel(none, none + 1, none, 0.0, known=False)
    mean = features.mean(axis=0)
    scale = features.std(axis=0)
    scale[scale < 1e-9] = 1.0
    good, bad = (good - mean) / scale, (bad - mean) / scale
    n = min(max_pairs, 8 * max(len(good), len(bad)))
    rng = np.random.default_rng(seed)
    won = np.resize(rng.permutation(len(good)), n)
    lost = np.concatenate([rng.permutation(len(bad)) for _ in range(n // len(bad) + 1)])[:n]
    weights = fit_pairs(good[won] - bad[lost])
    # The place between the scores on either side of the quantile.
    scores = np.sort(((features - mean) / scale) @ weights)
    k = int(np.clip(len(bad), 1, len(scores) - 1))
    return QualityModel(mean, scale, weights, float(scores[k - 1 : k + 1].mean()))


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into ``fold``; false for a null id."""
    key = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(F.pmod(key, F.lit(folds)) == fold, F.lit(False))


def usable_labels(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality"
) -> DataFrame:
    """One ``__label`` per ``__id`` outside the held-out fold that has a document.

    An id with both labels counts as 0.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .where(~held_out(id_col, 5, 0))
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.min(label_col).cast("int").alias("__label"))
    )
    present = docs.select(F.col(id_col).alias("__doc")).distinct()
    return known.join(present, F.col("__id") == F.col("__doc"), "left_semi")


def learn_weights(
    docs: DataFrame,
    usable: DataFrame,
    max_labelled: int = 20_000,
    max_pairs: int = 40_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> QualityModel:
    """A model whose cut is still that of the sample.

    At most ``max_labelled`` of the usable ids, the first by a hash of the id, reach the
    driver and are sent to the tasks, so the broadcast side of the join is bounded. An id
    with repeated rows counts once, by its least feature vector.
    """
    rank = F.xxhash64("__id")
    sample = usable.orderBy(rank, "__id").limit(max_labelled)
    chosen = docs.sparkSession.createDataFrame(sample.toArrow())
    texts = (
        docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
        .join(F.broadcast(chosen), "__id")
        .select("__id", "__label", "__text")
    )
    schema = "__id string, __label int, __features array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = [text_features(text) for text in utf8(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.string()),
                    batch.column(1),
                    pa.array(values, pa.list_(pa.float64())),
                ],
                names=["__id", "__label", "__features"],
            )

    # One row per id, so that an id with many rows crowds out no other.
    table = (
        texts.mapInArrow(run, schema)
        .groupBy("__id", "__label")
        .agg(F.min("__features").alias("__features"))
        .orderBy(rank, "__id")
        .toArrow()
    )
    features = np.array(table["__features"].to_pylist()).reshape(-1, N_FEATURES)
    return fit_model(features, table["__label"].to_numpy(), max_pairs)


def with_raw(
    docs: DataFrame, model: QualityModel, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (all by default) and the ``__raw`` score of every row.

    One pass over the texts; a column that is not kept does not come back from the tasks.
    """
    keep = docs.columns if keep is None else keep
    rows = docs.select(*dict.fromkeys([*keep, text_col]))
    place = rows.columns.index(text_col)
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("__raw", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            features = [text_features(text) for text in utf8(batch.column(place))]
            raw = model.raw(np.array(features).reshape(-1, N_FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(raw)], names=schema.names
            )

    return rows.mapInArrow(run, schema)


def full_cut(scored: DataFrame, usable: DataFrame, id_col: str = "doc_id") -> float:
    """The place between the scores on either side of the quantile, over all of ``usable``.

    An id with repeated rows counts once, by its least score.
    """
    least = (
        scored.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.min("__raw").alias("__raw"))
    )
    labelled = materialise(least.join(usable, "__id").select("__raw", "__label"))
    n, bad = labelled.agg(F.count(F.lit(1)), F.count_if(F.col("__label") == 0)).first()
    k = int(np.clip(bad, 1, n - 1))
    cut = exact_quantiles(labelled, ["__raw"], (k - 0.5) / (n - 1))["__raw"]
    release(labelled)
    return cut


def learn_quality(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = 20_000,
    max_pairs: int = 40_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> QualityModel:
    """A model from the labels outside the held-out fold, to be used on any documents.

    Rows with a null id or label, and labels without a document, are left out. The bound
    ``max_labelled`` is for the weights only: the cut covers all labelled ids that have a
    document. To score ``docs`` themselves, :func:`rank_quality` saves a pass over the texts.
    """
    usable = materialise(usable_labels(docs, labels, id_col, label_col))
    model = learn_weights(docs, usable, max_labelled, max_pairs, id_col, text_col)
    if model.known:
        scored = materialise(with_raw(docs, model, text_col, [id_col]))
        model = replace(model, cut=full_cut(scored, usable, id_col))
        release(scored)
    release(usable)
    return model


def _score(model: QualityModel) -> Column:
    """:meth:`QualityModel.score` of the kept raw score."""
    if not model.known:
        return F.lit(0.5)
    shift = float(np.log(model.threshold / (1 - model.threshold)))
    apart = F.least(F.greatest(F.col("__raw") - model.cut, F.lit(-30.0)), F.lit(30.0))
    return 1 / (1 + F.exp(-(apart + shift)))


def rank_quality(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = 20_000,
    max_pairs: int = 40_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """``id_col``, ``held_out``, ``score``, ``predicted`` for every row of ``docs``.

    The model is learned as by :func:`learn_quality`, but every text is read for its score
    once. A null text is scored as the empty text. Repeated rows and null ids give a row
    each; a null id is not held out. Without usable labels of both kinds every score is 0.5.
    Other columns are not read. An empty table gives no rows.
    """
    usable = materialise(usable_labels(docs, labels, id_col, label_col))
    model = learn_weights(docs, usable, max_labelled, max_pairs, id_col, text_col)
    scored = materialise(with_raw(docs, model, text_col, [id_col]))
    if model.known:
        model = replace(model, cut=full_cut(scored, usable, id_col))
    release(usable)
    return scored.select(
        id_col, held_out(id_col, 5, 0).alias("held_out"), _score(model).alias("score")
    ).withColumn("predicted", (F.col("score") >= model.threshold).cast("int"))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = 20_000,
    max_pairs: int = 40_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """The whole rows of ``docs`` that :func:`rank_quality` predicts as 1.

    The rows are written once beside their raw score, so texts are read for it once. Null
    texts, repeated rows and null ids are judged like any other row; an empty table
    gives no rows.
    """
    usable = materialise(usable_labels(docs, labels, id_col, label_col))
    model = learn_weights(docs, usable, max_labelled, max_pairs, id_col, text_col)
    scored = materialise(with_raw(docs, model, text_col))
    if model.known:
        model = replace(model, cut=full_cut(scored, usable, id_col))
    release(usable)
    return scored.where(_score(model) >= model.threshold).select(*docs.columns)


def score_texts(model: QualityModel, texts: list[bytes]) -> np.ndarray:
    return model.score(np.array([text_features(t) for t in texts]).reshape(-1, N_FEATURES))


def score_quality(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``held_out``, ``score``, ``predicted`` for every row of ``docs``.

    A null text is scored as the empty text. Repeated rows and null ids give a row each;
    a null id is not held out. Other columns are not read.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            score = score_texts(model, utf8(batch.column(2)))
            predicted = (score >= model.threshold).astype(np.int32)
            columns = [batch.column(0), batch.column(1), pa.array(score), pa.array(predicted)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(id_col, held_out(id_col, 5, 0).alias("__held_out"), text_col).mapInArrow(
        run, schema
    )


def keep_rows(
    batches: Iterator[pa.RecordBatch], place: int, keep: Callable[[list[bytes]], np.ndarray]
) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        yield batch.filter(pa.array(np.asarray(keep(utf8(batch.column(place))), bool)))


def filter_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model predicts as 1, with all their columns.

    A null text is judged as the empty text; repeated rows are alike; an empty table gives no
    rows.
    """

    def keep(texts: list[bytes]) -> np.ndarray:
        return score_texts(model, texts) >= model.threshold

    place = docs.columns.index(text_col)
    return docs.mapInArrow(partial(keep_rows, place=place, keep=keep), docs.schema)
