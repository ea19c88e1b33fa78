"""Autoencoder-based imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from ..session import materialise, release
from .autoencoder import Layer, Shape, reconstructor, train, uniform
from .impute import clean, resolve_columns
from .numbering import number_rows

_MIN_COMPLETE = 10


class NeuralImputer:
    """Fill missing cells with an autoencoder's reconstruction of the row.

    The network learns on complete rows, standardised, with a share of the cells
    masked to zero; it normalises batches in three layers and drops units in the first. Rows are
    numbered in the order of their values, and which cells are masked, which rows are held out
    and which replica a row trains depend on that number and the seed alone: not on the
    partitions, and equal rows are spread. When filling, a missing cell enters as
    zero in standardised units, that is as the column mean.
    """

    def __init__(
        self,
        encoding_dim: int = 64,
        epochs: int = 50,
        masking_fraction: float = 0.2,
        seed: int = 42,
        columns: Sequence[str] | None = None,
        patience: int = 5,
        learning_rate: float = 0.005,
        batch_size: int = 32,
        replicas: int | None = None,
        dropout: float = 0.2,
    ):
        self.encoding_dim = encoding_dim
        self.epochs = epochs
        self.masking_fraction = masking_fraction
        self.seed = seed
        self.columns = columns
        self.patience = patience
        self.learning_rate = learning_rate
        self.batch_size = batch_size
        self.replicas = replicas
        self.dropout = dropout
        self.network = None

    def fit(self, df: DataFrame) -> NeuralImputer:
        columns = resolve_columns(df, self.columns)
        complete = (
            clean(df, columns)
            .select(*[F.col(c).cast("double").alias(c) for c in columns])
            .na.drop()
        )
        row = complete.agg(
            F.count(F.lit(1)).alias("__n"),
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"sd_{c}") for c in columns],
        ).first()
        if row["__n"] < _MIN_COMPLETE:
            raise ValueError(
                f"NeuralImputer requires at least {_MIN_COMPLETE} complete-case rows. "
                f"Found {row['__n']}. Consider the simple or mice imputer."
            )
        self.scale = {c: (row[f"mean_{c}"], row[f"sd_{c}"] or 1.0) for c in columns}
        # Ordered by values first: equal rows may change places, which changes nothing.
        numbered = number_rows(
            complete.withColumn("__spot", F.monotonically_increasing_id()),
            [*columns, "__spot"],
            "__number",
        )
        key = [F.col("__number")]
        targets = {f"y{i}": (F.col(c) - m) / s for i, (c, (m, s)) in enumerate(self.scale.items())}
        inputs = {
            f"x{i}": F.when(
                uniform(key, f"mask{i}", self.seed) >= self.masking_fraction, targets[f"y{i}"]
            ).otherwise(0.0)
            for i in range(len(columns))
        }
        held = uniform(key, "hold", self.seed) < 0.1
        rows = materialise(
            numbered.select(
                *[e.alias(n) for n, e in {**inputs, **targets}.items()],
                held.alias("hold"),
                F.xxhash64(*key, F.lit(self.seed)).alias("slot"),
            )
        )
        self.network, self.history = train(
            rows,
            list(inputs),
            list(targets),
            "hold",
            F.col("slot"),
            self.shape(len(columns)),
            self.epochs,
            self.patience,
            self.seed,
            self.learning_rate,
            self.batch_size,
            self.replicas,
        )
        release(rows)
        return self

    def shape(self, p: int) -> Shape:
        """Layers for ``p`` columns: two down to the code and two up again."""
        wide, narrow = min(256, 4 * p), min(128, 2 * p)
        return Shape(
            p,
            (
                Layer(wide, normalise=True, dropout=self.dropout),
                Layer(narrow, normalise=True),
                Layer(self.encoding_dim),
                Layer(narrow, normalise=True),
                Layer(wide),
                Layer(p, relu=False),
            ),
        )

    def transform(self, df: DataFrame) -> DataFrame:
        if self.network is None:
            raise RuntimeError("NeuralImputer must be fitted before calling transform().")
        value = {c: nan_to_null(df, c).cast("double") for c in self.scale}
        scaled = [F.coalesce((value[c] - m) / s, F.lit(0.0)) for c, (m, s) in self.scale.items()]
        names = [f"r{i}" for i in range(len(scaled))]
        rebuilt = df.withColumn("__rebuilt", reconstructor(self.network, names)(*scaled))
        return rebuilt.withColumns(
            {
                c: F.coalesce(value[c], F.col("__rebuilt")[name] * s + m)
                for name, (c, (m, s)) in zip(names, self.scale.items())
            }
        ).drop("__rebuilt")

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)
