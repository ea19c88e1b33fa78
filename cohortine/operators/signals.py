"""Scoring of subjects by how unusual their adverse-event profile is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import mean_square
from ..session import materialise, release
from .autoencoder import Layer, Shape, normal, reconstructor, train, uniform
from .quantiles import exact_quantiles
from .tables import emergent

ID = "USUBJID"
SCORE = "RECONSTRUCTION_ERROR"
FLAG = "ANOMALY_FLAG"


def _system_feature(name: Column) -> Column:
    """Feature name of a body system: its first 20 characters, in capitals."""
    capitals = F.upper(F.replace(name, F.lit(" "), F.lit("_")))
    return F.concat(F.lit("SOC_"), F.substring(capitals, 1, 20))


def _kinds(adae: DataFrame, grade3plus: bool) -> dict[str, Column]:
    """Features that count events of a kind, for the columns the dataset has."""
    kinds = {}
    if "ATOXGR" in adae.columns:
        kinds |= {f"GRADE_{g}_N": F.count_if(F.col("ATOXGR") == g) for g in range(1, 6)}
        if grade3plus:
            kinds["GRADE_3PLUS_N"] = F.count_if(F.col("ATOXGR") >= 3)
    if "ASER" in adae.columns:
        kinds["SERIOUS_N"] = F.count_if(F.col("ASER") == "Y")
    if "AEREL" in adae.columns:
        kinds["RELATED_N"] = F.count_if(F.col("AEREL") == "Y")
    return kinds


def feature_counts(adae: DataFrame, grade3plus: bool = False) -> DataFrame:
    """Emergent events per (subject, body-system feature), from one pass over the events.

    The long form behind the profiles: it holds for any number of body systems. Columns:
    subject, ``feature`` (NULL without a body system), ``TOTAL_TEAE`` and the kinds.
    """
    feature = _system_feature(F.col("AEBODSYS")) if "AEBODSYS" in adae.columns else F.lit(None)
    return (
        emergent(adae)
        .where(F.col(ID).isNotNull())
        .groupBy(ID, feature.cast("string").alias("feature"))
        .agg(
            F.count(F.lit(1)).alias("TOTAL_TEAE"),
            *[count.alias(name) for name, count in _kinds(adae, grade3plus).items()],
        )
    )


def system_features(counts: DataFrame) -> list[str]:
    """The body-system features that occur, in order; read from the long counts."""
    rows = counts.select("feature").where("feature IS NOT NULL").distinct().collect()
    return sorted(row["feature"] for row in rows)


def subject_features(
    adae: DataFrame,
    adsl: DataFrame,
    systems: Sequence[str] | None = None,
    grade3plus: bool = False,
) -> DataFrame:
    """One row per subject: counts of emergent events by kind.

    Body systems that agree in their first 20 characters are added up. ``systems`` names
    the body systems to count apart; without it they are read from the written counts
    per subject and system, so the events are gone through once either way.
    """
    counts = feature_counts(adae, grade3plus)
    if systems is None:
        counts = materialise(counts)
        names = system_features(counts)
    else:
        given = [F.lit(s) for s in systems]
        named = adae.sparkSession.range(1).select(*[_system_feature(s) for s in given])
        names = sorted(set(named.first())) if given else []
    return widen(counts, adsl, names)


def widen(counts: DataFrame, adsl: DataFrame, systems: Sequence[str]) -> DataFrame:
    """The long counts as one row per subject; a column for each feature in ``systems``."""
    kinds = [c for c in counts.columns if c not in (ID, "feature", "TOTAL_TEAE")]
    per_system = F.map_from_entries(
        F.filter(
            F.collect_list(F.struct("feature", "TOTAL_TEAE")), lambda e: e["feature"].isNotNull()
        )
    )
    wide = counts.groupBy(ID).agg(
        F.sum("TOTAL_TEAE").alias("TOTAL_TEAE"),
        per_system.alias("__systems"),
        *[F.sum(c).alias(c) for c in kinds],
    )
    features = ["TOTAL_TEAE", *systems, *kinds]
    columns = {c: F.col(c) for c in features}
    columns |= {s: F.try_element_at("__systems", F.lit(s)) for s in systems}
    subjects = adsl.select(ID).where(F.col(ID).isNotNull()).distinct()
    return (
        subjects.join(wide, ID, "left")
        .select(ID, *[e.cast("double").alias(c) for c, e in columns.items()])
        .na.fill(0.0, features)
    )


def scaling(features: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and population SD per feature; a constant feature keeps its scale."""
    names = [c for c in features.columns if c != ID]
    row = features.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in names],
        *[F.stddev_pop(c).alias(f"sd_{c}") for c in names],
    ).first()
    return {c: (row[f"mean_{c}"], row[f"sd_{c}"] or 1.0) for c in names}


def scaled(features: DataFrame, scale: dict[str, tuple[float, float]]) -> DataFrame:
    """Standardised features."""
    return features.select(ID, *[((F.col(c) - m) / s).alias(c) for c, (m, s) in scale.items()])


def profile_distance(features: DataFrame) -> DataFrame:
    """Mean squared standardised feature per subject, a model-free score."""
    scale = scaling(features)
    values = scaled(features, scale)
    return values.select(ID, mean_square([F.col(c) for c in scale]).alias(SCORE))


def flag_scores(scores: DataFrame, contamination: float = 0.05) -> tuple[DataFrame, float]:
    """Flag scores above the interpolated ``1 - contamination`` quantile."""
    threshold = exact_quantiles(scores, [SCORE], 1 - contamination)[SCORE]
    return scores.withColumn(FLAG, F.col(SCORE) > F.lit(threshold)), threshold


def signal_summary(flagged: DataFrame, threshold: float) -> DataFrame:
    """Subject and anomaly counts, rate, threshold, mean and largest error."""
    rows, flags = F.count(F.lit(1)), F.count_if(F.col(FLAG))
    return flagged.agg(
        rows.alias("n_subjects"),
        flags.alias("n_anomalies"),
        F.round(100.0 * flags / rows, 1).alias("anomaly_rate"),
        F.round(F.lit(threshold), 4).alias("threshold"),
        F.round(F.avg(SCORE), 4).alias("mean_error"),
        F.round(F.max(SCORE), 4).alias("max_error"),
    )


class SignalDetector:
    """Autoencoder over subject profiles; a high reconstruction error is a signal.

    The body systems seen when fitting are kept: scoring new data ignores others
    and counts absent ones as zero.
    """

    def __init__(
        self,
        encoding_dim: int = 16,
        epochs: int = 100,
        contamination: float = 0.05,
        seed: int = 42,
        patience: int = 10,
        learning_rate: float = 0.003,
        batch_size: int = 16,
        replicas: int | None = None,
        dropout: float = 0.2,
    ):
        self.encoding_dim = encoding_dim
        self.epochs = epochs
        self.contamination = contamination
        self.seed = seed
        self.patience = patience
        self.learning_rate = learning_rate
        self.batch_size = batch_size
        self.replicas = replicas
        self.dropout = dropout
        self.network = None

    def fit_detect(self, adae: DataFrame, adsl: DataFrame) -> DataFrame:
        """Scores and flags of all subjects, highest error first."""
        counts = materialise(feature_counts(adae))
        self.systems = system_features(counts)
        features = materialise(widen(counts, adsl, self.systems))
        release(counts)
        self.scale = scaling(features)
        names = list(self.scale)
        key = [F.col(ID)]
        noisy = [
            (F.col(c) + 0.1 * normal(key, c, self.seed)).alias(f"x{i}") for i, c in enumerate(names)
        ]
        clean = [F.col(c).alias(f"y{i}") for i, c in enumerate(names)]
        held = (uniform(key, "hold", self.seed) < 0.1).alias("hold")
        slot = F.xxhash64(ID, F.lit(self.seed)).alias("slot")
        rows = materialise(scaled(features, self.scale).select(*noisy, *clean, held, slot))
        p = len(names)
        wide = max(32, 2 * p)
        self.network, self.history = train(
            rows,
            [f"x{i}" for i in range(p)],
            [f"y{i}" for i in range(p)],
            "hold",
            F.col("slot"),
            Shape(
                p,
                (
                    Layer(wide, dropout=self.dropout),
                    Layer(self.encoding_dim),
                    Layer(wide),
                    Layer(p, relu=False),
                ),
            ),
            self.epochs,
            self.patience,
            self.seed,
            self.learning_rate,
            self.batch_size,
            self.replicas,
        )
        scores = materialise(self._score(features))
        release(rows, features)
        flagged, self.threshold = flag_scores(scores, self.contamination)
        return flagged.orderBy(F.desc(SCORE), ID)

    def _score(self, features: DataFrame) -> DataFrame:
        names = list(self.scale)
        outputs = [f"r{i}" for i in range(len(names))]
        rebuilt = scaled(features, self.scale).withColumn(
            "__rebuilt",
            reconstructor(self.network, outputs)(*[F.col(c) for c in names]),
        )
        residuals = [F.col(c) - F.col("__rebuilt")[o] for c, o in zip(names, outputs)]
        return rebuilt.select(ID, mean_square(residuals).alias(SCORE))

    def reconstruct(self, adae: DataFrame, adsl: DataFrame) -> DataFrame:
        """Errors of new subjects under the fitted model."""
        if self.network is None:
            raise RuntimeError("Model must be trained first. Call fit_detect().")
        features = widen(feature_counts(adae), adsl, self.systems)
        absent = [c for c in self.scale if c not in features.columns]
        return self._score(features.withColumns({c: F.lit(0.0) for c in absent}))
