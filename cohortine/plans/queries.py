"""The registered queries: every operator over the whole study tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import word_count
from ..operators import (
    adam,
    autoencoder,
    concordance,
    conformance,
    cox,
    impute,
    metadata,
    protocol,
    sdtm,
    signals,
    summaries,
    survival,
    tables,
)
from ..operators.mice import ChainedImputer
from ..operators.neural import NeuralImputer
from ..operators.numbering import number_rows
from ..session import materialise, spread
from ..sources import protocols
from ..sources import study_tables as study
from .oracles_fits import SCALES, WIDE, wide_columns

ARMS = ("Drug X", "Placebo")
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared inputs; sequence numbers are only assigned where a query shows them ----


def _dm(spark, d, orders=study.DATE_ORDERS):
    raw = study.raw_demographics(spark, d)
    return sdtm.map_domain(sdtm.DEMOGRAPHICS, raw, study.STUDY_ID, date_orders=orders)


def _ae(spark, d, order_by=None, orders=study.DATE_ORDERS):
    raw = study.raw_adverse_events(spark, d)
    return sdtm.map_domain(
        sdtm.ADVERSE_EVENTS, raw, study.STUDY_ID, order_by, date_orders=orders
    )


def _lb(spark, d, order_by=None, keep=()):
    raw = study.raw_laboratory(spark, d)
    return sdtm.map_domain(
        sdtm.LABORATORY, raw, study.STUDY_ID, order_by, keep, study.DATE_ORDERS
    )


def _vs(spark, d, order_by=None):
    raw = study.raw_vital_signs(spark, d)
    return sdtm.map_domain(
        sdtm.VITAL_SIGNS, raw, study.STUDY_ID, order_by, date_orders=study.DATE_ORDERS
    )


def _ex(spark, d, order_by=None):
    raw = study.raw_exposure(spark, d)
    return sdtm.map_domain(
        sdtm.EXPOSURE, raw, study.STUDY_ID, order_by, date_orders=study.DATE_ORDERS
    )


def _adsl(spark, d):
    return adam.subject_level(_dm(spark, d))


def _safety(spark, d):
    """Adverse-event analysis and subject-level datasets."""
    adsl = _adsl(spark, d)
    return adam.adverse_event_analysis(_ae(spark, d), adsl), adsl


def _os(spark, d):
    return adam.overall_survival(_adsl(spark, d), study.os_events(spark, d))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in names})


# --- tabulation domains -------------------------------------------------------------


@query
def sdtm_dm(spark, d):
    """A day-first and a month-first column, each settled by its own values."""
    return _dm(spark, d, orders=None)


@query
def sdtm_ae(spark, d):
    return _ae(spark, d, study.LINE_KEYS, orders=None)


@query
def sdtm_lb(spark, d):
    return _lb(spark, d, study.LINE_KEYS)


@query
def sdtm_vs(spark, d):
    return _vs(spark, d, ("event_id",))


@query
def sdtm_ex(spark, d):
    return _ex(spark, d, ("o_orderkey",))


@query
def sdtm_controlled_terms(spark, d):
    terms = {"AUTOMOBILE": "OTHER", "MACHINERY": "OTHER", "BUILDING": "MULTIPLE"}
    return sdtm.apply_terms(_dm(spark, d), "RACE", terms).select("USUBJID", "RACE")


def _defective_ae(spark, d):
    """Adverse events without sequence and decoded term, with damaged keys."""
    return (
        _ae(spark, d)
        .withColumns(
            {
                "STUDYID": F.when(F.col("AESEV") != "FATAL", F.col("STUDYID")),
                "DOMAIN": F.when(F.col("AESEV") == "UNKNOWN", "XX").otherwise(F.col("DOMAIN")),
                "USUBJID": F.when(
                    F.col("AEOUT") == "FATAL", F.replace("USUBJID", F.lit("-"), F.lit("_"))
                ).otherwise(F.col("USUBJID")),
            }
        )
        .drop("AEDECOD")
    )


@query
def sdtm_validate(spark, d):
    return conformance.validate(_defective_ae(spark, d), sdtm.ADVERSE_EVENTS)


@query
def sdtm_validate_summary(spark, d):
    return conformance.validation_summary(_defective_ae(spark, d), sdtm.ADVERSE_EVENTS)


@query
def sdtm_duplicates(spark, d):
    return conformance.duplicate_keys(_ae(spark, d), ["USUBJID", "AEDECOD", "AESEV"])


# --- metadata -----------------------------------------------------------------------


def _domains(spark, d):
    def described(df: DataFrame, domain) -> DataFrame:
        # Metadata only counts records, so the sequence needs no values here.
        return df.withColumn(domain.sequence, F.lit(0).cast("bigint"))

    return {
        "DM": _dm(spark, d),
        "AE": described(_ae(spark, d), sdtm.ADVERSE_EVENTS),
        "LB": described(_lb(spark, d), sdtm.LABORATORY),
        "VS": described(_vs(spark, d), sdtm.VITAL_SIGNS),
        "EX": described(_ex(spark, d), sdtm.EXPOSURE),
    }


@query
def define_variables(spark, d):
    return metadata.variable_metadata(_domains(spark, d))


@query
def define_datasets(spark, d):
    return metadata.dataset_metadata(_domains(spark, d))


@query
def define_summary(spark, d):
    return metadata.study_summary(_domains(spark, d), study.STUDY_ID)


# --- analysis datasets --------------------------------------------------------------


@query
def adam_adsl(spark, d):
    return _adsl(spark, d)


@query
def adam_adae(spark, d):
    ae = _ae(spark, d, study.LINE_KEYS)
    return adam.adverse_event_analysis(ae, _adsl(spark, d), order_by=["AESEQ"])


@query
def adam_adtte_os(spark, d):
    return _os(spark, d)


@query
def adam_adtte_pfs(spark, d):
    return adam.progression_free_survival(_adsl(spark, d), study.pfs_response(spark, d))


@query
def adam_adtte_pfs_earliest(spark, d):
    response = study.pfs_response(spark, d)
    return adam.progression_free_survival(_adsl(spark, d), response, earliest=True)


@query
def adam_adlb(spark, d):
    lb = _lb(spark, d, study.LINE_KEYS)
    return _rounded(adam.laboratory_analysis(lb, _adsl(spark, d)), "PCHG")


# --- imputation ---------------------------------------------------------------------


def _impute_simple(spark, d, strategy):
    panel = study.lab_panel(spark, d)
    return _rounded(impute.SimpleImputer(strategy, study.PANEL).fit_transform(panel), *study.PANEL)


@query
def impute_mean(spark, d):
    return _impute_simple(spark, d, "mean")


@query
def impute_median(spark, d):
    return _impute_simple(spark, d, "median")


@query
def impute_mode(spark, d):
    return _impute_simple(spark, d, "most_frequent")


@query
def impute_regression(spark, d):
    panel = study.lab_panel(spark, d).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    filled = impute.regression_fill(panel, "l_extendedprice", "l_quantity")
    return filled.withColumn("l_extendedprice", F.round("l_extendedprice", 4))


def _spread_panel(spark, d):
    # The imputers below run Python per row.
    return spread(study.lab_panel(spark, d), *study.PANEL_KEYS)


@query
def impute_mice(spark, d):
    return ChainedImputer(columns=study.PANEL).fit_transform(_spread_panel(spark, d))


def _kept(panel: DataFrame, columns: Sequence[str], imputer) -> DataFrame:
    """Observed cells as they were, with counts of cells left missing or changed."""
    before = panel.withColumns({f"was_{c}": F.col(c) for c in columns})
    after = imputer.fit_transform(before)
    missing, changed = F.lit(0), F.lit(0)
    for c in columns:
        missing = missing + F.col(c).isNull().cast("bigint")
        same = F.col(f"was_{c}").isNull() | (F.col(c) == F.col(f"was_{c}"))
        changed = changed + (~same).cast("bigint")
    keys = [c for c in panel.columns if c not in columns]
    return after.select(
        *keys,
        *[F.col(f"was_{c}").alias(c) for c in columns],
        missing.alias("missing"),
        changed.alias("changed"),
    )


@query
def impute_mice_kept(spark, d):
    return _kept(_spread_panel(spark, d), study.PANEL, ChainedImputer(columns=study.PANEL))


@query
def impute_neural_kept(spark, d):
    return _kept(_spread_panel(spark, d), study.PANEL, NeuralImputer(columns=study.PANEL))


@query
def impute_mice_wide(spark, d):
    """Fourteen incomplete columns."""
    columns = [f"w{k}" for k in range(len(WIDE))]
    lines = study.table(spark, d, "lineitem").selectExpr(*study.PANEL_KEYS, *wide_columns())
    panel = spread(lines, *study.PANEL_KEYS)
    return _kept(panel, columns, ChainedImputer(columns=columns))


@query
def impute_neural(spark, d):
    imputer = NeuralImputer(columns=study.PANEL)
    return imputer.fit_transform(_spread_panel(spark, d))


@query
def impute_audit(spark, d):
    panel = study.lab_panel(spark, d)
    filled = impute.SimpleImputer("mean", study.PANEL).fit_transform(panel)
    return impute.missing_audit(panel, filled, study.PANEL)


# --- tables and listings ------------------------------------------------------------


@query
def tlf_demographics(spark, d):
    return tables.demographics(_adsl(spark, d), arms=ARMS).body


@query
def tlf_adverse_events(spark, d):
    return tables.adverse_events(*_safety(spark, d), arms=ARMS).body


@query
def tlf_lab_shift(spark, d):
    lb = _lb(spark, d, keep=study.LINE_KEYS)
    adlb = adam.laboratory_analysis(lb, _adsl(spark, d), order_by=study.LINE_KEYS)
    return tables.lab_shift(adlb, "ECONOMY", arms=ARMS, order_by=study.LINE_KEYS).body


WITH_TOTAL = (*ARMS, tables.TOTAL)


@query
def tlf_demographics_total(spark, d):
    return tables.demographics(_adsl(spark, d), arms=WITH_TOTAL).body


@query
def tlf_adverse_events_total(spark, d):
    return tables.adverse_events(*_safety(spark, d), arms=WITH_TOTAL).body


@query
def tlf_lab_shift_total(spark, d):
    lb = _lb(spark, d, keep=study.LINE_KEYS)
    adlb = adam.laboratory_analysis(lb, _adsl(spark, d), order_by=study.LINE_KEYS)
    return tables.lab_shift(adlb, "ECONOMY", arms=WITH_TOTAL, order_by=study.LINE_KEYS).body


@query
def tlf_subject_listing(spark, d):
    return tables.subject_listing(_adsl(spark, d)).body


# --- section summaries --------------------------------------------------------------


@query
def summary_demographics(spark, d):
    return summaries.demographics_summary(_adsl(spark, d))


@query
def summary_safety(spark, d):
    return summaries.safety_summary(*_safety(spark, d))


@query
def summary_top_terms(spark, d):
    return summaries.top_terms(_safety(spark, d)[0])


@query
def summary_tte(spark, d):
    return summaries.time_to_event_summary(_os(spark, d), "Overall Survival")


@query
def summary_payload(spark, d):
    adae, adsl = _safety(spark, d)
    times = adam.overall_survival(adsl, study.os_events(spark, d))
    return summaries.section_payload(adsl, adae, times, "OS")


# --- survival -----------------------------------------------------------------------


@query
def km_curve(spark, d):
    return _rounded(survival.km_curve(_os(spark, d)), "survival", "ci_lower", "ci_upper")


@query
def km_summary(spark, d):
    return survival.km_summary(survival.km_curve(_os(spark, d)))


@query
def logrank(spark, d):
    parts = survival.logrank_components(_os(spark, d), *ARMS)
    return _rounded(parts, "expected", "variance", "chi_square")


@query
def logrank_p(spark, d):
    parts = _rounded(survival.logrank_components(_os(spark, d), *ARMS), "chi_square")
    return survival.with_p_value(parts).select(F.round("p_value", 6).alias("p_value"))


@query
def survival_table(spark, d):
    return _rounded(survival.survival_table(survival.km_curve(_os(spark, d)), ARMS[0]), "survival")


def _cox_input(spark, d):
    adsl = _adsl(spark, d)
    subjects = adsl.select(
        "USUBJID", "AGE", F.when(F.col("SEX") == "M", 1).otherwise(0).alias("SEX_NUM")
    )
    times = adam.overall_survival(adsl, study.os_events(spark, d))
    times = times.select("USUBJID", "TRT01AN", "AVAL", "CNSR")
    return times.join(subjects, "USUBJID")


def _cox(spark, d):
    return cox.fit_cox(_cox_input(spark, d), ["AGE", "SEX_NUM", "TRT01AN"])


@query
def cox_ph(spark, d):
    return _cox(spark, d).summary(spark)


@query
def cox_fit(spark, d):
    return _cox(spark, d).fit_statistics(spark)


_FIXED = {"AGE": 0.01, "SEX_NUM": -0.2, "TRT01AN": 0.1}


@query
def cox_components(spark, d):
    parts = cox.cox_components(_cox_input(spark, d), _FIXED)
    return parts.withColumn("value", F.round("value", 3))


@query
def cox_hazard(spark, d):
    return cox.cox_hazard(_cox_input(spark, d), _FIXED).withColumn("hazard", F.round("hazard", 9))


@query
def cox_gradient(spark, d):
    """The gradient of the likelihood at an unpenalised fit: zero."""
    names = list(_FIXED)
    model = cox.fit_cox(_cox_input(spark, d), names, penalizer=0.0)
    there = dict(zip(names, map(float, model.coefficients)))
    parts = cox.cox_components(_cox_input(spark, d), there).where("term LIKE 'g:%'")
    # Tiny values of either sign round to plain zero.
    return parts.select(
        F.substring("term", 3, 20).alias("covariate"),
        (F.round("value", 2) + F.lit(0.0)).alias("gradient"),
    )


@query
def cox_curves(spark, d):
    """Whole curves at fixed coefficients, named by the first subject that has them."""
    subjects = _cox_input(spark, d)
    found = cox.model_at(subjects, _FIXED).survival_curves(subjects)
    named = found.members.groupBy("pattern").agg(
        F.min("USUBJID").alias("USUBJID"), F.count(F.lit(1)).alias("subjects")
    )
    return _rounded(found.curves().join(named, "pattern").drop("pattern"), "survival")


@query
def cox_concordance(spark, d):
    result = concordance.concordance(_cox_input(spark, d), "AGE")
    return _rounded(result, "concordance")


@query
def cox_survival(spark, d):
    subjects = _cox_input(spark, d)
    model = cox.fit_cox(subjects, ["AGE", "SEX_NUM", "TRT01AN"])
    return model.predict_survival(subjects, times=[180, 365, 730, 1460])


# --- adverse-event signals ----------------------------------------------------------


@query
def ae_features(spark, d):
    return signals.subject_features(*_safety(spark, d))


@query
def ae_features_scaled(spark, d):
    features = signals.subject_features(*_safety(spark, d))
    scale = signals.scaling(features)
    return _rounded(signals.scaled(features, scale), *scale)


@query
def ae_signal_scores(spark, d):
    return signals.SignalDetector().fit_detect(*_safety(spark, d))


@query
def autoencoder_pass(spark, d):
    """Loss (place -1) and gradient of one pass at fixed weights of a linear network."""
    p = len(study.PANEL)
    shape = autoencoder.Shape.dense(p, p)
    weights = [(i + 1) / 10 - j / 20 for i in range(p) for j in range(p)] + [0.1] * p
    network = autoencoder.Network(shape, np.array(weights), np.zeros(0))
    rows = _spread_panel(spark, d).select(
        *[(F.col(c) / SCALES[c]).alias(c) for c in study.PANEL]
    )
    gradient, loss, _ = autoencoder.pass_sums(
        rows.na.drop(), list(study.PANEL), list(study.PANEL), network
    )
    values = [(i - 1, float(v)) for i, v in enumerate([loss, *gradient])]
    table = spark.createDataFrame(values, "place bigint, value double")
    return table.withColumn("value", F.round("value", 4))


@query
def autoencoder_normalised(spark, d):
    """What a fixed network with a normalised layer makes of every complete row."""
    p, hidden = len(study.PANEL), 3
    layers = (autoencoder.Layer(hidden, normalise=True), autoencoder.Layer(p, relu=False))
    weights = [(i + 1) / 10 - j / 20 for i in range(p) for j in range(hidden)] + [0.1] * hidden
    weights += [1 + j / 10 for j in range(hidden)] + [j / 20 for j in range(hidden)]
    weights += [(k + 1) / 10 - j / 20 for j in range(hidden) for k in range(p)] + [0.1] * p
    stats = [0.5] * hidden + [0.25 + j / 4 for j in range(hidden)]
    shape = autoencoder.Shape(p, layers)
    network = autoencoder.Network(shape, np.array(weights), np.array(stats))
    names = [f"r{k}" for k in range(p)]
    rows = _spread_panel(spark, d).na.drop(subset=list(study.PANEL))
    scaled = [F.col(c) / SCALES[c] for c in study.PANEL]
    rebuilt = rows.withColumn("r", autoencoder.reconstructor(network, names)(*scaled))
    return _rounded(rebuilt.select(*study.PANEL_KEYS, "r.*"), *names)


@query
def ae_signal_ranks(spark, d):
    """Flags and places in the ranking, given the errors."""
    flagged, _ = signals.flag_scores(_distances(spark, d))
    keyed = flagged.withColumn("fall", -F.round(signals.SCORE, 6))
    return number_rows(keyed, ["fall", "USUBJID"], "rank").select(
        "USUBJID", signals.FLAG, "rank"
    )


def _distances(spark, d):
    features = signals.subject_features(*_safety(spark, d))
    return materialise(signals.profile_distance(features))


@query
def ae_signal_flags(spark, d):
    flagged, _ = signals.flag_scores(_distances(spark, d))
    return _rounded(flagged, signals.SCORE)


@query
def ae_signal_summary(spark, d):
    return signals.signal_summary(*signals.flag_scores(_distances(spark, d)))


# --- protocol -----------------------------------------------------------------------


def _protocols(spark, d):
    return protocols.parse_protocols(study.protocol_documents(spark, d), "document")


@query
def protocol_metadata(spark, d):
    return _protocols(spark, d).select(
        "study_title",
        "protocol_number",
        "phase",
        "indication",
        "sponsor",
        *[F.array_join(c, " | ").alias(c) for c in protocols.ITEM_FIELDS],
        F.col("treatment_arms")[0]["dose"].alias("first_dose"),
        F.array_join(F.col("visit_schedule")[0]["assessments"], " | ").alias("assessments"),
        "raw_text_length",
    )


@query
def protocol_items(spark, d):
    return protocol.protocol_items(_protocols(spark, d))


@query
def protocol_word_counts(spark, d):
    items = protocol.protocol_items(_protocols(spark, d))
    words = word_count(F.col("endpoint")).cast("bigint")
    return items.select("protocol_number", "kind", "position", words.alias("words"))


@query
def protocol_mapping(spark, d):
    return protocol.map_items(protocol.protocol_items(_protocols(spark, d)))


@query
def protocol_mapping_rules(spark, d):
    """Items against a rule table with more rules than there are parts."""
    items, rules = study.measured_items(spark, d), study.keyword_rules(spark, d)
    return protocol.map_items(items, rules)


@query
def protocol_mapping_summary(spark, d):
    return protocol.mapping_summary(protocol_mapping(spark, d))
