"""DuckDB SQL for the exact parts of the fitted operators, at fixed coefficients or weights."""

from __future__ import annotations

from .oracles import _KM, _OS, _PANEL, _PANEL_KEYS, _SIGNAL, _with

_COX = ("AGE", "SEX_NUM", "TRT01AN")
_ETA = "0.01 * AGE - 0.2 * SEX_NUM + 0.1 * TRT01AN"


def _on(blocks: tuple[str, ...], more: str, body: str) -> str:
    """A query with the named blocks and further ones written out."""
    return _with(blocks, "").rstrip() + ",\n" + more + "\n" + body


def _cox_blocks() -> str:
    """Sums per time (s all, t tied) with those of the risk set (r), then one row per tie."""
    moments = {"0": "w"} | {a: f"w * {a}" for a in _COX}
    moments |= {f"{a}_{b}": f"w * {a} * {b}" for i, a in enumerate(_COX) for b in _COX[: i + 1]}
    sums = ", ".join(f"sum({m}) AS s{k}, sum(e * {m}) AS t{k}" for k, m in moments.items())
    risk = ", ".join(f"sum(s{k}) OVER (ORDER BY time DESC) AS r{k}" for k in moments)
    return f"""
    cx AS (
      SELECT CAST(AVAL AS DOUBLE) AS time, 1 - CNSR AS e, CAST(AGE AS DOUBLE) AS AGE,
        CAST(CASE WHEN SEX = 'M' THEN 1 ELSE 0 END AS DOUBLE) AS SEX_NUM,
        CAST(adsl.TRT01AN AS DOUBLE) AS TRT01AN
      FROM os JOIN adsl USING (USUBJID) WHERE AVAL IS NOT NULL AND AGE IS NOT NULL),
    cw AS (SELECT *, {_ETA} AS eta, exp({_ETA}) AS w FROM cx),
    per AS (
      SELECT time, CAST(sum(e) AS BIGINT) AS d, sum(e * eta) AS eta,
        {", ".join(f"sum(e * {a}) AS x{a}" for a in _COX)}, {sums}
      FROM cw GROUP BY time),
    risk AS (SELECT *, {risk} FROM per),
    ties AS (
      SELECT *, l / d AS f, r0 - l / d * t0 AS phi
      FROM (SELECT *, unnest(range(d)) AS l FROM risk WHERE d > 0))"""


def _components() -> str:
    rows = ["SELECT 'loglik' AS term, round(sum(eta / d - ln(phi)), 3) AS value FROM ties"]
    rows += [
        f"SELECT 'g:{a}', round(sum(x{a} / d - (r{a} - f * t{a}) / phi), 3) FROM ties"
        for a in _COX
    ]
    rows += [
        f"SELECT 'h:{a}:{b}', round(-sum((r{a}_{b} - f * t{a}_{b}) / phi"
        f" - (r{a} - f * t{a}) * (r{b} - f * t{b}) / phi ** 2), 3) FROM ties"
        for i, a in enumerate(_COX)
        for b in _COX[: i + 1]
    ]
    return _on(_OS, _cox_blocks(), "\nUNION ALL ".join(rows))


_HAZARD = _on(
    _OS, _cox_blocks(), "SELECT time, round(d / r0, 9) AS hazard FROM risk WHERE d > 0"
)

_CURVES = _on(
    _OS,
    _cox_blocks(),
    f"""
    SELECT USUBJID, subjects, time, round(exp(-total * exp({_ETA})), 6) AS survival
    FROM (SELECT time, sum(CASE WHEN d > 0 THEN d / r0 ELSE 0 END) OVER (ORDER BY time) AS total FROM risk),
      (SELECT AGE, SEX_NUM, TRT01AN, min(USUBJID) AS USUBJID, count(*) AS subjects
       FROM (SELECT USUBJID, AGE, CASE WHEN SEX = 'M' THEN 1 ELSE 0 END AS SEX_NUM, adsl.TRT01AN
             FROM os JOIN adsl USING (USUBJID))
       WHERE AGE IS NOT NULL GROUP BY 1, 2, 3)""",
)

# Simpson's rule for the error function at sqrt(x / 2), with 2000 steps.
_LOGRANK_P = """
    SELECT round(1 - 2 / sqrt(pi()) * a / 6000 * sum(
      CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END * exp(-((a * k / 2000) ** 2))
    ), 6) AS p_value
    FROM (SELECT sqrt(chi_square / 2) AS a FROM ({logrank})), range(2001) r(k) GROUP BY a"""

#: Scales of the panel's columns in the autoencoder check.
SCALES = {"l_quantity": 50.0, "l_extendedprice": 100_000.0, "l_discount": 0.1, "l_tax": 0.1}


def _autoencoder_pass() -> str:
    """Loss and gradient of a linear network: weight i, j is (i + 1) / 10 - j / 20, bias 0.1."""
    p = len(_PANEL)
    x = [f"{c} / {SCALES[c]}" for c in _PANEL]
    out = [
        " + ".join(f"x{i} * ({(i + 1) / 10} - {j / 20})" for i in range(p)) + " + 0.1"
        for j in range(p)
    ]
    blocks = f"""
    scaled AS (
      SELECT {", ".join(f"{e} AS x{i}" for i, e in enumerate(x))} FROM panel
      WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _PANEL)}),
    away AS (SELECT *, {", ".join(f"{o} - x{j} AS e{j}" for j, o in enumerate(out))} FROM scaled)"""
    squares = " + ".join(f"e{j} * e{j}" for j in range(p))
    rows = [f"SELECT CAST(-1 AS BIGINT) AS place, round(sum(({squares}) / {p}), 4) AS value FROM away"]
    rows += [
        f"SELECT {i * p + j}, round(sum(x{i} * 2 * e{j} / {p}), 4) FROM away"
        for i in range(p)
        for j in range(p)
    ]
    rows += [f"SELECT {p * p + j}, round(sum(2 * e{j} / {p}), 4) FROM away" for j in range(p)]
    return _on(("panel",), blocks, "\nUNION ALL ".join(rows))


def _normalised() -> str:
    """A layer of three, normalised with fixed statistics, and a linear one back to four."""
    p, hidden = len(_PANEL), 3
    z = [" + ".join(f"x{i} * ({(i + 1) / 10} - {j / 20})" for i in range(p)) for j in range(hidden)]
    y = [
        f"{1 + j / 10} * (greatest({e} + 0.1, 0) - 0.5) / sqrt({0.25 + j / 4} + 0.001) + {j / 20} AS y{j}"
        for j, e in enumerate(z)
    ]
    out = [
        " + ".join(f"y{j} * ({(k + 1) / 10} - {j / 20})" for j in range(hidden)) + " + 0.1"
        for k in range(p)
    ]
    blocks = f"""
    scaled AS (
      SELECT {_PANEL_KEYS}, {", ".join(f"{c} / {SCALES[c]} AS x{i}" for i, c in enumerate(_PANEL))}
      FROM panel WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _PANEL)}),
    hidden AS (SELECT *, {", ".join(y)} FROM scaled)"""
    columns = ", ".join(f"round({o}, 6) AS r{k}" for k, o in enumerate(out))
    return _on(("panel",), blocks, f"SELECT {_PANEL_KEYS}, {columns} FROM hidden")


#: Fourteen measurements made from the panel's four columns, as SQL both engines read.
WIDE = (
    "l_quantity", "l_extendedprice / 1000", "l_discount * 100", "l_tax * 100",
    "l_quantity + l_extendedprice / 1000", "l_quantity - l_discount * 100",
    "l_extendedprice / 1000 + l_tax * 100", "(l_discount + l_tax) * 100",
    "l_quantity * 0.5 + l_tax * 100", "l_extendedprice / 1000 - l_discount * 100",
    "l_quantity + (l_discount + l_tax) * 100", "l_extendedprice * 0.0003 + l_quantity",
    "l_tax * 100 - l_quantity * 0.1", "l_quantity * l_discount * 10",
)


def wide_columns() -> list[str]:
    shift = "l_orderkey * 7 + l_partkey * 3 + l_linenumber"
    return [
        f"CASE WHEN ({shift} + {3 * k}) % 11 <> 0 THEN {e} END AS w{k}"
        for k, e in enumerate(WIDE)
    ]


def _kept(columns: list[str], source: str) -> str:
    named = ", ".join(columns)
    return (
        f"SELECT {_PANEL_KEYS}, {named}, CAST(0 AS BIGINT) AS missing, "
        f"CAST(0 AS BIGINT) AS changed FROM {source}"
    )


def fit_oracles(logrank: str) -> dict[str, str]:
    wide = f"(SELECT {_PANEL_KEYS}, {', '.join(wide_columns())} FROM lineitem)"
    names = [f"w{k}" for k in range(len(WIDE))]
    return {
        "cox_components": _components(),
        "cox_hazard": _HAZARD,
        "cox_curves": _CURVES,
        "cox_gradient": "SELECT unnest(['AGE', 'SEX_NUM', 'TRT01AN']) AS covariate, CAST(0 AS DOUBLE) AS gradient",
        "autoencoder_pass": _autoencoder_pass(),
        "autoencoder_normalised": _normalised(),
        "impute_mice_kept": _with(("panel",), _kept(list(_PANEL), "panel")),
        "impute_neural_kept": _with(("panel",), _kept(list(_PANEL), "panel")),
        "impute_mice_wide": _kept(names, wide),
        "ae_signal_ranks": _with(
            _SIGNAL,
            """SELECT USUBJID, ANOMALY_FLAG, row_number() OVER (
               ORDER BY round(RECONSTRUCTION_ERROR, 6) DESC, USUBJID) AS rank FROM flagged""",
        ),
        "logrank_p": _LOGRANK_P.format(logrank=logrank),
        "survival_table": _with(
            _KM, "SELECT time, round(survival, 6) AS survival FROM km WHERE arm = 'Drug X'"
        ),
        "protocol_word_counts": _with(
            ("protocols", "items"),
            "SELECT protocol_number, kind, position, len(string_split(trim(endpoint), ' ')) AS words FROM items",
        ),
    }
