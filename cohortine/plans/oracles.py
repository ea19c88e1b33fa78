"""DuckDB SQL that computes the expected result of the registered queries.

Written from the definitions of the operators, with global windows and direct
joins where the Spark side has distributed forms.
"""

from __future__ import annotations

from ..functions.codelists import DATASET_LABELS, DATASET_STRUCTURES, VARIABLES

_LINE_KEYS = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate"
)
_USUBJID = "'STUDY-01-' || c_nationkey || '-' || {key}"

# Named building blocks; each query lists the ones it needs, in order.
_CTE = {
    "first_order": "SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS day FROM orders GROUP BY 1",
    "dm": f"""
        SELECT 'STUDY-01' AS STUDYID, 'DM' AS DOMAIN,
               CAST(c_custkey AS VARCHAR) AS SUBJID, CAST(c_nationkey AS VARCHAR) AS SITEID,
               {_USUBJID.format(key='c_custkey')} AS USUBJID,
               18 + c_custkey % 73 AS AGE, 'YEARS' AS AGEU,
               CASE c_custkey % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'F'
                                  WHEN 3 THEN 'M' ELSE 'U' END AS SEX,
               c_mktsegment AS RACE, 'UNKNOWN' AS ETHNIC,
               CASE WHEN c_custkey % 2 = 0 THEN 'DRUG_X' ELSE 'PLACEBO' END AS ARMCD,
               CASE WHEN c_custkey % 2 = 0 THEN 'Drug X' ELSE 'Placebo' END AS ARM,
               CASE WHEN c_custkey % 110 = 6 THEN NULL
                    ELSE strftime(day + 173, '%Y-%m-%d') END AS RFICDTC,
               CASE WHEN c_custkey % 110 = 6 THEN NULL
                    ELSE strftime(day + 180, '%Y-%m-%d') END AS RFSTDTC
        FROM customer LEFT JOIN first_order ON c_custkey = o_custkey""",
    "adsl": """
        SELECT dm.*, ARM AS TRT01P, CASE ARM WHEN 'Drug X' THEN 1 ELSE 2 END AS TRT01PN,
               ARM AS TRT01A, CASE ARM WHEN 'Drug X' THEN 1 ELSE 2 END AS TRT01AN,
               CASE WHEN AGE <= 64 THEN '<65' WHEN AGE <= 74 THEN '65-74' ELSE '>=75' END AS AGEGR1,
               CASE WHEN AGE <= 64 THEN 1 WHEN AGE <= 74 THEN 2 ELSE 3 END AS AGEGR1N,
               CAST(RFSTDTC AS DATE) AS TRTSDT, CAST(RFSTDTC AS TIMESTAMP) AS TRTSDTM,
               'Y' AS ITTFL, 'Y' AS SAFFL, 'Y' AS PPROTFL, 'Y' AS EVALFL
        FROM dm""",
    "lines": """
        SELECT * FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN customer ON o_custkey = c_custkey""",
    "ae": f"""
        SELECT 'STUDY-01' AS STUDYID, 'AE' AS DOMAIN,
               {_USUBJID.format(key='o_custkey')} AS USUBJID,
               upper(p_name) AS AETERM, upper(p_brand) AS AEDECOD, upper(p_type) AS AEBODSYS,
               CASE WHEN l_partkey % 110 = 6 THEN NULL
                    ELSE strftime(l_shipdate, '%Y-%m-%d') END AS AESTDTC,
               strftime(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER), '%Y-%m-%d') AS AEENDTC,
               CASE l_linenumber WHEN 1 THEN 'MILD' WHEN 2 THEN 'MODERATE' WHEN 3 THEN 'SEVERE'
                    WHEN 4 THEN 'LIFE-THREATENING' WHEN 5 THEN 'FATAL' ELSE 'UNKNOWN' END AS AESEV,
               CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS AESER,
               CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END AS AEREL,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'RECOVERED/RESOLVED'
                    WHEN '2-HIGH' THEN 'RECOVERED/RESOLVED'
                    WHEN '3-MEDIUM' THEN 'NOT RECOVERED/NOT RESOLVED'
                    WHEN '4-NOT SPECIFIED' THEN 'FATAL' ELSE 'UNKNOWN' END AS AEOUT,
               row_number() OVER (ORDER BY {_LINE_KEYS}) AS AESEQ
        FROM lines WHERE l_returnflag = 'R'""",
    "lb": f"""
        SELECT 'STUDY-01' AS STUDYID, 'LB' AS DOMAIN,
               {_USUBJID.format(key='o_custkey')} AS USUBJID,
               left(upper(p_type), 8) AS LBTESTCD, upper(p_type) AS LBTEST, 'CHEMISTRY' AS LBCAT,
               CAST(l_quantity AS VARCHAR) AS LBORRES, 'MG/DL' AS LBORRESU,
               l_quantity AS LBSTRESN, 'MG/DL' AS LBSTRESU, 10 AS LBSTNRLO, 40 AS LBSTNRHI,
               CASE WHEN l_quantity < 10 THEN 'LOW' WHEN l_quantity > 40 THEN 'HIGH'
                    ELSE 'NORMAL' END AS LBNRIND,
               strftime(l_shipdate, '%Y-%m-%d') AS LBDTC,
               CASE WHEN l_linenumber = 1 THEN 'BASELINE' ELSE 'WEEK ' || l_linenumber END AS VISIT,
               row_number() OVER (ORDER BY {_LINE_KEYS}) AS LBSEQ
        FROM lines WHERE l_returnflag <> 'R'""",
    "vs": f"""
        SELECT 'STUDY-01' AS STUDYID, 'VS' AS DOMAIN,
               {_USUBJID.format(key='user_id')} AS USUBJID,
               CASE event_type WHEN 'click' THEN 'HR' WHEN 'error' THEN 'SYSBP'
                    WHEN 'purchase' THEN 'WEIGHT' WHEN 'signup' THEN 'GRIP STR'
                    WHEN 'view' THEN 'BMI' END AS VSTESTCD,
               CASE event_type WHEN 'click' THEN 'HEART RATE' WHEN 'error' THEN 'SYSTOLIC BLOOD PRESSURE'
                    WHEN 'purchase' THEN 'WEIGHT' WHEN 'signup' THEN 'GRIP STRENGTH LEFT'
                    WHEN 'view' THEN 'BMI' END AS VSTEST,
               'SITTING' AS VSPOS, CAST(value AS VARCHAR) AS VSORRES, 'UNIT' AS VSORRESU,
               value AS VSSTRESN, 'UNIT' AS VSSTRESU, strftime(ts, '%Y-%m-%d') AS VSDTC,
               'DAY 1' AS VISIT, row_number() OVER (ORDER BY event_id) AS VSSEQ
        FROM events LEFT JOIN customer ON user_id = c_custkey""",
    "ex": f"""
        SELECT 'STUDY-01' AS STUDYID, 'EX' AS DOMAIN,
               {_USUBJID.format(key='o_custkey')} AS USUBJID,
               CASE WHEN o_custkey % 2 = 0 THEN 'DRUG X' ELSE 'PLACEBO' END AS EXTRT,
               o_totalprice AS EXDOSE, 'MG' AS EXDOSU, o_orderstatus AS EXROUTE,
               o_orderpriority AS EXDOSFRQ, strftime(o_orderdate, '%Y-%m-%d') AS EXSTDTC,
               strftime(CAST(o_orderdate AS DATE) + 21, '%Y-%m-%d') AS EXENDTC,
               'CYCLE 1 DAY 1' AS VISIT, row_number() OVER (ORDER BY o_orderkey) AS EXSEQ
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "adae": """
        SELECT ae.*, TRTSDT, TRT01A, TRT01AN, SAFFL, TRT01A AS TRTA, TRT01AN AS TRTAN,
               CAST(AESTDTC AS DATE) AS ASTDT, CAST(AEENDTC AS DATE) AS AENDT,
               date_diff('day', TRTSDT, CAST(AESTDTC AS DATE)) + 1 AS AESTDY,
               CASE WHEN CAST(AESTDTC AS DATE) >= TRTSDT THEN 'Y' ELSE '' END AS TRTEMFL,
               CASE AESEV WHEN 'MILD' THEN 1 WHEN 'MODERATE' THEN 2 WHEN 'SEVERE' THEN 3
                    WHEN 'LIFE-THREATENING' THEN 4 WHEN 'FATAL' THEN 5 ELSE 0 END AS ATOXGR,
               CASE WHEN AEREL = 'Y' THEN 'RELATED' ELSE 'NOT RELATED' END AS AREL,
               AESER AS ASER, AESEQ AS ASEQ
        FROM ae LEFT JOIN adsl USING (USUBJID)""",
    "teae": "SELECT * FROM adae WHERE TRTEMFL = 'Y'",
    "contacts": f"""
        SELECT c_custkey, {_USUBJID.format(key='c_custkey')} AS USUBJID, day + 180 AS start,
               (SELECT CAST(max(o_orderdate) AS DATE) FROM orders o WHERE o.o_custkey = c_custkey) AS last,
               (SELECT CAST(min(o_orderdate) AS DATE) FROM orders o WHERE o.o_custkey = c_custkey
                AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS urgent,
               (SELECT CAST(min(o_orderdate) AS DATE) FROM orders o WHERE o.o_custkey = c_custkey
                AND o_orderstatus = 'P' AND o_orderpriority = '2-HIGH'
                AND CAST(o_orderdate AS DATE) >= day + 180) AS progression
        FROM customer JOIN first_order ON c_custkey = first_order.o_custkey""",
    "os": """
        SELECT USUBJID, TRTSDT, TRT01A, TRT01AN,
               strftime(death, '%Y-%m-%d') AS death_date, strftime(last, '%Y-%m-%d') AS last_contact_date,
               'Overall Survival' AS PARAM, 'OS' AS PARAMCD,
               CASE WHEN death IS NULL THEN 1 ELSE 0 END AS CNSR, coalesce(death, last) AS ADT,
               date_diff('day', TRTSDT, coalesce(death, last)) AS AVAL, 'DAYS' AS AVALU,
               CASE WHEN death IS NULL THEN 'CENSORED' ELSE 'DEATH' END AS EVNTDESC,
               TRT01A AS TRTA, TRT01AN AS TRTAN
        FROM adsl LEFT JOIN (SELECT USUBJID, last, CASE WHEN urgent >= start THEN urgent END AS death
                             FROM contacts) USING (USUBJID)""",
    "panel": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CASE WHEN (k + 0) % 7 <> 0 THEN l_quantity END AS l_quantity,
               CASE WHEN (k + 1) % 7 <> 0 THEN l_extendedprice END AS l_extendedprice,
               CASE WHEN (k + 2) % 7 <> 0 THEN l_discount END AS l_discount,
               CASE WHEN (k + 3) % 7 <> 0 THEN l_tax END AS l_tax
        FROM (SELECT *, l_orderkey * 7 + l_partkey * 3 + l_linenumber AS k FROM lineitem)""",
    "km_counts": """
        SELECT TRTA AS arm, AVAL AS time, count(*) FILTER (CNSR = 0) AS d, count(*) AS left_n
        FROM os WHERE AVAL IS NOT NULL GROUP BY 1, 2
        UNION ALL
        SELECT TRTA, 0, 0, 0 FROM os GROUP BY 1 HAVING min(AVAL) > 0""",
    "km_risk": """
        SELECT *, sum(left_n) OVER (PARTITION BY arm ORDER BY time
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n FROM km_counts""",
    "km_sums": """
        SELECT *, max(CASE WHEN d = n THEN 1 ELSE 0 END) OVER w AS ended,
               sum(CASE WHEN d = n THEN 0 ELSE ln(1 - d / n) END) OVER w AS log_s,
               sum(CASE WHEN d = n THEN 0 ELSE d / (n * (n - d)) END) OVER w AS v
        FROM (SELECT arm, time, d, left_n, CAST(n AS DOUBLE) AS n FROM km_risk)
        WINDOW w AS (PARTITION BY arm ORDER BY time)""",
    "km": """
        SELECT arm, time, CAST(n AS BIGINT) AS n_risk, d AS n_event, left_n - d AS n_censored,
               CASE WHEN ended = 1 THEN 0 ELSE exp(log_s) END AS survival,
               CASE WHEN ended = 1 THEN NULL WHEN log_s = 0 THEN 1
                    ELSE exp(-exp(ln(-log_s) - 1.959963984540054 * sqrt(v) / log_s)) END AS ci_lower,
               CASE WHEN ended = 1 THEN NULL WHEN log_s = 0 THEN 1
                    ELSE exp(-exp(ln(-log_s) + 1.959963984540054 * sqrt(v) / log_s)) END AS ci_upper
        FROM km_sums""",
    "features": """
        SELECT USUBJID, CAST(count(term) AS DOUBLE) AS TOTAL_TEAE,
               {systems},
               {grades},
               CAST(count(*) FILTER (ASER = 'Y') AS DOUBLE) AS SERIOUS_N,
               CAST(count(*) FILTER (AEREL = 'Y') AS DOUBLE) AS RELATED_N
        FROM (SELECT DISTINCT USUBJID FROM adsl)
        LEFT JOIN (SELECT USUBJID, 1 AS term, AEBODSYS, ATOXGR, ASER, AEREL FROM teae) USING (USUBJID)
        GROUP BY 1""",
    "protocols": """
        SELECT 'Study of compound ' || o_custkey AS study_title, 'P-' || o_orderkey AS protocol_number,
               'Phase ' || (o_orderkey % 3 + 1) AS phase, 'NSCLC' AS indication,
               'Synthetic sponsor' AS sponsor,
               CASE o_orderpriority
                    WHEN '1-URGENT' THEN ['Overall survival (OS) until death from any cause']
                    WHEN '2-HIGH' THEN ['Progression-free survival (PFS) by review',
                                        'Objective response rate (ORR)']
                    WHEN '3-MEDIUM' THEN ['Change in laboratory values at week 12']
                    WHEN '4-NOT SPECIFIED' THEN ['xyzzy frobnicate entanglement score']
                    ELSE [] END AS primary_endpoints,
               CASE o_orderstatus
                    WHEN 'F' THEN ['Safety and tolerability per CTCAE', 'Duration of response']
                    WHEN 'O' THEN ['Systolic blood pressure at week 12'] ELSE [] END AS secondary_endpoints,
               ['Age >= ' || (18 + o_custkey % 50), 'Adequate hematology values'] AS inclusion_criteria,
               ['Prior treatment with compound ' || o_custkey] AS exclusion_criteria,
               (o_custkey % 5 * 100) || 'mg' AS first_dose,
               'Demographics | Laboratory tests | ECG' AS assessments,
               CAST(floor(o_totalprice) AS BIGINT) AS raw_text_length
        FROM orders""",
    "items": """
        SELECT protocol_number, 'primary_endpoints' AS kind, generate_subscripts(primary_endpoints, 1) AS position,
               unnest(primary_endpoints) AS endpoint FROM protocols
        UNION ALL SELECT protocol_number, 'secondary_endpoints', generate_subscripts(secondary_endpoints, 1),
               unnest(secondary_endpoints) FROM protocols
        UNION ALL SELECT protocol_number, 'inclusion_criteria', generate_subscripts(inclusion_criteria, 1),
               unnest(inclusion_criteria) FROM protocols
        UNION ALL SELECT protocol_number, 'exclusion_criteria', generate_subscripts(exclusion_criteria, 1),
               unnest(exclusion_criteria) FROM protocols""",
    # The items above only use these texts, so their placement is listed directly.
    "mapping": """
        SELECT endpoint, protocol_number, kind, position,
               CASE WHEN endpoint LIKE 'Overall survival%' THEN 'DM'
                    WHEN endpoint LIKE 'Progression-free%' THEN 'RS'
                    WHEN endpoint LIKE 'Objective response rate%' THEN 'RS'
                    WHEN endpoint LIKE 'Duration of response%' THEN 'RS'
                    WHEN endpoint LIKE 'Safety%' THEN 'AE'
                    WHEN endpoint LIKE 'Change in laboratory%' THEN 'LB'
                    WHEN endpoint LIKE 'Adequate hematology%' THEN 'LB'
                    WHEN endpoint LIKE 'Systolic%' THEN 'VS'
                    WHEN endpoint LIKE 'Age >=%' THEN 'DM'
                    WHEN endpoint LIKE 'Prior treatment%' THEN 'CM' END AS suggested_sdtm_domain,
               CASE WHEN endpoint LIKE 'Overall survival%' THEN 'ADTTE'
                    WHEN endpoint LIKE 'Progression-free%' THEN 'ADTTE'
                    WHEN endpoint LIKE 'Objective response rate%' THEN 'ADRS'
                    WHEN endpoint LIKE 'Duration of response%' THEN 'ADTTE'
                    WHEN endpoint LIKE 'Safety%' THEN 'ADAE'
                    WHEN endpoint LIKE 'Change in laboratory%' THEN 'ADLB'
                    WHEN endpoint LIKE 'Adequate hematology%' THEN 'ADLB'
                    WHEN endpoint LIKE 'Systolic%' THEN 'ADVS'
                    WHEN endpoint LIKE 'Age >=%' THEN 'ADSL'
                    WHEN endpoint LIKE 'Prior treatment%' THEN 'ADCM' END AS suggested_adam_dataset,
               CASE WHEN endpoint LIKE 'xyzzy%' THEN 'low'
                    WHEN endpoint LIKE 'Safety%' OR endpoint LIKE 'Age >=%'
                         OR endpoint LIKE 'Prior treatment%' THEN 'medium'
                    ELSE 'high' END AS confidence,
               endpoint LIKE 'xyzzy%' AS requires_suppqual
        FROM items""",
}

_SYSTEMS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
_FEATURES = (
    "TOTAL_TEAE",
    *[f"SOC_{s}" for s in _SYSTEMS],
    *[f"GRADE_{g}_N" for g in range(1, 6)],
    "SERIOUS_N",
    "RELATED_N",
)
_CTE["features"] = _CTE["features"].format(
    systems=", ".join(
        f"CAST(count(*) FILTER (AEBODSYS = '{s}') AS DOUBLE) AS SOC_{s}" for s in _SYSTEMS
    ),
    grades=", ".join(
        f"CAST(count(*) FILTER (ATOXGR = {g}) AS DOUBLE) AS GRADE_{g}_N" for g in range(1, 6)
    ),
)
_CTE["scaled"] = (
    "SELECT USUBJID, "
    + ", ".join(
        f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS {c}"
        for c in _FEATURES
    )
    + " FROM features"
)
_CTE["scores"] = (
    "SELECT USUBJID, ("
    + " + ".join(f"{c} * {c}" for c in _FEATURES)
    + f") / {len(_FEATURES)} AS RECONSTRUCTION_ERROR FROM scaled"
)
_CTE["flagged"] = """
    SELECT USUBJID, RECONSTRUCTION_ERROR, cut,
           RECONSTRUCTION_ERROR > cut AS ANOMALY_FLAG
    FROM scores, (SELECT quantile_cont(RECONSTRUCTION_ERROR, 0.95) AS cut FROM scores)"""

_ADSL = ("first_order", "dm", "adsl")
_ADAE = (*_ADSL, "lines", "ae", "adae")
_OS = (*_ADSL, "contacts", "os")
_KM = (*_OS, "km_counts", "km_risk", "km_sums", "km")
_SIGNAL = (*_ADAE, "teae", "features", "scaled", "scores", "flagged")


def _with(blocks: tuple[str, ...], body: str) -> str:
    named = ",\n".join(f"{name} AS ({_CTE[name]})" for name in blocks)
    return f"WITH {named}\n{body}"


def _columns(df_columns: str) -> list[str]:
    return [c.strip() for c in df_columns.split(",")]


_DOMAIN_COLUMNS = {
    "DM": "STUDYID, DOMAIN, SUBJID, SITEID, USUBJID, AGE, AGEU, SEX, RACE, ETHNIC, ARMCD, ARM,"
    "RFICDTC, RFSTDTC",
    "AE": "STUDYID, DOMAIN, USUBJID, AETERM, AEDECOD, AEBODSYS, AESTDTC, AEENDTC, AESEV, AESER,"
    "AEREL, AEOUT, AESEQ",
    "LB": "STUDYID, DOMAIN, USUBJID, LBTESTCD, LBTEST, LBCAT, LBORRES, LBORRESU, LBSTRESN,"
    "LBSTRESU, LBSTNRLO, LBSTNRHI, LBNRIND, LBDTC, VISIT, LBSEQ",
    "VS": "STUDYID, DOMAIN, USUBJID, VSTESTCD, VSTEST, VSPOS, VSORRES, VSORRESU, VSSTRESN,"
    "VSSTRESU, VSDTC, VISIT, VSSEQ",
    "EX": "STUDYID, DOMAIN, USUBJID, EXTRT, EXDOSE, EXDOSU, EXROUTE, EXDOSFRQ, EXSTDTC, EXENDTC,"
    "VISIT, EXSEQ",
}
# Numeric variables of the data whose type differs from the listed one.
_RETYPED = {"LBSTNRLO": "integer", "LBSTNRHI": "integer"}
_COUNTS = {
    "DM": "SELECT count(*) FROM customer",
    "AE": "SELECT count(*) FROM lines WHERE l_returnflag = 'R'",
    "LB": "SELECT count(*) FROM lines WHERE l_returnflag <> 'R'",
    "VS": "SELECT count(*) FROM events",
    "EX": "SELECT count(*) FROM orders",
}


def _define_variables() -> str:
    rows = []
    for code, names in _DOMAIN_COLUMNS.items():
        for i, name in enumerate(_columns(names), start=1):
            label, kind, length = VARIABLES[name]
            kind = _RETYPED.get(name, kind)
            mandatory = "Yes" if name in ("STUDYID", "DOMAIN", "USUBJID") else "No"
            rows.append(
                f"SELECT '{code}' AS domain, {i} AS order_number, 'IT.{code}.{name}' AS item_oid, "
                f"'{name}' AS name, '{label}' AS label, '{kind}' AS data_type, {length} AS length, "
                f"'{mandatory}' AS mandatory, 'CRF' AS origin, '{name}' AS field_name, "
                f"({_COUNTS[code]}) AS dataset_records"
            )
    return _with(("lines",), "\nUNION ALL ".join(rows))


def _define_datasets() -> str:
    rows = [
        f"SELECT '{code}' AS domain, 'IG.{code}' AS group_oid, '{DATASET_LABELS[code]}' AS label, "
        f"'{DATASET_STRUCTURES[code]}' AS structure, 'Tabulation' AS purpose, "
        f"'{'No' if code == 'DM' else 'Yes'}' AS repeating, {len(_columns(names))} AS variables, "
        f"({_COUNTS[code]}) AS records"
        for code, names in _DOMAIN_COLUMNS.items()
    ]
    return _with(("lines",), "\nUNION ALL ".join(rows))


def _define_summary() -> str:
    rows = [
        f"SELECT 'STUDY-01' AS study_id, 'SDTM 1.7' AS standard_version, '{code}' AS domain, "
        f"'{DATASET_LABELS[code]}' AS label, ({_COUNTS[code]}) AS records, "
        f"{len(_columns(names))} AS variables, 5 AS total_datasets"
        for code, names in _DOMAIN_COLUMNS.items()
    ]
    return _with(("lines",), "\nUNION ALL ".join(rows))


_PFS = """
    SELECT USUBJID, TRTSDT, TRT01A, TRT01AN, strftime(progression, '%Y-%m-%d') AS progression_date,
           strftime(death, '%Y-%m-%d') AS death_date, strftime(last, '%Y-%m-%d') AS last_assessment_date,
           'Progression-Free Survival' AS PARAM, 'PFS' AS PARAMCD,
           CASE WHEN progression IS NULL AND death IS NULL THEN 1 ELSE 0 END AS CNSR,
           {date} AS ADT, date_diff('day', TRTSDT, {date}) AS AVAL, 'DAYS' AS AVALU,
           CASE WHEN {progressed} THEN 'PROGRESSION' WHEN death IS NOT NULL THEN 'DEATH'
                ELSE 'CENSORED' END AS EVNTDESC,
           TRT01A AS TRTA, TRT01AN AS TRTAN
    FROM adsl LEFT JOIN (SELECT USUBJID, progression, last,
                                CASE WHEN urgent >= start THEN urgent END AS death
                         FROM contacts) USING (USUBJID)"""

_ADLB = """
    SELECT STUDYID, DOMAIN, USUBJID, LBTESTCD, LBTEST, LBCAT, LBORRES, LBORRESU, LBSTRESN, LBSTRESU,
           LBSTNRLO, LBSTNRHI, LBNRIND, LBDTC, VISIT, LBSEQ, TRT01A, TRT01AN, TRTSDT,
           TRT01A AS TRTA, TRT01AN AS TRTAN, LBTEST AS PARAM, LBTESTCD AS PARAMCD,
           LBSTRESN AS AVAL, LBSTRESU AS AVALU,
           CASE WHEN VISIT = 'BASELINE' THEN 'Y' ELSE '' END AS ABLFL,
           BASE, LBSTRESN - BASE AS CHG,
           CASE WHEN BASE <> 0 THEN round(100 * (LBSTRESN - BASE) / BASE, 6) END AS PCHG,
           LBNRIND AS ANRIND
    FROM (SELECT lb.*, first(CASE WHEN VISIT = 'BASELINE' THEN LBSTRESN END IGNORE NULLS)
                       OVER (PARTITION BY USUBJID, LBTESTCD ORDER BY VISIT <> 'BASELINE', LBSEQ
                             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS BASE
          FROM lb)
    LEFT JOIN (SELECT USUBJID, TRT01A, TRT01AN, TRTSDT FROM adsl) USING (USUBJID)"""

_PANEL = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_PANEL_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _filled(value: str) -> str:
    columns = ", ".join(
        f"round(coalesce({c}, ({value.format(c=c)})), 6) AS {c}" for c in _PANEL
    )
    return _with(("panel",), f"SELECT {_PANEL_KEYS}, {columns} FROM panel")


_REGRESSION = f"""
    , filled AS (SELECT *, coalesce(l_quantity, (SELECT avg(l_quantity) FROM panel)) AS x FROM panel),
    line AS (SELECT regr_slope(l_extendedprice, x) AS slope,
                    regr_intercept(l_extendedprice, x) AS intercept FROM filled)
    SELECT {_PANEL_KEYS}, l_quantity,
           round(coalesce(l_extendedprice, intercept + slope * x), 4) AS l_extendedprice
    FROM filled, line"""

_AUDIT = "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_before, "
    f"CAST(0 AS BIGINT) AS missing_after, count(*) - count({c}) AS imputed FROM panel"
    for c in _PANEL
)


_ARMS = ("Drug X", "Placebo")


def _per_arm(
    cell: str, block: int, row: str, label: str, source: str, extra: str = "", columns=_ARMS
) -> str:
    """One report row (or row group): the cell of each arm side by side."""
    arms = ", ".join(f"max(CASE WHEN arm = '{a}' THEN {cell} END) AS \"{a}\"" for a in columns)
    return (
        f"SELECT {block} AS block, {row} AS row, {label} AS characteristic, {arms} "
        f"FROM {source} {extra}"
    )


def _over_all(report: str) -> str:
    """The report of a study whose subjects, and so their events, stand once more under Total."""
    once = f"adsl AS ({_CTE['adsl']})"
    twice = f"""adsl AS (
      WITH one AS ({_CTE["adsl"]})
      SELECT * FROM one UNION ALL SELECT * REPLACE ('Total' AS TRT01A) FROM one)"""
    return report.replace(once, twice)


def _demographics(columns=_ARMS) -> str:
    blocks = "adsl_n AS (SELECT TRT01A AS arm, count(*) AS n FROM adsl WHERE SAFFL = 'Y' GROUP BY 1)"
    age = """age AS (SELECT TRT01A AS arm, count(AGE) AS n, avg(AGE) AS m, stddev_samp(AGE) AS s,
             median(AGE) AS med, min(AGE) AS lo, max(AGE) AS hi FROM adsl GROUP BY 1)"""
    parts = [_per_arm("'(N=' || n || ')'", 0, "''", "'Characteristic'", "adsl_n", columns=columns)]
    for block, title in enumerate(
        ("Age (years)", "Sex, n (%)", "Race, n (%)", "Age group, n (%)"), start=1
    ):
        parts.append(_per_arm("''", block, "''", f"'{title}'", "adsl_n", columns=columns))
    texts = [
        ("  n", "CAST(n AS VARCHAR)"),
        ("  Mean (SD)", "printf('%.1f (%.2f)', round(m, 1), round(s, 2))"),
        ("  Median", "printf('%.1f', round(med, 1))"),
        ("  Min, Max", "printf('%.1f, %.1f', CAST(lo AS DOUBLE), CAST(hi AS DOUBLE))"),
    ]
    for i, (label, text) in enumerate(texts, start=1):
        parts.append(_per_arm(text, 1, f"'{i}'", f"'{label}'", "age", columns=columns))
    for block, name in ((2, "SEX"), (3, "RACE"), (4, "AGEGR1")):
        label = (
            "CASE cat WHEN 'M' THEN '  Male' WHEN 'F' THEN '  Female' ELSE '  Unknown' END"
            if name == "SEX"
            else "'  ' || cat"
        )
        source = f"""(SELECT c.cat, a.arm, a.n,
                      (SELECT count(*) FROM adsl s WHERE s.TRT01A = a.arm AND s.{name} = c.cat) AS k
                      FROM (SELECT DISTINCT {name} AS cat FROM adsl) c CROSS JOIN adsl_n a)"""
        cell = "printf('%d (%.1f%%)', k, round(100.0 * k / n, 1))"
        parts.append(_per_arm(cell, block, "cat", label, source, "GROUP BY cat", columns))
    return _with(_ADSL, f", {blocks}, {age} " + "\nUNION ALL ".join(parts))


def _adverse_events(columns=_ARMS) -> str:
    kinds = [
        ("  Any TEAE", "true"),
        ("  Any serious TEAE", "ASER = 'Y'"),
        ("  Any related TEAE", "AEREL = 'Y'"),
        ("  Any Grade ≥ 3 TEAE", "ATOXGR >= 3"),
        ("  TEAE leading to death", "AEOUT = 'FATAL'"),
    ]
    counts = ", ".join(
        f"(SELECT count(DISTINCT USUBJID) FROM teae WHERE TRTA = arm AND {c}) AS k{i}"
        for i, (_, c) in enumerate(kinds, start=1)
    )
    source = f"""(SELECT arm, n, {counts} FROM
                 (SELECT TRT01A AS arm, count(*) AS n FROM adsl WHERE SAFFL = 'Y' GROUP BY 1))"""
    parts = [_per_arm("'(N=' || n || ')'", 0, "'0'", "'Adverse Event Category'", source, "", columns)]
    for i, (label, _) in enumerate(kinds, start=1):
        cell = f"printf('%d (%.1f%%)', k{i}, round(100.0 * k{i} / n, 1))"
        parts.append(_per_arm(cell, 0, f"'{i}'", f"'{label}'", source, "", columns))
    return _with((*_ADAE, "teae"), "\nUNION ALL ".join(parts))


_LAB_SHIFT = """
    , adlb AS (SELECT * FROM lb LEFT JOIN adsl USING (USUBJID) WHERE LBTESTCD = 'ECONOMY'),
    worst AS (SELECT USUBJID, LBNRIND AS WORST_POST, TRT01A AS arm FROM adlb WHERE VISIT <> 'BASELINE'
              QUALIFY row_number() OVER (PARTITION BY USUBJID ORDER BY LBSTRESN DESC, LBSEQ) = 1)
    SELECT b.LBNRIND AS BASELINE, WORST_POST, count(*) FILTER (worst.arm = 'Drug X') AS "Drug X",
           count(*) FILTER (worst.arm = 'Placebo') AS "Placebo"
    FROM adlb b JOIN worst USING (USUBJID) WHERE VISIT = 'BASELINE' GROUP BY 1, 2"""

#: Every different text against every rule, as text with blanks around the words.
_RULE_TABLE = """
    WITH rules AS (
      SELECT p_name || ' ' || p_partkey AS keyword, p_type AS domain, p_brand AS dataset,
             'high' AS confidence FROM part
      UNION ALL SELECT p_name, min(p_type), min(p_brand), 'medium' FROM part GROUP BY 1
      UNION ALL SELECT DISTINCT split_part(p_name, ' ', 2), 'NOUN', 'ADNOUN', 'low' FROM part),
    items AS (
      SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber % 4
        WHEN 0 THEN 'Change in ' || p_name || ' ' || p_partkey || ' at week 12'
        WHEN 1 THEN upper(p_name) || 's, by review' WHEN 2 THEN 'Rate of over' || p_name
        ELSE 'Time to un' || replace(p_name, ' ', '') END AS endpoint
      FROM lineitem JOIN part ON l_partkey = p_partkey),
    texts AS (
      SELECT DISTINCT endpoint,
        ' ' || replace(replace(lower(endpoint), 's, by', ' by'), ',', '') || ' ' AS said FROM items),
    best AS (
      SELECT endpoint, domain, dataset, confidence FROM texts
      JOIN rules ON contains(said, ' ' || keyword || ' ')
      QUALIFY row_number() OVER (PARTITION BY endpoint ORDER BY len(string_split(keyword, ' ')) DESC,
        length(keyword) DESC, keyword, domain, dataset, confidence) = 1)
    SELECT items.*, domain AS suggested_sdtm_domain, dataset AS suggested_adam_dataset,
      coalesce(confidence, 'low') AS confidence, coalesce(confidence, 'low') = 'low' AS requires_suppqual
    FROM items LEFT JOIN best USING (endpoint)"""

_SUMMARY_DEMOGRAPHICS = """
    SELECT TRT01A AS arm, count(*) AS n, round(avg(AGE), 1) AS age_mean,
           round(stddev_samp(AGE), 2) AS age_sd, round(median(AGE), 1) AS age_median,
           min(AGE) AS age_min, max(AGE) AS age_max,
           count(*) FILTER (SEX = 'M') AS sex_m_n, count(*) FILTER (SEX = 'F') AS sex_f_n,
           round(100.0 * count(*) FILTER (SEX = 'M') / count(*), 1) AS sex_m_pct,
           round(100.0 * count(*) FILTER (SEX = 'F') / count(*), 1) AS sex_f_pct
    FROM adsl GROUP BY 1"""

_SUMMARY_SAFETY = """
    SELECT arm, n_safety, n_any_teae, round(100.0 * n_any_teae / n_safety, 1) AS pct_any_teae,
           n_serious, n_related, n_grade3plus
    FROM (SELECT TRT01A AS arm, count(*) AS n_safety FROM adsl GROUP BY 1)
    JOIN (SELECT TRTA AS arm, count(DISTINCT USUBJID) AS n_any_teae,
                 count(DISTINCT USUBJID) FILTER (ASER = 'Y') AS n_serious,
                 count(DISTINCT USUBJID) FILTER (AEREL = 'Y') AS n_related,
                 count(DISTINCT USUBJID) FILTER (ATOXGR >= 3) AS n_grade3plus
          FROM teae GROUP BY 1) USING (arm)"""

_TOP_TERMS = """
    SELECT TRTA AS arm, AEDECOD AS term, count(DISTINCT USUBJID) AS n_subjects,
           row_number() OVER (PARTITION BY TRTA ORDER BY count(DISTINCT USUBJID) DESC, AEDECOD) AS rank
    FROM teae GROUP BY 1, 2 QUALIFY rank <= 5"""

_SUMMARY_TTE = """
    SELECT TRTA AS arm, count(*) AS n, count(*) FILTER (CNSR = 0) AS n_events,
           count(*) FILTER (CNSR = 1) AS n_censored,
           round(100.0 * count(*) FILTER (CNSR = 0) / count(*), 1) AS event_rate,
           round(CAST(median(AVAL) AS DOUBLE), 1) AS median_aval,
           CAST(min(AVAL) AS DOUBLE) AS min_aval, CAST(max(AVAL) AS DOUBLE) AS max_aval
    FROM os GROUP BY 1"""

_KM_SUMMARY = """
    SELECT arm, max(n_risk) AS n_subjects, CAST(sum(n_event) AS BIGINT) AS n_events,
           min(time) FILTER (survival <= 0.5) AS median_survival,
           min(time) FILTER (coalesce(ci_lower, 0) <= 0.5) AS median_ci_lower,
           min(time) FILTER (coalesce(ci_upper, 0) <= 0.5) AS median_ci_upper
    FROM km GROUP BY 1"""

_LOGRANK = """
    , times AS (SELECT DISTINCT AVAL AS t FROM os WHERE CNSR = 0 AND AVAL IS NOT NULL),
    risk AS (SELECT t,
        CAST((SELECT count(*) FROM os WHERE AVAL >= t) AS DOUBLE) AS n,
        CAST((SELECT count(*) FROM os WHERE AVAL >= t AND TRTA = 'Drug X') AS DOUBLE) AS n1,
        (SELECT count(*) FROM os WHERE AVAL = t AND CNSR = 0) AS d,
        (SELECT count(*) FROM os WHERE AVAL = t AND CNSR = 0 AND TRTA = 'Drug X') AS d1 FROM times),
    total AS (SELECT CAST(sum(d1) AS BIGINT) AS observed, sum(d * n1 / n) AS expected,
              sum(CASE WHEN n > 1 THEN d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0 END)
              AS variance FROM risk)
    SELECT observed, round(expected, 6) AS expected, round(variance, 6) AS variance,
           round((observed - expected) * (observed - expected) / variance, 6) AS chi_square
    FROM total"""

_CONCORDANCE = """
    , s AS (SELECT AVAL, CNSR, AGE FROM os JOIN (SELECT USUBJID, AGE FROM adsl) USING (USUBJID)
            WHERE AVAL IS NOT NULL),
    pairs AS (SELECT a.AGE AS mine, b.AGE AS other FROM s a JOIN s b
              ON a.CNSR = 0 AND (b.AVAL > a.AVAL OR (b.AVAL = a.AVAL AND b.CNSR = 1)))
    SELECT count(*) AS comparable, count(*) FILTER (mine > other) AS concordant,
           count(*) FILTER (mine = other) AS tied,
           round((count(*) FILTER (mine > other) + 0.5 * count(*) FILTER (mine = other))
                 / count(*), 6) AS concordance
    FROM pairs"""

_VALIDATE = """
    , bad AS (SELECT CASE WHEN AESEV <> 'FATAL' THEN STUDYID END AS STUDYID,
                     CASE WHEN AESEV = 'UNKNOWN' THEN 'XX' ELSE DOMAIN END AS DOMAIN,
                     CASE WHEN AEOUT = 'FATAL' THEN replace(USUBJID, '-', '_') ELSE USUBJID END AS USUBJID
              FROM ae),
    findings AS (
        SELECT 'AE' AS domain, 'required_variable' AS rule, 'ERROR' AS severity, count(*) AS n_records,
               'Required variable missing: AESEQ' AS message FROM bad
        UNION ALL SELECT 'AE', 'required_variable', 'ERROR', count(*),
               'Required variable missing: AEDECOD' FROM bad
        UNION ALL SELECT 'AE', 'study_present', 'ERROR', count(*), 'STUDYID contains null values'
               FROM bad WHERE STUDYID IS NULL
        UNION ALL SELECT 'AE', 'domain_code', 'ERROR', count(*), 'DOMAIN value mismatch, expected AE'
               FROM bad WHERE DOMAIN IS DISTINCT FROM 'AE'
        UNION ALL SELECT 'AE', 'subject_format', 'WARNING', count(*),
               count(*) || ' USUBJID values may not follow STUDYID-SITEID-SUBJID convention'
               FROM bad WHERE USUBJID NOT LIKE '%-%')
    """

_VALIDATE_SUMMARY = """
    SELECT 'AE' AS domain, false AS is_valid, count(*) FILTER (severity = 'ERROR') AS n_errors,
           count(*) FILTER (severity = 'WARNING') AS n_warnings,
           'Domain: AE' || chr(10) || 'Valid: False' || chr(10) || 'Errors (4):' || chr(10)
           || string_agg('  [ERROR] ' || message, chr(10) ORDER BY message) FILTER (severity = 'ERROR')
           || chr(10) || 'Warnings (1):' || chr(10)
           || string_agg('  [WARN] ' || message, chr(10) ORDER BY message)
              FILTER (severity = 'WARNING') AS summary
    FROM findings"""



def _json(fields: str, more: str = "") -> str:
    """JSON text of the named columns; ``more`` is appended before the brace."""
    parts = " || ',' || ".join(f"'\"{f}\":' || {f}" for f in _columns(fields))
    return f"'{{' || {parts}{more} || '}}'"


def _payload() -> str:
    terms = """' {"rank":' || rank || ',"term":"' || term || '","n_subjects":' || n_subjects || '}'"""
    top = f"""(SELECT '[' || string_agg(trim({terms}), ',' ORDER BY rank) || ']'
               FROM ({_TOP_TERMS}) t WHERE t.arm = s.arm)"""
    sections = [
        ("11.2", "Demographic and Baseline Characteristics", _SUMMARY_DEMOGRAPHICS,
         _json("n, age_mean, age_sd, age_median, age_min, age_max, sex_m_n, sex_f_n, sex_m_pct,"
               "sex_f_pct")),
        ("11.4", "Analysis of Efficacy", _SUMMARY_TTE,
         _json("n, n_events, n_censored, event_rate, median_aval, min_aval, max_aval")),
        ("11.5", "Safety and Tolerability", _SUMMARY_SAFETY,
         _json("n_safety, n_any_teae, pct_any_teae, n_serious, n_related, n_grade3plus",
               f""" || ',"top5_preferred_terms":' || {top}""")),
    ]
    parts = [
        f"SELECT '{number}' AS section, '{title}' AS section_title, arm, {text} AS stats "
        f"FROM ({summary}) s"
        for number, title, summary, text in sections
    ]
    return _with((*_ADAE, "teae", "contacts", "os"), "\nUNION ALL ".join(parts))


_ITEM_LISTS = (
    "primary_endpoints", "secondary_endpoints", "inclusion_criteria", "exclusion_criteria",
)
_PROTOCOL_METADATA = (
    "SELECT study_title, protocol_number, phase, indication, sponsor, "
    + ", ".join(f"array_to_string({c}, ' | ') AS {c}" for c in _ITEM_LISTS)
    + ", first_dose, assessments, raw_text_length FROM protocols"
)


def all_oracles() -> dict[str, str]:
    from .oracles_fits import fit_oracles

    logrank = _with(_OS, _LOGRANK)
    return fit_oracles(logrank) | {
        "sdtm_dm": _with(("first_order", "dm"), "SELECT * FROM dm"),
        "sdtm_ae": _with(("lines", "ae"), "SELECT * FROM ae"),
        "sdtm_lb": _with(("lines", "lb"), "SELECT * FROM lb"),
        "sdtm_vs": _with(("vs",), "SELECT * FROM vs"),
        "sdtm_ex": _with(("ex",), "SELECT * FROM ex"),
        "sdtm_controlled_terms": _with(
            ("first_order", "dm"),
            """SELECT USUBJID, CASE WHEN RACE IN ('AUTOMOBILE', 'MACHINERY') THEN 'OTHER'
               WHEN RACE = 'BUILDING' THEN 'MULTIPLE' ELSE RACE END AS RACE FROM dm""",
        ),
        "sdtm_validate": _with(("lines", "ae"), _VALIDATE + "SELECT * FROM findings"),
        "sdtm_validate_summary": _with(("lines", "ae"), _VALIDATE + _VALIDATE_SUMMARY),
        "sdtm_duplicates": _with(
            ("lines", "ae"),
            """SELECT USUBJID, AEDECOD, AESEV, count(*) AS n_records FROM ae
               GROUP BY 1, 2, 3 HAVING count(*) > 1""",
        ),
        "define_variables": _define_variables(),
        "define_datasets": _define_datasets(),
        "define_summary": _define_summary(),
        "adam_adsl": _with(_ADSL, "SELECT * FROM adsl"),
        "adam_adae": _with(_ADAE, "SELECT * FROM adae"),
        "adam_adtte_os": _with(_OS, "SELECT * FROM os"),
        "adam_adtte_pfs": _with(
            (*_ADSL, "contacts"),
            _PFS.format(date="coalesce(progression, death, last)", progressed="progression IS NOT NULL"),
        ),
        "adam_adtte_pfs_earliest": _with(
            (*_ADSL, "contacts"),
            _PFS.format(
                date="coalesce(least(progression, death), last)",
                progressed="progression IS NOT NULL AND (death IS NULL OR progression <= death)",
            ),
        ),
        "adam_adlb": _with((*_ADSL, "lines", "lb"), _ADLB),
        "impute_mean": _filled("SELECT avg({c}) FROM panel"),
        "impute_median": _filled("SELECT median({c}) FROM panel"),
        "impute_mode": _filled(
            "SELECT {c} FROM panel WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1"
        ),
        "impute_regression": _with(("panel",), _REGRESSION),
        "impute_audit": _with(("panel",), _AUDIT),
        "tlf_demographics": _demographics(),
        "tlf_demographics_total": _over_all(_demographics((*_ARMS, "Total"))),
        "tlf_adverse_events": _adverse_events(),
        "tlf_adverse_events_total": _over_all(_adverse_events((*_ARMS, "Total"))),
        "tlf_lab_shift_total": _with(
            (*_ADSL, "lines", "lb"),
            _LAB_SHIFT.replace(' AS "Placebo"\n', ' AS "Placebo", count(*) AS "Total"\n'),
        ),
        "tlf_lab_shift": _with((*_ADSL, "lines", "lb"), _LAB_SHIFT),
        "protocol_mapping_rules": _RULE_TABLE,
        "tlf_subject_listing": _with(
            _ADSL, "SELECT USUBJID, SITEID, AGE, AGEGR1, SEX, RACE, TRT01A, ITTFL, SAFFL FROM adsl"
        ),
        "summary_demographics": _with(_ADSL, _SUMMARY_DEMOGRAPHICS),
        "summary_safety": _with((*_ADAE, "teae"), _SUMMARY_SAFETY),
        "summary_top_terms": _with((*_ADAE, "teae"), _TOP_TERMS),
        "summary_tte": _with(_OS, _SUMMARY_TTE),
        "summary_payload": _payload(),
        "km_curve": _with(
            _KM,
            """SELECT arm, time, n_risk, n_event, n_censored, round(survival, 6) AS survival,
               round(ci_lower, 6) AS ci_lower, round(ci_upper, 6) AS ci_upper FROM km""",
        ),
        "km_summary": _with(_KM, _KM_SUMMARY),
        "logrank": _with(_OS, _LOGRANK),
        "cox_concordance": _with(_OS, _CONCORDANCE),
        "ae_features": _with((*_ADAE, "teae", "features"), "SELECT * FROM features"),
        "ae_features_scaled": _with(
            (*_ADAE, "teae", "features", "scaled"),
            "SELECT USUBJID, "
            + ", ".join(f"round({c}, 6) AS {c}" for c in _FEATURES)
            + " FROM scaled",
        ),
        "ae_signal_flags": _with(
            _SIGNAL,
            """SELECT USUBJID, round(RECONSTRUCTION_ERROR, 6) AS RECONSTRUCTION_ERROR, ANOMALY_FLAG
               FROM flagged""",
        ),
        "ae_signal_summary": _with(
            _SIGNAL,
            """SELECT count(*) AS n_subjects, count(*) FILTER (ANOMALY_FLAG) AS n_anomalies,
               round(100.0 * count(*) FILTER (ANOMALY_FLAG) / count(*), 1) AS anomaly_rate,
               round(any_value(cut), 4) AS threshold, round(avg(RECONSTRUCTION_ERROR), 4) AS mean_error,
               round(max(RECONSTRUCTION_ERROR), 4) AS max_error FROM flagged""",
        ),
        "protocol_metadata": _with(("protocols",), _PROTOCOL_METADATA),
        "protocol_items": _with(("protocols", "items"), "SELECT * FROM items"),
        "protocol_mapping": _with(("protocols", "items", "mapping"), "SELECT * FROM mapping"),
        "protocol_mapping_summary": _with(
            ("protocols", "items", "mapping"),
            """SELECT count(*) AS total_endpoints,
               count(DISTINCT suggested_sdtm_domain) AS unique_sdtm_domains,
               count(*) FILTER (requires_suppqual) AS suppqual_required,
               count(*) FILTER (confidence = 'low') AS low_confidence_count FROM mapping""",
        ),
    }
