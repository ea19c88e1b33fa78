"""Fixed code lists, labels and variable metadata of the clinical standards.

The values in this file are fixed values: they must equal the published
standards' terms (or the source system's codes) for results to be right.
"""

from __future__ import annotations

# --- fixed values: demographics ------------------------------------------------
SEX_CODES = {"M": "M", "F": "F", "MALE": "M", "FEMALE": "F", "U": "U"}
SEX_LABELS = {"M": "Male", "F": "Female", "U": "Unknown"}

# --- fixed values: adverse events ----------------------------------------------
SEVERITY_CODES = {
    "MILD": "MILD",
    "1": "MILD",
    "GRADE 1": "MILD",
    "MODERATE": "MODERATE",
    "2": "MODERATE",
    "GRADE 2": "MODERATE",
    "SEVERE": "SEVERE",
    "3": "SEVERE",
    "GRADE 3": "SEVERE",
    "LIFE-THREATENING": "LIFE-THREATENING",
    "4": "LIFE-THREATENING",
    "FATAL": "FATAL",
    "5": "FATAL",
}
SERIOUS_CODES = {"YES": "Y", "NO": "N", "Y": "Y", "N": "N"}
RELATED_CODES = {"RELATED": "Y", "NOT RELATED": "N", "YES": "Y", "NO": "N"}
OUTCOME_CODES = {
    "RECOVERED": "RECOVERED/RESOLVED",
    "RESOLVED": "RECOVERED/RESOLVED",
    "RECOVERING": "RECOVERING/RESOLVING",
    "NOT RECOVERED": "NOT RECOVERED/NOT RESOLVED",
    "FATAL": "FATAL",
    "UNKNOWN": "UNKNOWN",
}
SEVERITY_GRADES = {
    "MILD": 1,
    "MODERATE": 2,
    "SEVERE": 3,
    "LIFE-THREATENING": 4,
    "FATAL": 5,
}

# --- fixed values: vital signs ---------------------------------------------------
VITAL_TEST_CODES = {
    "SYSTOLIC BLOOD PRESSURE": "SYSBP",
    "DIASTOLIC BLOOD PRESSURE": "DIABP",
    "HEART RATE": "HR",
    "BODY TEMPERATURE": "TEMP",
    "RESPIRATORY RATE": "RESP",
    "WEIGHT": "WEIGHT",
    "HEIGHT": "HEIGHT",
    "BMI": "BMI",
    "OXYGEN SATURATION": "OXYSAT",
}

# --- fixed values: report titles and row labels ------------------------------------
REPORT_TITLES = {
    "14.1.1": "Summary of Demographic and Baseline Characteristics",
    "14.3.1": "Summary of Treatment-Emergent Adverse Events",
    "14.3.4": "Shift Table: {parameter} (Baseline vs Worst Post-Baseline)",
    "16.2.1": "Subject Disposition and Demographic Listing",
}
EVENT_ROW_LABELS = {
    "any": "  Any TEAE",
    "serious": "  Any serious TEAE",
    "related": "  Any related TEAE",
    "grade3": "  Any Grade ≥ 3 TEAE",
    "fatal": "  TEAE leading to death",
}

# --- notes under the reports, free wording -----------------------------------------
REPORT_FOOTNOTES = {
    "14.1.1": (
        "The table covers everyone in the safety population.",
        "Shares are of the column total in the first row.",
    ),
    "14.3.1": (
        "A TEAE (treatment-emergent adverse event) starts once treatment has started.",
        "Each row counts people, not events; shares are of the safety population.",
    ),
    "14.3.4": (
        "Rows and columns show the range category of {parameter}.",
        "The later category is the worst one recorded after baseline.",
    ),
    "16.2.1": ("One line per subject, in the order of their identifiers.",),
}

# --- fixed values: visits that count as baseline ---------------------------------
BASELINE_VISITS = ("SCREENING", "BASELINE", "DAY 1", "CYCLE 1 DAY 1")

# --- fixed values: dataset labels and structures ---------------------------------
DATASET_LABELS = {
    "DM": "Demographics",
    "AE": "Adverse Events",
    "LB": "Laboratory Test Results",
    "VS": "Vital Signs",
    "EX": "Exposure",
}
DATASET_STRUCTURES = {
    "DM": "One record per subject",
    "AE": "One record per adverse event per subject",
    "LB": "One record per lab test per time point per subject",
    "VS": "One record per vital sign measurement per subject",
    "EX": "One record per protocol-specified treatment per subject",
}

# --- fixed values: variable -> (label, type, length) -----------------------------
VARIABLES = {
    "STUDYID": ("Study Identifier", "text", 12),
    "DOMAIN": ("Domain Abbreviation", "text", 2),
    "USUBJID": ("Unique Subject Identifier", "text", 50),
    "SUBJID": ("Subject Identifier for the Study", "text", 20),
    "SITEID": ("Study Site Identifier", "text", 20),
    "AGE": ("Age", "integer", 3),
    "AGEU": ("Age Units", "text", 10),
    "SEX": ("Sex", "text", 1),
    "RACE": ("Race", "text", 50),
    "ETHNIC": ("Ethnicity", "text", 50),
    "ARMCD": ("Planned Arm Code", "text", 20),
    "ARM": ("Description of Planned Arm", "text", 50),
    "RFSTDTC": ("Subject Reference Start Date/Time", "datetime", 20),
    "RFICDTC": ("Date/Time of Informed Consent", "datetime", 20),
    "AESEQ": ("Sequence Number", "integer", 8),
    "AETERM": ("Reported Term for the AE", "text", 200),
    "AEDECOD": ("Dictionary-Derived Term", "text", 200),
    "AEBODSYS": ("Body System or Organ Class", "text", 200),
    "AESTDTC": ("Start Date/Time of AE", "datetime", 20),
    "AEENDTC": ("End Date/Time of AE", "datetime", 20),
    "AESEV": ("Severity/Intensity", "text", 20),
    "AESER": ("Serious Event", "text", 1),
    "AEREL": ("Causality", "text", 1),
    "AEOUT": ("Outcome of AE", "text", 50),
    "LBSEQ": ("Sequence Number", "integer", 8),
    "LBTESTCD": ("Lab Test or Examination Short Name", "text", 8),
    "LBTEST": ("Lab Test or Examination Name", "text", 40),
    "LBCAT": ("Category for Lab Test", "text", 40),
    "LBORRES": ("Result or Finding in Original Units", "text", 20),
    "LBORRESU": ("Original Units", "text", 20),
    "LBSTRESN": ("Numeric Result/Finding in Std Units", "float", 20),
    "LBSTRESU": ("Standard Units", "text", 20),
    "LBSTNRLO": ("Reference Range Lower Limit-Std", "float", 20),
    "LBSTNRHI": ("Reference Range Upper Limit-Std", "float", 20),
    "LBNRIND": ("Reference Range Indicator", "text", 10),
    "LBDTC": ("Date/Time of Specimen Collection", "datetime", 20),
    "VSSEQ": ("Sequence Number", "integer", 8),
    "VSTESTCD": ("Vital Signs Test Short Name", "text", 8),
    "VSTEST": ("Vital Signs Test Name", "text", 40),
    "VSPOS": ("Vital Signs Position of Subject", "text", 20),
    "VSORRES": ("Result or Finding in Original Units", "text", 20),
    "VSORRESU": ("Original Units", "text", 20),
    "VSSTRESN": ("Numeric Result in Standard Units", "float", 20),
    "VSSTRESU": ("Standard Units", "text", 20),
    "VSDTC": ("Date/Time of Vital Signs", "datetime", 20),
    "EXSEQ": ("Sequence Number", "integer", 8),
    "EXTRT": ("Name of Actual Treatment", "text", 200),
    "EXDOSE": ("Dose per Administration", "float", 20),
    "EXDOSU": ("Units of Dose", "text", 20),
    "EXROUTE": ("Route of Administration", "text", 40),
    "EXDOSFRQ": ("Dosing Frequency per Interval", "text", 20),
    "EXSTDTC": ("Start Date/Time of Treatment", "datetime", 20),
    "EXENDTC": ("End Date/Time of Treatment", "datetime", 20),
    "VISIT": ("Visit Name", "text", 40),
}
