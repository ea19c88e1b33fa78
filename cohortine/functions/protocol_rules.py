"""Keyword rules that place protocol items in datasets.

Only three placements are given by the behaviour this library matches: overall
survival belongs to ADTTE, laboratory items to LB, and an unrecognised item has
low confidence and needs a supplemental qualifier. All other rules are our own.
The longest rule whose words occur in the item wins.
"""

from __future__ import annotations

# keyword, tabulation domain, analysis dataset, confidence
RULES = (
    ("overall survival", "DM", "ADTTE", "high"),
    ("progression-free survival", "RS", "ADTTE", "high"),
    ("duration of response", "RS", "ADTTE", "high"),
    ("time to", "RS", "ADTTE", "medium"),
    ("adverse event", "AE", "ADAE", "high"),
    ("safety", "AE", "ADAE", "medium"),
    ("tolerability", "AE", "ADAE", "medium"),
    ("laboratory", "LB", "ADLB", "high"),
    ("hematology", "LB", "ADLB", "high"),
    ("blood pressure", "VS", "ADVS", "high"),
    ("vital sign", "VS", "ADVS", "high"),
    ("body weight", "VS", "ADVS", "medium"),
    ("response rate", "RS", "ADRS", "high"),
    ("tumor", "TU", "ADTR", "medium"),
    ("questionnaire", "QS", "ADQS", "high"),
    ("performance status", "QS", "ADQS", "medium"),
    ("prior treatment", "CM", "ADCM", "medium"),
    ("medication", "CM", "ADCM", "medium"),
    ("dose", "EX", "ADEX", "medium"),
    ("disease", "MH", "ADMH", "medium"),
    ("age >=", "DM", "ADSL", "medium"),
    ("informed consent", "DM", "ADSL", "medium"),
)
