"""Clinical-trial analytics on PySpark: tabulation domains, analysis datasets,
imputation, report tables, survival models and adverse-event signal scores."""
