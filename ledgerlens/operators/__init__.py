"""The analytical operators, one engine per family, each method a lazy DataFrame:
``metrics.MetricsEngine`` (revenue), ``cohort.CohortEngine`` (signup cohorts),
``failures.FailureMonitor`` (failures, retries, leakage, reconciliation),
``checks.Validator`` (graded data-quality checks) and ``views`` (dashboard data prep)."""
