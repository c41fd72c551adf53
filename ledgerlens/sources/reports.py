"""Report sinks (S14–S17): small result frames written as header CSVs.

A report is an aggregate bounded by months, cohorts, gateway × reason or the
eight checks, so it is written as one CSV file (one writer task); the frames
that feed it are computed in parallel. ``read_report`` reads one back with the
frame's own schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerlens.operators.checks import Validator
from ledgerlens.operators.cohort import CohortEngine
from ledgerlens.operators.failures import FailureMonitor
from ledgerlens.operators.metrics import MetricsEngine
from ledgerlens.sources.csv import read_csv, write_csv

# Fixed values that must equal the reference's report file names.
REVENUE_REPORT = "revenue_report.csv"
COHORT_REPORT = "cohort_report.csv"
FAILURE_REPORT = "failure_monitor.csv"
RETRY_REPORT = "retry_summary.csv"
QUALITY_REPORT = "quality_report.csv"


def _out(out_dir: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{name}"


def export_revenue_report(metrics: MetricsEngine, out_dir: str) -> str:
    return write_csv(metrics.monthly_revenue(), _out(out_dir, REVENUE_REPORT), single_file=True)


def export_cohort_report(cohorts: CohortEngine, out_dir: str) -> str:
    return write_csv(cohorts.cohort_arpu(), _out(out_dir, COHORT_REPORT), single_file=True)


def export_full_report(failures: FailureMonitor, out_dir: str) -> tuple[str, str]:
    a = write_csv(failures.failure_monitor(), _out(out_dir, FAILURE_REPORT), single_file=True)
    b = write_csv(failures.retry_summary(), _out(out_dir, RETRY_REPORT), single_file=True)
    return a, b


def export_quality_report(validator: Validator, out_dir: str) -> str:
    return write_csv(validator.quality_report(), _out(out_dir, QUALITY_REPORT), single_file=True)


def read_report(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_csv(spark, path, schema=schema)
