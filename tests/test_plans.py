"""Plan assertions: no Python UDFs, anti-joins, scans per table, pushdown on stored tables."""

import re

import pytest

from conftest import SF_SMALL
from ledgerlens.operators.checks import Validator
from ledgerlens.operators.failures import FailureMonitor
from ledgerlens.operators.metrics import MetricsEngine
from ledgerlens.params import FIXTURE_PARAMS
from ledgerlens.plans.registry import QUERIES
from ledgerlens.sources.binding import bind
from ledgerlens.sources.tables import read_tables, write_table, write_tables

# The reference's operators; those of the training-data subpackage have their own tests.
PLAIN = sorted(k for k in QUERIES if not k.startswith(("export_", "load_", "src_")))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", PLAIN)
def test_no_python_udf(spark, key):
    p = plan(QUERIES[key](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
        assert node not in p, key


def test_anti_joins(spark):
    t = bind(spark, SF_SMALL)
    assert "LeftAnti" in FailureMonitor(t, FIXTURE_PARAMS).stale_pending()._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "LeftAnti" in Validator(t).orphan_count()._jdf.queryExecution().optimizedPlan().toString()


def test_null_scan_reads_each_table_once(spark, tmp_path):
    root = str(tmp_path / "store")
    write_tables(bind(spark, SF_SMALL), root)
    stored = read_tables(spark, root)
    p = Validator(stored).null_scan()._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Relation ") == 3     # users, payments, payment_failures — not ten scans


def test_pushdown_and_pruning_on_stored_tables(spark, tmp_path):
    root = str(tmp_path / "store")
    write_table(bind(spark, SF_SMALL).payments, root, "payments")
    stored = read_tables(spark, root)
    p = plan(MetricsEngine(stored).monthly_revenue())
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,success)]" in p
    assert "ReadSchema: struct<user_id:bigint,payment_date:date,amount:decimal(18,2),status:string>" in p


def test_no_collect_in_library_code():
    """Library code never pulls a data set to the driver; the only driver reads are
    one-row results (`first()` in the check isolation helper and `scalar`). The
    training-data subpackage reads bounded tables (a row per range, pattern or template
    word), each named in its module, and is not covered here."""
    import pathlib
    import re

    root = pathlib.Path(__file__).resolve().parents[1] / "ledgerlens"
    offenders = []
    for p in sorted(root.rglob("*.py")):
        if p.parent.name == "llm":
            continue
        for i, line in enumerate(p.read_text().splitlines(), 1):
            if re.search(r"\.(collect|toPandas|take|toLocalIterator)\(", line):
                offenders.append(f"{p.name}:{i}")
    assert offenders == []





def _aggregated_before_join(df) -> bool:
    """In the optimized plan, every scan of the payments/failures source (orders under the
    binding) reaches its first Join ancestor through an Aggregate grouped by user_id."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()

    def depth(ln: str) -> int:
        m = re.search(r"[+:]- ", ln)
        return m.start() if m else -1

    scans = [i for i, ln in enumerate(lines) if "Relation [o_orderkey" in ln]
    assert scans
    for i in scans:
        d, pre_aggregated = depth(lines[i]), False
        for ln in reversed(lines[:i]):
            if depth(ln) < d:                   # the parent of the current node
                d = depth(ln)
                if "Aggregate [" in ln and "user_id" in ln.split("], [")[0]:
                    pre_aggregated = True
                if "Join " in ln:
                    if not pre_aggregated:
                        return False
                    break
    return True


def test_pre_aggregation_before_user_joins(spark):
    from ledgerlens.operators.cohort import CohortEngine

    t = bind(spark, SF_SMALL)
    c, f, v = CohortEngine(t), FailureMonitor(t, FIXTURE_PARAMS), Validator(t, FIXTURE_PARAMS)
    for df in (c.cohort_revenue_raw(), c.cohort_revenue_matrix(), c.cohort_lifetime(), f.revenue_leakage(),
               v.payments_user_links()):
        assert _aggregated_before_join(df)
    # Negative control: a join of raw payments is caught.
    assert not _aggregated_before_join(t.payments.join(t.users, "user_id").groupBy("cohort_month").count())
