"""DuckDB-dialect building blocks for the oracle strings.

The oracle strings are an independent statement of each operator's semantics in
plain SQL, run by DuckDB on the same Parquet tables. They share the fixture
binding as a CTE prelude and the conventions of ``ledgerlens.functions.expr`` (one
rounding; ratios in DOUBLE with NULLIF on the divisor; money sums exact in DECIMAL,
DOUBLE at the edge). Display text is DuckDB's own ``format``.
"""

from __future__ import annotations


def R2(x: str) -> str:
    """Half-up in one rounding of the double's shortest decimal text."""
    return f"CAST(ROUND(CAST(CAST(CAST(({x}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def R2E(x: str) -> str:
    """Whole hundredths of 100 x, ties to the even one, over 100."""
    v = f"(CAST(({x}) AS DOUBLE) * 100.0)"
    return f"(CASE WHEN {v} - floor({v}) = 0.5 THEN 2.0 * round({v} / 2.0) ELSE round({v}) END / CAST(100 AS DOUBLE))"


def RATIO(n: str, d: str) -> str:
    return f"(CAST(({n}) AS DOUBLE) / NULLIF(CAST(({d}) AS DOUBLE), 0.0))"


def PCT(n: str, d: str) -> str:
    return R2(f"{RATIO(n, d)} * 100.0")


def MONEY(x: str) -> str:
    return f"CAST(({x}) AS DOUBLE)"


def CNT(cond: str) -> str:
    """COUNT(*) FILTER (WHERE cond) as BIGINT."""
    return f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT)"


def YM(d: str) -> str:
    return f"strftime({d}, '%Y-%m')"


def DADD(d: str, n: str) -> str:
    return f"CAST({d} + {n} AS DATE)"


def LEADING_INT(text: str) -> str:
    """The whole number ``text`` begins with, 0 where there is none, NULL of NULL."""
    number = f"regexp_extract({text}, '^[ \\t\\n\\f\\r\\x0B]*([+-]?[0-9]+)', 1)"
    return f"CASE {number} WHEN '' THEN 0 ELSE CAST(nullif({number}, '') AS INTEGER) END"


def MOFF(d: str, cm: str) -> str:
    """Whole calendar months from cohort YYYY-MM ``cm`` to the month of ``d``."""
    return (f"((CAST(year({d}) AS INTEGER) - {LEADING_INT(f'substr({cm}, 1, 4)')}) * 12"
            f" + (CAST(month({d}) AS INTEGER) - {LEADING_INT(f'substr({cm}, 6, 2)')}))")


# The fixture binding (FIXTURES.md §3) in DuckDB dialect. It ends in the CTE
# list; each oracle string appends its own CTEs or its final SELECT.
BINDING = f"""WITH users AS (
 SELECT c_custkey AS user_id, {DADD("DATE '1995-01-01'", "CAST((c_custkey * 37) % 730 AS INT)")} AS signup_date,
  {YM(DADD("DATE '1995-01-01'", "CAST((c_custkey * 37) % 730 AS INT)"))} AS cohort_month,
  CAST(CASE WHEN c_acctbal < -900 THEN NULL WHEN c_acctbal < 1800 THEN 0 ELSE 1 END AS INTEGER) AS active FROM customer),
 base_pay AS (SELECT o_orderkey AS pid, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS payment_date,
   CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
   CASE WHEN o_orderstatus='F' AND o_orderkey % 2 = 0 THEN 'failed'
        WHEN o_orderstatus='P' AND o_orderkey % 5 = 0 THEN 'refunded'
        WHEN o_orderstatus='P' AND o_orderkey % 10 = 1 THEN 'pending' ELSE 'success' END AS status,
   CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'stripe' WHEN o_orderpriority='3-MEDIUM' THEN 'razorpay'
        WHEN o_orderpriority='4-NOT SPECIFIED' THEN 'paypal' ELSE 'bank_transfer' END AS gateway FROM orders),
 all_pay AS (SELECT pid AS payment_id, * FROM base_pay UNION ALL SELECT -pid-1 AS payment_id, * FROM base_pay WHERE pid % 50 = 7),
 payments_x AS (SELECT payment_id, user_id, payment_date, amount, status, gateway, CASE WHEN status NOT IN ('failed','refunded') THEN NULL
   WHEN gateway='stripe' THEN CASE pid % 3 WHEN 0 THEN 'card_declined' WHEN 1 THEN 'fraud_detected' ELSE 'expired_card' END
   WHEN gateway='razorpay' THEN CASE pid % 3 WHEN 0 THEN 'insufficient_funds' WHEN 1 THEN 'bank_error' ELSE 'network_error' END
   WHEN gateway='paypal' THEN CASE pid % 3 WHEN 0 THEN 'card_declined' WHEN 1 THEN 'network_error' ELSE 'invalid_card' END
   ELSE CASE pid % 3 WHEN 0 THEN 'bank_error' WHEN 1 THEN 'gateway_timeout' ELSE 'insufficient_funds' END END AS failure_reason, pid FROM all_pay),
 payments AS (SELECT payment_id, user_id, payment_date, amount, status, gateway, failure_reason FROM payments_x),
 fail0 AS (SELECT payment_id, user_id, payment_date AS failure_date, coalesce(failure_reason,'unknown') AS failure_reason, gateway, amount, pid,
   (pid // 2) % 20 < 7 AS rec, {DADD("payment_date", "CAST(1 + pid % 7 AS INT)")} AS rdate FROM payments_x WHERE status='failed'),
 payment_failures_x AS (SELECT payment_id AS failure_id, payment_id, user_id, failure_date, failure_reason, gateway, amount,
   CAST(CASE WHEN rec AND rdate <= DATE '2001-08-01' THEN 1 ELSE 0 END AS INTEGER) AS recovered,
   CASE WHEN rec AND rdate <= DATE '2001-08-01' THEN rdate END AS recovery_date,
   CASE WHEN rec AND rdate <= DATE '2001-08-01' THEN CAST(amount * CAST(100 - pid % 6 AS DECIMAL(5,0)) / 100 AS DECIMAL(18,2)) END AS recovery_amount,
   pid FROM fail0),
 payment_failures AS (SELECT failure_id, payment_id, user_id, failure_date, failure_reason, gateway, amount, recovered,
   recovery_date, recovery_amount FROM payment_failures_x),
 revenue_events AS (SELECT event_id, payment_id, event_type, CAST(event_date AS TIMESTAMP) AS event_time FROM (
   SELECT payment_id*4 AS event_id, payment_id, CASE WHEN status='refunded' THEN 'refund_issued' ELSE 'payment_received' END AS event_type, payment_date AS event_date FROM payments_x WHERE NOT (status='pending' AND pid % 3 = 0)
   UNION ALL SELECT payment_id*4+1, payment_id, 'chargeback', {DADD("payment_date", "CAST(1 + pid % 30 AS INT)")} FROM payments_x WHERE status='success' AND pid % 33 = 0
   UNION ALL SELECT payment_id*4+2, payment_id, 'retry_success', recovery_date FROM payment_failures_x WHERE recovered = 1 AND recovery_date IS NOT NULL)),
 applications AS (SELECT o_orderkey AS application_id, o_custkey AS user_id, CONCAT('company_', CAST(o_orderkey % 100 AS VARCHAR)) AS company,
   CAST(199 + o_orderkey % 4800 AS DECIMAL(18,2)) AS fee FROM orders)"""


def with_binding(body: str) -> str:
    """``body`` either starts with ``, name AS (...)`` (more CTEs) or is a SELECT."""
    return f"{BINDING}\n{body.strip()}"
