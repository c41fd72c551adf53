"""Binds the driver's test tables (``customer``, ``orders``) to the five domain tables.

This is a test-input adapter, not an operator: it turns the TPC-H-like tables
into users / payments / applications / revenue_events / payment_failures with
the dirty cases the operators must handle (duplicates, pre-signup payments,
NULL flags, stale pendings, voided recoveries, chargebacks). The same mapping
is written as a SQL prelude in ``ledgerlens.plans.oracle`` for DuckDB.

Every table is one lazy projection over a single scan: duplicate payments and
the event fan-out come from ``explode`` over a small literal array rather than
``union`` of re-scans, so the bound tables cost one pass over ``orders``.
Ids stay BIGINT under the binding.
"""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.sources.tables import Tables

# Fixed values of the fixture binding.
SIGNUP_EPOCH = dt.date(1995, 1, 1)
SIGNUP_SPREAD_DAYS = 730
SIGNUP_STRIDE = 37
ACTIVE_NULL_BELOW = -900
ACTIVE_ZERO_BELOW = 1800
DUP_EVERY, DUP_AT = 50, 7
RECOVERY_CUTOFF = dt.date(2001, 8, 1)
CHARGEBACK_EVERY, CHARGEBACK_SPREAD = 33, 30
# Failure reason by gateway, chosen by payment key modulo 3 (positions 0, 1, 2).
REASONS_BY_GATEWAY = {
    "stripe": ("card_declined", "fraud_detected", "expired_card"),
    "razorpay": ("insufficient_funds", "bank_error", "network_error"),
    "paypal": ("card_declined", "network_error", "invalid_card"),
    "bank_transfer": ("bank_error", "gateway_timeout", "insufficient_funds"),
}


def bind(spark: SparkSession, sf_dir: str) -> Tables:
    d = sf_dir.rstrip("/")
    return bind_frames(lambda: spark.read.parquet(f"{d}/customer.parquet"),
                       lambda: spark.read.parquet(f"{d}/orders.parquet"))


# Each bound table is a couple of ``selectExpr`` projections: the expressions are
# parsed on the JVM side in one call, instead of one py4j round trip per Column.
_SIGNUP = f"date_add(DATE'{SIGNUP_EPOCH}', CAST((c_custkey * {SIGNUP_STRIDE}) % {SIGNUP_SPREAD_DAYS} AS INT))"

_STATUS = ("CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'failed' "
           "WHEN o_orderstatus = 'P' AND o_orderkey % 5 = 0 THEN 'refunded' "
           "WHEN o_orderstatus = 'P' AND o_orderkey % 10 = 1 THEN 'pending' ELSE 'success' END")

_GATEWAY = ("CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'stripe' "
            "WHEN o_orderpriority = '3-MEDIUM' THEN 'razorpay' "
            "WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'paypal' ELSE 'bank_transfer' END")


def _pick3(names: tuple[str, str, str]) -> str:
    r0, r1, r2 = names
    return f"CASE pid % 3 WHEN 0 THEN '{r0}' WHEN 1 THEN '{r1}' ELSE '{r2}' END"


# Unknown gateways take the last list, as bank_transfer does.
_REASON = ("CASE WHEN status NOT IN ('failed', 'refunded') THEN NULL "
           + " ".join(f"WHEN gateway = '{gw}' THEN {_pick3(rs)}" for gw, rs in REASONS_BY_GATEWAY.items())
           + f" ELSE {_pick3(REASONS_BY_GATEWAY['bank_transfer'])} END")

_RDATE = "date_add(payment_date, CAST(1 + pid % 7 AS INT))"
_RECOVERED = f"((pid div 2) % 20 < 7 AND {_RDATE} <= DATE'{RECOVERY_CUTOFF}')"


def _users(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "c_custkey AS user_id",
        f"{_SIGNUP} AS signup_date",
        f"date_format({_SIGNUP}, 'yyyy-MM') AS cohort_month",
        f"CAST(CASE WHEN c_acctbal < {ACTIVE_NULL_BELOW} THEN NULL WHEN c_acctbal < {ACTIVE_ZERO_BELOW} THEN 0"
        " ELSE 1 END AS INT) AS active")


def _payments_with_pid(orders: DataFrame) -> DataFrame:
    base = orders.selectExpr(
        "o_orderkey AS pid",
        f"explode(sequence(0, CASE WHEN o_orderkey % {DUP_EVERY} = {DUP_AT} THEN 1 ELSE 0 END)) AS copy",
        "o_custkey AS user_id",
        "CAST(o_orderdate AS DATE) AS payment_date",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS amount",
        f"{_STATUS} AS status",
        f"{_GATEWAY} AS gateway")
    return base.selectExpr(
        "CASE WHEN copy = 1 THEN -pid - 1 ELSE pid END AS payment_id",
        "user_id", "payment_date", "amount", "status", "gateway",
        f"{_REASON} AS failure_reason",
        "pid")


def _failures(pay: DataFrame) -> DataFrame:
    return pay.where("status = 'failed'").selectExpr(
        "payment_id AS failure_id", "payment_id", "user_id",
        "payment_date AS failure_date",
        "coalesce(failure_reason, 'unknown') AS failure_reason",
        "gateway", "amount",
        f"CAST(CASE WHEN {_RECOVERED} THEN 1 ELSE 0 END AS INT) AS recovered",
        f"CASE WHEN {_RECOVERED} THEN {_RDATE} END AS recovery_date",
        f"CASE WHEN {_RECOVERED} THEN CAST(amount * CAST(100 - pid % 6 AS DECIMAL(5,0)) / 100 AS DECIMAL(18,2))"
        " END AS recovery_amount")


def _events(pay: DataFrame) -> DataFrame:
    """Up to three events per payment from one pass: the payment event (missing
    for a third of pendings, which makes them stale), a chargeback for some
    successes, and a retry_success for recovered failures."""
    def ev(cond: str, eid: str, etype: str, edate: str) -> str:
        return (f"CASE WHEN {cond} THEN named_struct('event_id', {eid}, 'event_type', {etype}, "
                f"'event_date', {edate}) END")

    main = ev("NOT (status = 'pending' AND pid % 3 = 0)", "payment_id * 4",
              "CASE WHEN status = 'refunded' THEN 'refund_issued' ELSE 'payment_received' END", "payment_date")
    chargeback = ev(f"status = 'success' AND pid % {CHARGEBACK_EVERY} = 0", "payment_id * 4 + 1", "'chargeback'",
                    f"date_add(payment_date, CAST(1 + pid % {CHARGEBACK_SPREAD} AS INT))")
    retry = ev(f"status = 'failed' AND {_RECOVERED}", "payment_id * 4 + 2", "'retry_success'", _RDATE)
    return (pay.selectExpr("payment_id", f"explode(array({main}, {chargeback}, {retry})) AS e")
            .where("e IS NOT NULL")
            .selectExpr("e.event_id AS event_id", "payment_id", "e.event_type AS event_type",
                        "CAST(e.event_date AS TIMESTAMP_NTZ) AS event_time"))


def _applications(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS application_id",
        "o_custkey AS user_id",
        "concat('company_', CAST(o_orderkey % 100 AS STRING)) AS company",
        "CAST(199 + o_orderkey % 4800 AS DECIMAL(18,2)) AS fee")


def _once(fn: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
    box: list[DataFrame] = []

    def get() -> DataFrame:
        if not box:
            box.append(fn())
        return box[0]

    return get


def bind_frames(customer: DataFrame | Callable[[], DataFrame],
                orders: DataFrame | Callable[[], DataFrame]) -> Tables:
    """Bound tables over ``customer`` and ``orders`` (frames, or callables giving them).
    Nothing is planned until a table is first used."""
    cust = customer if callable(customer) else (lambda: customer)
    ords = _once(orders if callable(orders) else (lambda: orders))
    pay = _once(lambda: _payments_with_pid(ords()))
    return Tables(
        users=lambda: _users(cust()),
        payments=lambda: pay().drop("pid"),
        applications=lambda: _applications(ords()),
        revenue_events=lambda: _events(pay()),
        payment_failures=lambda: _failures(pay()),
    )
