"""Explicit schemas of the five domain tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

USERS = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("signup_date", T.DateType(), False),
    T.StructField("cohort_month", T.StringType(), False),
    T.StructField("active", T.IntegerType(), True),
])

PAYMENTS = T.StructType([
    T.StructField("payment_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("payment_date", T.DateType(), True),
    T.StructField("amount", MONEY, True),
    T.StructField("status", T.StringType(), True),
    T.StructField("gateway", T.StringType(), True),
    T.StructField("failure_reason", T.StringType(), True),
])

APPLICATIONS = T.StructType([
    T.StructField("application_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("company", T.StringType(), True),
    T.StructField("fee", MONEY, True),
])

REVENUE_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("payment_id", T.StringType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("event_time", T.TimestampNTZType(), True),
])

PAYMENT_FAILURES = T.StructType([
    T.StructField("failure_id", T.StringType(), False),
    T.StructField("payment_id", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("failure_date", T.DateType(), True),
    T.StructField("failure_reason", T.StringType(), True),
    T.StructField("gateway", T.StringType(), True),
    T.StructField("amount", MONEY, True),
    T.StructField("recovered", T.IntegerType(), True),
    T.StructField("recovery_date", T.DateType(), True),
    T.StructField("recovery_amount", MONEY, True),
])

# Load order: parents before children (FK direction users → payments → events/failures).
TABLE_SCHEMAS: dict[str, T.StructType] = {
    "users": USERS,
    "payments": PAYMENTS,
    "applications": APPLICATIONS,
    "revenue_events": REVENUE_EVENTS,
    "payment_failures": PAYMENT_FAILURES,
}
TABLE_NAMES = tuple(TABLE_SCHEMAS)

# Fixed values that must equal the reference's domains.
STATUSES = ("success", "failed", "refunded", "pending")
GATEWAYS = ("stripe", "razorpay", "paypal", "bank_transfer")
EVENT_TYPES = ("payment_received", "refund_issued", "chargeback", "retry_success")
