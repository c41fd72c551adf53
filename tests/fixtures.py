"""Hand-built micro fixtures (a few rows each) in the domain schemas."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from ledgerlens.schema import TABLE_SCHEMAS
from ledgerlens.sources.tables import Tables

D = dt.date


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def user(uid, signup, cohort=None, active=1):
    signup = D.fromisoformat(signup)
    return (str(uid), signup, cohort if cohort is not None else signup.strftime("%Y-%m"), active)


def pay(pid, uid, date, amount, status="success", gateway="stripe", reason=None):
    return (str(pid), None if uid is None else str(uid), D.fromisoformat(date), money(amount), status, gateway,
            reason)


def fail(fid, uid, date, amount, gateway="stripe", reason="card_declined", recovered=0, rdate=None, ramount=None):
    return (str(fid), str(fid), str(uid), D.fromisoformat(date), reason, gateway, money(amount), recovered,
            None if rdate is None else D.fromisoformat(rdate), None if ramount is None else money(ramount))


def event(eid, pid, etype="payment_received", ts="2024-01-01T00:00:00"):
    return (str(eid), str(pid), etype, dt.datetime.fromisoformat(ts))


def make_tables(spark, users=(), payments=(), revenue_events=(), payment_failures=(), applications=()):
    rows = {"users": users, "payments": payments, "applications": applications,
            "revenue_events": revenue_events, "payment_failures": payment_failures}
    return Tables(**{n: spark.createDataFrame(list(r), TABLE_SCHEMAS[n]) for n, r in rows.items()})
