"""Small hand-made inputs for the model."""

import datetime as dt
from decimal import Decimal

from tidemark import schemas as S


def d(s):
    return dt.date.fromisoformat(s)


def money(x):
    return Decimal(str(x)).quantize(Decimal("0.01"))


PLAN_ROWS = [("plan_basic", "Basic", money(19), "monthly"),
             ("plan_pro", "Professional", money(49), "monthly"),
             ("plan_enterprise", "Enterprise", money(199), "monthly")]


def plans(spark, rows=None):
    return spark.createDataFrame(PLAN_ROWS if rows is None else rows, S.PLANS)


def customers(spark, ids=("cust_1",), country="US", industry="Tech", size="SMB"):
    rows = [(c, f"C {c}", d("2025-01-01"), country, industry, size) for c in ids]
    return spark.createDataFrame(rows, S.CUSTOMERS)


def events(spark, rows):
    """rows: (event_id, customer_id, plan_id, event_type, 'yyyy-mm-dd', amount)."""
    typed = [(e, c, p, t, d(day), money(a)) for e, c, p, t, day, a in rows]
    return spark.createDataFrame(typed, S.EVENTS)


def ledger(spark, rows, columns):
    """A stand-in ledger table with only some columns (as the reference's negative tests)."""
    return spark.createDataFrame(rows, columns)
