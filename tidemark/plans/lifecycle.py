"""L1: derive each event's type from the customer's ordered amounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sequence import ordered_lag

ORDER = ["event_date", "event_id"]
#: Leading characters of event_id that cut a customer's day: identifiers are unique, so those of `evt_` and twelve
#: digits that share them, and with them the rows of one task, are at most 100,000.
ID_PREFIX = 11


def day_cut(id_prefix: int | None) -> F.Column | None:
    """A customer's day in the order of its events' identifiers, by their first characters (None: uncut)."""
    return None if id_prefix is None else F.substring("event_id", 1, id_prefix)


def event_type_rule(amount, prev_amount) -> F.Column:
    """First event -> signup, whatever its amount; 0 -> cancel; from 0 -> reactivate;
    not cheaper (a move at the same price too) -> upgrade; cheaper -> downgrade."""
    a, p = F.col(amount), F.col(prev_amount)
    return (
        F.when(p.isNull(), F.lit("signup"))
        .when(a == 0, F.lit("cancel"))
        .when(p == 0, F.lit("reactivate"))
        .when(a >= p, F.lit("upgrade"))
        .otherwise(F.lit("downgrade"))
    )


def derive_event_type(events: DataFrame, split_rows: int | None = None, id_prefix: int | None = ID_PREFIX) -> DataFrame:
    """Add ``event_type`` (replacing any existing one) from the previous amount of
    the same customer in (event_date, event_id) order. A customer's day is cut by
    the first ``id_prefix`` characters of event_id, without a look at the data; choose them by the format of the
    identifiers. ``split_rows``: count and sample instead, and split days above that many events."""
    base = events.drop("event_type") if "event_type" in events.columns else events
    lagged = ordered_lag(base, "customer_id", ORDER, ["monthly_amount"], prefix="_prev_", split_rows=split_rows,
                         cut=day_cut(id_prefix))
    return lagged.select(
        *base.columns,
        event_type_rule("monthly_amount", "_prev_monthly_amount").alias("event_type"),
    )
