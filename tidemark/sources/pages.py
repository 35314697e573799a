"""A large result handed to a client page by page, by position in a total order.

A page is the next rows behind the last one seen, so every page costs one
pass with a bounded heap per task (a top-k), whatever its number; nothing is
numbered and no rows before it are sent. The total comes from a count that
reads no column it does not have to.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: The most rows that a page may ask for: what the driver may be sent at once.
MOST_ROWS = 10_000


class Page:
    """Rows of one page, and `after`: the position to ask for the next one, None behind the last."""

    def __init__(self, rows: list[Row], after: tuple | None):
        self.rows = rows
        self.after = after


def _above(column: Column, value) -> Column:
    """Null first, as rows are ordered."""
    return column.isNotNull() if value is None else column > F.lit(value)


def behind(order: Sequence[str], after: Sequence) -> Column:
    """Whether a row stands behind the position `after` in `order` (ascending, null first)."""
    if len(order) != len(after):
        raise ValueError(f"a position has {len(order)} values, not {len(after)}")
    cases = []
    for i, (name, value) in enumerate(zip(order, after, strict=True)):
        same = [F.col(n).eqNullSafe(F.lit(v)) for n, v in zip(order[:i], after[:i], strict=False)]
        cases.append(reduce(Column.__and__, same, _above(F.col(name), value)))
    found = reduce(Column.__or__, cases)
    # implied by the rest, and simple enough to reach a stored table's statistics
    return found if after[0] is None else (F.col(order[0]) >= F.lit(after[0])) & found


def page_rows(df: DataFrame, order: Sequence[str], size: int, after: Sequence | None = None) -> DataFrame:
    """The `size` rows of `df` behind `after` (None: from the start), in `order`.

    `order` must be unique over the rows, or rows that share a position at a page's end are lost.
    """
    if not 0 < size <= MOST_ROWS:
        raise ValueError(f"a page has 1 to {MOST_ROWS} rows, not {size}")
    rows = df if after is None else df.where(behind(order, after))
    return rows.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(size)


def read_page(df: DataFrame, order: Sequence[str], size: int, after: Sequence | None = None) -> Page:
    """One page, sent to the driver: at most `size` rows."""
    rows = page_rows(df, order, size, after).collect()
    return Page(rows, tuple(rows[-1][c] for c in order) if len(rows) == size else None)


def read_pages(df: DataFrame, order: Sequence[str], size: int) -> Iterator[Page]:
    """All pages one after the other; the last may be empty, when the rows before it filled theirs."""
    after: tuple | None = None
    while True:
        page = read_page(df, order, size, after)
        yield page
        after = page.after
        if after is None:
            return


def total_rows(df: DataFrame) -> int:
    """How many rows the pages have together; a count, without any row."""
    return df.count()
