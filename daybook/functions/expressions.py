"""Scalar column expressions. All are built-in Catalyst expressions, so they
stay inside whole-stage codegen; none needs a UDF."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: must equal the source system's for right results. ---
# Review titles and the sentiment each one means, in the source's order.
# Matching is exact and case-sensitive; any other title is 'unknown'.
TITLE_SENTIMENT = [
    ("Cực kì hài lòng", "positive"),
    ("Hài lòng", "positive"),
    ("Bình thường", "neutral"),
    ("Không hài lòng", "negative"),
    ("Rất không hài lòng", "negative"),
]
UNKNOWN = "unknown"
# Content values that mean "no content".
EMPTY_CONTENT = ["", "null"]
# Valid rating range, inclusive.
RATING_MIN, RATING_MAX = 1, 5
# Per-column defaults of the product cleaning step.
PRODUCT_DEFAULTS = {
    "price": 0.0,
    "list_price": 0.0,
    "discount": 0.0,
    "discount_rate": 0.0,
    "all_time_quantity_sold": 0,
    "stock_item_qty": 0,
    "stock_item_max_sale_qty": 0,
    "short_description": "",
    "inventory_status": "unknown",
}
# High-water-mark floors when a target is empty: dimensions compare with >=,
# facts with >.
DIM_FLOOR_DATE = "1900-01-01"
FACT_FLOOR_DATE = "1900-12-31"
# Stamp formats of landed files: run stamp and day stamp.
RUN_STAMP_FORMAT = "yyyyMMdd_HHmmss"
DAY_FORMAT = "yyyy-MM-dd"
# --- end of fixed values ---


# Every value the sentiment expression can produce.
SENTIMENTS = sorted({label for _, label in TITLE_SENTIMENT} | {UNKNOWN})


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_ts(c: str | Column) -> Column:
    """Epoch seconds -> TIMESTAMP (no round trip through formatted text)."""
    return F.timestamp_seconds(col_(c))


def parse_day(c: str | Column) -> Column:
    """'yyyy-MM-dd' text -> DATE; malformed text gives NULL, not an error."""
    return F.try_to_date(col_(c), DAY_FORMAT)


def days_between(a: str | Column, b: str | Column) -> Column:
    """Absolute whole-day distance; NULL when either side is NULL."""
    return F.abs(F.datediff(col_(a), col_(b)))


def sentiment(title: str | Column, mapping: list[tuple[str, str]] | None = None) -> Column:
    """Exact title -> label lookup as one CASE expression (``mapping``
    defaults to the fixed title vocabulary); anything else is 'unknown'."""
    t = col_(title)
    expr = None
    for text, label in (mapping or TITLE_SENTIMENT):
        expr = F.when(t == text, label) if expr is None else expr.when(t == text, label)
    return expr.otherwise(UNKNOWN)


def title_or_unknown(title: str | Column) -> Column:
    return F.coalesce(col_(title), F.lit(UNKNOWN))


def content_or_unknown(content: str | Column) -> Column:
    c = col_(content)
    return F.when(c.isNull() | c.isin(*EMPTY_CONTENT), F.lit(UNKNOWN)).otherwise(c)


def rating_valid(rating: str | Column) -> Column:
    r = col_(rating)
    return (r >= RATING_MIN) & (r <= RATING_MAX)


def changed(left: str, right: str, cols: list[str], null_safe: bool = False) -> Column:
    """Attribute-change predicate between two aliased sides.

    ``null_safe=False`` is the warehouse's ``a != b OR ...``: a NULL on either
    side makes that term NULL, so a change to or from NULL goes unseen.
    ``null_safe=True`` treats NULL as a value."""
    terms = []
    for c in cols:
        a, b = F.col(f"{left}.{c}"), F.col(f"{right}.{c}")
        terms.append(~a.eqNullSafe(b) if null_safe else a != b)
    return reduce(or_, terms)


def last_segment(s: str | Column, sep: str) -> Column:
    """Text after the last ``sep`` (the whole text when ``sep`` is absent)."""
    return F.element_at(F.split(col_(s), re.escape(sep)), -1)


def run_stamp(ts: str | Column) -> Column:
    return F.date_format(col_(ts), RUN_STAMP_FORMAT)


def day_stamp(ts: str | Column) -> Column:
    return F.date_format(col_(ts), DAY_FORMAT)


def date_lit(d: str) -> Column:
    return F.lit(d).cast("date")


def null_date() -> Column:
    return F.lit(None).cast("date")
