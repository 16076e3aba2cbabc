"""Calendar helpers: quarter labels, quarter dates and month arithmetic.

The time axis is a quarter label ``YYYYQn`` at the edges (it orders
lexicographically for four-digit years) and a first-of-quarter DATE or an
integer quarter index internally. Column helpers stay JVM-side; the plain
Python helpers only derive run parameters (origins, window bounds) on the
driver, never data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: pattern of the quarter label, e.g. 2022Q1.
QUARTER_PATTERN = "yyyy'Q'q"
# Fixed value: pattern of the month label, e.g. Apr'22.
MONTH_LABEL_PATTERN = "MMM''yy"
# Quarter index origin; any affine shift gives the same forecasts, a small
# index keeps regressions well conditioned.
INDEX_BASE_YEAR = 1970


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- column functions -------------------------------------------------------

def quarter_label(d) -> Column:
    """date or timestamp -> ``YYYYQn``."""
    return F.date_format(_col(d), QUARTER_PATTERN)


def month_start(d) -> Column:
    """First day of the month of a date/timestamp, as DATE."""
    return F.trunc(F.to_date(_col(d)), "MM")


def month_key(d) -> Column:
    """``yyyy-MM`` month key of a date (the reference's YEARMONTH format)."""
    return F.date_format(_col(d), "yyyy-MM")


def month_key_to_date(k) -> Column:
    """``yyyy-MM`` string -> first of month DATE."""
    return F.to_date(_col(k), "yyyy-MM")


def quarter_year(label) -> Column:
    return F.substring(_col(label), 1, 4).cast("int")


def quarter_number(label) -> Column:
    return F.substring(_col(label), 6, 1).cast("int")


def quarter_start(label) -> Column:
    """``YYYYQn`` -> first day of the quarter (Spark cannot parse ``q``)."""
    return F.make_date(quarter_year(label), (quarter_number(label) - 1) * 3 + 1, F.lit(1))


def literal_quarter_date(label) -> Column:
    """the literal reading of ``YYYYQn`` as year and *month* n.

    2021Q4 -> 2021-04-01. Kept only for ``true_dates=False`` recency weights.
    """
    return F.make_date(quarter_year(label), quarter_number(label), F.lit(1))


def quarter_index(label) -> Column:
    """Integer quarter index, consecutive across years."""
    return (quarter_year(label) - INDEX_BASE_YEAR) * 4 + quarter_number(label) - 1


def quarter_from_index(idx) -> Column:
    """Inverse of :func:`quarter_index`."""
    idx = _col(idx)
    year = F.floor(idx / 4).cast("int") + INDEX_BASE_YEAR
    q = F.pmod(idx, F.lit(4)) + 1
    return F.concat(year.cast("string"), F.lit("Q"), q.cast("string"))


def month_label(label) -> Column:
    """F8: ``YYYYQn`` -> ``Mon'YY`` of the quarter's first month."""
    return F.date_format(quarter_start(label), MONTH_LABEL_PATTERN)


# --- driver-side parameter helpers -----------------------------------------

def to_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])


def add_months(d, months: int) -> _dt.date:
    """F4 for parameters: same day-of-month clamp as ``add_months``."""
    d = to_date(d)
    m = d.month - 1 + months
    year, month = d.year + m // 12, m % 12 + 1
    for day in (d.day, 30, 29, 28):
        try:
            return _dt.date(year, month, day)
        except ValueError:
            continue
    raise ValueError(d)


def quarter_of(d) -> str:
    """F2 for parameters: date -> ``YYYYQn``."""
    d = to_date(d)
    return f"{d.year}Q{(d.month - 1) // 3 + 1}"


def parse_quarter(label: str) -> _dt.date:
    """F3 for parameters: ``YYYYQn`` -> first day of the quarter."""
    label = label.replace(" ", "")
    return _dt.date(int(label[:4]), (int(label[-1]) - 1) * 3 + 1, 1)


def shift_quarter(label: str, quarters: int) -> str:
    return quarter_of(add_months(parse_quarter(label), 3 * quarters))
