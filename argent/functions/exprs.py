"""Cleaning, casting, date, regex and masking expressions."""

from __future__ import annotations

import datetime as _dt
from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]

# ---------------------------------------------------------------------------
# These must equal the reference pipeline's values for the
# results to match. Stated plainly, in natural order.
# ---------------------------------------------------------------------------
UNKNOWN_TEXT = "Unknown"                      # default for missing names (F1)
MASK_TEXT = "***MASKED***"                    # string mask (G2)
MIN_DATE = "2000-01-01"                       # high-water default (F7)
OPEN_END_DATE = "9999-12-31"                  # open validity sentinel (F16)
LOOKBACK_DAYS = 3                             # late-data re-read window (P6)
DEV_WINDOW_DAYS = 90                          # development date window (P8)
CHANGE_RETENTION_DAYS = 2                     # change-log retention (S5)
PRIVILEGED_ROLES = ("COMPLIANCE_ROLE", "ADMIN_ROLE")   # see unmasked data (G2/G3)
PII_TYPES = ("EMAIL", "PHONE", "FIRST_NAME", "LAST_NAME", "FULL_NAME",
             "DOB", "ADDRESS", "POSTCODE", "NATIONAL_ID", "FINANCIAL", "OTHER")
# The three e-mail patterns differ on purpose (macro allows an apostrophe,
# the generic test does not, the column test allows a one-letter ending).
EMAIL_PATTERN_MACRO = r"^[a-zA-Z0-9._%+'-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
EMAIL_PATTERN_TEST = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
EMAIL_PATTERN_COLUMN = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
# ---------------------------------------------------------------------------

__all__ = [
    "UNKNOWN_TEXT", "MASK_TEXT", "MIN_DATE", "OPEN_END_DATE", "LOOKBACK_DAYS",
    "DEV_WINDOW_DAYS", "CHANGE_RETENTION_DAYS", "PRIVILEGED_ROLES", "PII_TYPES",
    "EMAIL_PATTERN_MACRO", "EMAIL_PATTERN_TEST", "EMAIL_PATTERN_COLUMN",
    "col_of", "or_unknown", "clean_upper", "money", "whole", "to_text", "try_ts",
    "lit_ts", "lit_date", "days_ago", "as_of_ts", "full_match", "is_email",
    "type_name", "type_of", "year_floor", "upper_differs", "open_end", "scd_id",
    "mask_string", "mask_by_role", "mask_date", "is_privileged",
]


def col_of(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_unknown(c: ColumnOrName, default: str = UNKNOWN_TEXT) -> Column:
    """NULL becomes the default text; an empty string is kept."""
    return F.coalesce(col_of(c), F.lit(default))


def clean_upper(c: ColumnOrName) -> Column:
    """trim spaces (only spaces, a tab stays) and upper-case."""
    return F.upper(F.trim(col_of(c)))


def money(c: ColumnOrName) -> Column:
    """exact two-decimal amount; bad text raises under ANSI casts."""
    return col_of(c).cast("decimal(18,2)")


def whole(c: ColumnOrName) -> Column:
    """whole number, rounding half away from zero."""
    return col_of(c).cast("decimal(38,0)")


def to_text(c: ColumnOrName) -> Column:
    """cast to string."""
    return col_of(c).cast("string")


def try_ts(c: ColumnOrName, epoch_digits: bool = False) -> Column:
    """tolerant parse to a timestamp without zone; bad text -> NULL.

    ``epoch_digits`` also reads an all-digit text as epoch seconds.
    """
    c = col_of(c)
    parsed = c.try_cast("timestamp_ntz")
    if epoch_digits:
        epoch = F.timestamp_seconds(c.try_cast("long")).cast("timestamp_ntz")
        parsed = F.when(c.rlike(r"^\d+$"), epoch).otherwise(parsed)
    return parsed


def lit_ts(value: Union[str, _dt.datetime, _dt.date]) -> Column:
    """timestamp literal (no zone) from a date / datetime / text."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def lit_date(value: Union[str, _dt.date]) -> Column:
    if isinstance(value, _dt.datetime):
        value = value.date()
    return F.lit(str(value)).cast("date")


def as_of_ts(as_of=None) -> Column:
    """the run's 'now'. Injected for repeatable runs; else current time."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return lit_ts(as_of)


def days_ago(n: int, as_of=None) -> Column:
    """F8: 'now' minus n days, as a timestamp without zone."""
    return as_of_ts(as_of) - F.make_dt_interval(F.lit(n))


def full_match(pattern: str) -> str:
    """Whole-string regex: Java's ``$`` also matches before a final newline,
    so the end anchor becomes ``\\z``."""
    return pattern[:-1] + r"\z" if pattern.endswith("$") else pattern


def is_email(c: ColumnOrName, pattern: str = EMAIL_PATTERN_MACRO) -> Column:
    """e-mail shape as a boolean; NULL gives FALSE."""
    return F.coalesce(col_of(c).rlike(full_match(pattern)), F.lit(False))


def type_name(dtype) -> str:
    """the type name a column reports (``typeof``)."""
    return dtype.simpleString()


def type_of(c: ColumnOrName) -> Column:
    """F12 on a table: the name of a column's type, upper case."""
    return F.upper(F.typeof(col_of(c)))


def year_floor(c: ColumnOrName) -> Column:
    """1 January of the value's year; NULL stays NULL."""
    c = col_of(c)
    return F.make_date(F.year(c), F.lit(1), F.lit(1))


def upper_differs(a: ColumnOrName, b: ColumnOrName) -> Column:
    """case-insensitive inequality."""
    return F.upper(col_of(a)) != F.upper(col_of(b))


def open_end() -> Column:
    """F16: the open-ended validity sentinel as a timestamp."""
    return lit_ts(OPEN_END_DATE)


def scd_id(keys, updated_at: ColumnOrName) -> Column:
    """version id = md5 of key(s) and update time in a fixed format."""
    if isinstance(keys, (str, Column)):
        keys = [keys]
    parts = [F.coalesce(col_of(k).cast("string"), F.lit("")) for k in keys]
    ts = F.coalesce(F.date_format(col_of(updated_at), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(""))
    return F.md5(F.concat_ws("|", *parts, ts))


def is_privileged(roles) -> bool:
    """The role test of the masks: any privileged role in the session."""
    return any(r.upper() in PRIVILEGED_ROLES for r in (roles or ()))


def mask_string(c: ColumnOrName, roles=()) -> Column:
    """Value for privileged readers, else the mask text (NULL included)."""
    return col_of(c) if is_privileged(roles) else F.lit(MASK_TEXT)


def mask_by_role(c: ColumnOrName, role: ColumnOrName) -> Column:
    """F13 / G2 on data: the value where the row's reader role is a privileged
    one, else the mask text; a NULL role sees the mask."""
    return F.when(F.upper(col_of(role)).isin(*PRIVILEGED_ROLES), col_of(c)).otherwise(F.lit(MASK_TEXT))


def mask_date(c: ColumnOrName, roles=()) -> Column:
    """Value for privileged readers, else 1 January of its year."""
    return col_of(c) if is_privileged(roles) else year_floor(c)
