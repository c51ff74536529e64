"""Column expressions used across the lake. All are Catalyst built-ins, no Python UDFs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Fixed values
EXCHANGE_ZONE = "America/New_York"
UNKNOWN_ID = -1
UNKNOWN_CODE = "UNK"
KEY_UNSAFE_CHARS = "[^a-zA-Z0-9._=-]"
ASSET_CLASS_IDS = {"EQUITY": 1, "INDEX": 2, "CRYPTO": 3}
CURRENCY_IDS = {"USD": 1, "INR": 2}
TRADING_DAYS = 252

EPOCH_START = "timestamp_ntz'1970-01-01 00:00:00'"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- arithmetic -------------------------------------------------------------

def change(now: Column | str, before: Column | str) -> Column:
    """``now / before - 1``; NULL where there is no base or the base is zero."""
    return _col(now) / F.nullif(_col(before), F.lit(0.0)) - 1


def relative_difference(now: Column | str, before: Column | str) -> Column:
    """``(now - before) / before``; the gold export's spelling of growth."""
    return (_col(now) - _col(before)) / F.nullif(_col(before), F.lit(0.0))


def log_growth(rate: Column | str) -> Column:
    """``ln(1 + rate)``; NULL where the growth factor is not positive."""
    factor = 1 + _col(rate)
    return F.when(factor > 0, F.ln(factor))


def profit(market: Column | str, average: Column | str, quantity: Column | str) -> Column:
    return F.round((_col(market) - _col(average)) * _col(quantity), 2)


# --- rounding and text formats ----------------------------------------------

def fixed_point(value: Column | str, digits: int = 4) -> Column:
    """Price as it is stored: rounded half up, still a double."""
    return F.round(_col(value), digits)


def fixed_point_text(value: Column | str, digits: int = 4) -> Column:
    return F.format_string(f"%.{digits}f", _col(value))


def money(amount: Column | str) -> Column:
    """Amount at scale 2, rounded half to even."""
    return F.bround(_col(amount).cast("decimal(38,6)"), 2).cast("decimal(38,2)")


# --- classification and null handling ---------------------------------------

def symbol_class(symbol: Column | str) -> Column:
    return F.when(_col(symbol).startswith("^"), "INDEX").otherwise("EQUITY")


def period_type(date: Column | str, corrected: bool = False) -> Column:
    """Period of an observation date: M, Q or Y.

    The plain form looks at the last letter only, so ``2015M01`` counts as yearly;
    ``corrected`` recognises ``2015M01`` and ``2015Q1``.
    """
    text = _col(date)
    if corrected:
        monthly, quarterly = text.rlike(r"^\d{4}M\d{1,2}$"), text.rlike(r"^\d{4}Q\d$")
    else:
        monthly, quarterly = text.endswith("M"), text.endswith("Q")
    return F.when(monthly, "M").when(quarterly, "Q").otherwise("Y")


def leading_number(text: Column | str) -> Column:
    """First run of digits, or the empty string."""
    return F.regexp_extract(_col(text), r"\d+", 0)


def code_id(code: Column | str, ids: Mapping[str, int], default: int = UNKNOWN_ID) -> Column:
    chain = None
    for name, number in ids.items():
        hit = _col(code) == name
        chain = F.when(hit, number) if chain is None else chain.when(hit, number)
    return chain.otherwise(default)


def or_unknown(text: Column | str, member: str = UNKNOWN_CODE) -> Column:
    """Empty and missing codes become the unknown member."""
    return F.coalesce(F.nullif(_col(text), F.lit("")), F.lit(member))


def safe_key(text: Column | str) -> Column:
    """Key as a directory name."""
    return F.regexp_replace(_col(text), KEY_UNSAFE_CHARS, "_")


# --- time -------------------------------------------------------------------
# None of these depends on the session zone: wall-clock values stay TIMESTAMP_NTZ.

def epoch_to_timestamp(seconds: Column | str) -> Column:
    return F.timestamp_add("SECOND", _col(seconds).cast("bigint"), F.expr(EPOCH_START))


def _seconds_since_epoch(ts: Column | str) -> Column:
    return (_col(ts) - F.expr(EPOCH_START)).cast("interval second").cast("decimal(20,6)")


def timestamp_to_epoch(ts: Column | str) -> Column:
    return F.floor(_seconds_since_epoch(ts)).cast("bigint")


def timestamp_to_micros(ts: Column | str) -> Column:
    return (_seconds_since_epoch(ts) * 1_000_000).cast("bigint")


def utc_instant(ts: Column | str) -> Column:
    """TIMESTAMP of a wall-clock value that is meant in UTC."""
    return F.timestamp_micros(timestamp_to_micros(ts))


def epoch_date(seconds: Column | str) -> Column:
    return F.date_from_unix_date(F.floor(_col(seconds) / 86_400).cast("int"))


def exchange_date(seconds: Column | str, zone: str = EXCHANGE_ZONE) -> Column:
    """Calendar date at the exchange for an epoch in seconds."""
    return epoch_date(F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(_col(seconds)), zone)))


# --- ordering ---------------------------------------------------------------

def sequence_key(major: Column | str, minor: Column | str) -> Column:
    """Order by two non-negative bigints as one DECIMAL(38,0).

    A decimal is a fixed-width aggregation buffer, so ``min_by``/``max_by`` on it keep
    hash aggregation; a struct key would turn the whole aggregate into a sort.
    """
    return (_col(major).cast("decimal(19,0)") * F.lit("10000000000000000000").cast("decimal(20,0)")
            + _col(minor).cast("decimal(19,0)")).cast("decimal(38,0)")
