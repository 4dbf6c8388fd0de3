"""Surrogate keys, name concatenation and rounded percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_key(session_id: Column | str, start_time: Column | str) -> Column:
    """md5 hex of session id text || 'yyyy-MM-dd HH:mm:ss' start time (warehouse key)."""
    return F.md5(F.concat(_c(session_id).cast("string"),
                          F.date_format(_c(start_time), "yyyy-MM-dd HH:mm:ss")))


def full_name(first: Column | str, last: Column | str) -> Column:
    """first + ' ' + last; null when either part is null (as string concatenation does)."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def percent2(num: Column | str, den: Column | str) -> Column:
    """100*num/den rounded half-up to 2 decimals (a double); null when den is 0.

    Exact integer arithmetic first -- floor((20000*num + den) / (2*den)) in
    hundredths of a percent -- so the value never depends on how an engine
    rounds a binary double that lies on a tie.
    """
    num, den = _c(num).cast("long"), _c(den).cast("long")
    a = (num * 20000 + den).cast("decimal(38,0)")
    b = (den * 2).cast("decimal(38,0)")
    hundredths = ((a - F.pmod(a, b)) / b).cast("long")
    return F.when(den > 0, hundredths.cast("double") / 100.0)
