"""Report dates. Instants are UTC: ``timestamp`` read in a UTC session, or ``timestamp_ntz`` in UTC.

Call ``rentledger.configure(spark)`` first; it pins the session zone to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REPORT_ZONE = "America/Chicago"
RENTAL_ZONE = "Asia/Kolkata"
DAY_FIRST = "dd/MM/yyyy"
MONTH_FIRST = "MM/dd/yyyy"
CLOCK = "hh:mm:ss a"


def _wall(ts: Column, zone: str) -> Column:
    """Wall time as the instant that reads the same in UTC.

    ``from_utc_timestamp`` looks a constant zone up once a task, ``convert_timezone`` parses both names again in every row.
    """
    return F.from_utc_timestamp(ts.cast("timestamp"), zone)


def wall_time(ts: Column, zone: str = REPORT_ZONE) -> Column:
    """Local wall time of an instant."""
    return _wall(ts, zone).cast("timestamp_ntz")


def local_date(ts: Column, zone: str = REPORT_ZONE, fmt: str = DAY_FIRST) -> Column:
    return F.date_format(_wall(ts, zone), fmt)


def local_time(ts: Column, zone: str = REPORT_ZONE) -> Column:
    return F.date_format(_wall(ts, zone), CLOCK)


def double_shift(
    ts: Column,
    via_zone: str = RENTAL_ZONE,
    as_zone: str = REPORT_ZONE,
    session_zone: str | None = None,
    fmt: str = DAY_FIRST,
) -> Column:
    """Wall time in ``via_zone``, re-read as ``as_zone`` time, printed in ``session_zone``.

    ``session_zone`` defaults to ``as_zone``, the zone the reports are read in.
    """
    reread = F.to_utc_timestamp(_wall(ts, via_zone), as_zone)
    return F.date_format(_wall(reread, session_zone or as_zone), fmt)
