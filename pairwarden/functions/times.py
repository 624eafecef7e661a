"""Time texts, buckets and run ranges. All timestamps are zone-less."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(moment: datetime) -> Column:
    """A zone-less time literal; a plain literal would depend on the session's zone."""
    return F.lit(moment.isoformat(" ")).cast("timestamp_ntz")


def parse_second(col: str) -> Column:
    """First 14 digits of a time text."""
    return F.to_timestamp_ntz(F.substring(col, 1, 14), F.lit("yyyyMMddHHmmss"))


def parse_fraction(col: str) -> Column:
    """First 16 digits; digits 15-16 are hundredths of a second."""
    text = F.concat(F.substring(col, 1, 14), F.lit("."), F.rpad(F.substring(col, 15, 2), 2, "0"))
    return F.to_timestamp_ntz(text, F.lit("yyyyMMddHHmmss.SS"))


def parse_lenient(col: str) -> Column:
    """As ``parse_second``, but an unparsable text is the epoch instead of an error."""
    parsed = F.try_to_timestamp(F.substring(col, 1, 14), F.lit("yyyyMMddHHmmss"))
    return F.coalesce(parsed.cast("timestamp_ntz"), at(datetime(1970, 1, 1)))


def bucket(col: str, width: str = "10 minutes") -> Column:
    """Start of the tumbling bucket a time falls into."""
    return F.window(F.col(col), width).getField("start")


# Cron field, its text and the unit the run time is cut to; the first hit counts.
CRON_UNITS = (
    (0, "*/1", "minute"),
    (0, "*/5", "5 minutes"),
    (0, "*/15", "15 minutes"),
    (1, "*/1", "hour"),
    (2, "*/1", "day"),
    (2, "*/4", "quarter"),
    (3, "*/1", "month"),
    (4, "*/1", "year"),
)


def cron_unit(cron: str) -> str:
    """Unit a five-field cron text asks for; anything unknown means hour."""
    if cron == "* * * * *":
        return "minute"
    fields = cron.split(" ")
    if len(fields) == 5:
        for position, text, unit in CRON_UNITS:
            if fields[position] == text:
                return unit
    return "hour"


def bucket_for_cron(cron: str, col: str) -> Column:
    unit = cron_unit(cron)
    if " " in unit:
        return bucket(col, unit)
    return F.date_trunc(unit, F.col(col)).cast("timestamp_ntz")


_DELTA_UNITS = ("seconds", "minutes", "hours", "days", "weeks")


def parse_delta(text: str) -> timedelta:
    """``unit=n`` to a duration; bad text means one day."""
    parts = str(text).split("=")
    try:
        if parts[0] in _DELTA_UNITS:
            return timedelta(**{parts[0]: int(parts[1])})
    except (IndexError, ValueError):
        pass
    return timedelta(days=1)


def run_range(now: datetime, now_delta: str, prev_delta: str) -> tuple[datetime, datetime]:
    """Range of one run: it ends ``now_delta`` before now and lasts ``prev_delta``."""
    end = now - parse_delta(now_delta)
    return end - parse_delta(prev_delta), end
