from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

# Any offset the text lacks is supplied by appending one; where the text has its
# own, that one is read first and the appended one is skipped as a literal.
_DEFAULT_OFFSET = " +0000"
_REQUEST_TIME_FORM = f"d/MMM/yyyy:H:m:s[ XXX][ Z]['{_DEFAULT_OFFSET}']"


def request_time(text: Column) -> Column:
    """Instant of a request from ``dd/Mon/yyyy:HH:MM:SS [zone]``.

    The offset is honoured (``+0100``, ``+01:00``, ``Z``), a missing one means
    UTC, and text that is not a time gives NULL. The session time zone plays no
    part. ``text`` occurs once in the expression, as Catalyst copies it into
    each filter on the result.
    """
    zoned = F.concat(F.trim(text), F.lit(_DEFAULT_OFFSET))
    return F.try_to_timestamp(zoned, F.lit(_REQUEST_TIME_FORM))


def utc_wall_clock(instant: Column) -> Column:
    """TIMESTAMP as the TIMESTAMP_NTZ a clock in UTC shows, whatever the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def as_utc_timestamp(moment: datetime | str) -> Column:
    """Literal instant; a value without an offset is read as UTC."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.lit(moment)
