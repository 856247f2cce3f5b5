"""Time at the border: ISO text in UTC, whatever the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def utc_iso(ts: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), ISO_FORMAT)


def from_utc_wall_clock(ts: Column) -> Column:
    """A time without zone, read as UTC; streams need this for their watermark."""
    return F.from_utc_timestamp(ts.cast("timestamp"), F.current_timezone())


def as_of_text(as_of: str | None) -> Column:
    """Check time of a run: the given text, or the start of the query."""
    return F.lit(as_of) if as_of is not None else utc_iso(F.current_timestamp())
