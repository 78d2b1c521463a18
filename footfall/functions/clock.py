"""Column functions for time. Times are epoch milliseconds; none of these depend
on the session time zone."""

from pyspark.sql import Column, functions as F

from footfall.functions.text import _col

DAY_MS = 86_400_000


def local_millis(ms, tz="UTC") -> Column:
    """Milliseconds since 1970 on the wall clock of `tz` (a name or a column)."""
    ms = _col(ms)
    if tz == "UTC":
        return ms
    return F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(ms), tz))


def day_number(ms, tz="UTC") -> Column:
    return F.floor(local_millis(ms, tz) / DAY_MS)


def utc_text(ms) -> Column:
    """`yyyy-MM-dd HH:mm:ss` in UTC."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    whole = F.floor(_col(ms) / 1000).cast("decimal(18,6)")
    return (start + F.make_dt_interval(secs=whole)).cast("string")


def from_utc_text(c) -> Column:
    """Inverse of `utc_text`, as whole seconds since 1970; NULL on bad text."""
    at = F.try_to_timestamp(F.concat(_col(c), F.lit("+00")), F.lit("yyyy-MM-dd HH:mm:ssx"))
    return F.unix_seconds(at)
