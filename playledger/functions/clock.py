"""Time expressions: the recap week, the cursor, and text to date / timestamp.

Play times are UTC wall-clock values in TIMESTAMP_NTZ columns, so nothing here depends on the
session time zone.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

AsOf = Column | str | date | datetime | None

#: Exactly three fraction digits and a literal Z; other texts are not play times.
_PLAYED_AT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z\z"
_EPOCH = datetime(1970, 1, 1)
#: The recap window around a Monday, 00:00:00.
_BEFORE_MONDAY = "INTERVAL '0 23:59:00' DAY TO SECOND"
_AFTER_MONDAY = "INTERVAL '5 08:59:00' DAY TO SECOND"


def utc_now() -> Column:
    """Current UTC wall-clock time; one value for the whole query, folded before planning."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def moment(as_of: AsOf = None) -> Column:
    """``as_of`` as a TIMESTAMP_NTZ expression; ``None`` means now."""
    if as_of is None:
        return utc_now()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    if isinstance(as_of, datetime) and as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(str(as_of)).cast("timestamp_ntz")


def monday_of(day: Column) -> Column:
    """Monday of the ISO week of a date."""
    return F.date_sub(day, F.weekday(day))


def week_bounds(as_of: AsOf = None) -> tuple[Column, Column]:
    """Half-open recap window ``[start, end)`` of the ISO week that holds ``as_of``.

    Start: the Sunday before that week's Monday, 00:01:00. End: that week's Saturday, 08:59:00.
    Consecutive windows leave a gap from Saturday 08:59:00 to Sunday 00:01:00.
    """
    monday = monday_of(moment(as_of).cast("date")).cast("timestamp_ntz")
    return monday - F.expr(_BEFORE_MONDAY), monday + F.expr(_AFTER_MONDAY)


def week_of(played_at: Column) -> Column:
    """Monday of the one week whose recap window holds the play; NULL for plays in the gap."""
    monday = monday_of((played_at + F.expr(_BEFORE_MONDAY)).cast("date"))
    return F.when(played_at < monday.cast("timestamp_ntz") + F.expr(_AFTER_MONDAY), monday)


def epoch_ms(after: int | Column) -> Column:
    """Epoch milliseconds as a UTC wall-clock timestamp."""
    if isinstance(after, Column):
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
            secs=(after / F.lit(1000)).cast("decimal(18,6)")
        )
    return F.lit(str(_EPOCH + timedelta(milliseconds=after))).cast("timestamp_ntz")


def parse_played_at(text: Column) -> Column:
    """Play time text (``2024-07-01T12:34:56.789Z``) to TIMESTAMP_NTZ; other texts give NULL."""
    return F.when(text.rlike(_PLAYED_AT), F.left(text, F.lit(23)).try_cast("timestamp_ntz"))


def event_time(ts: Column) -> Column:
    """A UTC wall-clock timestamp as a point in time, which watermarks need; in any session time zone."""
    return F.concat(ts.cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp")


def played_ms(text: Column) -> Column:
    """Play time text to epoch milliseconds; other texts give NULL."""
    return F.unix_millis(F.to_timestamp_ltz(F.when(parse_played_at(text).isNotNull(), text)))


def format_played_at(ts: Column) -> Column:
    """A UTC wall-clock timestamp as play time text, cut to milliseconds."""
    text = ts.cast("timestamp_ntz").cast("string")
    millis = F.rpad(F.substring(text, 21, 3), 3, "0")
    return F.concat(F.translate(F.left(text, F.lit(19)), " ", "T"), F.lit("."), millis, F.lit("Z"))


def parse_release_date(text: Column) -> Column:
    """Release date text of year, month or day precision to DATE; other texts give NULL."""
    return text.try_cast("date")
