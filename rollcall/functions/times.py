"""Time functions as Column expressions: labels, estimates by named policy, links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock(seconds: Column) -> Column:
    """MM:SS, or HH:MM:SS from an hour on; null is 00:00."""
    s = F.coalesce(seconds, F.lit(0)).cast("int")
    two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    short = F.concat(two(F.floor(s / 60)), F.lit(":"), two(s % 60))
    return F.when(s < 3600, short).otherwise(F.concat(two(F.floor(s / 3600)), F.lit(":"), two(F.floor(s % 3600 / 60)), F.lit(":"), two(s % 60)))


def long_label(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "MMMM d, yyyy"), F.lit(" at "), F.date_format(ts, "h:mm a"), F.lit(" PST"))


def by_frame(seconds: Column, frame: Column) -> Column:
    return F.coalesce(seconds, F.greatest(F.lit(1), F.coalesce(frame, F.lit(0)) * 2)).cast("int")


def frame_label(seconds: Column) -> Column:
    """Whether by_frame() gives a time that is there, or an estimate (a time of 0 is none)."""
    return F.when(F.coalesce(seconds, F.lit(0)) != 0, "actual").otherwise("estimated")


def by_content(text: Column, frame: Column) -> Column:
    """Frame times 30 plus an offset by kind of item."""
    t = F.lower(text)
    offset = F.when(F.contains(t, F.lit("consent")), 300)
    for word, n in (("public hearing", 1800), ("adjournment", 3600), ("resolution", 1200), ("ordinance", 1500)):
        offset = offset.when(F.contains(t, F.lit(word)), n)
    return (frame * 30 + F.when(t.isNull(), 0).otherwise(offset.otherwise(900))).cast("int")


def by_rate(frame: Column) -> Column:
    return F.floor(frame / 30).cast("int")


def date_of_id(n: Column, year: int, k: int) -> Column:
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(F.lit(f"{year}-"), two(F.pmod(n - k, F.lit(12)) + 1), F.lit("-"), two(F.pmod(n - k, F.lit(28)) + 1))


def deep_link(base: Column, session: Column, marker: Column, seconds: Column) -> Column:
    root = F.concat(base, session.cast("string"))
    minutes = F.concat(root, F.lit("?t="), F.floor(seconds / 60).cast("long").cast("string"), F.lit("m"), (seconds % 60).cast("long").cast("string"), F.lit("s"))
    return F.when(session.isNull(), F.lit(None)).when(marker.isNotNull(), F.concat(root, F.lit("&meta_id="), marker.cast("string"))).when(seconds.isNotNull(), minutes).otherwise(root)


#: A date that stands for none, and the year and shift of each session id prefix.
NO_DATE = "2024-01-28"
YEARS = (("14", 2024, 243), ("15", 2025, 490))


def estimated_date(session: Column) -> Column:
    """A date made from a session id: its prefix gives the year, the number after it month and day. An id of another kind is
    taken whole, in the first year; one that is no number gives the year's first day."""
    year, shift = F.lit(YEARS[0][1]), F.lit(YEARS[0][2])
    prefixed = F.lit(False)
    for prefix, y, k in reversed(YEARS):
        has = F.startswith(session, F.lit(prefix))
        year, shift, prefixed = F.when(has, y).otherwise(year), F.when(has, k).otherwise(shift), has | prefixed
    digits = F.when(prefixed, F.substr(session, F.lit(3))).otherwise(session)
    number = F.when(F.rlike(digits, F.lit("^[0-9]{1,18}$")), digits.cast("long"))
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    made = F.concat_ws("-", year.cast("string"), two(F.pmod(number - shift, F.lit(12)) + 1), two(F.pmod(number - shift, F.lit(28)) + 1))
    return F.when(number.isNull(), F.concat(year.cast("string"), F.lit("-01-01"))).otherwise(made)


def date_or_estimate(date: Column, session: Column) -> Column:
    """The date, or an estimate where it is missing, empty or stands for none."""
    return F.when(F.coalesce(date, F.lit("")).isin("", NO_DATE), estimated_date(session)).otherwise(date)


def meeting_label(date: Column, time: Column) -> Column:
    """'January 2, 2024 at 6:30 PM PST' of texts YYYY-MM-DD and HH:MM; the date alone without a time; a message without a date;
    both as they are where they cannot be read."""
    day, clock_time = F.try_to_date(date, "yyyy-MM-dd"), F.try_to_timestamp(F.concat(F.lit("2000-01-01 "), time), F.lit("yyyy-MM-dd H:m"))
    label = F.date_format(day, "MMMM d, yyyy")
    timed = F.concat(label, F.lit(" at "), F.date_format(clock_time, "h:mm a"), F.lit(" PST"))
    no_time = F.coalesce(time, F.lit("")) == ""
    raw = F.when(no_time, date).otherwise(F.concat(date, F.lit(" at "), time))
    return F.when(F.coalesce(date, F.lit("")) == "", "Date not available").otherwise(F.coalesce(F.when(no_time, label).otherwise(timed), raw))
