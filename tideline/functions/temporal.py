"""Dates, times and intervals as epoch numbers and ISO texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.functions.numeric import fail, integer

DAY = 86_400
MONTH_MICROS = 2_629_800_000_000  # 365.25 days / 12
LIMIT = (1 << 63) - 1


def epoch_days(date: Column) -> Column:
    """Days since 1970-01-01 of a date or timestamp (rounded down, also before 1970)."""
    return F.unix_date(date.cast("date"))


def _parts(text: Column) -> list[Column]:
    return [F.regexp_extract(text, r"^(-?\d+)-(\d{1,2})-(\d{1,2})", i).cast("int") for i in (1, 2, 3)]


DATE_TEXT = r"^-?\d{1,5}-\d{1,2}-\d{1,2}([T ].*)?$"


def guarded_date(text: Column) -> Column:
    """Days since 1970-01-01 of a date's text: null where the year, month or day is zero or less, an error where it is no date.

    Years from -1 to 10000 and beyond those of a DATE column are counted by civil-calendar arithmetic.
    """
    year, month, day = _parts(text)
    zero = (year <= 0) | (month <= 0) | (day <= 0)
    known = F.when(~text.rlike(DATE_TEXT), fail("not a date: ", text)).when(zero, F.lit(None))
    return F.when(text.isNull(), F.lit(None)).otherwise(known.when((month > 12) | (day > days_in_month(year, month)), fail("no such day: ", text)).otherwise(civil_days(year, month, day))).cast("int")


def days_in_month(year: Column, month: Column) -> Column:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)


def civil_days(year: Column, month: Column, day: Column) -> Column:
    """Days since 1970-01-01 of a proleptic Gregorian date of any year, with March as the first month."""
    y = F.when(month <= 2, year - 1).otherwise(year)
    of_year = F.floor((F.lit(153) * F.pmod(month + 9, F.lit(12)) + 2) / 5) + day - 1
    return (y * 365 + F.floor(y / 4) - F.floor(y / 100) + F.floor(y / 400) + of_year - 719468).cast("int")


def zero_date_guard(text: Column) -> Column:
    """A datetime's text, or null if its year, month or day is zero."""
    return F.when(F.forall(F.array(*_parts(F.substring(text, 1, 10))), lambda p: p != 0), text)


def instant(value: Column) -> Column:
    """A timestamp, or one without zone as the instant of that wall time in the session's zone (UTC here)."""
    return value.cast("timestamp")


def epoch_millis(value: Column) -> Column:
    return F.unix_millis(instant(value))


def epoch_micros(value: Column) -> Column:
    return F.unix_micros(instant(value))


def epoch_nanos(value: Column) -> Column:
    """Nanoseconds, whole microseconds only."""
    return F.unix_micros(instant(value)) * 1000


def zoned_text(value: Column) -> Column:
    """ISO text in UTC with up to six fraction digits and no trailing zeros; null for years before 0 or after 9999."""
    text = F.date_format(instant(value), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    bare = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(F.year(instant(value)).between(0, 9999), F.concat(bare, F.lit("Z")))


def year_number(value: Column) -> Column:
    return integer(value, "int")


def time_micros(value: Column) -> Column:
    """Microseconds past midnight of a timestamp."""
    return F.pmod(F.unix_micros(instant(value)), F.lit(DAY * 1_000_000))


def time_millis(value: Column) -> Column:
    return F.floor(time_micros(value) / 1000).cast("int")


def time_nanos(value: Column) -> Column:
    return time_micros(value) * 1000


CLOCK = r"^(\d{1,2}):(\d{2}):(\d{2})(?:[.](\d{1,6}))?$"


def clock_micros(text: Column, most_hours: int = 23) -> Column:
    """Microseconds past midnight of HH:MM:SS[.f]; an error for any other text (signs, 24 hours and more among them)."""
    hour, minute, second = (F.regexp_extract(text, CLOCK, i).cast("bigint") for i in (1, 2, 3))
    micros = F.rpad(F.regexp_extract(text, CLOCK, 4), 6, "0").cast("bigint")
    total = ((hour * 60 + minute) * 60 + second) * 1_000_000 + micros
    good = text.rlike(CLOCK) & (F.when(text.rlike(CLOCK), (hour <= most_hours) & (minute < 60) & (second < 60)).otherwise(False))
    good = good | (text.rlike(r"^24:00:00([.]0*)?$") if most_hours == 24 else F.lit(False))
    return F.when(text.isNull(), F.lit(None)).when(good, total).otherwise(fail("not a time of day: ", text)).cast("bigint")


def clock_millis(text: Column) -> Column:
    """Milliseconds past midnight, 24:00:00 included, microseconds cut off."""
    micros = clock_micros(text, 24)
    return integer(F.floor(micros / 1000), "int")


ZONED_CLOCK = r"^(\d{2}):(\d{2}):(\d{2})(?:[.](\d{3}|\d{6}))?([+-])(\d{2})$"


def utc_clock(text: Column) -> Column:
    """HH:MM:SS[.fff|.ffffff]±HH as the time in UTC with six fraction digits and Z; an error for other layouts."""
    part = lambda i: F.regexp_extract(text, ZONED_CLOCK, i)
    good = text.rlike(ZONED_CLOCK)
    seconds = (part(1).cast("int") * 60 + part(2).cast("int")) * 60 + part(3).cast("int")
    shift = part(6).cast("int") * 3600 * F.when(part(5) == "-", 1).otherwise(-1)
    at = F.pmod(seconds + shift, F.lit(DAY))
    utc = F.format_string("%02d:%02d:%02d.%sZ", F.floor(at / 3600), F.floor(at / 60) % 60, at % 60, F.rpad(part(4), 6, "0"))
    fits = (part(1).cast("int") < 24) & (part(2).cast("int") < 60) & (part(3).cast("int") < 60)
    return F.when(text.isNull(), F.lit(None)).when(good, F.when(fits, utc).otherwise(fail("not a time of day: ", text))).otherwise(fail("not a zoned time: ", text))


def interval_micros(months: Column, days: Column, micros: Column) -> Column:
    """Microseconds of an interval, a month being a twelfth of 365.25 days; an error beyond 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    total = wide(months) * F.lit(MONTH_MICROS).cast("decimal(14,0)") + wide(days) * F.lit(DAY * 1_000_000).cast("decimal(12,0)") + wide(micros)
    fits = total.between(F.lit(-LIMIT - 1).cast("decimal(20,0)"), F.lit(LIMIT).cast("decimal(20,0)"))
    return F.when(total.isNull(), F.lit(None)).when(fits, total).otherwise(fail("interval overflows 64 bits")).cast("bigint")


LAYOUTS = {
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    "yyyy-MM-dd HH:mm:ss.SSS": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}[.]\d{3}$",
    "yyyy-MM-dd HH:mm:ss.SSSSSS": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}[.]\d{6}$",
}


def parse_exact(text: Column, layouts: list[str]) -> Column:
    """The first layout whose parse writes the same text again; an error if there is none."""
    tries = [F.when(text.rlike(LAYOUTS[x]), F.try_to_timestamp(text, F.lit(x))) for x in layouts]
    kept = [F.when(F.date_format(t, x) == text, t) for t, x in zip(tries, layouts, strict=True)]
    return F.when(text.isNull(), F.lit(None)).otherwise(F.coalesce(*kept, fail("no layout fits: ", text).cast("timestamp")))


def seconds_instant(seconds: Column) -> Column:
    """Event time of a log that counts whole seconds."""
    return F.timestamp_seconds(seconds)
