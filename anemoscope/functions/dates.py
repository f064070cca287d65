"""Timestamps out of text. All results are TIMESTAMP_NTZ."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from anemoscope import config


def is_padded(text: Column) -> Column:
    """Whether text is in the strict format with every number padded."""
    return text.rlike(config.PADDED_DATE)


def is_strict(text: Column) -> Column:
    """Whether text is written year-month-day hours:minutes:seconds."""
    return text.rlike(config.STRICT_DATE)


def rarely(text: Column, build) -> Column:
    """``build`` of a text, kept out of the code that is compiled for every row.

    Forms that few values have are many and long; compiled together with the others they
    would make one method larger than the JVM compiles.
    """
    return F.get(F.transform(F.array(text), build), F.lit(0))


def meridiem(text: Column) -> Column:
    """``a`` or ``p`` of a clock of twelve hours, else empty."""
    return F.lower(F.regexp_extract(text, config.MERIDIEM, 2))


def in_numbers(text: Column, year: int | None = None) -> Column:
    """A date with names, a short year or no separators in a form of numbers.

    Whatever else is written stays as it is, without a weekday and without AM or PM. A year
    of two digits lies less than fifty years after ``year``, by default the present one, or
    before it; it stands first only above 31, where it can be no day.
    """
    now = year or date.today().year
    plain = F.regexp_replace(F.regexp_replace(text, config.MERIDIEM, "$1"), config.WEEKDAY, "")
    return rarely(plain, lambda text: _in_numbers(text, now))


def _in_numbers(text: Column, now: int) -> Column:
    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, pattern, group)

    def full(digits: Column) -> Column:
        value = digits.cast("int") + now // 100 * 100
        near = value - F.when(value >= now + 50, 100).when(value < now - 50, -100).otherwise(0)
        return F.when(F.length(digits) == 2, near.cast("string")).otherwise(digits)

    def month(pattern: str, group: int) -> Column:
        place = F.instr(F.lit(config.MONTHS), F.lower(F.substring(part(pattern, group), 1, 3)))
        return ((place + 2) / 3).cast("int").cast("string")

    def dated(year: Column, month: Column, day: Column, rest: Column) -> Column:
        return F.concat(year, F.lit("-"), month, F.lit("-"), day, rest)

    compact = F.regexp_replace(text, config.COMPACT, "$1-$2-$3 $4:$5:$6")
    second, first, short = config.NAME_SECOND, config.NAME_FIRST, config.SHORT_YEAR
    after, clock, alone = config.NAME_AFTER_YEAR, config.CLOCK_BEFORE_YEAR, config.NAME_AND_YEAR
    old, bare = config.SHORT_YEAR_FIRST, config.YEAR_AND_MONTH
    return (
        F.when(text.rlike(clock), dated(part(clock, 4), month(clock, 1), part(clock, 2), F.concat(F.lit(" "), part(clock, 3))))
        .when(text.rlike(after), dated(full(part(after, 1)), month(after, 2), part(after, 3), part(after, 4)))
        .when(text.rlike(second), dated(full(part(second, 3)), month(second, 2), part(second, 1), part(second, 4)))
        .when(text.rlike(first), dated(full(part(first, 3)), month(first, 1), part(first, 2), part(first, 4)))
        .when(text.rlike(alone), dated(part(alone, 2), month(alone, 1), F.lit("1"), F.lit("")))
        .when(text.rlike(old), dated(full(part(old, 1)), part(old, 2), part(old, 3), part(old, 4)))
        .when(
            text.rlike(short),
            F.concat(
                part(short, 1), part(short, 2), part(short, 3), part(short, 2),
                full(part(short, 4)), part(short, 5),
            ),
        )
        .when(text.rlike(config.COMPACT), F.regexp_replace(compact, "[ :]+$", ""))
        .when(text.rlike(bare), dated(part(bare, 1), part(bare, 2), F.lit("1"), F.lit("")))
        .otherwise(text)
    )


def on_twelve_hours(moment: Column, half: Column) -> Column:
    """A moment read from a clock of twelve hours; NULL where the hour is beyond it."""
    hour = F.hour(moment)
    shift = F.when((half == "p") & (hour < 12), 12).when((half == "a") & (hour == 12), -12)
    moved = moment + F.make_dt_interval(F.lit(0), F.coalesce(shift, F.lit(0)))
    return F.when(half == "", moment).when(hour <= 12, moved)


def iso_text(text: Column, dayfirst: bool = False) -> Column:
    """A date in any known form rewritten to the ISO form, else NULL.

    A year-last date is read month first, and day first only where the first
    number cannot be a month. ``dayfirst`` turns that preference round. Parts of the clock
    that are not written are left empty. Whether the numbers make a date is left to the cast.
    """
    year_first = (config.YEAR_FIRST_DATE, "$1-$2-$3 $4:$5:$6")
    month_first = (config.MONTH_FIRST_DATE, "$3-$1-$2 $4:$5:$6")
    day_first = (config.DAY_FIRST_DATE, "$3-$2-$1 $4:$5:$6")
    year_last = [day_first, month_first] if dayfirst else [month_first, day_first]
    written = F.when(is_strict(text), F.regexp_replace(text, r"\s+", " "))
    for pattern, order in [year_first, *year_last]:
        written = written.when(text.rlike(pattern), F.regexp_replace(text, pattern, order))
    return written


def with_whole_clock(written: Column) -> Column:
    """What ``iso_text`` gives with the parts of the clock that were not written."""
    size = F.length(written)

    def shorter(count: int) -> Column:
        return F.substr(written, F.lit(1), size - count)

    return (
        F.when(F.endswith(written, F.lit(" ::")), shorter(3))
        .when(F.endswith(written, F.lit("::")), F.concat(shorter(2), F.lit(":00:00")))
        .when(F.endswith(written, F.lit(":")), F.concat(written, F.lit("00")))
        .otherwise(written)
    )


def in_range(moment: Column) -> Column:
    """The moment, NULL if it does not fit 64-bit nanoseconds."""
    earliest = F.lit(config.EARLIEST).cast("timestamp_ntz")
    latest = F.lit(config.LATEST).cast("timestamp_ntz")
    return F.when(moment.between(earliest, latest), moment)


def start_of(unit: str, moment: Column) -> Column:
    """Start of the hour, day or month, independent of the session time zone."""
    if unit == "hour":
        past = F.make_dt_interval(
            F.lit(0), F.lit(0), F.minute(moment), F.extract(F.lit("SECOND"), moment)
        )
        return moment - past
    day = moment.cast("date")
    if unit == "month":
        day = F.trunc(day, "month")
    return day.cast("timestamp_ntz")
