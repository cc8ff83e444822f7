"""Text to typed values. Bad input becomes null instead of failing the job (ANSI mode is on)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

MONEY = "decimal(28,6)"  # up to 10^22; sums of it are decimal(38,6)


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row.

    A column used inside a lambda is otherwise computed anew for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(column(c)), F.lit(""))


def to_int(c: Column | str) -> Column:
    return blank_to_null(c).try_cast("int")


def to_money(c: Column | str) -> Column:
    """`$1,234.50` -> 1234.50. Accounting negatives such as `($5)` are not numbers: null."""
    return F.nullif(F.translate(F.trim(column(c)), "$,", ""), F.lit("")).try_cast(MONEY)


def money_rejects(c: Column | str) -> Column:
    """Aggregate: texts that are neither blank nor an amount, so that none is lost unseen."""
    return F.count_if(blank_to_null(c).isNotNull() & to_money(c).isNull())


def to_day(c: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(blank_to_null(c), pattern)


# The zone names of RFC 822 with their offsets; other letters (military zones) count as UTC, as RFC 2822 says.
FEED_ZONES = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400", "CST": "-0600",
    "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}
_FEED_DATE = (
    r"^(?:[A-Za-z]+\.?,?\s+)?(\d{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*\.?[\s-]+(\d{2,4})[\s,]+"
    r"(\d{1,2}):(\d{2})(?::(\d{2})(?:\.\d+)?)?\s*([+-]\d{2}:?\d{2}|[A-Za-z]+)$"
)


def to_feed_time(c: Column | str) -> Column:
    """RFC 822 text to timestamp, also in its loose forms.

    Weekday and seconds are optional, months may be written out, a year of two digits counts from 1950 to 2049 and one of
    three from 1900 (as RFC 2822 says), the zone is an offset or a name, and comments in parentheses are left out. Text
    in another form, without a zone or with an unknown one, is null: see `feed_time_rejects`.
    """
    text = F.trim(F.regexp_replace(F.regexp_replace(column(c), r"\([^()]*\)", " "), r"\s+", " "))

    def parsed(text: Column) -> Column:
        day, month, year, hour, minute, second, zone = (F.regexp_extract(text, _FEED_DATE, i) for i in range(1, 8))
        digits = F.length(year)
        since = F.when(digits == 2, F.when(year < "50", 2000).otherwise(1900)).when(digits == 3, 1900).otherwise(0)
        names = F.create_map(*[F.lit(x) for pair in FEED_ZONES.items() for x in pair])
        letter = F.when(zone.rlike("^[A-IK-Za-ik-z]$"), "+0000")
        offset = F.when(zone.rlike("^[+-]"), F.replace(zone, F.lit(":"), F.lit(""))).otherwise(
            F.coalesce(F.try_element_at(names, F.upper(zone)), letter)
        )
        whole = F.concat_ws(" ", day, F.initcap(F.lower(month)), (since + year.try_cast("int")).cast("string"))
        time = F.concat_ws(":", F.lpad(hour, 2, "0"), minute, F.coalesce(F.nullif(second, F.lit("")), F.lit("00")))
        # the weekday is left out because Spark refuses to parse it
        return F.try_to_timestamp(F.concat(whole, F.lit(" "), time, F.lit(" "), offset), F.lit("d MMM yyyy HH:mm:ss Z"))

    return let(text, parsed)


def feed_time_rejects(c: Column | str) -> Column:
    """Aggregate: texts that are neither blank nor a date, so that none is lost unseen."""
    return F.count_if(blank_to_null(c).isNotNull() & to_feed_time(c).isNull())
