"""Timestamps, period labels and year ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kartotek.functions.text import bind, filled, strip

# The four period forms, in the order they are tried.
_YEAR = "(1[5-9][0-9]{2}|2[0-9]{3}|3000)"
PERIOD_FORMS = {
    "Annual": rf"^{_YEAR}$",
    "Quarterly": rf"^{_YEAR}[QK][1-4]$",
    "Monthly": rf"^{_YEAR}(M0?[1-9]|M1[0-2]|0?[1-9]|1[0-2])$",
    "Weekly": rf"^{_YEAR}(W0?[1-9]|W[1-4][0-9]|W5[0-3])$",
}
TIME_UNITS = ("Annual", "Quarterly", "Monthly", "Weekly", "Other")
FIRST_PROBE_YEAR = 1970
FIRST_FEED_YEAR = 2010
YEARS_AHEAD = 3
WINDOW_DAYS = 30

_DATE = r"(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2})|-?W(\d{2})(?:-?([1-7]))?)"
_CLOCK = r"(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
_ZONE = r"(?:([+-])(\d{2}):?(\d{2})(?::?(\d{2}))?)?"
_ISO = rf"^{_DATE}(?:[^0-9]{_CLOCK}{_ZONE})?$"
# The form nearly every source sends; Spark's own cast reads it once a zone is spelled out.
_COMMON = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?)?$"


def parse_ts(c: Column) -> Column:
    """ISO 8601 text to an instant: offset or Z honoured, none means UTC, date only is
    midnight, and anything else is NULL."""
    return bind(strip(c), _read)


def _read(text: Column) -> Column:
    zoned = (
        F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z")))
        .when(text.rlike(r"(Z|[+-]\d{2}:\d{2})$") & (F.length(text) > 10), text)
        .otherwise(F.concat(text, F.lit("Z")))
    )
    return F.when(text.rlike(_COMMON), zoned.try_cast("timestamp")).otherwise(_any_iso(text))


def _any_iso(text: Column) -> Column:
    raw = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    groups = "\x01".join(f"${i}" for i in range(1, 16))
    parts = F.split(F.regexp_replace(raw, _ISO, groups), "\x01")
    return bind(parts, _instant)


def _instant(parts: Column) -> Column:
    def part(i: int) -> Column:
        return filled(F.get(parts, F.lit(i - 1)))

    year = part(1)
    week_monday = F.date_add(
        F.date_trunc("week", F.concat(year, F.lit("-01-04")).try_cast("date")).cast("date"),
        (part(6).try_cast("int") - 1) * 7,
    )
    week_date = F.when(
        F.weekofyear(week_monday) == part(6).try_cast("int"),
        F.date_add(week_monday, F.coalesce(part(7), F.lit("1")).try_cast("int") - 1),
    ).cast("string")
    day = F.when(part(6).isNotNull(), week_date).otherwise(
        F.concat_ws("-", year, F.coalesce(part(2), part(4)), F.coalesce(part(3), part(5)))
    )
    fraction = F.rpad(F.substring(F.coalesce(part(11), F.lit("0")), 1, 6), 6, "0")
    clock = [F.coalesce(part(i), F.lit("00")) for i in (8, 9, 10)]
    local = F.concat(
        day, F.lit("T"), F.concat_ws(":", *clock), F.lit("."), fraction, F.lit("+00:00")
    ).try_cast("timestamp")
    hours, minutes, seconds = (
        F.coalesce(part(i).try_cast("int"), F.lit(0)) for i in (13, 14, 15)
    )
    offset = hours * 3600 + minutes * 60 + seconds
    return F.when(
        F.size(parts) == 15,
        F.timestamp_add("SECOND", F.when(part(12) == "-", offset).otherwise(-offset), local),
    )


def time_unit(first: Column, last: Column) -> Column:
    """First period form both labels have, else ``Other``."""
    unit = None
    for name, form in PERIOD_FORMS.items():
        both = first.rlike(form) & last.rlike(form)
        unit = F.when(both, name) if unit is None else unit.when(both, name)
    return unit.otherwise("Other")


def year_range(first: Column, last: Column) -> Column:
    """Ascending years; empty when the end lies before the start."""
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def window_start(started_at: Column) -> Column:
    """Midnight UTC thirty days before the run's start date."""
    return F.date_sub(F.to_date(started_at), WINDOW_DAYS).cast("timestamp")


def stale_before(started_at: Column) -> Column:
    """The instant exactly thirty days before the run's start."""
    return F.timestamp_add("DAY", F.lit(-WINDOW_DAYS), started_at)
