"""Week labels and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _label(year: Column, week: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def week_key(t: Column) -> Column:
    """Calendar year with ISO week number: the label of the stored tables, odd around New Year."""
    return _label(F.year(t), F.weekofyear(t))


def iso_week_key(t: Column) -> Column:
    return _label(F.extract(F.lit("YEAROFWEEK"), t), F.weekofyear(t))


def monday_week_key(t: Column) -> Column:
    """Calendar year with the number of Mondays so far."""
    return _label(F.year(t), F.floor((F.dayofyear(t) + 6 - F.weekday(t)) / 7))


def week_to_date(key: Column) -> Column:
    """Monday of an ISO week label; NULL where the label is no ISO week."""
    y, w = F.regexp_extract(key, r"^(\d{4})-W(\d{2})$", 1).try_cast("int"), F.regexp_extract(key, r"^(\d{4})-W(\d{2})$", 2).try_cast("int")
    jan4 = F.make_date(y, F.lit(1), F.lit(4))
    monday = F.date_add(jan4, (w - 1) * 7 - F.weekday(jan4))
    return F.when((w >= 1) & (w <= 53) & (iso_week_key(monday) == key), monday)


def weeks_between(later: Column, earlier: Column) -> Column:
    """Whole weeks from one label to another, never negative; 0 where a label is missing or invalid."""
    return F.coalesce(F.greatest(F.lit(0), F.floor(F.datediff(week_to_date(later), week_to_date(earlier)) / 7)), F.lit(0))


def is_first_sunday(t: Column) -> Column:
    return (F.dayofweek(t) == 1) & (F.dayofmonth(t) <= 7)


# Zone names of RFC 822 with their hours from UTC. Other names, and none, count as UTC.
RFC822_ZONES = {"UT": 0, "UTC": 0, "GMT": 0, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}
RFC822 = r"^\s*(?:[A-Za-z]{3},\s*)?(\d{1,2}) ([A-Za-z]{3}) (\d{4}) (\d{2}:\d{2})(:\d{2})?(?: ([+-]\d{4}|[A-Za-z]{1,5}))?\s*$"


def rfc822_age_days(ts: Column, now: Column) -> Column:
    """Days since an RFC 822 time, at least 0; NULL where it does not parse."""
    part = lambda k: F.regexp_extract(ts, RFC822, k)
    seconds = F.when(part(5) == "", ":00").otherwise(part(5))
    t = F.try_to_timestamp(F.concat(part(1), F.lit(" "), F.initcap(part(2)), F.lit(" "), part(3), F.lit(" "), part(4), seconds, F.lit(" +0000")), F.lit("d MMM yyyy HH:mm:ss Z"))
    zone = F.upper(part(6))
    hours = F.coalesce(F.create_map(*[F.lit(x) for kv in RFC822_ZONES.items() for x in kv])[zone], F.lit(0))
    minutes = F.when(zone.rlike(r"^[+-]"), F.concat(F.substring(zone, 1, 1), F.lit("1")).try_cast("int") * (F.substring(zone, 2, 2).try_cast("int") * 60 + F.substring(zone, 4, 2).try_cast("int"))).otherwise(hours * 60)
    return F.when(ts.rlike(RFC822) & t.isNotNull(), F.greatest(F.lit(0.0), (F.unix_micros(now) - F.unix_micros(t) + minutes.cast("bigint") * 60_000_000) / 86_400_000_000))
