"""Instants from text in many notations.

Every notation is one alternative of ONE regular expression with named groups. A single replacement pass writes the groups that
matched, in a fixed order, so the components are extracted once; all later work is integer arithmetic on them. Nothing here
parses dates by pattern letters and no Python runs per row.

Defined results
* NULL or blank input: NULL result and status NULL.
* Text that no notation covers, and components outside the calendar or the clock: status ``invalid``.
* Local times that the zone had twice: ``ambiguous``; that it skipped: ``nonexistent``.
* No zone in the text and none (or an unknown one) given for the row: ``invalid``, as no instant can be fixed.
* Numeric dates are month-first for locale ``en-US`` and day-first otherwise; a NULL locale counts as day-first.
"""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fence

# Month names by language, January to December.
MONTH_NAMES = {
    "en": "january february march april may june july august september october november december",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "pt": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
    "it": "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre",
    "ru": "января февраля марта апреля мая июня июля августа сентября октября ноября декабря",
}
# Usual short forms that are not the first three letters.
SHORT_MONTHS = {"sept": 9, "mrz": 3, "janv": 1, "févr": 2, "avr": 4, "juil": 7, "déc": 12}
# Zone abbreviations, minutes east of UTC.
ABBREVIATIONS = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180,
    "IST": 330, "JST": 540, "KST": 540, "AWST": 480, "ACST": 570, "ACDT": 630, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "BRT": -180, "ART": -180,
}


def month_numbers() -> dict[str, int]:
    """Month name or abbreviation, lower case and without dot, to its number; ambiguous short forms are left out."""
    found: dict[str, set[int]] = {}
    for names in MONTH_NAMES.values():
        for n, name in enumerate(names.split(), 1):
            for form in {name, name[:3]}:
                found.setdefault(form, set()).add(n)
    return {k: v.copy().pop() for k, v in found.items() if len(v) == 1} | SHORT_MONTHS


_TIME = r"(?<h{k}>\d{{1,2}}):(?<mi{k}>\d{{2}})(?::(?<s{k}>\d{{2}})(?:[.,](?<f{k}>\d{{1,9}}))?)?"
_ZONE = r"(?:\s*(?:(?<o{k}>[+-]\d{{2}}:?\d{{2}})|(?<a{k}>Z|[A-Z]{{2,5}})|\[?(?<r{k}>[A-Za-z]+(?:/[A-Za-z0-9_+-]+)+)\]?))?"
_AMPM = r"(?:\s*(?<p{k}>[AaPp])\.?[Mm](?![A-Za-z])\.?)?"
#: One alternative each; {k} numbers the groups, as a name may stand only once in an expression.
NOTATIONS = (
    r"(?<y{k}>\d{{4}})[-/](?<m{k}>\d{{1,2}})[-/](?<d{k}>\d{{1,2}})(?:(?:[Tt]|,?\s+)" + _TIME + _AMPM + _ZONE + ")?",
    r"(?<y{k}>\d{{4}})(?<m{k}>\d{{2}})(?<d{k}>\d{{2}})[Tt](?<h{k}>\d{{2}})(?<mi{k}>\d{{2}})(?:(?<s{k}>\d{{2}})(?:[.,](?<f{k}>\d{{1,9}}))?)?" + _ZONE,
    r"(?:\p{{L}}+\.?,?\s+)?(?<d{k}>\d{{1,2}})(?:\.|st|nd|rd|th)?\s+(?:de\s+)?(?<n{k}>\p{{L}}{{3,}})\.?,?\s+(?:de\s+)?(?<y{k}>\d{{4}}|\d{{2}})(?:,?\s+(?:at\s+|um\s+|à\s+)?" + _TIME + _AMPM + r"(?:\s*Uhr)?" + _ZONE + ")?",
    r"(?:\p{{L}}+,\s+)?(?<n{k}>\p{{L}}{{3,}})\.?\s+(?<d{k}>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?<y{k}>\d{{4}})(?:,?\s+(?:at\s+)?" + _TIME + _AMPM + _ZONE + ")?",
    r"(?<x{k}>\d{{1,2}})[/.-](?<z{k}>\d{{1,2}})[/.-](?<y{k}>\d{{4}}|\d{{2}})(?:,?\s+" + _TIME + _AMPM + r"(?:\s*Uhr)?" + _ZONE + ")?",
    r"(?<y{k}>\d{{4}})年\s*(?<m{k}>\d{{1,2}})月\s*(?<d{k}>\d{{1,2}})日(?:\s*" + _TIME + _ZONE + ")?",
    r"(?<e{k}>-?\d{{1,18}})(?:\.(?<f{k}>\d{{1,9}}))?",
)
#: Components in the order in which they are written out.
PARTS = ("y", "m", "d", "x", "z", "n", "h", "mi", "s", "f", "p", "o", "a", "r", "e")
CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}\+00:00$"
_SEP = "\u0001"


def alternation() -> tuple[str, str]:
    """The expression over all notations and the replacement that writes its components."""
    expr = "^(?:" + "|".join(f"(?:{n.format(k=k)})" for k, n in enumerate(NOTATIONS)) + ")$"
    has = lambda part, k: f"(?<{part}{k}>" in NOTATIONS[k].format(k=k)
    out = [_SEP + "".join("${%s%d}" % (part, k) for k in range(len(NOTATIONS)) if has(part, k)) for part in PARTS]
    return expr, "".join(out)


def days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a proleptic Gregorian date, by integer arithmetic alone."""
    yy = y - F.when(m <= 2, 1).otherwise(0)
    era = F.floor(yy / 400)
    yoe = yy - era * 400
    doy = F.floor((153 * (m + F.when(m > 2, -3).otherwise(9)) + 2) / 5) + d - 1
    return era * 146097 + yoe * 365 + F.floor(yoe / 4) - F.floor(yoe / 100) + doy - 719468


def days_in_month(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def _offset_at(seconds: Column, zone: Column) -> Column:
    """Seconds east of UTC of a zone at an instant given in epoch seconds."""
    t = F.timestamp_seconds(seconds)
    return F.unix_seconds(F.from_utc_timestamp(t, zone)) - F.unix_seconds(t)


def normalise(df: DataFrame, value: str, zone: str, locale: str) -> DataFrame:
    """df with `utc` (text, YYYY-MM-DDTHH:MM:SS.mmmZ, or ambiguous / nonexistent / invalid) and `utc_ms` (epoch ms or NULL).

    value, zone and locale name columns. Working columns start with `__ts_`, so clashing input names are not touched.
    """
    expr, written = alternation()
    text = F.trim(F.regexp_replace(F.col(value), r"[\s   ]+", " "))
    df = df.withColumn("__ts_t", F.when(text == "", None).otherwise(text))
    df = fence(df.withColumn("__ts_p", F.split(F.regexp_replace("__ts_t", expr, written), _SEP)))
    part = lambda name: F.nullif(F.get("__ts_p", F.lit(PARTS.index(name) + 1)), F.lit(""))
    num = lambda name: part(name).try_cast("bigint")
    months = F.create_map(*[F.lit(x) for kv in month_numbers().items() for x in kv])
    abbr = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    year = F.when(F.length(part("y")) == 2, num("y") + F.when(num("y") < 70, 2000).otherwise(1900)).otherwise(num("y"))
    us = F.coalesce(F.col(locale) == "en-US", F.lit(False))
    month = F.coalesce(num("m"), F.when(part("n").isNotNull(), F.element_at(months, F.lower(part("n")))), F.when(us, num("x")).otherwise(num("z")))
    day = F.coalesce(num("d"), F.when(us, num("z")).otherwise(num("x")))
    frac_ms = F.coalesce(F.substring(F.rpad(part("f"), 9, "0"), 1, 3).cast("bigint"), F.lit(0))
    half = F.lower(part("p"))
    hour = F.when(half.isNull(), num("h")).when(num("h").between(1, 12), num("h") % 12 + F.when(half == "p", 12).otherwise(0))
    off = part("o")
    off_s = (F.substring(off, 2, 2).try_cast("bigint") * 3600 + F.substring(off, -2, 2).try_cast("bigint") * 60) * F.when(F.substring(off, 1, 1) == "-", -1).otherwise(1)
    df = fence(df.select(
        "*",
        year.alias("__ts_y"), month.cast("bigint").alias("__ts_m"), day.alias("__ts_d"),
        F.when(part("h").isNull(), 0).otherwise(hour).alias("__ts_h"), F.coalesce(num("mi"), F.lit(0)).alias("__ts_mi"), F.coalesce(num("s"), F.lit(0)).alias("__ts_s"),
        frac_ms.alias("__ts_ms"), num("e").alias("__ts_e"), part("e").alias("__ts_es"), off.alias("__ts_o"), part("a").alias("__ts_a"),
        F.when(off.isNotNull(), F.when(F.abs(off_s) <= 18 * 3600, off_s)).when(part("a").isNotNull(), F.element_at(abbr, part("a")) * 60).alias("__ts_fixed"),
        part("r").alias("__ts_r"),
    ).drop("__ts_p"))
    # zone names are checked against the public list (some 600 names, fixed) before the JVM sees them
    zones = df.sparkSession.createDataFrame([(z, z) for z in sorted(available_timezones()) if "/" in z or z in ("UTC", "GMT")], "__ts_zn string, __ts_zone string")
    df = df.withColumn("__ts_zk", F.coalesce("__ts_r", F.col(zone))).join(F.broadcast(zones), F.col("__ts_zk") == F.col("__ts_zn"), "left")
    y, m, d = F.col("__ts_y"), F.col("__ts_m"), F.col("__ts_d")
    dated = y.between(1, 9999) & m.between(1, 12) & (d >= 1) & (d <= days_in_month(y, m)) & F.col("__ts_h").between(0, 23) & F.col("__ts_mi").between(0, 59) & F.col("__ts_s").between(0, 59)
    df = df.withColumn("__ts_ok", F.coalesce(dated, F.lit(False)))
    df = df.withColumn("__ts_l", F.when(F.col("__ts_ok"), days_from_civil(y, m, d) * 86400 + F.col("__ts_h") * 3600 + F.col("__ts_mi") * 60 + F.col("__ts_s")).cast("bigint"))
    local, z = F.col("__ts_l"), F.col("__ts_zone")
    # far from any change of offset both neighbours agree; near one, the two readings are tried against the zone's own rule
    need = F.col("__ts_o").isNull() & F.col("__ts_a").isNull() & local.isNotNull() & z.isNotNull()
    df = df.withColumn("__ts_b", F.when(need, _offset_at(local - 86400, z))).withColumn("__ts_c", F.when(need, _offset_at(local + 86400, z)))
    df = fence(df)
    b, c = F.col("__ts_b"), F.col("__ts_c")
    df = df.withColumn("__ts_bv", F.when(need & (b != c), _offset_at(local - b, z) == b)).withColumn("__ts_cv", F.when(need & (b != c), _offset_at(local - c, z) == c))
    bv, cv, e = F.col("__ts_bv"), F.col("__ts_cv"), F.col("__ts_e")
    epoch_ms = F.when(F.abs(e) < 10**11, e * 1000 + F.when(F.col("__ts_es").startswith("-"), -F.col("__ts_ms")).otherwise(F.col("__ts_ms"))).when(F.abs(e) < 10**14, e).otherwise(F.floor(e / 1000)).cast("bigint")
    status = (
        F.when(e.isNotNull(), F.when(epoch_ms.between(-62135596800000, 253402300799999), "ok").otherwise("invalid"))
        .when(local.isNull(), "invalid")
        .when(F.col("__ts_o").isNotNull() | F.col("__ts_a").isNotNull(), F.when(F.col("__ts_fixed").isNull(), "invalid").otherwise("ok"))
        .when(z.isNull(), "invalid")
        .when(b == c, "ok").when(bv & cv, "ambiguous").when(bv | cv, "ok").otherwise("nonexistent")
    )
    offset = F.when(F.col("__ts_fixed").isNotNull(), F.col("__ts_fixed")).when(b == c, b).when(bv, b).otherwise(c)
    ms = F.when(e.isNotNull(), epoch_ms).otherwise((local - offset) * 1000 + F.col("__ts_ms"))
    df = fence(df)
    df = df.withColumn("__ts_st", F.when(F.col("__ts_t").isNotNull(), status)).withColumn("utc_ms", F.when(F.col("__ts_st") == "ok", ms))
    df = fence(df.select(*[x for x in df.columns if not x.startswith("__ts_") or x == "__ts_st"]))
    shown = F.concat(F.date_format(F.timestamp_seconds(F.floor(F.col("utc_ms") / 1000)), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), F.lpad(F.pmod(F.col("utc_ms"), F.lit(1000)).cast("string"), 3, "0"), F.lit("Z"))
    df = df.withColumn("utc", F.when(F.col("__ts_st") == "ok", shown).otherwise(F.col("__ts_st")))
    # an already canonical value: exactly the stored form, and valid
    df = df.withColumn("canonical", F.coalesce(F.col(value).rlike(CANONICAL) & (F.col("__ts_st") == "ok"), F.lit(False)))
    return fence(df.drop("__ts_st"))
