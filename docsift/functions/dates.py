"""Flexible date parsing (optional month/day/time parts, optional zone).

Accepted: ``yyyy[-MM][-dd][T[HH][:mm][:ss][.f{1,9}][Z|+hh[:mm]]]``; missing
month/day = 1, missing time parts = 0, no zone = UTC, the fraction is cut to
milliseconds.  A string that is no such date but an integer is epoch
milliseconds (so ``2015`` is a year, ``20150`` is epoch ms).  What is neither
(``2015-13``, a number beyond 64 bits) becomes null.

A value is read in stages: date and time part at ``T``, the zone off the time's
end, the fraction at the dot, then the fields at ``-`` and ``:``, each checked on
its own.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = _dt.datetime(1970, 1, 1)
# The checks of single parts.
YEAR, TWO, FRACTION, ZONE, WHOLE = r"^[0-9]{4}$", r"^[0-9]{2}$", r"^[0-9]{1,9}$", r"^(Z|[+-][0-9]{2}(:?[0-9]{2})?)$", r"^-?[0-9]+$"


def parse_date(c: Column) -> Column:
    """string -> timestamp (UTC instant); null when rejected."""
    s = c.cast("string")
    at = F.instr(s, "T")
    day = F.when(at > 0, F.substring(s, F.lit(1), at - 1)).otherwise(s)
    time = F.when(at > 0, F.substring(s, at + 1, F.length(s))).otherwise(F.lit(""))
    zone = F.regexp_extract(time, r"(Z|[+-][0-9:]*)$", 1)
    clock = F.substring(time, F.lit(1), F.length(time) - F.length(zone))
    dot = F.instr(clock, ".")
    fraction = F.when(dot > 0, F.substring(clock, dot + 1, F.length(clock)))
    hms = F.split(F.when(dot > 0, F.substring(clock, F.lit(1), dot - 1)).otherwise(clock), ":")
    ymd = F.split(day, "-")
    ok = (F.size(ymd) <= 3) & (F.size(hms) <= 3) & F.get(ymd, F.lit(0)).rlike(YEAR)
    ok = ok & ((zone == "") | zone.rlike(ZONE)) & (fraction.isNull() | fraction.rlike(FRACTION))
    ok = ok & ((F.get(hms, F.lit(0)) == "") | F.get(hms, F.lit(0)).rlike(TWO))
    for part in (F.get(ymd, F.lit(1)), F.get(ymd, F.lit(2)), F.get(hms, F.lit(1)), F.get(hms, F.lit(2))):
        ok = ok & (part.isNull() | part.rlike(TWO))
    number = lambda part, default: F.coalesce(part.try_cast("int"), F.lit(default))
    ms = F.coalesce(F.rpad(F.substring(fraction, 1, 3), 3, "0").try_cast("int"), F.lit(0))
    seconds = number(F.get(hms, F.lit(2)), 0).cast("decimal(12,3)") + ms.cast("decimal(12,3)") / F.lit(1000)
    local = F.try_make_timestamp_ntz(number(F.get(ymd, F.lit(0)), 1), number(F.get(ymd, F.lit(1)), 1), number(F.get(ymd, F.lit(2)), 1),
                                     number(F.get(hms, F.lit(0)), 0), number(F.get(hms, F.lit(1)), 0), seconds)
    digits = F.regexp_replace(zone, "[^0-9]", "")
    offset = number(F.substring(digits, 1, 2), 0) * 3600 + number(F.substring(digits, 3, 2), 0) * 60
    offset = F.when(F.startswith(zone, F.lit("-")), -offset).otherwise(offset)
    utc_ms = F.unix_millis(local.cast("timestamp")) - offset.cast("long") * 1000
    as_ms = F.when(s.rlike(WHOLE), s.try_cast("long"))
    return F.when(F.coalesce(ok, F.lit(False)) & local.isNotNull(), F.timestamp_millis(utc_ms)).otherwise(F.timestamp_millis(as_ms))


def date_literal_ms(v) -> int:
    """Epoch milliseconds of a literal: a datetime, a date string, or epoch milliseconds."""
    if isinstance(v, _dt.datetime):
        return int((v - _EPOCH).total_seconds() * 1000)
    if isinstance(v, _dt.date):
        return (v - _EPOCH.date()).days * 86_400_000
    s = str(int(v)) if isinstance(v, float) else str(v)
    day, _, time = s.partition("T")
    zone = re.search(r"(Z|[+-][0-9:]*)$", time)
    zone = zone.group() if zone else ""
    clock, dot, fraction = time[:len(time) - len(zone)].partition(".")
    ymd, hms = day.split("-"), clock.split(":")
    two = lambda part: re.match(TWO, part) is not None
    if (re.match(YEAR, ymd[0]) and len(ymd) <= 3 and len(hms) <= 3 and all(map(two, ymd[1:])) and all(map(two, hms[1:]))
            and (not hms[0] or two(hms[0])) and (not zone or re.match(ZONE, zone)) and (not dot or re.match(FRACTION, fraction))):
        y, mo, d = (int(x) for x in [*ymd, "1", "1"][:3])
        h, mi, se = (int(x or 0) for x in [*hms, "0", "0"][:3])
        local = _dt.datetime(y, mo, d, h, mi, se, int(fraction[:3].ljust(3, "0")) * 1000 if fraction else 0)
        digits = re.sub("[^0-9]", "", zone)
        offset = (int(digits[:2] or 0) * 3600 + int(digits[2:4] or 0) * 60) * (-1 if zone.startswith("-") else 1)
        return round((local - _EPOCH).total_seconds() * 1000) - offset * 1000
    if re.match(WHOLE, s):
        return int(s)
    raise ValueError(f"cannot parse date {v!r}")


def parse_date_literal(v) -> Column:
    """Timestamp of a *literal* (query parameter)."""
    if isinstance(v, (_dt.datetime, _dt.date)):
        return F.lit(v)
    return F.timestamp_millis(F.lit(date_literal_ms(v)))
