"""Date and time expressions."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strptime directive -> (pattern letters, fixed-width pattern letters).
DIRECTIVES = {
    "Y": ("yyyy", "yyyy"),
    "y": ("yy", "yy"),
    "m": ("M", "MM"),
    "d": ("d", "dd"),
    "H": ("H", "HH"),
    "I": ("h", "hh"),
    "M": ("m", "mm"),
    "S": ("s", "ss"),
    "f": ("SSSSSS", "SSSSSS"),
    "j": ("D", "DDD"),
    "p": ("a", "a"),
    "b": ("MMM", "MMM"),
    "B": ("MMMM", "MMMM"),
}
_NUMERIC = set("YymdHIMSfj")


def spark_pattern(strptime_format: str) -> str:
    """Translate a strptime format to a Spark datetime pattern.

    A lone numeric directive takes one or two digits; touching numeric directives (``%Y%m%d``)
    need fixed widths, or the first would swallow the second.
    """
    tokens = _tokens(strptime_format)
    codes = [code for _, code in tokens]
    out = []
    for i, (token, code) in enumerate(tokens):
        if code is None:
            literal = "%" if token == "%%" else token
            if literal == "%" and token == "%":
                raise ValueError(f"stray '%' at the end of {strptime_format!r}")
            out.append(_quote(literal))
            continue
        if code not in DIRECTIVES:
            raise ValueError(f"directive %{code} in {strptime_format!r} is not supported")
        neighbours = {codes[j] for j in (i - 1, i + 1) if 0 <= j < len(codes)}
        touching = code in _NUMERIC and bool(neighbours & _NUMERIC)
        out.append(DIRECTIVES[code][1 if touching else 0])
    return "".join(out)


def _quote(literal: str) -> str:
    pieces = re.findall(r"[A-Za-z'\[\]#{}]+|[^A-Za-z'\[\]#{}]+", literal)
    return "".join(
        "'" + p.replace("'", "''") + "'" if re.match(r"[A-Za-z'\[\]#{}]", p) else p for p in pieces
    )


# What strptime takes for the directives that Spark's patterns can't parse.
_OFFSET = "[+-][0-9]{2}:?[0-5][0-9](?::?[0-5][0-9])?|Z"
_WEEKDAYS = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()
SET_APART = {
    "z": _OFFSET,
    "Z": "[A-Za-z][A-Za-z0-9_+/-]*",
    "a": "(?i:" + "|".join(d[:3] for d in _WEEKDAYS) + ")",
    "A": "(?i:" + "|".join(_WEEKDAYS) + ")",
}


def _tokens(strptime_format: str) -> list[tuple[str, str | None]]:
    """The format's directives and the texts between them, each with the directive's letter."""
    tokens = re.findall(r"%.|[^%]+|%$", strptime_format, flags=re.DOTALL)
    return [(t, t[1] if t[0] == "%" and len(t) == 2 and t != "%%" else None) for t in tokens]


def _set_apart(strptime_format: str) -> tuple[set[str], str]:
    """The directives that are read apart from the rest, and a pattern with one group for each token."""
    tokens = _tokens(strptime_format)
    found = {code for _, code in tokens if code in SET_APART}
    if {"z", "Z"} <= found:
        raise ValueError(f"{strptime_format!r} has two zones")

    def group(token: str, code: str | None) -> str:
        if code in SET_APART:
            return f"({SET_APART[code]})"
        if code is None:
            return f"({re.escape('%' if token == '%%' else token)})"
        return "([0-9]+)" if code in _NUMERIC else "(\\p{L}+)"

    return found, "^" + "".join(group(*t) for t in tokens) + "$"


def parse_timestamp(c: Column, strptime_format: str, ntz_session: bool, zones: Sequence[str] = ()) -> Column:
    """Strict whole-string parse to ``timestamp_ntz``, or to ``timestamp`` if the format has a zone; text that does not fit is null.

    Names of weekdays (``%a``, ``%A``) must be such names but needn't be those of the date. ``%z`` takes offsets and ``Z``,
    ``%Z`` the names in ``zones``, by the letter.
    ``ntz_session`` tells whether ``spark.sql.timestampType`` is TIMESTAMP_NTZ. If not, the text is
    read as UTC, so that a wall-clock time in a daylight-saving gap of the session zone survives.
    """
    apart, groups = _set_apart(strptime_format)
    if apart:
        plain = "".join(token for token, code in _tokens(strptime_format) if code not in apart)
        wall = parse_timestamp(F.when(c.rlike(groups), F.regexp_replace(c, groups, "".join(f"${i + 1}" for i, (_, code) in enumerate(_tokens(strptime_format)) if code not in apart))), plain, ntz_session)
        places = {code: i + 1 for i, (_, code) in enumerate(_tokens(strptime_format))}
        for code in apart & {"z", "Z"}:
            zone = F.regexp_extract(c, groups, places[code])
            known = F.lit(True) if code == "z" else zone.isin(list(zones))
            # 1970 in UTC is the zero of instants; the distance is exact, whatever the session's zone.
            # Seconds of an offset don't count.
            named = F.when(zone == "Z", "UTC").otherwise(F.regexp_replace(zone, "^([+-][0-9]{2}):?([0-9]{2}).*$", "$1:$2"))
            utc = F.convert_timezone(named, F.lit("UTC"), wall)
            seconds = (utc - F.lit("1970-01-01").cast("timestamp_ntz")).cast("interval second").cast("decimal(20,6)")
            wall = F.when(known, F.timestamp_micros((seconds * 1_000_000).cast("bigint")))
        return wall
    pattern = spark_pattern(strptime_format)
    directives = set(re.findall(r"%(.)", strptime_format.replace("%%", "")))
    text = c
    if not directives & {"Y", "y"}:
        text, pattern = F.concat(F.lit("1900 "), text), "yyyy " + pattern
    if "I" in directives and "p" not in directives:
        text, pattern = F.concat(text, F.lit(" AM")), pattern + " a"
    if ntz_session:
        parsed = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
    else:
        instant = F.try_to_timestamp(F.concat(text, F.lit(" UTC")), F.lit(pattern + " VV"))
        seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
        zero = F.lit(0)
        parsed = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)
    if "y" in directives:
        # Two-digit years turn at 69: 68 is 2068, 69 is 1969.
        parsed = F.when(
            F.year(parsed) >= 2069, parsed - F.make_ym_interval(F.lit(100), F.lit(0))
        ).otherwise(parsed)
    return parsed


def military_time(number: Column) -> Column:
    """HHMM number to a day-time interval; null and values outside a small integer count as 0."""
    value = F.coalesce(number.try_cast("smallint"), F.lit(0)).cast("int")
    hours = F.floor(value / F.lit(100)).cast("int")
    minutes = F.pmod(value, F.lit(100))
    return F.make_dt_interval(F.lit(0), hours, minutes)


def is_workday(c: Column | None = None) -> Column:
    """True from Tuesday to Saturday. Without a column: today, one value per query."""
    day = F.current_date() if c is None else c
    return ~F.weekday(day).isin(0, 6)


def is_workday_date(date: dt.date | None = None) -> bool:
    """The same rule for one Python date, default today."""
    return (date or dt.date.today()).weekday() not in (0, 6)
