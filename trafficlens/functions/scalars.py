"""Scalar Column helpers (X5-X21) used across operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the stamps carried in file names and keys.
DAY_FORMAT = "yyyyMMdd"
HOUR_FORMAT = "yyyyMMddHHmmss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_bigint(c) -> Column:
    """Lenient integer cast (NULL instead of an error)."""
    return _c(c).try_cast("bigint")


def to_double(c) -> Column:
    return _c(c).try_cast("double")


def day_stamp(ts) -> Column:
    """timestamp -> 'yyyyMMdd' key (the date of a timestamp_ntz is zone free)."""
    return F.date_format(F.to_date(_c(ts)), DAY_FORMAT)


def hour_of(ts) -> Column:
    """timestamp -> start of its hour as timestamp_ntz, from its date and hour
    fields (``date_trunc`` would pass through the session zone, where a
    daylight-saving gap moves the hour)."""
    t = _c(ts).cast("timestamp_ntz")
    return F.try_make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                    F.lit(0), F.lit(0))


def stamp_to_date(stamp) -> Column:
    """X17: 'yyyyMMdd' or 'yyyyMMddHHmmss' -> date (first 8 chars)."""
    return F.to_date(F.substring(_c(stamp), 1, 8), DAY_FORMAT)


def file_stamp(path) -> Column:
    """The 'YYYYMMDD-HHMMSS' after the last 'pagecounts-' of a path (the
    file or hour-directory name) -> 'YYYYMMDDHHMMSS'; NULL when absent.

    Plain string functions on the UTF-8 bytes: a regex here would decode the
    whole path into a Java string for every line read.
    """
    p = _c(path)
    cand = F.substring(F.substring_index(p, "pagecounts-", -1), 1, 15)
    ok = (p.contains("pagecounts-") & (F.length(cand) == 15) & (F.substring(cand, 9, 1) == "-")
          & (F.translate(cand, "0123456789", "") == "-"))
    return F.when(ok, F.concat(F.substring(cand, 1, 8), F.substring(cand, 10, 6)))


def _stamp_parts(stamp) -> list[Column]:
    st = _c(stamp)
    return [F.substring(st, a, b).try_cast("int") for a, b in
            ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2))]


def stamp_to_ts(stamp) -> Column:
    """'yyyyMMddHHmmss' -> timestamp_ntz, built from its digits (no session
    time zone involved, so no daylight-saving gap can move it); NULL when
    malformed."""
    return F.try_make_timestamp_ntz(*_stamp_parts(stamp))


def stamp_to_instant(stamp) -> Column:
    """'yyyyMMddHHmmss' -> TIMESTAMP instant whose UTC clock reads the stamp.

    Event-time watermarks need TIMESTAMP; pinning the stamp to UTC makes
    hourly windows fall on the stamp's own hours in any session time zone.
    """
    return F.try_make_timestamp(*_stamp_parts(stamp), F.lit("UTC"))


def file_place(path) -> Column:
    """The 15 characters of a path that ``file_stamp`` reads, if any."""
    p = _c(path)
    return F.when(p.contains("pagecounts-"), F.substring(F.substring_index(p, "pagecounts-", -1), 1, 15))


def place_number(place) -> Column:
    """The 14 digits of a ``file_place`` behind a 1, which tells them from signs
    and blanks by the size of the number; NULL for anything else."""
    c = _c(place)
    n = F.concat(F.lit("1"), F.substring(c, 1, 8), F.substring(c, 10, 6)).try_cast("bigint")
    return F.when(F.substring(c, 9, 1) == "-", n)


def number_to_instant(number) -> Column:
    """``stamp_to_instant(file_stamp(path))`` from a ``place_number`` by integer
    arithmetic, for a stream needs it for every line; second 60 is the next
    minute, as there."""
    n = _c(number)
    part = lambda unit, size: F.call_function("div", n, F.lit(unit)) % size
    y, mo, d, h, m, s = (part(10 ** k, 100 if k < 10 else 10000).cast("int") for k in (10, 8, 6, 4, 2, 0))
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    last = F.when(mo == 2, F.when(leap, 29).otherwise(28)).when(mo.isin(4, 6, 9, 11), 30).otherwise(31)
    ok = (n >= 10 ** 14) & (mo >= 1) & (mo <= 12) & (d >= 1) & (d <= last) & (h < 24) & (m < 60) & (s <= 60)
    days = F.unix_date(F.make_date(y, mo, d)).cast("bigint")
    return F.when(ok, F.timestamp_seconds(days * 86400 + h * 3600 + m * 60 + s))


def instant_to_wallclock(ts) -> Column:
    """Inverse of ``stamp_to_instant``: the UTC clock of an instant as
    timestamp_ntz (epoch + seconds; no session time zone involved)."""
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.unix_micros(_c(ts)).cast("decimal(20,0)") / F.lit(1000000))


def hours_before(ts, hours: int) -> Column:
    """Ts - h hours."""
    return _c(ts) - F.make_dt_interval(F.lit(0), F.lit(hours))


def doc_id(title, stamp) -> Column:
    """sha1 hex of title + date stamp."""
    return F.sha1(F.concat(_c(title), _c(stamp)))


def json_bigint_array(s) -> Column:
    """X12: '[1,2,3]' -> array<bigint>."""
    return F.from_json(_c(s), "array<bigint>")


def json_string_array(s) -> Column:
    """X12: '[20150301,20150302]' -> array<string> (numbers kept as text)."""
    return F.from_json(_c(s), "array<string>")


def json_array_text(arr) -> Column:
    """Inverse of the two above for integer/date-stamp arrays: '[a,b]'."""
    return F.concat(F.lit("["), F.array_join(_c(arr), ","), F.lit("]"))


def sum_array(arr) -> Column:
    """Sum of an array<bigint> (0 when empty)."""
    return F.aggregate(_c(arr), F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def underscores_to_spaces(s) -> Column:
    """X7."""
    return F.replace(_c(s), F.lit("_"), F.lit(" "))
