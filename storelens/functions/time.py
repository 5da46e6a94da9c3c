"""Time expressions.

Event times travel as epoch milliseconds (``long``) or as ``yyyy-MM-dd HH:mm:ss`` text, as in the shop's
records. Every conversion goes through TIMESTAMP_NTZ wall clocks and ``convert_timezone``, so results
depend on the ``zone`` argument only, never on the session or machine zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyyMMdd"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(ntz, zone: str = "UTC") -> Column:
    """Wall clock (TIMESTAMP_NTZ) in ``zone`` -> epoch milliseconds, truncated.

    Pure wall-clock arithmetic (days since epoch, hours, minutes, seconds): ``timestampdiff`` and
    ``unix_millis`` would first cast to the session-zone TIMESTAMP and shift across DST changes."""
    utc = _c(ntz) if zone == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), _c(ntz))
    return (F.unix_date(utc.cast("date")).cast("long") * 86_400_000
            + F.hour(utc).cast("long") * 3_600_000 + F.minute(utc).cast("long") * 60_000
            + F.floor(F.extract(F.lit("SECOND"), utc) * 1000).cast("long"))


def local_time(ms, zone: str = "UTC") -> Column:
    """Epoch milliseconds -> wall clock (TIMESTAMP_NTZ) in ``zone``."""
    utc = F.timestamp_add("MILLISECOND", _c(ms), _epoch())
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def day_of(ms, zone: str = "UTC", fmt: str = DAY_FORMAT) -> Column:
    """epoch ms -> day text such as ``20240101`` (or ``yyyy-MM-dd``)."""
    day = local_time(ms, zone).cast("date").cast("string")
    if fmt == DAY_FORMAT:
        return F.regexp_replace(day, "-", "")
    if fmt == "yyyy-MM-dd":
        return day
    return F.date_format(local_time(ms, zone), fmt)


def format_ts(ntz, fmt: str = TEXT_FORMAT) -> Column:
    """F8: wall clock -> text. The default format is read off the NTZ text form, which no session
    zone touches (``date_format`` goes through the session-zone TIMESTAMP)."""
    if fmt == TEXT_FORMAT:
        return F.substring(_c(ntz).cast("timestamp_ntz").cast("string"), 1, 19)
    return F.date_format(_c(ntz), fmt)


def parse_ms(text, zone: str = "UTC", fmt: str = TEXT_FORMAT) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text in ``zone`` -> epoch ms."""
    return epoch_ms(F.to_timestamp_ntz(_c(text), F.lit(fmt)), zone)


def window_bounds(window_col, zone: str = "UTC", fmt: str = TEXT_FORMAT) -> tuple[Column, Column]:
    """``stt``/``edt`` text of a ``F.window`` struct over an event-time instant, on the wall
    clock of ``zone`` (the window itself is epoch-aligned, as the shop's tumbling windows are)."""
    w = _c(window_col)
    return (format_ts(local_time(F.unix_millis(w["start"]), zone), fmt).alias("stt"),
            format_ts(local_time(F.unix_millis(w["end"]), zone), fmt).alias("edt"))


def event_time(ms) -> Column:
    """Epoch ms -> TIMESTAMP instant: the type watermarks and windows need."""
    return F.timestamp_millis(_c(ms))


def age_years(birthday, as_of=None) -> Column:
    """whole years of 365 days between a ``yyyy-MM-dd`` birthday and ``as_of`` (text, a date
    column, or None for today's date as the shop's wall clock did)."""
    if as_of is None:
        ref = F.current_date()
    elif isinstance(as_of, str):
        ref = F.to_date(F.lit(as_of))
    else:
        ref = F.to_date(as_of)
    return F.floor(F.datediff(ref, F.to_date(_c(birthday))) / 365).cast("int")
