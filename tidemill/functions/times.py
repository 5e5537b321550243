"""Time expressions. All of them follow ``spark.sql.session.timeZone``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY = "yyyy-MM-dd"
SECOND = "yyyy-MM-dd HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_millis(text: Column | str, full: bool = True) -> Column:
    """Date-time text (or day text when ``full`` is false) to epoch milliseconds; null where the text is neither."""
    return F.unix_millis(F.try_to_timestamp(_col(text), F.lit(SECOND if full else DAY)))


def millis_to_time(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms))


def millis_to_second_time(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp with the fraction cut off."""
    return F.timestamp_seconds(F.floor(_col(ms) / F.lit(1000)))


def millis_to_day(ms: Column | str) -> Column:
    return F.date_format(F.timestamp_millis(_col(ms)), DAY)


def millis_to_text(ms: Column | str) -> Column:
    return F.date_format(F.timestamp_millis(_col(ms)), SECOND)


def day_of_text(text: Column | str) -> Column:
    """The day part of date-time text."""
    return F.substring_index(_col(text), " ", 1)


def text_day(text: Column | str) -> Column:
    """``date_format`` of date-time text; null where the text is no date-time."""
    return F.date_format(F.try_to_timestamp(_col(text), F.lit(SECOND)), DAY)


def text_time(text: Column | str) -> Column:
    """Date-time text to a timestamp; null where the text is no date-time, so one bad row fails no job."""
    return F.try_to_timestamp(_col(text), F.lit(SECOND))


def zulu_time(text: Column | str) -> Column:
    """`2022-04-01 11:10:55.9Z` to a timestamp; the fraction counts from the left (.9 = 900 ms).

    Fractions beyond the millisecond are dropped, so two such texts compare at millisecond grain.
    """
    return F.date_trunc("millisecond", F.try_to_timestamp(F.translate(_col(text), "Z", "")))


def compare_zulu(left: Column | str, right: Column | str) -> Column:
    """-1, 0 or 1, comparing two such texts by time rather than letter by letter."""
    a, b = zulu_time(left), zulu_time(right)
    return F.when(a < b, -1).when(a == b, 0).when(a > b, 1)


def tumble(time: Column | str, size: str) -> Column:
    return F.window(_col(time), size)


def window_text(window: Column | str = "window") -> list[Column]:
    """`stt` and `edt` of a window column as text."""
    w = _col(window)
    return [
        F.date_format(w.getField("start"), SECOND).alias("stt"),
        F.date_format(w.getField("end"), SECOND).alias("edt"),
    ]
