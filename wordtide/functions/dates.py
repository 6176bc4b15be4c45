"""Date column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
# Business dates live in Japan Standard Time.
BUSINESS_TZ = "Asia/Tokyo"
# Weekday labels of the board's post dates, Monday first: 月 火 水 木 金 土 日
WEEKDAY_LABELS = ["月", "火", "水", "木", "金", "土", "日"]
# Post date text format: yyyy/MM/dd(曜) HH:mm:ss.SS ; the day prefix ends with '('.
DAY_PREFIX_FORMAT = "yyyy/MM/dd"
# History and regression frames, in days before the week start.
HISTORY_DAYS = 49
# -----------------------------------------------------------------------------


def target_date_jst(ts_utc: Column) -> Column:
    """The JST calendar date of a UTC wall-clock time (``timestamp_ntz``), minus
    one day.  ``convert_timezone`` does not depend on the session time zone."""
    return F.date_sub(F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(BUSINESS_TZ), ts_utc.cast("timestamp_ntz"))), 1)


def day_prefix(d: Column) -> Column:
    """``yyyy/MM/dd(`` of a date, the prefix every post of that day starts with."""
    return F.concat(F.date_format(d, DAY_PREFIX_FORMAT), F.lit("("))


def post_date_text(ts: Column) -> Column:
    """Board-style display text ``yyyy/MM/dd(曜) HH:mm:ss.SS`` of a timestamp."""
    wd = F.element_at(F.array(*[F.lit(x) for x in WEEKDAY_LABELS]), F.weekday(ts) + 1)
    return F.concat(day_prefix(ts), wd, F.lit(") "), F.date_format(ts, "HH:mm:ss.SS"))


def week_start(d: Column) -> Column:
    """Monday of the ISO week containing ``d``."""
    return F.to_date(F.date_trunc("week", d))


def previous_week(execution_date: Column) -> tuple[Column, Column]:
    """(Monday, Sunday) of the week before the execution date; any weekday is accepted."""
    start = F.date_sub(week_start(execution_date), 7)
    return start, F.date_add(start, 6)


def analysis_window(week: Column, days: int = HISTORY_DAYS) -> tuple[Column, Column]:
    """Regression window = [week - 49 days, week + 6 days]; ``days`` for other numbers of weeks."""
    return F.date_sub(week, days), F.date_add(week, 6)


def iso(d: Column) -> Column:
    """Dates as ISO text for engine-neutral result comparison."""
    return F.date_format(d, "yyyy-MM-dd")
