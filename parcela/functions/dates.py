"""Date parsing and arithmetic (f11, f12, f38)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text formats, tried in order -------------------------
DATE_FORMATS = ["yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "MM/dd/yyyy", "yyyy/MM/dd"]
EPOCH_MS_THRESHOLD = 1e12
EPOCH_SECONDS = (-62135596800, 253402300799)          # years 1 to 9999
# ----------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_listing_date(x) -> Column:
    """f11: epoch seconds or milliseconds (> 1e12) or one of DATE_FORMATS -> DATE."""
    s = F.trim(_c(x).cast("string"))
    # no number begins with four digits and a dash or holds a slash; a refused cast costs an exception a row
    num = F.when(~s.rlike(r"^\d{4}-|/"), s.try_cast("double"))
    seconds = F.when(num > EPOCH_MS_THRESHOLD, num / 1000).otherwise(num).try_cast("long")
    from_epoch = F.timestamp_seconds(F.when(seconds.between(*EPOCH_SECONDS), seconds))
    text = F.coalesce(*[F.try_to_timestamp(F.substring(s, 1, 19), F.lit(f)) for f in DATE_FORMATS])
    return F.when(num.isNotNull(), from_epoch.cast("date")).otherwise(text.cast("date"))


def parse_iso_z(x) -> Column:
    """f11: ISO timestamp with trailing Z -> TIMESTAMP (UTC session)."""
    s = F.regexp_replace(F.trim(_c(x)), "Z$", "")
    # a refused format costs an exception a row
    return F.coalesce(F.when(s.contains("."), F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS"))),
                      F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss")),
                      F.try_to_timestamp(s, F.lit("yyyy-MM-dd")))


def period_month_date(year, period) -> Column:
    """f11/f19: year + 'M03' -> first day of the month; M13 (annual) and bad -> NULL."""
    p = F.regexp_extract(_c(period), r"^M(\d\d)$", 1).try_cast("int")
    y = _c(year).try_cast("int")
    return F.when(p.between(1, 12) & y.between(1, 9999), F.make_date(y, p, F.lit(1)))


def month_start(x) -> Column:
    """f12."""
    return F.trunc(_c(x), "month")


def year_end(year) -> Column:
    """f12: Dec 31 of a year."""
    return F.make_date(_c(year), F.lit(12), F.lit(31))


def to_iso(x) -> Column:
    """f38: date / timestamp -> ISO text."""
    return F.date_format(_c(x), "yyyy-MM-dd'T'HH:mm:ss")
