"""Numeric parsing and arithmetic expressions (f05-f08, f10, f14-f16, f22-f26, p20)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values ---------------------------------------------------------------
SQFT_PER_M2 = 10.7639
BOOL_TRUE = ["1", "yes", "true", "y"]
BOOL_FALSE = ["0", "no", "false", "n"]
MORTGAGE_MONTHS = 360
HOUSING_SHARE = 0.28
DEFAULT_MORTGAGE_RATE = 7.0
# ----------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_float(x) -> Column:
    """f05: blank or bad text -> NULL double."""
    return _try_cast(F.nullif(F.trim(_c(x).cast("string")), F.lit("")), "double")


def _try_cast(c: Column, t: str) -> Column:
    return c.try_cast(t)


def safe_int(x) -> Column:
    """f05: int via float truncation; blank or bad -> NULL."""
    return whole(safe_float(x))


def whole(d: Column) -> Column:
    """f05: a double cut to an int; beyond its range NULL."""
    return F.when(F.abs(d) < 2147483648.0, d.cast("int"))


def sentinel_null(x, sentinels=(-666666666, -999999999), negative_is_null: bool = True) -> Column:
    """f06: listed sentinel codes and (optionally) negatives -> NULL."""
    c = _c(x)
    cond = ~c.isin(list(sentinels))
    if negative_is_null:
        cond = cond & (c >= 0)
    return F.when(cond, c)


def locale_number(x) -> Column:
    """f07: '1.234.567,89' / '1,5' / '$ 450.000.000' -> double.

    Both '.' and ',' present: '.' is thousands and ',' decimal. Only ',': decimal.
    Only '.': thousands when every group after a dot has 3 digits, else decimal.
    """
    s = F.regexp_replace(F.trim(_c(x).cast("string")), r"[^0-9.,\-]", "")
    both = s.contains(".") & s.contains(",")
    only_comma = s.contains(",") & ~s.contains(".")
    dot_thousands = s.rlike(r"^-?\d{1,3}(\.\d{3})+$")
    norm = (F.when(both, F.regexp_replace(F.regexp_replace(s, r"\.", ""), ",", "."))
             .when(only_comma, F.regexp_replace(s, ",", "."))
             .when(dot_thousands, F.regexp_replace(s, r"\.", ""))
             .otherwise(s))
    return _try_cast(F.nullif(norm, F.lit("")), "double")


def parse_count(x) -> Column:
    """f07: count with separators stripped must be all digits, else NULL."""
    s = F.regexp_replace(F.trim(_c(x).cast("string")), r"[.,\s]", "")
    return F.when(s.rlike(r"^\d+$"), _try_cast(s, "bigint"))


def bool_decode(x) -> Column:
    """f08: 1/yes/true/y -> true; 0/no/false/n -> false; else NULL."""
    s = F.lower(F.trim(_c(x).cast("string")))
    return F.when(s.isin(BOOL_TRUE), F.lit(True)).when(s.isin(BOOL_FALSE), F.lit(False))


def zip_pad(x, width: int = 5) -> Column:
    """f10: left pad with zeros, then keep the first ``width`` characters."""
    return F.substring(F.lpad(F.trim(_c(x).cast("string")), width, "0"), 1, width)


def m2_to_sqft(x) -> Column:
    """f14."""
    return _c(x) * F.lit(SQFT_PER_M2)


def cop_to_usd(cop, rate) -> Column:
    """f15: COP / rate truncated to long (NULL-safe; zero rate -> NULL)."""
    return F.try_divide(_c(cop).cast("double"), F.nullif(_c(rate), F.lit(0.0))).try_cast("long")


def usd_to_cop(usd, rate) -> Column:
    """f15: USD * rate truncated to long."""
    return (_c(usd).cast("double") * _c(rate)).try_cast("long")


def price_per_area(price, area) -> Column:
    """f16: price / area; NULL when area NULL or <= 0."""
    return F.when(_c(area) > 0, _c(price).cast("double") / _c(area))


def ratio_pct(num, den) -> Column:
    """f22: 100 * num / den; NULL on missing or zero denominator."""
    return F.when(_c(den) != 0, F.lit(100.0) * _c(num) / _c(den))


def months_of_supply(inventory, sold) -> Column:
    """f23: inventory / homes_sold when sold > 0 and inventory present."""
    return F.when(_c(sold).isNotNull() & (_c(sold) > 0) & _c(inventory).isNotNull(),
                  _c(inventory).cast("double") / _c(sold).cast("double"))


def discount_pct(median, price) -> Column:
    """f24: (median - price) / median * 100."""
    return (_c(median) - _c(price)) / _c(median) * 100.0


def score_from_measure(x, full_scale: float) -> Column:
    """f25: min(x / full_scale, 1)."""
    return F.least(_c(x) / F.lit(float(full_scale)), F.lit(1.0))


def max_affordable_price(annual_income, rate_pct, down_payment=None) -> Column:
    """f26: principal of a 30-year annuity paying 28 % of monthly income, + down payment."""
    pmt = _c(annual_income) * F.lit(HOUSING_SHARE) / F.lit(12.0)
    r = _c(rate_pct) / F.lit(100.0) / F.lit(12.0)
    n = F.lit(float(MORTGAGE_MONTHS))
    principal = F.when(r <= 0, pmt * n).otherwise(pmt / r * (F.lit(1.0) - F.pow(F.lit(1.0) + r, -n)))
    dp = F.coalesce(_c(down_payment), F.lit(0.0)) if down_payment is not None else F.lit(0.0)
    return principal + dp


def clamp_param(x, default, low, high) -> Column:
    """p20: greatest(low, least(high, coalesce(try_cast(x), default)))."""
    v = F.coalesce(_try_cast(_c(x).cast("string"), "double").try_cast("bigint"), F.lit(default))
    return F.greatest(F.lit(low), F.least(F.lit(high), v))


def clamp_limit(value, default: int = 10, low: int = 1, high: int | None = 50) -> int:
    """p20 for plain request parameters (driver-side, a single value)."""
    try:
        v = int(float(value))
    except (TypeError, ValueError, OverflowError):
        return default
    return max(low, v if high is None else min(high, v))
