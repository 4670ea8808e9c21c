"""Score arithmetic (f18-f21, f33)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights ------------------------------------------------------
AMENITY_WEIGHTS = {"grocery_count": 3, "transit_stop_count": 3, "park_count": 2, "hospital_count": 1}
HAZARD_WEIGHTS = {"flood_risk_score": 0.30, "earthquake_risk_score": 0.30, "wildfire_risk_score": 0.20,
                  "tornado_risk_score": 0.10, "landslide_risk_score": 0.10}
COMPOSITE_WEIGHTS = {"safety_score": 0.30, "school_score_normalized": 0.25, "amenity_density_score": 0.20,
                     "hazard_safety_score": 0.15, "transit_access_score": 0.10}
COMPOSITE_MISSING = 50.0
# ----------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def weighted_sum(weights: dict, default=None) -> Column:
    """f19: sum of coalesce(c, default) * w (plain c * w when default is None)."""
    out = None
    for name, w in weights.items():
        c = F.col(name) if default is None else F.coalesce(F.col(name), F.lit(default))
        term = c * F.lit(w)
        out = term if out is None else out + term
    return out


def scaled(x, lo, hi, invert: bool = False, range_floor: float = 1.0) -> Column:
    """f18: (x - lo) / max(hi - lo, floor) * 100, optionally 100 - that; NULL lo/hi -> 0."""
    lo_c = F.coalesce(_c(lo).cast("double"), F.lit(0.0))
    hi_c = F.coalesce(_c(hi).cast("double"), F.lit(0.0))
    rng = F.greatest(hi_c - lo_c, F.lit(float(range_floor)))
    e = (_c(x) - lo_c) / rng * F.lit(100.0)
    return F.lit(100.0) - e if invert else e


def clamp_0_100(x) -> Column:
    """f20: below 0 -> 0, above 100 -> 100, NULL stays NULL."""
    c = _c(x)
    return F.when(c < 0, F.lit(0.0)).when(c > 100, F.lit(100.0)).otherwise(c)


def mean_of_two(a, b, null_if_both_null: bool = True) -> Column:
    """f21: (coalesce(a,0) + coalesce(b,0)) / 2."""
    m = (F.coalesce(_c(a), F.lit(0.0)) + F.coalesce(_c(b), F.lit(0.0))) / 2.0
    if null_if_both_null:
        return F.when(_c(a).isNotNull() | _c(b).isNotNull(), m)
    return m


def temp_mean(tmax, tmin) -> Column:
    """f33: (max + min) / 2, NULL propagates."""
    return (_c(tmax) + _c(tmin)) / 2.0
