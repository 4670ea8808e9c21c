"""Categorical mappings and threshold labels as native `when` chains (p12-p15, f09, f13, f27-f30, j18)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import accent_strip, token_normalize

# Fixed values that must match the source behaviour -------------------------
PROPERTY_SINGLE_FAMILY = ["single_family", "single family", "sfh"]
PROPERTY_APARTMENT = ["condo", "condominium", "apartment", "apartamento"]
PROPERTY_TOWNHOUSE = ["townhouse", "town home", "town-house"]
PROPERTY_CASA = ["casa"]

MARKET_TEMP_THRESHOLDS = [(2.0, "hot"), (4.0, "warm"), (6.0, "cool")]   # else "cold"
HAZARD_LABEL_THRESHOLDS = [(25.0, "low"), (50.0, "medium"), (75.0, "high")]  # else "very_high"
RISK_LEVEL_THRESHOLDS = [(0.8, "very_high"), (0.6, "high"), (0.3, "medium")]  # >=, else "low"

EXTREME_PRECIPITATION_MM = 50.0
EXTREME_WIND_KMH = 80.0
EXTREME_TEMP_MAX_C = 38.0
EXTREME_TEMP_MIN_C = -15.0

SPANISH_MONTHS = {
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7,
    "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
}

FBI_VIOLENT = ["homicide", "rape", "robbery", "aggravated-assault"]
FBI_PROPERTY = ["burglary", "larceny", "motor-vehicle-theft"]
INCIDENT_VIOLENT = ["assault", "robbery", "shooting", "homicide"]
INCIDENT_PROPERTY = ["burglary", "theft", "vandalism", "arson"]
SPANISH_VIOLENT_TERMS = ["homicid", "lesion", "secuestr", "violenc", "violacion", "feminicid",
                         "delitos sexuales", "sexual"]
SPANISH_VIOLENT_HURTO = ["violen", "con violencia", "violento"]
SPANISH_PROPERTY_TERMS = ["hurto", "robo", "dano", "abigeato", "piracy", "pirateria"]

FLOOD_ZONE_RISK = [("AE", 0.9), ("A", 0.9), ("AH", 0.9), ("AO", 0.9), ("V", 0.9), ("VE", 0.9),
                   ("X500", 0.4), ("X", 0.1)]   # exact match first, then prefix in this order
FLOOD_ZONE_DEFAULT = 0.5
RISK_CLASS_SCORE = {"bajo": 0.2, "medio": 0.5, "alto": 0.8, "muy alto": 0.95, "muy_alto": 0.95}
INCIDENT_TYPE_HAZARD = {
    "Flood": "flood", "Coastal Storm": "flood", "Severe Storm": "flood", "Severe Storm(s)": "flood",
    "Hurricane": "hurricane", "Tropical Storm": "hurricane", "Typhoon": "hurricane",
    "Tornado": "tornado", "Fire": "wildfire", "Earthquake": "earthquake",
    "Mud/Landslide": "landslide", "Severe Ice Storm": "flood",
}
RENT_MARKERS = ["FOR_RENT", "RENT", "RENTAL"]
SALE_MARKERS = ["FOR_SALE", "FORSALE", "SALE"]
GRADE_NULL = ["", "-1", "-2", "-3", "NA", "N/A"]
SUBJECT_MATH = ["math", "mathematics"]
SUBJECT_READING = ["read", "reading", "ela", "english"]
# ----------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit_map(d: dict) -> Column:
    return F.create_map(*[F.lit(v) for kv in d.items() for v in kv])


def property_type_norm(x) -> Column:
    """p12: raw property type -> single_family / apartment / townhouse (default apartment)."""
    t = F.lower(_c(x))
    return (F.when(t.isin(PROPERTY_SINGLE_FAMILY), "single_family")
             .when(t.isin(PROPERTY_APARTMENT), "apartment")
             .when(t.isin(PROPERTY_TOWNHOUSE), "townhouse")
             .when(t.isin(PROPERTY_CASA), "single_family")
             .otherwise("apartment"))


def market_temp(months_of_supply) -> Column:
    """p13: months of supply -> hot / warm / cool / cold, NULL stays NULL."""
    m = _c(months_of_supply)
    out = None
    for bound, label in MARKET_TEMP_THRESHOLDS:
        out = (F.when(m < bound, label) if out is None else out.when(m < bound, label))
    return out.when(m.isNotNull(), "cold")


def hazard_label(score_0_100) -> Column:
    """p13: composite hazard 0-100 -> low / medium / high / very_high; NULL stays NULL."""
    s = _c(score_0_100)
    out = None
    for bound, label in HAZARD_LABEL_THRESHOLDS:
        out = (F.when(s < bound, label) if out is None else out.when(s < bound, label))
    return out.when(s.isNotNull(), "very_high")


def risk_level(score_0_1) -> Column:
    """p13: 0-1 risk score -> very_high / high / medium / low; NULL stays NULL."""
    s = _c(score_0_1)
    out = None
    for bound, label in RISK_LEVEL_THRESHOLDS:
        out = (F.when(s >= bound, label) if out is None else out.when(s >= bound, label))
    return out.when(s.isNotNull(), "low")


def is_for_sale(status_type, home_status, listing_type) -> Column:
    """p14: reject rentals, accept sale markers, accept when all blank, else reject."""
    vals = [F.upper(F.coalesce(_c(v), F.lit(""))) for v in (status_type, home_status, listing_type)]
    rent = F.lit(False)
    sale = F.lit(False)
    for v in vals:
        for m in RENT_MARKERS:
            rent = rent | v.contains(m)
        for m in SALE_MARKERS:
            sale = sale | v.contains(m)
    all_blank = (vals[0] == "") & (vals[1] == "") & (vals[2] == "")
    return ~rent & (sale | all_blank)


def is_extreme_day(precip, wind, tmax, tmin) -> Column:
    """p15: any threshold crossed; NULL inputs count as not extreme."""
    return (F.coalesce(_c(precip) > EXTREME_PRECIPITATION_MM, F.lit(False))
            | F.coalesce(_c(wind) > EXTREME_WIND_KMH, F.lit(False))
            | F.coalesce(_c(tmax) > EXTREME_TEMP_MAX_C, F.lit(False))
            | F.coalesce(_c(tmin) < EXTREME_TEMP_MIN_C, F.lit(False)))


def month_number(x) -> Column:
    """f13: Spanish month name, or a number 1..12 -> int; else NULL."""
    s = accent_strip(x)
    by_name = F.element_at(_lit_map(SPANISH_MONTHS), s)
    num = s.try_cast("double").try_cast("int")
    return F.coalesce(by_name, F.when(num.between(1, 12), num))


def crime_category_fbi(code) -> Column:
    """f27: FBI offence code -> violent / property / other."""
    c = F.lower(F.coalesce(_c(code), F.lit("")))
    return F.when(c.isin(FBI_VIOLENT), "violent").when(c.isin(FBI_PROPERTY), "property").otherwise("other")


def crime_category_incident(kind) -> Column:
    """f27: incident feed label -> violent / property / other."""
    c = F.lower(F.trim(F.coalesce(_c(kind), F.lit(""))))
    return (F.when(c.isin(INCIDENT_VIOLENT), "violent")
             .when(c.isin(INCIDENT_PROPERTY), "property").otherwise("other"))


def _contains_any(c: Column, terms) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | c.contains(t)
    return out


def crime_category_spanish(label) -> Column:
    """f27: Spanish offence text -> violent / property / other (violent terms first)."""
    raw = accent_strip(F.coalesce(_c(label), F.lit("")))
    return (F.when(raw == "", "other")
             .when(_contains_any(raw, SPANISH_VIOLENT_TERMS), "violent")
             .when(raw.contains("hurto") & _contains_any(raw, SPANISH_VIOLENT_HURTO), "violent")
             .when(_contains_any(raw, SPANISH_PROPERTY_TERMS), "property")
             .otherwise("other"))


def school_sector_type(raw) -> Column:
    """f28: sector text -> privado / oficial / NULL."""
    t = token_normalize(raw)
    return (F.when(t.isNull() | (t == ""), F.lit(None).cast("string"))
             .when(t.contains("nooficial") | t.contains("privad") | t.contains("particular"), "privado")
             .when(t.contains("oficial") | t.contains("publico") | t.contains("estatal"), "oficial"))


def title_property_type(title) -> Column:
    """f29: listing title -> apartamento / casa / NULL."""
    t = accent_strip(title)
    return (F.when(t.contains("apartamento") | t.contains("apto"), "apartamento")
             .when(t.contains("casa"), "casa"))


def subject_fold(subject) -> Column:
    """f30: subject synonyms -> math / reading / NULL."""
    s = F.lower(F.trim(_c(subject)))
    return F.when(s.isin(SUBJECT_MATH), "math").when(s.isin(SUBJECT_READING), "reading")


def grade_format(x) -> Column:
    """f09: grade code -> 'KG', 'PK', '01'..'12'; sentinels and negatives -> NULL."""
    v = F.upper(F.trim(_c(x).cast("string")))
    n = v.try_cast("double").try_cast("int")
    return (F.when(v.isNull() | v.isin(GRADE_NULL), F.lit(None).cast("string"))
             .when(v.isin("KG", "K"), "KG")
             .when(v.isin("PK", "PRE"), "PK")
             .when(n.isNull(), v)
             .when(n < 0, F.lit(None).cast("string"))
             .when(n == 0, "KG")
             .otherwise(F.lpad(n.cast("string"), 2, "0")))


def grade_levels(low, high) -> Column:
    """f09: 'lo-hi' when both present, else the one present."""
    lo, hi = grade_format(low), grade_format(high)
    return F.when(lo.isNotNull() & hi.isNotNull(), F.concat_ws("-", lo, hi)).otherwise(F.coalesce(lo, hi))


def flood_zone_risk(code) -> Column:
    """j18: flood-zone code -> 0-1 score; exact match, then ordered prefix match, default 0.5."""
    z = F.upper(F.trim(_c(code)))
    out = F.when(z.isNull() | (z == ""), F.lit(FLOOD_ZONE_DEFAULT))
    for k, v in FLOOD_ZONE_RISK:
        out = out.when(z == k, F.lit(v))
    for k, v in FLOOD_ZONE_RISK:
        out = out.when(z.startswith(k), F.lit(v))
    return out.otherwise(F.lit(FLOOD_ZONE_DEFAULT))


def risk_class_score(text) -> Column:
    """j18: risk class text -> 0-1 score (whitespace-collapsed retry)."""
    t = accent_strip(text)
    m = _lit_map(RISK_CLASS_SCORE)
    return F.coalesce(F.element_at(m, t), F.element_at(m, F.regexp_replace(t, r"\s+", " ")))


def incident_hazard_type(kind) -> Column:
    """j18: declared incident type -> hazard vocabulary."""
    return F.element_at(_lit_map(INCIDENT_TYPE_HAZARD), F.trim(_c(kind)))
