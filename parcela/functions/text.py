"""Text expressions (Column -> Column); all JVM-side, no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the source behaviour -------------------------
ACCENTED = "áéíóúñü"           # lower-case accented letters folded by f03
PLAIN = "aeiounu"              # their plain replacements, same order
NULLISH = ["null", "none", "n/a", "na", "unknown", "not specified", ""]
# ----------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def concat_key(*parts, sep: str = "_") -> Column:
    """f01: composite id; NULL parts are skipped by concat_ws."""
    return F.concat_ws(sep, *[_c(p) for p in parts])


def key_with_defaults(*pairs, sep: str = "_") -> Column:
    """f01: composite id with per-part defaults for NULL, e.g. ('zip','UNK')."""
    cols = [F.coalesce(_c(c), F.lit(d)) if d is not None else _c(c) for c, d in pairs]
    return F.concat_ws(sep, *cols)


def id_token(x) -> Column:
    """f01: spaces -> '_', quotes removed (source_type_geo ids)."""
    return F.regexp_replace(F.regexp_replace(_c(x), "['\"]", ""), r"\s+", "_")


def slug(x) -> Column:
    """f02: lower, drop commas, split on blanks, join with '-'."""
    s = F.trim(F.regexp_replace(F.lower(_c(x)), ",", ""))
    return F.array_join(F.filter(F.split(s, r"\s+"), lambda w: w != ""), "-")


def accent_strip(x) -> Column:
    """f03: lower, trim, fold the accented letters."""
    return F.translate(F.lower(F.trim(_c(x))), ACCENTED, PLAIN)


def token_normalize(x) -> Column:
    """f04: f03 then drop every character outside [a-z0-9]."""
    return F.regexp_replace(accent_strip(x), "[^a-z0-9]", "")


def first_comma_segment(x) -> Column:
    """f31: text before the first comma, trimmed; blank -> NULL."""
    return F.nullif(F.trim(F.split_part(_c(x), F.lit(","), F.lit(1))), F.lit(""))


def filename_slug(x) -> Column:
    """f32: strip a leading source prefix, digits and separators from a file stem."""
    s = F.lower(F.regexp_replace(_c(x), r"\.[A-Za-z0-9]+$", ""))
    s = F.regexp_replace(s, r"^[a-z]+[_\-]", "")
    s = F.regexp_replace(s, r"[0-9]+", "")
    s = F.regexp_replace(s, r"[_\-\s]+", "_")
    return F.regexp_replace(s, r"^_+|_+$", "")


def nullish(x) -> Column:
    """f36: listed placeholder strings -> NULL, else trimmed."""
    t = F.trim(_c(x))
    return F.when(F.lower(t).isin(NULLISH), F.lit(None).cast("string")).otherwise(t)


def safe_str(x) -> Column:
    """f05: trim, blank -> NULL."""
    return F.nullif(F.trim(_c(x).cast("string")), F.lit(""))


def city_canonical(x, aliases: dict[str, str] | None = None) -> Column:
    """f37: accent strip, title case, optional alias -> canonical map."""
    base = F.initcap(accent_strip(x))
    if not aliases:
        return base
    m = F.create_map(*[F.lit(v) for kv in sorted(aliases.items()) for v in kv])
    return F.coalesce(F.element_at(m, F.lower(base)), base)


def json_object_text(x) -> Column:
    """f35: strip Markdown code fences, else keep first '{' .. last '}'."""
    c = F.regexp_replace(_c(x), r"```(?:json)?", "")
    return F.nullif(F.regexp_extract(c, r"(?s)(\{.*\})", 1), F.lit(""))
