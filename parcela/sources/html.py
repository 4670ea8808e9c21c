"""Listing-card extraction from raw HTML with native regex functions (s15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels, numbers, text

# Fixed patterns -------------------------------------------------------------------
CARD_RE = r"(?s)(<article\b.*?</article>)"
HEADING_RE = r"(?s)<h[1-3][^>]*>(.*?)</h[1-3]>"
LISTING_HREF_RE = r'<a\b[^>]*href="([^"]*(?:/inmueble/|/casa-en-venta/|/apartamento-en-venta/)[^"]*)"'
HREF_RE = r'<a\b[^>]*href="([^"]+)"'
LINK_TEXT_RE = r"(?s)<a\b[^>]*>(.*?)</a>"
DATA_ID_RE = r'^<article\b[^>]*\bdata-id="([^"]+)"'
LISTING_ID_RE = r'^<article\b[^>]*\bdata-listing-id="([^"]+)"'
SLUG_RE = r"/([\w-]+)/?(?:\?|$)"
PRICE_RE = r"\$|COP|\d[.,]?\d{3}"
BEDS_RE = r"(?i)(\d+)\s*(?:hab|habitaci|alcoba)"
BATHS_RE = r"(?i)(\d+(?:[.,]\d+)?)\s*ba[nñ]"
AREA_RE = r"(?i)(\d+(?:[.,]\d+)?)\s*m\s*(?:²|2)"
LOCATION_RE = r'(?i)data-testid="[^"]*(?:location|address)[^"]*"[^>]*>([^<]*)<'
MIN_PRICE = 10_000_000
# -----------------------------------------------------------------------------------


def _found(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def _plain(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(c, "<[^>]*>", "")), F.lit(""))


def extract_cards(df: DataFrame, html_col: str = "html", keep=(), base_url: str = "", raw: str | None = None) -> DataFrame:
    """One row per ``<article>`` card of every page, with the card's own link, id, title, price and facts.

    The id is the card's data-id, else its data-listing-id, else the last segment of its link; a card without a link or
    an id is dropped. The price is the first text of the card whose digits make at least MIN_PRICE. ``raw`` names a
    column for the card's own HTML."""
    # link and id are found inside the list, so a card without them is dropped before its facts are looked for
    found = F.transform(F.regexp_extract_all(F.col(html_col), F.lit(CARD_RE), 1), lambda c: F.struct(
        c.alias("c"), F.regexp_extract(c, LISTING_HREF_RE, 1).alias("href"), F.regexp_extract(c, DATA_ID_RE, 1).alias("id")))
    found = F.transform(found, lambda x: F.struct(
        x["c"].alias("c"), F.when(x["href"] != "", x["href"]).otherwise(_found(x["c"], HREF_RE)).alias("href"),
        F.when(x["id"] != "", x["id"]).otherwise(_found(x["c"], LISTING_ID_RE)).alias("id")))
    found = F.transform(found, lambda x: F.struct(
        x["c"].alias("c"), F.when(x["href"].startswith("http"), x["href"]).otherwise(F.concat(F.lit(base_url), x["href"])).alias("url"), x["id"].alias("id")))
    found = F.transform(found, lambda x: F.struct(x["c"].alias("c"), x["url"].alias("url"), F.coalesce(x["id"], _found(x["url"], SLUG_RE)).alias("id")))
    found = F.filter(found, lambda x: x["url"].isNotNull() & x["id"].isNotNull())
    cards = df.select(*keep, F.explode(found).alias("_x")).select(*keep, F.col("_x.c").alias("_c"), F.col("_x.url").alias("_url"), F.col("_x.id").alias("_id"))
    c = F.col("_c")
    texts = F.filter(F.transform(F.split(c, "<[^>]*>"), lambda s: F.trim(s)), lambda s: s != "")
    full = F.array_join("_texts", " ")
    digits = F.transform(F.filter("_texts", lambda s: s.rlike(PRICE_RE)), lambda s: F.regexp_replace(s, "[^0-9]", "").try_cast("bigint"))
    title = F.coalesce(_plain(_found(c, HEADING_RE)), _plain(_found(c, LINK_TEXT_RE)))
    # in steps: what several columns need is found once, and no generated method grows too long for the JVM to compile
    cards = cards.select(*keep, "_c", "_id", "_url", texts.alias("_texts"))
    cards = cards.select(*keep, "_c", "_id", "_url", "_texts", full.alias("_full"), title.alias("_title"))
    cards = cards.select(*keep, "_c", "_id", "_url", "_texts", "_title", _found(F.col("_full"), BEDS_RE).alias("_beds"), _found(F.col("_full"), BATHS_RE).alias("_baths"),
                         _found(F.col("_full"), AREA_RE).alias("_area"), F.nullif(F.trim(_found(c, LOCATION_RE)), F.lit("")).alias("_address"))
    return cards.select(
        *keep,
        F.col("_id").alias("listing_id"),
        F.col("_url").alias("listing_url"),
        F.col("_title").alias("title"),
        F.try_element_at(F.filter(digits, lambda n: n >= MIN_PRICE), F.lit(1)).alias("price_cop"),
        F.col("_beds").try_cast("int").alias("bedrooms"),
        numbers.locale_number("_baths").alias("bathrooms"),
        numbers.locale_number("_area").alias("area_m2"),
        text.first_comma_segment("_address").alias("barrio"),
        F.col("_address").alias("address"),
        labels.title_property_type(F.col("_title")).alias("property_type"),
        *([c.alias(raw)] if raw else []),
    )
