"""Listing keys and the addresses they appear in."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfpanel.functions.text import BLANK_CHARS, CATEGORY_SEPARATOR, or_not_found


def is_valid_asin(c: Column) -> Column:
    """Exactly ten capitals or digits, blanks around them ignored."""
    return F.coalesce(c.rlike(f"^[{BLANK_CHARS}]*[A-Z0-9]{{10}}[{BLANK_CHARS}]*$"), F.lit(False))


def asin_from_url(url: Column, page_value: Column | None = None) -> Column:
    """Key in the ``/dp/`` part of an address, else the value read from the page."""
    key = F.nullif(F.regexp_extract(url, "/dp/([A-Z0-9]{10})", 1), F.lit(""))
    return or_not_found(key if page_value is None else F.coalesce(key, page_value))


def product_url(base_url: Column, asin: Column, suffix: str = "") -> Column:
    return F.concat(base_url, asin, F.lit(suffix)) if suffix else F.concat(base_url, asin)


def form_encode(c: Column) -> Column:
    """Query-string encoding that keeps ``~`` and encodes ``*``."""
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def search_url(domain: Column, keyword: Column) -> Column:
    return F.concat(F.lit("https://"), domain, F.lit("/s?k="), form_encode(keyword))


def node_ids(hrefs: Column, separator: str = CATEGORY_SEPARATOR) -> Column:
    """First ``node=`` number of each link, joined; not found when there is none."""
    ids = F.transform(hrefs, lambda h: F.regexp_extract(h, r"node=(\d+)", 1))
    joined = F.array_join(F.filter(ids, lambda x: x != ""), separator)
    return or_not_found(F.nullif(joined, F.lit("")))


def script_object(html: Column) -> Column:
    """The ``immutableParams`` object inside a page script, as a JSON document of its own."""
    block = F.regexp_extract(html, r'(?s)("immutableParams"\s*:\s*\{.*?\})', 1)
    return F.concat(F.lit("{"), block, F.lit("}"))


def object_value(document: Column, key: str) -> Column:
    return or_not_found(F.get_json_object(document, f"$.immutableParams.{key}"))


def script_value(html: Column, key: str) -> Column:
    """A value of the ``immutableParams`` object inside a page script."""
    return object_value(script_object(html), key)


def run_key(*parts: Column) -> Column:
    """Eight-character id that is the same every time for the same run."""
    return F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 8)
