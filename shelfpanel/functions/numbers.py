"""Numbers inside text, money and durations."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfpanel.functions.text import or_not_found

NUMBER = r"\p{Nd}+\.?\p{Nd}*"
DIGITS = r"\p{Nd}+"
FLOAT_TEXT = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"
# Wording of member prices.
PRIME_JOIN = "Join Prime to buy this item at"
PRIME_PHRASES = ["This price is exclusively for Amazon Prime members.", "Exclusive Prime price"]


def first_number(c: Column) -> Column:
    """First number in the text, thousands commas dropped."""
    return or_not_found(F.regexp_substr(F.replace(c, F.lit(","), F.lit("")), F.lit(NUMBER)))


def count_digits(c: Column) -> Column:
    """Count text to digits: both thousands marks are dropped."""
    return or_not_found(F.regexp_substr(F.translate(c, ",.", ""), F.lit(DIGITS)))


def rating_number(c: Column) -> Column:
    """First number of a rating text that may use a decimal comma."""
    return or_not_found(F.regexp_substr(F.translate(c, ",", "."), F.lit(NUMBER)))


def price_text(whole: Column, fraction: Column) -> Column:
    """Price from its two page elements; not found unless both exist."""
    return or_not_found(
        F.replace(F.concat(whole, F.lit("."), fraction), F.lit(","), F.lit(""))
    )


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain number becomes null.

    The pattern keeps out what a cast would also take: 'nan', 'inf', '12d' and hexadecimal forms.
    """
    return F.when(c.rlike(FLOAT_TEXT), c.try_cast("double"))


def reconcile_prime(
    price: Column, ped: Column, list_price: Column, list_from_price: bool = False
) -> dict[str, Column]:
    """Price, PED and List Price after the member-price wording is resolved.

    A PED text asking to join moves the price to the list price and the offer to the price.
    ``list_from_price`` starts from the price instead of the collected list price.
    """
    offer = F.coalesce(ped.contains(PRIME_JOIN), F.lit(False))
    lead = PRIME_JOIN + r" [^\p{Nd}]*"
    start = price if list_from_price else list_price
    new_price = F.regexp_replace(F.when(offer, ped).otherwise(price), lead, "")
    plain_ped = F.regexp_replace(ped, lead, "")
    return {
        "Price": new_price,
        "PED": F.when(plain_ped.isin(*PRIME_PHRASES), new_price).otherwise(plain_ped),
        "List Price": F.when(offer, price).otherwise(start),
    }


def duration_text(seconds: Column) -> Column:
    """Whole seconds as ``1h 15m 30s``; parts that are zero are left out."""
    total = seconds.cast("long")
    h, m, s = F.floor(total / 3600), F.floor((total % 3600) / 60), total % 60
    return F.concat_ws(
        " ",
        F.when(h > 0, F.concat(h.cast("string"), F.lit("h"))),
        F.when(m > 0, F.concat(m.cast("string"), F.lit("m"))),
        F.when((s > 0) | ((h <= 0) & (m <= 0)), F.concat(s.cast("string"), F.lit("s"))),
    )


def percent(part: Column, whole: Column) -> Column:
    """part / whole in percent, 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), F.when(whole > 0, whole)), F.lit(0.0))


