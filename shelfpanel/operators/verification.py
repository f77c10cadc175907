"""Checks of what a page showed against what its country should show, and the audit sample."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpanel.functions.numbers import percent
from shelfpanel.functions.text import location_text, lookup, strip
from shelfpanel.sources.marketplaces import (
    CHECK_PROBABILITY,
    CURRENCY_ALIASES,
    CURRENCY_SYMBOLS,
    DEFAULT_CHECK_PROBABILITY,
)

LAST_IN_SESSION = 10
HASH_RANGE = 10_000


def normal_currency(text: Column) -> Column:
    """Symbol for a currency text, the text itself if it has no alias, null if blank."""
    seen = F.nullif(strip(text), F.lit(""))
    return F.coalesce(lookup(CURRENCY_ALIASES, F.upper(seen)), seen)


def currency_verdict(country: Column, symbol_text: Column, has_price: Column) -> Column:
    """ok, wrong, missing_priced (an error), missing_unpriced or unmapped."""
    expected = lookup(CURRENCY_SYMBOLS, F.upper(country))
    found = normal_currency(symbol_text)
    return (
        F.when(expected.isNull(), "unmapped")
        .when(found == expected, "ok")
        .when(found.isNotNull(), "wrong")
        .when(has_price, "missing_priced")
        .otherwise("missing_unpriced")
    )


def currency_is_valid(verdict: Column) -> Column:
    return verdict.isin("ok", "missing_unpriced", "unmapped")


def region_is_valid(location: Column, expected: Column) -> Column:
    """Whether a delivery-location text fits the expected postcode.

    The last two runs of letters or digits, joined, must begin the postcode; or the text holds
    the postcode; or a five-digit number of the text is part of it.
    """
    text = F.lower(location_text(location))
    code = F.lower(expected)
    runs = F.regexp_extract_all(text, F.lit("[a-z0-9]+"), F.lit(0))
    last_two = F.array_join(F.reverse(F.slice(F.reverse(runs), 1, 2)), "")
    begins = (F.size(runs) > 0) & F.regexp_replace(code, "[^a-z0-9]", "").startswith(last_two)
    five = F.regexp_extract(text, r"\b(\d{5})\b", 1)
    fits = begins | text.contains(code) | ((five != "") & code.contains(five))
    return F.coalesce(~text.contains("brazil") & (text != "") & fits, F.lit(False))


def check_share(country: Column) -> Column:
    return F.coalesce(lookup(CHECK_PROBABILITY, country), F.lit(DEFAULT_CHECK_PROBABILITY))


def audit_sample(
    rows: DataFrame, per_session: int, draw: Column | None = None, key: str = "ASIN", seed: int = 0
) -> DataFrame:
    """Rows to verify again, by country share; needs ``session_pos`` (0-based).

    The first row of a session is never taken and the last ten have twice the share. ``draw`` is
    a number from 0 to 9,999 per row; by default a hash of the key, so the sample is repeatable.
    """
    drawn = draw if draw is not None else F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(HASH_RANGE))
    late = (F.lit(per_session) - F.col("session_pos")) <= LAST_IN_SESSION
    share = check_share(F.col("Country")) * F.when(late, 2).otherwise(1)
    return rows.where((F.col("session_pos") > 0) & (drawn < F.round(share * HASH_RANGE)))


def check_rates(checks: DataFrame, by: list[str], failed: Column) -> DataFrame:
    """Checks done and failed, and the share that passed (null where none was done)."""
    done = F.count("*")
    bad = F.count_if(failed)
    return checks.groupBy(*by).agg(
        done.alias("checks"),
        bad.alias("failed"),
        F.round(percent(done - bad, done), 2).alias("success_rate"),
    )
