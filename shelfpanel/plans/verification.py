"""Checks of observed page facts, and of a repeatable sample of them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpanel.operators.dedup import keep_last
from shelfpanel.operators.positions import session_positions
from shelfpanel.operators.verification import (
    audit_sample,
    check_rates,
    currency_is_valid,
    currency_verdict,
    region_is_valid,
)
from shelfpanel.sources.marketplaces import dimension


def verify_pages(observed: DataFrame, marketplaces: DataFrame) -> DataFrame:
    """Currency and delivery-region verdict per observed page.

    ``observed``: Country, ASIN, symbol, has_price, location.
    """
    places = dimension(marketplaces, "zip_code")
    verdict = currency_verdict(F.col("Country"), F.col("symbol"), F.col("has_price"))
    checked = observed.join(places, "Country", "left").withColumn("currency", verdict)
    return checked.select(
        *observed.columns,
        "currency",
        currency_is_valid(F.col("currency")).alias("currency_valid"),
        region_is_valid(F.col("location"), F.col("zip_code")).alias("region_valid"),
    )


def sampled_check_rates(verified: DataFrame, per_session: int = 50) -> DataFrame:
    """Share of passed checks per country among the listings drawn for another check.

    A listing is collected once per run; copies of it count as one.
    """
    once = keep_last(verified, ["Country", "ASIN"], [])
    drawn = audit_sample(session_positions(once, per_session), per_session)
    failed = ~(F.col("currency_valid") & F.col("region_valid"))
    return check_rates(drawn, ["Country"], failed)
