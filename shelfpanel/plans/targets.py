"""What to collect next."""

from pyspark.sql import DataFrame

from shelfpanel.operators.positions import session_positions, work_batches
from shelfpanel.operators.targets import union_targets, with_product_urls
from shelfpanel.sources.tables import competitor_asins, own_asins


def collection_targets(
    listings: DataFrame,
    competitors: DataFrame,
    marketplaces: DataFrame,
    batches: int = 1,
    per_session: int = 50,
    country: str | None = None,
) -> DataFrame:
    """Own and competing keys of known countries with address, batch and session."""
    keys = union_targets(own_asins(listings, country), competitor_asins(competitors, country))
    targets = with_product_urls(keys, marketplaces)
    return session_positions(work_batches(targets, batches), per_session)
