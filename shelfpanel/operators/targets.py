"""Lists of what to collect."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpanel.functions.addresses import product_url, search_url
from shelfpanel.sources.marketplaces import dimension

URL_SUFFIX = "?th=1"


def union_targets(own: DataFrame, competitors: DataFrame) -> DataFrame:
    """Own and competing keys, each (Country, ASIN) once."""
    columns = ["Country", "ASIN"]
    return own.select(*columns).union(competitors.select(*columns)).distinct()


def with_product_urls(targets: DataFrame, marketplaces: DataFrame) -> DataFrame:
    places = dimension(marketplaces, "base_url")
    joined = targets.join(places, "Country")
    return joined.select(
        *targets.columns, product_url(F.col("base_url"), F.col("ASIN"), URL_SUFFIX).alias("Url")
    )


def with_search_urls(keywords: DataFrame, marketplaces: DataFrame) -> DataFrame:
    """Search address for every keyword of a region in each of its countries."""
    places = dimension(marketplaces, "region", "domain")
    listed = keywords.select(F.col("Sales Region").alias("region"), F.col("Keywords").alias("Keyword"))
    return listed.join(places, "region").select(
        "Country", "region", "Keyword", search_url(F.col("domain"), F.col("Keyword")).alias("Url")
    )


def first_targets(targets: DataFrame, n: int, extra: list[tuple[str, str]] | None = None) -> DataFrame:
    """Trial list: the first ``n`` keys in key order, and given extra keys after them."""
    head = targets.select("Country", "ASIN").orderBy("Country", "ASIN").limit(n)
    if not extra:
        return head
    return head.union(targets.sparkSession.createDataFrame(extra, "Country string, ASIN string"))
