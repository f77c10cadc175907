"""Key checks and corrections, and filters against key lists."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelfpanel.functions.addresses import is_valid_asin
from shelfpanel.functions.text import is_missing, strip
from shelfpanel.sources.marketplaces import dimension

FLAGS = ["page_invalid", "redirected"]


def correct_redirects(df: DataFrame, page_column: str = "ASIN Product Page") -> DataFrame:
    """Take the key of the page reached where it is valid and differs from the one asked for.

    Adds ``Requested ASIN``, ``page_invalid`` and ``redirected``; the page column goes away.
    """
    page = strip(F.col(f"`{page_column}`"))
    valid = is_valid_asin(page)
    moved = valid & ~page.eqNullSafe(F.col("ASIN"))
    others = [F.col(f"`{c}`") for c in df.columns if c not in ("ASIN", page_column)]
    return df.select(
        F.when(moved, page).otherwise(F.col("ASIN")).alias("ASIN"),
        *others,
        F.col("ASIN").alias("Requested ASIN"),
        (~valid).alias("page_invalid"),
        moved.alias("redirected"),
    )


def redirect_stats(corrected: DataFrame, by: list[str]) -> DataFrame:
    """Rows, redirects and pages without a valid key, per ``by``."""
    return corrected.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.count_if("redirected").alias("redirected"),
        F.count_if("page_invalid").alias("page_invalid"),
    )


def observed_stats(corrected: DataFrame, name: str = "processing") -> tuple[DataFrame, Observation]:
    """The same rows, and their counts as a by-product of whatever action reads them first: no scan of their own."""
    counts = Observation(name)
    return corrected.observe(
        counts,
        F.count(F.lit(1)).alias("rows"),
        F.count_if("redirected").alias("redirected"),
        F.count_if("page_invalid").alias("page_invalid"),
        F.count_if(is_missing(F.col("Price")) & is_missing(F.col("PED"))).alias("price_errors"),
    ), counts


def redirected_keys(corrected: DataFrame) -> DataFrame:
    return corrected.where("redirected").select("Country", "`Requested ASIN`", "ASIN")


def invalid_page_keys(corrected: DataFrame) -> DataFrame:
    return corrected.where("page_invalid").select("Country", "`Requested ASIN`")


def known_countries(df: DataFrame, marketplaces: DataFrame) -> DataFrame:
    return df.join(dimension(marketplaces), "Country", "left_semi")


def unknown_countries(df: DataFrame, marketplaces: DataFrame) -> DataFrame:
    """Rows whose country is not a marketplace (also those without a country)."""
    return df.join(dimension(marketplaces), "Country", "left_anti")


ACCEPTED = "accepted"


def tagged_rows(df: DataFrame, marketplaces: DataFrame) -> DataFrame:
    """All rows with ``Verdict``: accepted, or why the jobs leave them out. One pass, no shuffle."""
    places = dimension(marketplaces).withColumn("_known", F.lit(True))
    country = strip(F.col("Country"))
    verdict = (
        F.when(F.coalesce(country == "", F.lit(True)), "no country")
        .when(F.col("_known").isNull(), "unknown country")
        .when(is_missing(F.col("ASIN")), "no key")
        .otherwise(ACCEPTED)
    )
    return df.join(places, "Country", "left").select(*[df[c] for c in df.columns], verdict.alias("Verdict"))


def write_tagged(tagged: DataFrame, path: str) -> None:
    """Accepted and rejected rows in one write, a folder for each verdict."""
    tagged.write.mode("overwrite").partitionBy("Verdict").parquet(path)


def lost_keys(targets: DataFrame, observed: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Targets (Country, ASIN) that no observation answers, each once with the ``Reason``.

    ``observed``: corrected observations (see ``correct_redirects``). A target is answered by a row that was asked for with its key and
    reached a page with a valid key, or that was redirected to its key. ``ledger``: Country, ASIN, reason of failed attempts. Reasons in
    order: the ledger's; ``invalid page``; ``not collected``. Each side is one row per key before it is joined.
    """
    key = ["Country", "ASIN"]
    asked = observed.select("Country", F.col("Requested ASIN").alias("ASIN"), (~F.col("page_invalid")).alias("reached"))
    moved = observed.where("redirected").select("Country", "ASIN", F.lit(True).alias("reached"))
    seen = asked.unionByName(moved).groupBy(*key).agg(F.bool_or("reached").alias("reached"))
    reasons = F.lit(None).cast("string")
    lost = targets.select(*key).distinct().join(seen, key, "left").where(~F.coalesce("reached", F.lit(False)))
    if ledger is not None:
        lost = lost.join(ledger.groupBy(*key).agg(F.min("reason").alias("_reason")), key, "left")
        reasons = F.col("_reason")
    reason = F.coalesce(reasons, F.when(F.col("reached").isNotNull(), "invalid page"), F.lit("not collected"))
    return lost.select(*key, reason.alias("Reason"))


def only_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in ``keys``.

    No broadcast hint: the planner broadcasts a key list it knows to be small and otherwise
    shuffles, where AQE may split a hot key on the side of ``df``.
    """
    return df.join(keys.select(*on), on, "left_semi")


def without_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys.select(*on), on, "left_anti")


def price_errors(df: DataFrame) -> DataFrame:
    """Rows where both the price and the member price are missing."""
    return df.where(is_missing(F.col("Price")) & is_missing(F.col("PED")))
