"""Keyword-rank panel."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpanel.operators.dedup import keep_last
from shelfpanel.operators.ranks import last_ranks, pivot_ranks
from shelfpanel.schemas import KEYWORD_KEY, field

RANKS = ["Organic Rank", "Sponsored Rank"]


def merge_keyword_panel(existing: DataFrame | None, pivoted: DataFrame) -> DataFrame:
    """One row per (Date, Country, Keyword, ASIN): new rows beat old, then the last in column order.

    The other columns are compared one after the other, a missing value after all others; ranks
    decide only between rows that are otherwise equal.
    """
    new = pivoted.withColumn("_age", F.lit(1))
    rows = new if existing is None else existing.withColumn("_age", F.lit(0)).unionByName(
        new, allowMissingColumns=True
    )
    others = [c for c in pivoted.columns if c not in (*KEYWORD_KEY, *RANKS)]
    in_order = [part for c in others for part in (field(c).isNull(), field(c))]
    return keep_last(rows, KEYWORD_KEY, ["_age", *in_order, *RANKS]).drop("_age")


def keyword_panel(tiles: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Tiles of search pages to the rank panel, merged with what is stored."""
    return merge_keyword_panel(existing, pivot_ranks(last_ranks(tiles)))
