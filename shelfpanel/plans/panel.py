"""Keeping one row per country, listing and date."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpanel.functions.dates import iso_date, panel_date, panel_text
from shelfpanel.operators.dedup import keep_last
from shelfpanel.schemas import KEY_COLUMNS
from shelfpanel.sources.sinks import write_panel_table
from shelfpanel.sources.tables import read_panel


def _typed(rows: DataFrame) -> DataFrame:
    if dict(rows.dtypes)["Date"] == "string":
        return rows.withColumn("Date", panel_date(F.col("Date")))
    return rows


def upsert_panel(existing: DataFrame, new: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Existing and new rows, one per (Country, ASIN, Date); a new row beats an old one.

    Columns are matched by name; ``order`` names columns that decide between rows of the same
    age. Rows without a usable date share one key per listing.
    """
    aged = [
        _typed(rows).withColumn("_age", F.lit(age)) for age, rows in enumerate((existing, new))
    ]
    both = aged[0].unionByName(aged[1], allowMissingColumns=True)
    return keep_last(both, KEY_COLUMNS, ["_age", *(order or [])]).drop("_age")


def deduplicate_panel(panel: DataFrame, order: list[str] | None = None) -> DataFrame:
    return keep_last(_typed(panel), KEY_COLUMNS, order or [])


def panel_as_text(panel: DataFrame) -> DataFrame:
    """Panel with its dates in text form, as the CSV export has them."""
    return panel.withColumn("Date", panel_text(F.col("Date")))


def stored_rows_like(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of the stored panel in the country and date folders that ``new`` has rows for.

    An equality join with a broadcast list of folders lets Spark skip all other folders when it
    reads. Rows without a country or date cannot match by equality; their few folders are picked
    by a fixed filter and compared null-safe.
    """
    touched = new.select("Country", "Date").distinct()
    folders = F.broadcast(touched)  # one row per folder
    # Spark prunes folders only for a list that it expects to be selective, hence the comparison.
    dated = folders.where(F.col("Date") >= F.lit("0001-01-01").cast("date"))
    usual = stored.join(dated, ["Country", "Date"], "left_semi")
    odd = stored.where(F.col("Country").isNull() | F.col("Date").isNull())
    bare = folders.where(F.col("Country").isNull() | F.col("Date").isNull())
    same = odd["Country"].eqNullSafe(bare["Country"]) & odd["Date"].eqNullSafe(bare["Date"])
    return usual.unionByName(odd.join(bare, same, "left_semi"))


def upsert_panel_table(spark: SparkSession, path: str, new: DataFrame) -> None:
    """Upsert into the stored panel, touching only the countries and dates of ``new``.

    Only the touched folders are read and replaced, so a day's batch costs what that day costs
    and not what the panel costs.
    """
    typed = _typed(new)
    affected = stored_rows_like(_stored_panel(spark, path), typed)
    write_panel_table(upsert_panel(affected, typed), path)


def _stored_panel(spark: SparkSession, path: str) -> DataFrame:
    """Stored panel with a date column, also where folder names are read as text."""
    stored = read_panel(spark, path)
    if dict(stored.dtypes)["Date"] == "string":
        return stored.withColumn("Date", iso_date(F.col("Date")))
    return stored
