"""Change detection between consecutive collection dates of a country."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfpanel.functions.states import badge_value, change_type, stock_class
from shelfpanel.schemas import MONITORED_FIELDS, ensure_columns, field


def collection_calendar(panel: DataFrame) -> DataFrame:
    """Dates on which a country was collected, with their number and the date before.

    ``distinct`` comes first, so the window sees one row per country and day.
    """
    dates = panel.where(F.col("Date").isNotNull()).select("Country", "Date").distinct()
    by_date = Window.partitionBy("Country").orderBy("Date")
    by_last = Window.partitionBy("Country").orderBy(F.desc("Date"))
    return dates.select(
        "Country",
        "Date",
        F.dense_rank().over(by_date).alias("date_no"),
        F.lag("Date").over(by_date).alias("previous_date"),
        F.dense_rank().over(by_last).alias("from_last"),
    )


def monitored_states(
    panel: DataFrame, fields: list[str] | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Keys and monitored fields, each field brought to its comparable value."""
    fields = fields or MONITORED_FIELDS
    full = ensure_columns(panel, fields)
    return full.select(
        "Country",
        "ASIN",
        "Date",
        *[field(k) for k in keep or []],
        *[(stock_class if f == "Stock" else badge_value)(field(f)).alias(f) for f in fields],
    )


def field_changes(states: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """One row per field that differs from the key's own previous row.

    ``states`` holds one row per (Country, ASIN, Date), so a group of the window has at most one
    row per day. ``previous_seen`` is the date compared with.
    """
    fields = fields or MONITORED_FIELDS
    by_key = Window.partitionBy("Country", "ASIN").orderBy("Date")
    pairs = states.where(F.col("Date").isNotNull()).select(
        "Country",
        "ASIN",
        "Date",
        F.lag("Date").over(by_key).alias("previous_seen"),
        *[field(f) for f in fields],
        *[F.lag(field(f)).over(by_key).alias(f"before {f}") for f in fields],
    )
    per_field = F.array(
        *[
            F.struct(
                F.lit(f).alias("Field"),
                field(f"before {f}").alias("Value_before"),
                field(f).alias("Value_after"),
            )
            for f in fields
        ]
    )
    rows = pairs.where(F.col("previous_seen").isNotNull()).select(
        "Country", "ASIN", "Date", "previous_seen", F.inline(per_field)
    )
    before, after = F.col("Value_before"), F.col("Value_after")
    return rows.where(before != after).withColumn("Change_type", change_type(before, after))


def consecutive_only(changes: DataFrame, calendar: DataFrame) -> DataFrame:
    """Changes whose two dates follow each other in the country's calendar.

    A key that skipped a collection date has no event there. The join runs on the changes, which
    are few, instead of on the panel; ``calendar`` should come with a broadcast hint, since many
    changes share a country and date.
    """
    steps = calendar.select("Country", "Date", F.col("previous_date").alias("previous_seen"))
    return changes.join(steps, ["Country", "Date", "previous_seen"], "left_semi")


def key_pairs(panel: DataFrame) -> DataFrame:
    """Keys present on a collection date and on the one before it (both dates given).

    The calendar has one row per country and day and is broadcast, so that a country's day with
    very many keys is not gathered by the join.
    """
    days = panel.where(F.col("Date").isNotNull()).select("Country", "ASIN", "Date").distinct()
    by_key = Window.partitionBy("Country", "ASIN").orderBy("Date")
    steps = F.broadcast(collection_calendar(panel).select("Country", "Date", "previous_date"))
    seen = days.withColumn("previous_date", F.lag("Date").over(by_key)).where(
        F.col("previous_date").isNotNull()
    )
    return seen.join(steps, ["Country", "Date", "previous_date"], "left_semi")


def with_sku(events: DataFrame, skus: DataFrame) -> DataFrame:
    """Attach the SKU of the key, blank where it has none."""
    joined = events.join(skus.select("Country", "ASIN", "SKU"), ["Country", "ASIN"], "left")
    return joined.withColumn("SKU", F.coalesce("SKU", F.lit("")))


def change_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("Country", "Field", "Change_type").agg(F.count("*").alias("events"))
