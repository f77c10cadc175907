"""Change events of own listings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpanel.functions.dates import event_text
from shelfpanel.operators import changes as ops
from shelfpanel.operators.dedup import keep_last
from shelfpanel.schemas import EVENT_COLUMNS, KEY_COLUMNS, MONITORED_FIELDS
from shelfpanel.sources.tables import own_asins, own_skus

LISTING = ["Country", "ASIN"]


class _OwnRows:
    """Panel rows of own active listings.

    The semi join comes first and without a hint: Spark broadcasts a short list from its real
    size and otherwise splits the keys that are hot.
    """

    def __init__(self, panel: DataFrame, listings: DataFrame):
        dated = panel.where(F.col("Date").isNotNull())
        self.rows = dated.join(own_asins(listings), LISTING, "left_semi")

    def days(self) -> DataFrame:
        """Distinct dates of own rows per country."""
        return self.rows.select("Country", "Date").distinct()

    def states(
        self, fields: list[str] | None, order: list[str], unique: bool, dates: DataFrame | None = None
    ) -> DataFrame:
        """One row of comparable values per key and date, optionally of given dates only."""
        rows = self.rows
        if dates is not None:
            rows = rows.join(F.broadcast(dates), ["Country", "Date"], "left_semi")
        # Values are brought to their short form first, so the shuffles after this carry little.
        states = ops.monitored_states(rows, fields, order)
        return states if unique else keep_last(states, KEY_COLUMNS, order)


def _calendar(own: _OwnRows) -> DataFrame:
    """Collection dates with a broadcast hint: one row per country and day, whatever the panel holds."""
    return F.broadcast(ops.collection_calendar(own.days()))


def _limited(panel: DataFrame, start: str | None, countries: list[str] | None) -> DataFrame:
    rows = panel.where(F.col("Country").isin(countries)) if countries else panel
    return rows if start is None else rows.where(F.col("Date") >= F.lit(start).cast("date"))


def _named(changed: DataFrame, listings: DataFrame) -> DataFrame:
    events = ops.with_sku(changed, own_skus(listings))
    return events.withColumn("Date", event_text(F.col("Date"))).select(*EVENT_COLUMNS)


def covered_days(
    panel: DataFrame, listings: DataFrame, start: str | None = None, countries: list[str] | None = None,
    fields: list[str] | None = None, latest: bool = False,
) -> DataFrame:
    """What a change job with these arguments looks at (Date, Country, Field): for ``append_events``, so that a day without
    events any more is emptied. One row per country, day and field."""
    calendar = ops.collection_calendar(_OwnRows(_limited(panel, start, countries), listings).days())
    days = calendar.where(F.col("previous_date").isNotNull() & ((F.col("from_last") == 1) if latest else F.lit(True)))
    each = F.explode(F.array(*[F.lit(f) for f in fields or MONITORED_FIELDS]))
    return days.select(event_text(F.col("Date")).alias("Date"), "Country", each.alias("Field"))


def backfill_changes(
    panel: DataFrame,
    listings: DataFrame,
    start: str | None = None,
    countries: list[str] | None = None,
    fields: list[str] | None = None,
    order: list[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """All change events from ``start`` on.

    ``panel`` has a date column ``Date``; ``order`` names columns that decide between rows of one
    key. Pass ``unique=True`` for a stored panel, which already has one row per key: that saves a
    shuffle.
    """
    own = _OwnRows(_limited(panel, start, countries), listings)
    calendar = _calendar(own)
    states = own.states(fields, order or [], unique)
    return _named(ops.consecutive_only(ops.field_changes(states, fields), calendar), listings)


def latest_changes(
    panel: DataFrame,
    listings: DataFrame,
    start: str | None = None,
    countries: list[str] | None = None,
    fields: list[str] | None = None,
    order: list[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Change events between the last two collection dates of each country.

    Two rows of the calendar per country say which dates those are; broadcast to the panel they
    also keep Spark from reading other dates of a panel stored by country and date. ``start``
    limits how far back the dates are looked for.
    """
    own = _OwnRows(_limited(panel, start, countries), listings)
    calendar = _calendar(own)
    last_two = calendar.where("from_last <= 2").select("Country", "Date")
    states = own.states(fields, order or [], unique, last_two)
    newest = calendar.where("from_last = 1")
    return _named(ops.consecutive_only(ops.field_changes(states, fields), newest), listings)
