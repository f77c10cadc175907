"""Comparison of the latest rows with each key's own history."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpanel.functions.numbers import to_number
from shelfpanel.schemas import field

COMPARED = {"Price": "price", "Number of ratings": "ratings", "PED": "ped"}


def _numbers(panel: DataFrame) -> DataFrame:
    known = F.col("Date").isNotNull() & F.col("Country").isNotNull() & F.col("ASIN").isNotNull()
    return panel.where(known).select(
        "Country", "ASIN", "Date", *[to_number(field(c)).alias(n) for c, n in COMPARED.items()]
    )


def _is_recent(panel: DataFrame, per_country: bool) -> tuple[DataFrame, Column, Column]:
    """``panel`` with what tells recent rows (of the latest date) and earlier ones.

    The latest date is one for the whole table, so countries not collected on it have no recent rows; ``per_country`` takes each
    country's own.
    """
    if not per_country:
        latest = panel.agg(F.max("Date")).scalar()
        return panel, F.col("Date") == latest, F.col("Date") < latest
    newest = panel.groupBy("Country").agg(F.max("Date").alias("_latest"))
    return panel.join(F.broadcast(newest), "Country"), F.col("Date") == F.col("_latest"), F.col("Date") < F.col("_latest")


def history_means(history: DataFrame) -> DataFrame:
    """Mean price, rating count and member price per key."""
    return history.groupBy("Country", "ASIN").agg(
        *[F.avg(n).alias(f"avg_{n}") for n in COMPARED.values()]
    )


def recent_against_history(panel: DataFrame, per_country: bool = False) -> DataFrame:
    """Recent rows with the key's historical means, equal recent rows as one with their number.

    One scan serves both sides: rows are summed up per key and recent values before the shuffle (all history rows of a key are one such
    group), and the sums of a key's history meet its recent values in a window over those few rows.
    """
    names = list(COMPARED.values())
    dated, recent, earlier = _is_recent(_numbers(panel), per_country)
    groups = dated.select(
        "Country", "ASIN", recent.alias("_recent"), *[F.when(recent, F.col(n)).alias(n) for n in names],
        *[F.when(earlier, F.col(n)).alias(f"_past_{n}") for n in names],
    ).groupBy("Country", "ASIN", "_recent", *names).agg(
        F.count("*").alias("rows"),
        *[F.sum(f"_past_{n}").alias(f"_sum_{n}") for n in names], *[F.count(f"_past_{n}").alias(f"_n_{n}") for n in names],
    )
    key = Window.partitionBy("Country", "ASIN")
    means = {f"avg_{n}": F.try_divide(F.sum(f"_sum_{n}").over(key), F.sum(f"_n_{n}").over(key)) for n in names}
    has_past = F.bool_or(~F.col("_recent")).over(key)
    out = groups.withColumns({**means, "_has_past": has_past}).where(F.col("_recent") & F.col("_has_past"))
    return out.select("Country", "ASIN", *names, "rows", *means)


def rating_drop() -> Column:
    return F.coalesce(F.col("ratings") < F.col("avg_ratings"), F.lit(False))


def price_jump() -> Column:
    price, mean = F.col("price"), F.col("avg_price")
    return F.coalesce((price > mean * 1.5) | (price < mean * 0.5), F.lit(False))


def history_flags(panel: DataFrame, per_country: bool = False) -> DataFrame:
    """Rows per flag with the smallest key as the example; flags that no row has are absent."""
    compared = recent_against_history(panel, per_country)
    flags = F.filter(
        F.array(
            F.struct(F.lit("rating_drop").alias("flag"), rating_drop().alias("is_set")),
            F.struct(F.lit("price_jump").alias("flag"), price_jump().alias("is_set")),
        ),
        lambda x: x["is_set"],
    )
    marked = compared.select("Country", "ASIN", "rows", F.explode(flags).alias("f"))
    counted = marked.groupBy(F.col("f.flag").alias("flag")).agg(
        F.sum("rows").alias("rows"), F.min(F.struct("Country", "ASIN")).alias("e")
    )
    return counted.select(
        "flag", "rows", F.col("e.Country").alias("example_country"), F.col("e.ASIN").alias("example_asin")
    )
