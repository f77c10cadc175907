"""Exact interquartile outliers per country and column.

The exact percentile aggregate gathers all distinct values of a group in one task. Here values
are first counted, which spreads a large country over all tasks; each value belongs to a bin
that rises with it, the small table of bin sizes shows which bins hold the wanted ranks, and
only those bins are looked into. Bins are cut at approximate quantiles of the group's distinct
values, so that none holds many of them however close together they lie; the ranks are exact.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfpanel.functions.numbers import to_number
from shelfpanel.schemas import field

NUMERIC_COLUMNS = ["Price", "List Price", "Number of ratings", "PED"]
MIN_VALUES = 20
FENCE = 1.5
BINS = 128
STEP = 11
ACCURACY = 4096
BIN = ["Country", "column", "bin"]
GROUP = ["Country", "column"]


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """How often each numeric value occurs per country and column, with its bin."""
    values = F.array(
        *[F.struct(F.lit(c).alias("column"), to_number(field(c)).alias("value")) for c in columns]
    )
    long = df.select("Country", F.inline(values))
    # The joins below would add such conditions to some uses of the counts only, and uses that
    # differ cannot share the one shuffle.
    usable = long.where(F.col("Country").isNotNull() & F.col("value").isNotNull())
    counts = usable.groupBy(*GROUP, "value").agg(F.count("*").alias("n"))
    shares = [i / BINS for i in range(1, BINS)]
    # Asking for the number of each value, which is never 0, keeps it in this use as well, so that it shares that shuffle.
    cuts = counts.where(F.col("n") > 0).groupBy(*GROUP).agg(F.percentile_approx("value", shares, ACCURACY).alias("cuts"))
    # The cuts rise, so every STEP-th of them shows which few of the others to look at.
    marks = F.filter("cuts", lambda cut, i: i % STEP == STEP - 1)
    # One row of cuts per country and column, whatever the panel holds.
    joined = counts.join(F.broadcast(cuts.withColumn("marks", marks)), GROUP)
    passed = joined.withColumn("_passed", F.size(F.filter("marks", lambda cut: cut < F.col("value"))) * STEP)
    near = F.slice("cuts", F.col("_passed") + 1, F.lit(STEP))
    below = F.col("_passed") + F.size(F.filter(near, lambda cut: cut < F.col("value")))
    return passed.select(*GROUP, "value", "n", below.alias("bin"))


def bin_ranges(counts: DataFrame) -> DataFrame:
    """Size, first rank (from 0) and value range of each bin, and the size of its group."""
    sizes = counts.groupBy(*BIN).agg(
        F.sum("n").alias("size"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    group = Window.partitionBy(*GROUP)
    before = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *BIN,
        "size",
        "low",
        "high",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
        F.sum("size").over(group).alias("total"),
    )


def quartiles(counts: DataFrame, bins: DataFrame, min_values: int = MIN_VALUES) -> DataFrame:
    """First and third quartile with linear interpolation, for groups that are large enough."""
    last = F.col("total") - 1
    ranks = {
        f"{side}{q}": rounding(last * F.lit(share))
        for q, share in (("1", 0.25), ("3", 0.75))
        for side, rounding in (("lo", F.floor), ("hi", F.ceil))
    }
    end = F.col("start") + F.col("size")
    wanted = F.lit(False)
    for rank in ranks.values():
        wanted = wanted | ((rank >= F.col("start")) & (rank < end))
    needed = bins.where((F.col("total") >= min_values) & wanted).select(*BIN, "start", "total")
    up_to = Window.partitionBy(*BIN).orderBy("value")
    placed = counts.join(needed, BIN).select(
        *GROUP,
        "value",
        "total",
        (F.col("start") + F.sum("n").over(up_to)).alias("next_rank"),
        "n",
    )
    first = F.col("next_rank") - F.col("n")
    at = {
        name: F.max(F.when((rank >= first) & (rank < F.col("next_rank")), F.col("value"))).alias(name)
        for name, rank in ranks.items()
    }
    picked = placed.groupBy(*GROUP, "total").agg(*at.values())

    def between(q: str, share: float):
        position = last * F.lit(share)
        return F.col(f"lo{q}") + (F.col(f"hi{q}") - F.col(f"lo{q}")) * (position - F.floor(position))

    return picked.select(
        *GROUP, "total", between("1", 0.25).alias("q1"), between("3", 0.75).alias("q3")
    )


def iqr_outliers(
    df: DataFrame,
    columns: list[str] | None = None,
    min_values: int = MIN_VALUES,
    fence: float = FENCE,
) -> DataFrame:
    """Values strictly outside the fences: count, smallest, largest, and the fences."""
    columns = columns or [c for c in NUMERIC_COLUMNS if c in df.columns]
    counts = value_counts(df, columns)
    bins = bin_ranges(counts)
    spread = F.col("q3") - F.col("q1")
    fences = quartiles(counts, bins, min_values).select(
        *GROUP,
        "total",
        (F.col("q1") - F.lit(fence) * spread).alias("lower"),
        (F.col("q3") + F.lit(fence) * spread).alias("upper"),
    )
    crossing = (F.col("low") < F.col("lower")) | (F.col("high") > F.col("upper"))
    # Joining on the total as well keeps the counts in this use, so that it shares their shuffle.
    open_bins = bins.join(fences, [*GROUP, "total"]).where(crossing).select(*BIN, "lower", "upper")
    outside = counts.join(open_bins, BIN).where(
        (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    )
    return outside.groupBy(*GROUP, "lower", "upper").agg(
        F.sum("n").alias("outliers"),
        F.min("value").alias("min_outlier"),
        F.max("value").alias("max_outlier"),
    )
