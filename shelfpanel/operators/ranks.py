"""Organic and sponsored keyword ranks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpanel.operators.positions import number_within
from shelfpanel.schemas import field

RANK_SLICE = 1024


RANK_GROUP = ["Date", "Country", "Keyword", "Sponsored"]


def _numbered(tiles: DataFrame, weight: str | None = None) -> DataFrame:
    """Tiles with their rank counted anew; equal ranks follow in the order of all other columns."""
    columns = [c for c in tiles.columns if c != weight]
    ties = ["ASIN"] + [c for c in columns if c not in (*RANK_GROUP, "Rank", "ASIN")]
    numbered = number_within(
        tiles,
        RANK_GROUP,
        F.coalesce(F.floor(F.col("Rank") / RANK_SLICE), F.lit(2**53)),
        [F.col("Rank").asc_nulls_last(), *[field(c) for c in ties]],
        "_new_rank",
        weight=weight,
    )
    return numbered.select(
        *[F.col("_new_rank").alias("Rank") if c == "Rank" else field(c) for c in columns]
    )


def renumber_ranks(tiles: DataFrame) -> DataFrame:
    """Rank counted anew inside (Date, Country, Keyword, Sponsored), in the old rank's order."""
    return _numbered(tiles)


def last_ranks(tiles: DataFrame) -> DataFrame:
    """Distinct tiles with the new rank of the last of their copies.

    What ``renumber_ranks`` gives, without its rows that the keep-last steps drop: copies are
    counted before the shuffle, so a tile stored very many times stays one row.
    """
    counted = tiles.groupBy(*[field(c) for c in tiles.columns]).agg(F.count("*").alias("_copies"))
    return _numbered(counted, "_copies")


def _pivot_keys(tiles: DataFrame) -> list[str]:
    return [c for c in tiles.columns if c not in ("Rank", "Sponsored")]


def pivot_ranks(tiles: DataFrame) -> DataFrame:
    """One row per set of equal other columns with its last organic and last sponsored rank.

    A full join of the two sides gives one row per pair of equal rows; of those the keep-last
    step that always follows retains the highest ranks. Taking the maxima gives that row without
    making the pairs, with partial sums before the only shuffle.
    """
    keys = _pivot_keys(tiles)
    known = tiles.where(F.col("Sponsored").isin("Yes", "No"))
    return known.groupBy(*[field(k) for k in keys]).agg(
        F.max(F.when(F.col("Sponsored") == "No", F.col("Rank"))).alias("Organic Rank"),
        F.max(F.when(F.col("Sponsored") == "Yes", F.col("Rank"))).alias("Sponsored Rank"),
    )


def join_rank_sides(tiles: DataFrame) -> DataFrame:
    """The two sides joined on all other columns, every pair of equal rows kept, nulls equal.

    Equal rows are counted on both sides before they are joined, so a tile stored very many times is one row in the join; its pairs are
    written out afterwards, first one side's copies and, dealt anew over the tasks, the other's.
    """
    keys = _pivot_keys(tiles)

    def side(flag: str, name: str) -> DataFrame:
        rows = tiles.where(F.col("Sponsored") == flag)
        return rows.groupBy(*[field(k) for k in keys], F.col("Rank").alias(name)).agg(F.count(F.lit(1)).alias(f"copies {name}"))

    organic = side("No", "Organic Rank").alias("o")
    sponsored = side("Yes", "Sponsored Rank").alias("s")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"o.`{k}`").eqNullSafe(F.col(f"s.`{k}`"))
    out = organic.join(sponsored, same, "full").select(
        *[F.coalesce(F.col(f"o.`{k}`"), F.col(f"s.`{k}`")).alias(k) for k in keys],
        "o.Organic Rank",
        "s.Sponsored Rank",
        F.coalesce("o.copies Organic Rank", F.lit(1)).alias("_copies"),
        F.coalesce("s.copies Sponsored Rank", F.lit(1)).alias("_others"),
    )
    for copies in ("_copies", "_others"):
        each = F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))
        out = out.select("*", each.alias("_n")).drop("_n", copies).hint("rebalance")
    return out
