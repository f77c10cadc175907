"""Running numbers inside groups, also where one group holds much of the table.

A plain ``row_number`` over a country would put all of that country into one task. Here each
group is cut into ordered slices by a column of the row itself; rows are numbered inside their
slice and shifted by the size of the slices before it. Only the slice sizes, one row each, ever
meet per group.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_text(keys: list[str]) -> Column:
    """Key parts as one text that is never null; the lengths keep different keys apart."""

    def part(k: str) -> Column:
        value = F.col(f"`{k}`").cast("string")
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.concat_ws("|", *[part(k) for k in keys])


def number_within(
    df: DataFrame,
    keys: list[str],
    slice_by: Column,
    order: list[Column | str],
    name: str,
    size_name: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in its group, ordered by slice and then ``order``.

    With ``weight``, a column saying for how many equal rows a row stands, the position is that
    of the last of them; ``order`` must then tell all rows of a slice apart.
    ``slice_by`` must not be null and must not fall as the wanted order rises. ``size_name`` also
    adds the group size.
    """
    tagged = df.withColumns({"_group": group_text(keys), "_slice": slice_by})
    in_slice = Window.partitionBy("_group", "_slice").orderBy(*order)
    if weight:
        so_far = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local, rows = F.sum(weight).over(so_far), F.sum(weight)
    else:
        local, rows = F.row_number().over(in_slice), F.count("*")
    numbered = tagged.withColumn("_local", local)

    sizes = tagged.groupBy("_group", "_slice").agg(rows.alias("_rows"))
    group = Window.partitionBy("_group")
    before = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_group",
        "_slice",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(group).alias("_size"),
    )
    joined = numbered.join(offsets, ["_group", "_slice"])
    extra = [F.col("_size").alias(size_name)] if size_name else []
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (name, size_name)]
    return joined.select(*kept, (F.col("_offset") + F.col("_local")).alias(name), *extra)


def hash_slice(key: Column) -> Column:
    """Slice for a free order: 4,096 even parts of the key space, the same on every run."""
    return F.coalesce(F.substring(F.md5(key), 1, 3), F.lit(""))


def work_batches(df: DataFrame, batches: int, by: str = "Country", key: str = "ASIN") -> DataFrame:
    """Cut each country's list into ``batches`` near-equal parts, the larger parts first."""
    numbered = number_within(df, [by], hash_slice(F.col(key)), [key], "_pos", "_size")
    small = F.floor(F.col("_size") / batches)
    larger = F.col("_size") % batches
    cut = larger * (small + 1)
    zero_based = F.col("_pos") - 1
    batch = F.when(zero_based < cut, F.floor(zero_based / (small + 1))).otherwise(
        larger + F.floor((zero_based - cut) / F.greatest(small, F.lit(1)))
    )
    return numbered.withColumn("batch", (batch + 1).cast("int")).drop("_pos", "_size")


def session_positions(
    df: DataFrame, per_session: int, by: str = "Country", key: str = "ASIN"
) -> DataFrame:
    """Session number (from 1) and 0-based position inside a session of ``per_session`` rows."""
    numbered = number_within(df, [by], hash_slice(F.col(key)), [key], "_pos")
    zero_based = F.col("_pos") - 1
    return numbered.select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.floor(zero_based / per_session) + 1).cast("long").alias("session"),
        (zero_based % per_session).cast("int").alias("session_pos"),
    )
