"""Keep-last de-duplication."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _sortable(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.MapType, T.VariantType))


def keep_last(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the last one by ``order``, then by all other columns.

    The tie-break on every column makes the choice repeatable. Spark trims each key to one row
    before the shuffle, so a key with very many copies does not reach a single task whole.
    Null key parts group together.
    """
    given = [o if isinstance(o, Column) else F.col(f"`{o}`") for o in order]
    named = {o for o in order if isinstance(o, str)} | set(keys)
    ties = [
        F.col(f"`{f.name}`")
        for f in df.schema.fields
        if f.name not in named and _sortable(f.dataType)
    ]
    latest_first = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(
        *[c.desc_nulls_last() for c in given + ties]
    )
    ranked = df.withColumn("_nth", F.row_number().over(latest_first))
    return ranked.where("_nth = 1").drop("_nth")


def first_per_group(df: DataFrame, keys: list[str], order: list[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of each group; trimmed before the shuffle like ``keep_last``."""
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= n).drop("_nth")
