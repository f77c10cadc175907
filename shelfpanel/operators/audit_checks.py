"""Checks of a stored panel. Counting checks share one pass where they can."""

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpanel.functions.dates import panel_date
from shelfpanel.functions.numbers import to_number
from shelfpanel.functions.text import trimmed
from shelfpanel.operators.dedup import first_per_group
from shelfpanel.schemas import ESSENTIAL_COLUMNS, KEY_COLUMNS, NOT_FOUND, field, text_columns

# Alert limits.
MAX_SENTINEL_RATIO = 0.3
MAX_ROW_KB = 500
CORRUPT_ESCAPE = "\\" * 4


def date_of(df: DataFrame) -> Column:
    return panel_date(F.col("Date")) if dict(df.dtypes)["Date"] == "string" else F.col("Date")


def is_sentinel(c: Column) -> Column:
    return F.coalesce(c == NOT_FOUND, F.lit(False))


def has_corrupt_escape(c: Column) -> Column:
    """Four backslashes in a row, which four or more always hold."""
    return F.coalesce(c.contains(CORRUPT_ESCAPE), F.lit(False))


def date_profile(df: DataFrame) -> DataFrame:
    """First and last date, days between, distinct dates and rows without a usable date."""
    day = date_of(df)
    return df.select(day.alias("d")).agg(
        F.min("d").alias("first_date"),
        F.max("d").alias("last_date"),
        F.datediff(F.max("d"), F.min("d")).alias("span_days"),
        F.count_distinct("d").alias("dates"),
        F.count_if(F.col("d").isNull()).alias("invalid_dates"),
    )


def duplicate_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows that share their key with another one, every member counted, and such keys."""
    groups = df.groupBy(*(keys or KEY_COLUMNS)).agg(F.count("*").alias("n")).where("n > 1")
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"), F.count("*").alias("duplicate_keys")
    )


def sentinel_ratio(df: DataFrame, columns: list[str] | None = None, helper_columns: int = 0) -> DataFrame:
    """Share of cells that hold the sentinel; ``helper_columns`` widens the denominator."""
    columns = columns or df.columns
    texts = [c for c in columns if c in text_columns(df)]
    found = sum((is_sentinel(field(c)).cast("long") for c in texts), F.lit(0))
    cells = F.count("*") * F.lit(max(1, len(columns) + helper_columns))
    ratio = F.try_divide(F.sum(found), cells)
    return df.agg(
        F.coalesce(F.sum(found), F.lit(0)).alias("sentinels"),
        cells.alias("cells"),
        F.coalesce(ratio, F.lit(0.0)).alias("ratio"),
    ).withColumn("alert", F.col("ratio") > MAX_SENTINEL_RATIO)


def escape_scan(
    df: DataFrame, columns: list[str] | None = None, key: list[str] | None = None, examples: int = 2
) -> DataFrame:
    """Text columns with runs of four or more backslashes: row count and first examples by key."""
    columns = columns or text_columns(df)
    key = key or KEY_COLUMNS
    cells = F.array(*[F.struct(F.lit(c).alias("column"), field(c).alias("value")) for c in columns])
    key_names = [f"_key{i}" for i in range(len(key))]
    any_hit = reduce(or_, [has_corrupt_escape(field(c)) for c in columns])
    rows = df.where(any_hit).select(*[field(k).alias(n) for k, n in zip(key, key_names)], F.inline(cells))
    long = rows.where(has_corrupt_escape(F.col("value")))
    counts = long.groupBy("column").agg(F.count("*").alias("rows"))
    firsts = first_per_group(long, ["column"], [*key_names, "value"], examples)
    shown = firsts.groupBy("column").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(*key_names, "value"))), lambda s: s["value"]),
            " | ",
        ).alias("examples")
    )
    return counts.join(shown, "column")


MISSING, ABSENT = 1, 2


def with_states(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with a column ``_state_<i>`` for each of ``columns``: its cell is missing, not found, or (0) neither.

    Only texts can be blank or hold the sentinel. A column of its own is worked out once for both counts.
    """
    texts = set(text_columns(df))
    states = {}
    for i, c in enumerate(columns):
        value = field(c)
        state = F.when(value.isNull(), MISSING)
        if c in texts:
            bare = trimmed(value)
            state = F.coalesce(F.when(bare == "", MISSING).when(bare == NOT_FOUND, ABSENT).when(bare.isNotNull(), 0), F.lit(MISSING))
        states[f"_state_{i}"] = F.coalesce(state, F.lit(0))
    return df.withColumns(states)


def counters(columns: list[str]) -> list[Column]:
    """Counts of missing and of not-found cells in rows from ``with_states``."""
    names = (("missing", MISSING), ("not_found", ABSENT))
    return [F.count_if(F.col(f"_state_{i}") == k).alias(f"{n}_{i}") for i in range(len(columns)) for n, k in names]


def missing_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing and not-found cells per essential column, from one pass."""
    columns = [c for c in columns or ESSENTIAL_COLUMNS if c in df.columns]
    one_row = with_states(df, columns).agg(*counters(columns))
    per_column = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"missing_{i}").alias("missing"),
                F.col(f"not_found_{i}").alias("not_found"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return one_row.select(F.inline(per_column))


def range_rule_columns() -> dict[str, Column]:
    """Rule name to the rows that break it."""
    rating = to_number(field("Rating Stars"))
    return {
        "rating_out_of_range": F.coalesce((rating < 0) | (rating > 5), F.lit(False)),
        "negative_rating_count": F.coalesce(to_number(field("Number of ratings")) < 0, F.lit(False)),
        "size_name_escape": F.coalesce(field("Size Name").contains("\\\\"), F.lit(False)),
    }


def range_rules(df: DataFrame) -> DataFrame:
    """Rows that break each value rule."""
    rules = range_rule_columns()
    one_row = df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    per_rule = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("rows")) for n in rules])
    return one_row.select(F.inline(per_rule))


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in the panel's text form: every cell in quotes, quotes inside doubled, a mark after each cell."""
    texts = set(text_columns(df))
    cells = []
    for c in df.columns:
        size = F.coalesce(F.octet_length(field(c) if c in texts else field(c).cast("string")), F.lit(0)) + 3
        if c in texts:
            size = size + F.when(field(c).contains('"'), F.length(field(c)) - F.length(F.replace(field(c), F.lit('"'), F.lit("")))).otherwise(0)
        cells.append(size)
    return reduce(add, cells)


def row_size(df: DataFrame) -> DataFrame:
    """Rows and their mean size in bytes, as stored text."""
    return df.agg(F.count("*").alias("rows"), F.avg(row_bytes(df)).alias("avg_bytes")).withColumn(
        "alert", F.coalesce(F.col("avg_bytes") > MAX_ROW_KB * 1024, F.lit(False))
    )
