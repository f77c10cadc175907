"""Writers. What a re-run may repeat replaces whole partitions instead of adding rows.

A covered partition that has no rows any more gets a row without a key in their stead, since only partitions with rows are replaced;
the readers of these tables (``sources.tables``) leave such rows out.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpanel.functions.dates import panel_date, panel_text
from shelfpanel.schemas import EVENT_COLUMNS
from shelfpanel.sources.tables import read_events, read_or_empty


def write_text_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Every field quoted, quotes doubled, blanks kept, UTF-8."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quoteAll", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def write_panel_csv(panel: DataFrame, path: str) -> None:
    """Panel export in date order with dates as ``MM/dd/yyyy``, rows without a date last."""
    is_text = dict(panel.dtypes)["Date"] == "string"
    day = panel_date(F.col("Date")) if is_text else F.col("Date")
    ordered = panel.orderBy(day.asc_nulls_last(), "Country", "ASIN")
    write_text_csv(ordered if is_text else ordered.withColumn("Date", panel_text(F.col("Date"))), path)


def write_panel_table(panel: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Panel as Parquet, one folder per country and date, sorted by key inside a file.

    The rebalance hint gathers a folder's rows and lets AQE split the large ones, so that a
    country with a third of all rows is still written by many tasks.
    """
    balanced = panel.hint("rebalance", F.col("Country"), F.col("Date"))
    (
        balanced.sortWithinPartitions("Country", "Date", "ASIN")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("Country", "Date")
        .parquet(path)
    )


def _write_events(events: DataFrame, path: str, overwrite: str) -> None:
    # One task per folder or several for a large one, instead of a small file from every task.
    rows = events.select(*EVENT_COLUMNS).hint("rebalance", F.col("Date"), F.col("Country"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .partitionBy("Date", "Country")
        .parquet(path)
    )


def append_events(events: DataFrame, path: str, covered: DataFrame | None = None) -> None:
    """Add change events; a second run for the same dates and countries replaces the first.

    ``covered`` (Date, Country, Field; one row per day, country and field) says what the run looked at: stored events of these are
    replaced, also where the run found none now, and stored events of other fields of these days stay. Events outside are not written.
    """
    if covered is None:
        _write_events(events, path, "dynamic")
        return
    known = covered.select(F.col("Date").cast("string").alias("Date"), "Country", "Field").distinct()
    days = known.select("Date", "Country").distinct()
    new = events.join(F.broadcast(known), ["Date", "Country", "Field"], "left_semi").select(*EVENT_COLUMNS)
    stored = read_events(events.sparkSession, path)
    others = stored.join(F.broadcast(days), ["Date", "Country"], "left_semi").join(
        F.broadcast(known), ["Date", "Country", "Field"], "left_anti"
    )
    marks = days.select(*[F.col(c) if c in days.columns else F.lit(None).cast("string").alias(c) for c in EVENT_COLUMNS])
    _write_events(new.unionByName(others).unionByName(marks), path, "dynamic")


def rebuild_events(events: DataFrame, path: str) -> None:
    """Replace the whole event table."""
    _write_events(events, path, "static")


def replace_runs(rows: DataFrame, path: str, runs: DataFrame, schema: T.StructType) -> None:
    """Store rows of runs (Country, Date, Time), in a folder per month; what an earlier write of the same runs left there goes.

    ``runs``: the runs that were done, also those without rows. Only the months of these runs are read and written.
    """
    key = ["Country", "Date", "Time"]
    done = runs.select(*key).distinct()
    marks = done.select(*[F.col(c) if c in key else F.lit(None).cast(t).alias(c) for c, t in rows.dtypes])
    bare = marks.join(rows.select(*key).distinct(), key, "left_anti")
    month = F.substring("Date", 1, 7)
    stored = read_or_empty(rows.sparkSession, path, T.StructType([*schema.fields, T.StructField("month", T.StringType())]), "parquet")
    touched = F.broadcast(done.select(month.alias("month")).distinct())
    kept = stored.withColumn("month", month).join(touched, "month", "left_semi").join(done, key, "left_anti")
    out = rows.unionByName(bare).withColumn("month", month).unionByName(kept)
    (
        out.hint("rebalance", F.col("month")).sortWithinPartitions("month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(path)
    )


def write_targets(targets: DataFrame, path: str) -> None:
    """Headerless list of the addresses to collect, one per line."""
    targets.select("Url").write.mode("overwrite").text(path)


def write_keyword_csv(panel: DataFrame, path: str) -> None:
    """Keyword panel export in (Date, Keyword) order."""
    write_text_csv(panel.orderBy("Date", "Keyword", "Country", "ASIN"), path)


def append_report(lines: DataFrame, path: str) -> None:
    """Store report lines in a folder per run, in order; a second report of a run replaces the first."""
    (
        lines.withColumn("run", F.concat(F.lit("run-"), F.col("run_id").cast("string")))
        .repartition("run")
        .sortWithinPartitions("run", "line_no")
        .select("line", "run")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run")
        .text(path)
    )
