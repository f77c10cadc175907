"""Readers. CSV readers take an explicit schema; nothing is inferred from the data."""

import csv
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpanel import schemas as S
from shelfpanel.schemas import MONITORED_FIELDS, ensure_columns, field


def _csv_header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"').columns


def _files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files of a folder (or a single file), grouped by their header; only first lines are read."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    groups: dict[tuple[str, ...], list[str]] = {}
    for status in fs.listStatus(where):
        file = status.getPath()
        if status.isDirectory() or file.getName()[0] in "._" or not status.getLen():
            continue
        header = (_csv_header(spark, file.toString()) if not file.getName().endswith(".csv") else _first_line(jvm, fs, file)) or []
        groups.setdefault(tuple(header), []).append(file.toString())
    return groups


def _first_line(jvm, fs, file) -> list[str]:
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(file), "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return next(csv.reader([(line or "").lstrip("\ufeff")]), [])


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV with any columns, every column as text (the header names them).

    Files of one folder may have other columns, or the same in another order: files with the same header are one scan, and the scans
    are joined by name; a column that a file lacks is null there. Nothing is taken by position.
    """
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "enforceSchema": False}
    try:
        groups = _files_by_header(spark, path)
    except Py4JJavaError:  # no folder: Spark says what is wrong with the path, or expands it
        groups = {}
    if len(groups) < 2:
        return spark.read.csv(path, schema=S.text_schema(_csv_header(spark, path)), **options)
    parts = [spark.read.csv(files, schema=S.text_schema(list(header)), **options) for header, files in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    """The table at ``path``, or no rows of ``schema`` where nothing has been stored yet (no folder, or one without files)."""
    try:
        return read_text_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def read_panel(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_or_empty(spark, path, S.PANEL_SCHEMA, fmt)


def read_panel_fields(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Keys and monitored fields of the panel; fields that an old table lacks are not found."""
    panel = ensure_columns(read_panel(spark, path, fmt), MONITORED_FIELDS)
    return panel.select(*S.KEY_COLUMNS, *[field(f) for f in MONITORED_FIELDS])


def read_keyword_panel(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    panel = read_or_empty(spark, path, S.KEYWORD_PANEL_SCHEMA, fmt)
    types = {f.name: f.dataType for f in S.KEYWORD_PANEL_SCHEMA.fields}
    return panel.select(*[field(c).cast(types.get(c, T.StringType())).alias(c) for c in panel.columns])


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Stored change events, without the marks of partitions that were looked at."""
    events = read_or_empty(spark, path, S.EVENT_SCHEMA, "parquet")
    return events.where(F.col("ASIN").isNotNull()).select(*[field(c).cast("string").alias(c) for c in S.EVENT_COLUMNS])


def read_error_samples(spark: SparkSession, path: str) -> DataFrame:
    """Stored error samples, without the marks of runs that had none."""
    samples = read_or_empty(spark, path, S.ERROR_SCHEMA, "parquet")
    return samples.where(F.col("ASIN").isNotNull()).select(*S.ERROR_SCHEMA.names)


def read_run_summaries(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, S.SUMMARY_SCHEMA, "parquet").select(*[field(c) for c in S.SUMMARY_SCHEMA.names])


def read_listings(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_or_empty(spark, path, S.LISTING_SCHEMA, fmt)


def read_competitors(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_or_empty(spark, path, S.COMPETITOR_SCHEMA, fmt)


def read_keywords(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_or_empty(spark, path, S.KEYWORD_LIST_SCHEMA, fmt)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages: page_id, url, html and, where known, Country."""
    return spark.read.parquet(path)


def active_listings(listings: DataFrame, country: str | None = None) -> DataFrame:
    """Own active listings as (Country, ASIN, SKU), of one country or of all."""
    rows = listings.where((F.col("status") == "Active") & F.col("asin").isNotNull())
    if country is not None:
        rows = rows.where(F.col("sales_country") == country)
    return rows.select(
        F.col("sales_country").alias("Country"), F.col("asin").alias("ASIN"), F.col("sku").alias("SKU")
    )


def own_asins(listings: DataFrame, country: str | None = None) -> DataFrame:
    """Distinct (Country, ASIN) of the own active listings."""
    return active_listings(listings, country).select("Country", "ASIN").distinct()


def own_skus(listings: DataFrame, country: str | None = None) -> DataFrame:
    """One SKU per (Country, ASIN); the largest where a key has several."""
    return active_listings(listings, country).groupBy("Country", "ASIN").agg(F.max("SKU").alias("SKU"))


def competitor_asins(competitors: DataFrame, country: str | None = None) -> DataFrame:
    rows = competitors if country is None else competitors.where(F.col("Country") == country)
    return rows.where(F.col("ASIN").isNotNull()).select("Country", F.col("ASIN").cast("string").alias("ASIN"))


def region_keywords(keywords: DataFrame, region: str) -> DataFrame:
    return keywords.where(F.col("Sales Region") == region).select(F.col("Keywords").alias("Keyword"))
