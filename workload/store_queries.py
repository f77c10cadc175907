"""What the writers store, read again by the readers: panels, events, runs, targets, keyword panels and pages."""

import uuid

from pyspark.sql import functions as F

from shelfpanel.operators import runs as ops
from shelfpanel.operators.targets import first_targets, union_targets, with_product_urls
from shelfpanel.plans import changes as plans
from shelfpanel.plans.keywords import keyword_panel
from shelfpanel.schemas import ERROR_SCHEMA, EVENT_COLUMNS, SUMMARY_SCHEMA
from shelfpanel.sources import sinks
from shelfpanel.sources import tables as T
from workload import adapters as A
from workload.panel_queries import CHANGES_SQL, EVENT_LIST
from workload.panel_queries import ORACLES as PANEL
from workload.run_queries import ORACLES as RUNS
from workload.run_queries import SUMMARY_SQL

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def new_folder(spark, name):
    """A folder of its own below the shared one, deleted when the driver ends."""
    path = f"{A.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


STORED = ["Country", "ASIN", "Name", "Size Name", "Product Category", "Price"]


@query(
    "panel_files",
    A.joined_sql(A.PANEL_SQL)
    + f"""SELECT {", ".join(f'''coalesce("{c}", '') AS "{c}"''' for c in STORED)}, strftime("Date", '%m/%d/%Y') AS "Date",
      CASE "Country" WHEN 'CHINA' THEN '' ELSE coalesce("Brand", '') END AS "Brand" FROM panel""",
)
def panel_files(spark, d):
    """The panel in two files with other columns, one without brands, and a table that nobody has stored yet."""
    folder = new_folder(spark, "panel")
    panel = A.price_panel(spark, d).select("Date", *STORED, "Brand")
    late = F.col("Country") == "CHINA"
    sinks.write_panel_csv(panel.where(~late), folder)
    sinks.write_text_csv(
        panel.where(late).select("Price", F.date_format("Date", "MM/dd/yyyy").alias("Date"), *STORED[:-1]), folder, "append"
    )
    stored = T.read_panel(spark, folder, "csv")
    none = T.read_panel(spark, f"{folder}-absent", "csv")
    both = stored.unionByName(none, allowMissingColumns=True)
    return both.select("Date", *[F.coalesce(f"`{c}`", F.lit("")).alias(c) for c in [*STORED, "Brand"]])


@query("event_store", CHANGES_SQL + f"SELECT {EVENT_LIST} FROM events_out")
def event_store(spark, d):
    """All events, of which one country was stored wrongly at first and is covered by a second run."""
    folder = new_folder(spark, "events")
    panel, listings = A.state_rows(spark, d), A.listing_rows(spark, d)
    events = plans.backfill_changes(panel, listings, order=["ts"])
    wrong = events.withColumn("Value_after", F.when(F.col("Country") == "DE", "stale").otherwise(F.col("Value_after")))
    sinks.rebuild_events(wrong, folder)
    again = plans.backfill_changes(panel, listings, countries=["DE"], order=["ts"])
    sinks.append_events(again, folder, plans.covered_days(panel, listings, countries=["DE"]))
    return T.read_events(spark, folder).select(*EVENT_COLUMNS)


@query(
    "run_store",
    A.joined_sql(A.RUNS_SQL) + f'SELECT {", ".join(chr(34) + c + chr(34) for c in SUMMARY_SCHEMA.names)} FROM ({SUMMARY_SQL}) s',
)
def run_store(spark, d):
    """Summaries of all runs; those of one country are stored twice."""
    folder = new_folder(spark, "runs")
    summary = ops.execution_summary(*A.runs_and_errors(spark, d))
    sinks.replace_runs(summary, folder, summary, SUMMARY_SCHEMA)
    again = summary.where(F.col("Country") == "FRANCE")
    sinks.replace_runs(again, folder, again, SUMMARY_SCHEMA)
    return T.read_run_summaries(spark, folder)


@query("error_store", RUNS["error_topk"])
def error_store(spark, d):
    """Error samples of all runs; those of one country had none at first."""
    folder = new_folder(spark, "errors")
    runs, errors = A.runs_and_errors(spark, d)
    summary, samples = ops.execution_summary(runs, errors), ops.error_samples(errors)
    sinks.replace_runs(samples.where(F.col("Country") != "FRANCE"), folder, summary, ERROR_SCHEMA)
    one = F.col("Country") == "FRANCE"
    sinks.replace_runs(samples.where(one), folder, summary.where(one), ERROR_SCHEMA)
    return T.read_error_samples(spark, folder)


@query(
    "target_file",
    A.joined_sql(A.LISTINGS_SQL, A.COMPETITORS_SQL, A.PLACES_SQL)
    + """SELECT 'https://' || domain || '/dp/' || "ASIN" || '?th=1' AS "Url"
    FROM (SELECT "Country", "ASIN" FROM own UNION SELECT "Country", "ASIN" FROM competitors) u JOIN places ON code = u."Country" """,
)
def target_file(spark, d):
    folder = new_folder(spark, "targets")
    keys = union_targets(T.own_asins(A.listing_rows(spark, d)), T.competitor_asins(A.competitor_rows(spark, d)))
    sinks.write_targets(with_product_urls(keys, A.marketplaces(spark)), folder)
    return spark.read.text(folder).withColumnRenamed("value", "Url")


@query(
    "trial_targets",
    A.joined_sql(A.LISTINGS_SQL, A.COMPETITORS_SQL)
    + """(SELECT "Country", "ASIN" FROM (SELECT "Country", "ASIN" FROM own UNION SELECT "Country", "ASIN" FROM competitors) u
      ORDER BY 1, 2 LIMIT 100) UNION ALL SELECT 'US', 'B0000TRIAL' UNION ALL SELECT 'MX', 'B0000TRIAL'""",
)
def trial_targets(spark, d):
    """The limit is the feature: the first hundred keys and two that are always tried."""
    keys = union_targets(T.own_asins(A.listing_rows(spark, d)), T.competitor_asins(A.competitor_rows(spark, d)))
    return first_targets(keys, 100, [("US", "B0000TRIAL"), ("MX", "B0000TRIAL")])


@query("keyword_store", f"""SELECT * REPLACE (coalesce("Num Reviews", '') AS "Num Reviews") FROM ({PANEL["keyword_dedup"]}) k""")
def keyword_store(spark, d):
    folder = new_folder(spark, "keywords")
    sinks.write_keyword_csv(keyword_panel(A.keyword_tiles(spark, d)), folder)
    return T.read_keyword_panel(spark, folder, "csv").na.fill("")


@query(
    "region_keywords",
    """SELECT DISTINCT event_type || ' ' || CAST(user_id AS VARCHAR) AS "Keyword" FROM events WHERE user_id % 3 = 1""",
)
def region_keywords(spark, d):
    """The keyword list of one region, from a stored file."""
    folder = new_folder(spark, "keyword-list")
    user = F.col("user_id")
    listed = A.table(spark, d, "events").select(
        F.get(F.array(*[F.lit(r) for r in ("US", "EU", "MX")]), (user % 3).cast("int")).alias("Sales Region"),
        F.concat_ws(" ", "event_type", user.cast("string")).alias("Keywords"),
    )
    sinks.write_text_csv(listed.distinct(), folder)
    return T.region_keywords(T.read_keywords(spark, folder), "EU")


@query("stored_pages", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def stored_pages(spark, d):
    pages = T.read_pages(spark, f"{d}/pages.parquet")
    return pages.select("page_id", "url", F.char_length("html").cast("long").alias("n_chars"))
