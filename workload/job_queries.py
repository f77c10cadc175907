"""Rows that jobs reject or lose, statistics, selectors from settings, and parts of jobs with SQL of their own."""

from pathlib import Path

from pyspark.sql import functions as F

from shelfpanel.functions.text import size_name
from shelfpanel.operators import keys
from shelfpanel.operators.ranks import join_rank_sides
from shelfpanel.operators.targets import union_targets
from shelfpanel.plans import changes as plans
from shelfpanel.plans.pages import extract_products
from shelfpanel.plans.targets import collection_targets as targets_of
from shelfpanel.schemas import ensure_columns
from shelfpanel.sources.marketplaces import marketplaces_from_text
from shelfpanel.sources.tables import competitor_asins, own_asins
from workload import adapters as A
from workload.page_queries import product_pages, text_sql
from workload.panel_queries import CHANGES_SQL, EVENT_LIST
from workload.run_queries import ORDER_SQL

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def observed_rows(spark, d):
    """Collected rows from events: the key asked for from the user, the key of the page now and then another one or none."""
    e = A.table(spark, d, "events")
    user, n = F.col("user_id"), F.col("event_id")
    page = F.when(n % 11 == 0, A.asin_of(user + 1)).when(n % 7 == 0, F.lit("")).otherwise(A.asin_of(user))
    return e.select(
        F.when(user % 13 == 0, "XX").when(user % 17 == 0, F.lit(None)).when(user % 19 == 0, " ").otherwise(A.code_of(user)).alias("Country"),
        F.when(n % 23 == 0, "Not Found").otherwise(A.asin_of(user)).alias("ASIN"),
        page.alias("ASIN Product Page"),
        F.when(n % 3 == 0, "Not Found").otherwise("9.99").alias("Price"),
        F.when(n % 2 == 0, " ").otherwise("8.50").alias("PED"),
    )


OBSERVED_SQL = f"""observed AS (SELECT CASE WHEN user_id % 13 = 0 THEN 'XX' WHEN user_id % 17 = 0 THEN NULL WHEN user_id % 19 = 0 THEN ' '
      ELSE {A.CODE_SQL.format('user_id')} END AS "Country",
    CASE WHEN event_id % 23 = 0 THEN 'Not Found' ELSE {A.ASIN_SQL.format('user_id')} END AS asked,
    CASE WHEN event_id % 11 = 0 THEN {A.ASIN_SQL.format('(user_id + 1)')} WHEN event_id % 7 = 0 THEN '' ELSE {A.ASIN_SQL.format('user_id')} END AS page,
    event_id % 3 = 0 AND event_id % 2 = 0 AS no_price FROM events)"""


@query(
    "rejected_rows",
    A.joined_sql(OBSERVED_SQL)
    + f"""SELECT "Country", asked AS "ASIN", CASE WHEN coalesce(trim("Country"), '') = '' THEN 'no country'
      WHEN "Country" NOT IN ({", ".join(f"'{c}'" for c in A.CODES)}) THEN 'unknown country'
      WHEN asked = 'Not Found' THEN 'no key' ELSE 'accepted' END AS "Verdict", count(*) AS rows FROM observed GROUP BY ALL""",
)
def rejected_rows(spark, d):
    tagged = keys.tagged_rows(observed_rows(spark, d), A.marketplaces(spark))
    return tagged.groupBy("Country", "ASIN", "Verdict").agg(F.count("*").alias("rows"))


@query(
    "processing_stats",
    A.joined_sql(OBSERVED_SQL)
    + """SELECT "Country", count(*) AS rows, count(*) FILTER (page <> '' AND page <> asked) AS redirected,
      count(*) FILTER (page = '') AS page_invalid FROM observed GROUP BY 1""",
)
def processing_stats(spark, d):
    return keys.redirect_stats(keys.correct_redirects(observed_rows(spark, d)), ["Country"])


@query(
    "lost_keys",
    A.joined_sql(OBSERVED_SQL, A.LISTINGS_SQL, A.COMPETITORS_SQL)
    + f""", wanted AS (SELECT "Country", "ASIN" FROM own UNION SELECT "Country", "ASIN" FROM competitors),
    seen AS (SELECT "Country", "ASIN", bool_or(ok) AS ok FROM (
      SELECT "Country", asked AS "ASIN", page <> '' AS ok FROM observed
      UNION ALL SELECT "Country", page, true FROM observed WHERE page <> '' AND page <> asked) u GROUP BY 1, 2),
    failed AS (SELECT DISTINCT {A.CODE_SQL.format('user_id')} AS "Country", {A.ASIN_SQL.format('user_id')} AS "ASIN" FROM events WHERE event_type = 'error')
    SELECT w."Country", w."ASIN", CASE WHEN f."ASIN" IS NOT NULL THEN 'zip_error' WHEN s.ok IS NOT NULL THEN 'invalid page'
      ELSE 'not collected' END AS "Reason"
    FROM wanted w LEFT JOIN seen s ON s."Country" = w."Country" AND s."ASIN" = w."ASIN"
    LEFT JOIN failed f ON f."Country" = w."Country" AND f."ASIN" = w."ASIN" WHERE NOT coalesce(s.ok, false)""",
)
def lost_keys(spark, d):
    wanted = union_targets(own_asins(A.listing_rows(spark, d)), competitor_asins(A.competitor_rows(spark, d)))
    user = F.col("user_id")
    ledger = A.table(spark, d, "events").where("event_type = 'error'").select(
        A.code_of(user).alias("Country"), A.asin_of(user).alias("ASIN"), F.lit("zip_error").alias("reason")
    )
    return keys.lost_keys(wanted, keys.correct_redirects(observed_rows(spark, d)), ledger)


JOINED = ["Date", "Country", "Keyword", "ASIN", "Deal"]


@query(
    "rank_join",
    A.joined_sql(A.TILES_SQL)
    + """SELECT coalesce(o."Date", s."Date") AS "Date", coalesce(o."Country", s."Country") AS "Country",
      coalesce(o."Keyword", s."Keyword") AS "Keyword", coalesce(o."ASIN", s."ASIN") AS "ASIN", coalesce(o."Deal", s."Deal") AS "Deal",
      o.r AS "Organic Rank", s.r AS "Sponsored Rank"
    FROM (SELECT "Date", "Country", "Keyword", "ASIN", nullif("Deal", 'Not Found') AS "Deal", "Rank" % 3 AS r FROM tiles WHERE "Sponsored" = 'No') o
    FULL JOIN (SELECT "Date", "Country", "Keyword", "ASIN", nullif("Deal", 'Not Found') AS "Deal", "Rank" % 3 AS r FROM tiles WHERE "Sponsored" = 'Yes') s
    ON o."Date" = s."Date" AND o."Country" = s."Country" AND o."Keyword" = s."Keyword" AND o."ASIN" = s."ASIN"
      AND o."Deal" IS NOT DISTINCT FROM s."Deal" """,
)
def rank_join(spark, d):
    tiles = A.keyword_tiles(spark, d).select(
        "Date", "Country", "Keyword", "ASIN", F.nullif("Deal", F.lit("Not Found")).alias("Deal"), (F.col("Rank") % 3).alias("Rank"), "Sponsored"
    )
    return join_rank_sides(tiles)


@query(
    "country_selectors",
    f"""SELECT {A.ASIN_SQL.format('page_id')} AS "ASIN", code AS "Country",
      CASE code WHEN 'US' THEN {text_sql("regexp_extract(html, '(?s)<title>(.*?)</title>', 1) || ' \"A\" set'")}
        ELSE {text_sql("regexp_extract(html, '(?s)<article><h1>(.*?)</h1>', 1)")} END AS "Name",
      regexp_extract(html, '<nav><ul><li><a href="[^"]*">([^<]*)<', 1) AS "Brand", 'home' AS "Product Category GL",
      CASE code WHEN 'US' THEN CASE page_id % 3 WHEN 0 THEN 'In Stock' WHEN 1 THEN 'Only 3 left in stock' ELSE '' END
        ELSE {text_sql("regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)")} END AS "Stock"
    FROM (SELECT *, {A.CODE_SQL.format('page_id')} AS code FROM pages) p WHERE code IN ('US', 'DE')""",
)
def country_selectors(spark, d):
    places = marketplaces_from_text(spark, Path(__file__).with_name("settings.json").read_text(encoding="utf-8"))
    observed = extract_products(product_pages(spark, d), places, F.lit("2024-05-01").cast("date"))
    return observed.select("ASIN", "Country", "Name", "Brand", "Product Category GL", "Stock")


@query("size_names", "SELECT doc_id, left(text, 100) AS size_name FROM documents")
def size_names(spark, d):
    return A.table(spark, d, "documents").select("doc_id", size_name(F.col("text")).alias("size_name"))


START = "2024-01-10"


@query(
    "changes_since",
    CHANGES_SQL.replace("FROM events) e)", f"FROM events WHERE ts >= '{START}') e)") + f"SELECT {EVENT_LIST} FROM events_out",
)
def changes_since(spark, d):
    return plans.backfill_changes(A.state_rows(spark, d), A.listing_rows(spark, d), start=START, order=["ts"])


@query(
    "added_columns",
    A.joined_sql(A.STATES_SQL) + """SELECT "Country", 'Not Found' AS "Merchant", 'none' AS "Colour.Name", count(*) AS rows FROM states GROUP BY 1""",
)
def added_columns(spark, d):
    rows = ensure_columns(A.state_rows(spark, d), ["Badge", "Merchant"])
    rows = ensure_columns(rows, ["Colour.Name", "Country"], default="none")
    return rows.groupBy("Country", "Merchant", "`Colour.Name`").agg(F.count("*").alias("rows"))


@query(
    "collection_targets",
    A.joined_sql(A.LISTINGS_SQL, A.COMPETITORS_SQL, A.PLACES_SQL)
    + f"""SELECT "Country", "ASIN", 'https://' || domain || '/dp/' || "ASIN" || '?th=1' AS "Url",
      CAST(ntile(3) OVER (PARTITION BY "Country" ORDER BY {ORDER_SQL}) AS INT) AS batch,
      (row_number() OVER (PARTITION BY "Country" ORDER BY {ORDER_SQL}) - 1) // 50 + 1 AS session,
      CAST((row_number() OVER (PARTITION BY "Country" ORDER BY {ORDER_SQL}) - 1) % 50 AS INT) AS session_pos
    FROM (SELECT "Country", "ASIN" FROM own UNION SELECT "Country", "ASIN" FROM competitors) u JOIN places ON code = u."Country" """,
)
def collection_targets(spark, d):
    return targets_of(A.listing_rows(spark, d), A.competitor_rows(spark, d), A.marketplaces(spark), batches=3, per_session=50)
