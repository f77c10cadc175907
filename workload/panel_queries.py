"""Change events, panel upkeep, and keyword ranks."""

from pyspark.sql import functions as F

from shelfpanel.functions.dates import event_text
from shelfpanel.functions.states import STOCK_PATTERNS, stock_class
from shelfpanel.operators import changes as ch
from shelfpanel.operators.keys import only_keys
from shelfpanel.operators.ranks import last_ranks, pivot_ranks, renumber_ranks
from shelfpanel.plans import changes as plans
from shelfpanel.plans.keywords import keyword_panel
from shelfpanel.plans.panel import deduplicate_panel, upsert_panel
from shelfpanel.sources.tables import active_listings, own_skus
from workload import adapters as A

FIELDS = ["Badge", "Limited Time Deal", "Deal", "Coupon", "Stock"]
QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def stock_case(column: str) -> str:
    whens = " ".join(
        f"WHEN regexp_matches(lower(trim({column})), '{'|'.join(f'(?:{p})' for p in ps)}') THEN '{name}'"
        for name, ps in STOCK_PATTERNS.items()
    )
    return f"CASE WHEN {column} IS NULL OR trim({column}) IN ('', 'Not Found', 'nan') THEN 'null' {whens} ELSE 'null' END"


def value_case(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL OR trim({column}) IN ('', 'Not Found', 'nan') "
        f"THEN 'null' ELSE trim({column}) END"
    )


DAYS_SQL = """days AS (SELECT s.* EXCLUDE (rn) FROM (SELECT st.*, row_number() OVER (
    PARTITION BY st."Country", st."ASIN", st."Date" ORDER BY ts DESC) AS rn FROM states st
    JOIN own ON own."Country" = st."Country" AND own."ASIN" = st."ASIN") s WHERE rn = 1)"""
CALENDAR_SQL = """calendar AS (SELECT "Country", "Date",
    lag("Date") OVER (PARTITION BY "Country" ORDER BY "Date") AS previous_date,
    row_number() OVER (PARTITION BY "Country" ORDER BY "Date" DESC) AS from_last
  FROM (SELECT DISTINCT "Country", "Date" FROM days) d)"""
LONG_SQL = (
    "long AS ("
    + " UNION ALL ".join(
        f"""SELECT "Country", "ASIN", "Date", '{f}' AS field, """
        f"""{(stock_case if f == 'Stock' else value_case)(f'"{f}"')} AS v FROM days"""
        for f in FIELDS
    )
    + ")"
)
# Pairwise form: each calendar step joins the rows of its two dates.
EVENTS_SQL = """events_out AS (
  SELECT strftime(t."Date", '%Y-%m-%d') AS "Date", t."ASIN", t."Country", coalesce(own.sku, '') AS "SKU",
    t.field AS "Field", p.v AS "Value_before", t.v AS "Value_after",
    CASE WHEN p.v = 'null' THEN 'gained' WHEN t.v = 'null' THEN 'lost' ELSE 'changed' END AS "Change_type",
    c.from_last
  FROM calendar c
  JOIN long t ON t."Country" = c."Country" AND t."Date" = c."Date"
  JOIN long p ON p."Country" = c."Country" AND p."Date" = c.previous_date AND p."ASIN" = t."ASIN" AND p.field = t.field
  LEFT JOIN own ON own."Country" = t."Country" AND own."ASIN" = t."ASIN"
  WHERE p.v <> t.v)"""
CHANGES_SQL = A.joined_sql(A.STATES_SQL, A.LISTINGS_SQL, DAYS_SQL, CALENDAR_SQL, LONG_SQL, EVENTS_SQL)
EVENT_LIST = '"Date", "ASIN", "Country", "SKU", "Field", "Value_before", "Value_after", "Change_type"'


@query("change_events", CHANGES_SQL + f"SELECT {EVENT_LIST} FROM events_out")
def change_events(spark, d):
    return plans.backfill_changes(A.state_rows(spark, d), A.listing_rows(spark, d), order=["ts"])


@query("latest_changes", CHANGES_SQL + f"SELECT {EVENT_LIST} FROM events_out WHERE from_last = 1")
def latest_changes(spark, d):
    return plans.latest_changes(A.state_rows(spark, d), A.listing_rows(spark, d), order=["ts"])


@query(
    "change_summary",
    CHANGES_SQL + """SELECT "Country", "Field", "Change_type", count(*) AS events
    FROM events_out GROUP BY 1, 2, 3""",
)
def change_summary(spark, d):
    return ch.change_counts(change_events(spark, d))


@query(
    "date_pair_join",
    A.joined_sql(A.STATES_SQL, A.LISTINGS_SQL, DAYS_SQL, CALENDAR_SQL)
    + """SELECT t."Country", t."ASIN", strftime(t."Date", '%Y-%m-%d') AS "Date",
      strftime(c.previous_date, '%Y-%m-%d') AS previous_date
    FROM calendar c JOIN days t ON t."Country" = c."Country" AND t."Date" = c."Date"
    JOIN days p ON p."Country" = c."Country" AND p."Date" = c.previous_date AND p."ASIN" = t."ASIN" """,
)
def date_pair_join(spark, d):
    own = only_keys(A.state_rows(spark, d), active_listings(A.listing_rows(spark, d)), ["Country", "ASIN"])
    pairs = ch.key_pairs(own)
    return pairs.select(
        "Country", "ASIN", event_text(F.col("Date")).alias("Date"),
        event_text(F.col("previous_date")).alias("previous_date"),
    )


@query(
    "stock_class",
    A.joined_sql(A.STATES_SQL)
    + f"""SELECT "Stock" AS stock_text, {stock_case('"Stock"')} AS stock_class, count(*) AS n
    FROM states GROUP BY 1, 2""",
)
def stock_classes(spark, d):
    states = A.state_rows(spark, d).select(
        F.col("Stock").alias("stock_text"), stock_class(F.col("Stock")).alias("stock_class")
    )
    return states.groupBy("stock_text", "stock_class").agg(F.count("*").alias("n"))


@query(
    "own_semi_join",
    A.joined_sql(A.STATES_SQL, A.LISTINGS_SQL)
    + """SELECT st."Country", count(*) AS rows, count(DISTINCT st."ASIN") AS asins FROM states st
    WHERE EXISTS (SELECT 1 FROM own WHERE own."Country" = st."Country" AND own."ASIN" = st."ASIN") GROUP BY 1""",
)
def own_semi_join(spark, d):
    own = only_keys(A.state_rows(spark, d), active_listings(A.listing_rows(spark, d)), ["Country", "ASIN"])
    return own.groupBy("Country").agg(
        F.count("*").alias("rows"), F.count_distinct("ASIN").alias("asins")
    )


@query(
    "sku_lookup",
    A.joined_sql(A.COMPETITORS_SQL, A.LISTINGS_SQL)
    + """SELECT c."Country", c."ASIN", coalesce(own.sku, '') AS "SKU", count(*) AS rows FROM competitors c
    LEFT JOIN own ON own."Country" = c."Country" AND own."ASIN" = c."ASIN" GROUP BY 1, 2, 3""",
)
def sku_lookup(spark, d):
    # Counted per key first: a key with very many rows joins as one row.
    rows = A.competitor_rows(spark, d).groupBy("Country", "ASIN").agg(F.count("*").alias("rows"))
    return ch.with_sku(rows, own_skus(A.listing_rows(spark, d)))


PANEL_LIST = """"Country", "ASIN", strftime("Date", '%Y-%m-%d') AS "Date", seq, "Price", "List Price", "PED",
  "Number of ratings", "Rating Stars", "Name", "Brand", "Size Name", "Link", "Product Category" """
# All other columns break ties, in the order they have in the table, nulls first.
TIES = ", ".join(
    f'"{c}" DESC NULLS LAST'
    for c in ["Price", "List Price", "PED", "Number of ratings", "Rating Stars", "Name", "Brand", "Size Name",
              "Link", "Product Category"]
)


def _shown(panel):
    return panel.withColumn("Date", event_text(F.col("Date")))


@query(
    "panel_dedup",
    A.joined_sql(A.PANEL_SQL) + f"""SELECT {PANEL_LIST} FROM (SELECT *, row_number() OVER (
    PARTITION BY "Country", "ASIN", "Date" ORDER BY seq DESC, {TIES}) AS rn FROM panel) p WHERE rn = 1""",
)
def panel_dedup(spark, d):
    return _shown(deduplicate_panel(A.price_panel(spark, d), ["seq"]))


@query(
    "panel_upsert",
    A.joined_sql(A.PANEL_SQL)
    + f"""SELECT {PANEL_LIST} FROM (SELECT *, row_number() OVER (PARTITION BY "Country", "ASIN", "Date"
    ORDER BY CASE WHEN "Rating Stars" IN ('0', '1', '2') THEN 1 ELSE 0 END DESC, seq DESC, {TIES}) AS rn
    FROM panel) p WHERE rn = 1""",
)
def panel_upsert(spark, d):
    panel = A.price_panel(spark, d)
    is_new = F.col("`Rating Stars`").isin("0", "1", "2")
    return _shown(upsert_panel(panel.where(~is_new), panel.where(is_new), ["seq"]))


RENUMBERED_SQL = """renumbered AS (SELECT * EXCLUDE ("Rank"), row_number() OVER (
    PARTITION BY "Date", "Country", "Keyword", "Sponsored" ORDER BY "Rank", "ASIN") AS "Rank" FROM tiles)"""
KEY_LIST = '"Date", "Country", "Keyword", "ASIN", "Title", "Price", "Num Reviews", "Bought Past Month", "Deal"'
PIVOT_SQL = f"""pivoted AS (SELECT {KEY_LIST},
    max("Rank") FILTER ("Sponsored" = 'No') AS "Organic Rank",
    max("Rank") FILTER ("Sponsored" = 'Yes') AS "Sponsored Rank" FROM renumbered GROUP BY ALL)"""
# The last row of a key in the order of its other columns, a missing value after all others; then the highest ranks.
LAST_TILE = """"Title" DESC NULLS FIRST, "Price" DESC NULLS FIRST, "Num Reviews" DESC NULLS FIRST,
    "Bought Past Month" DESC NULLS FIRST, "Deal" DESC NULLS FIRST, "Organic Rank" DESC NULLS LAST,
    "Sponsored Rank" DESC NULLS LAST"""


@query(
    "rank_renumber",
    A.joined_sql(A.TILES_SQL, RENUMBERED_SQL)
    + f'SELECT {KEY_LIST}, "Sponsored", "Rank" FROM renumbered',
)
def rank_renumber(spark, d):
    return renumber_ranks(A.keyword_tiles(spark, d))


@query(
    "rank_pivot",
    # Full join of the two sides on all other columns; of the pairs made, the last ranks are kept.
    A.joined_sql(A.TILES_SQL, RENUMBERED_SQL)
    + """SELECT coalesce(o."Date", s."Date") AS "Date", coalesce(o."Country", s."Country") AS "Country",
      coalesce(o."Keyword", s."Keyword") AS "Keyword", coalesce(o."ASIN", s."ASIN") AS "ASIN",
      coalesce(o."Title", s."Title") AS "Title", coalesce(o."Price", s."Price") AS "Price",
      coalesce(o."Num Reviews", s."Num Reviews") AS "Num Reviews",
      coalesce(o."Bought Past Month", s."Bought Past Month") AS "Bought Past Month",
      coalesce(o."Deal", s."Deal") AS "Deal", max(o."Rank") AS "Organic Rank", max(s."Rank") AS "Sponsored Rank"
    FROM (SELECT * FROM renumbered WHERE "Sponsored" = 'No') o
    FULL JOIN (SELECT * FROM renumbered WHERE "Sponsored" = 'Yes') s
    ON o."Date" = s."Date" AND o."Country" = s."Country" AND o."Keyword" = s."Keyword" AND o."ASIN" = s."ASIN"
    AND o."Title" = s."Title" AND o."Price" = s."Price" AND o."Num Reviews" IS NOT DISTINCT FROM s."Num Reviews"
    AND o."Bought Past Month" = s."Bought Past Month" AND o."Deal" = s."Deal" GROUP BY ALL""",
)
def rank_pivot(spark, d):
    return pivot_ranks(last_ranks(A.keyword_tiles(spark, d)))


@query(
    "keyword_dedup",
    A.joined_sql(A.TILES_SQL, RENUMBERED_SQL, PIVOT_SQL)
    + f"""SELECT {KEY_LIST}, "Organic Rank", "Sponsored Rank" FROM (SELECT *, row_number() OVER (
    PARTITION BY "Date", "Country", "Keyword", "ASIN" ORDER BY {LAST_TILE}) AS rn FROM pivoted) p WHERE rn = 1""",
)
def keyword_dedup(spark, d):
    return keyword_panel(A.keyword_tiles(spark, d))


@query(
    "keyword_merge",
    # The stored panel holds the organic tiles, the batch that comes later the sponsored ones.
    A.joined_sql(A.TILES_SQL, RENUMBERED_SQL)
    + f"""SELECT {KEY_LIST}, "Organic Rank", "Sponsored Rank" FROM (SELECT *, row_number() OVER (
      PARTITION BY "Date", "Country", "Keyword", "ASIN" ORDER BY age DESC, {LAST_TILE}) AS rn
    FROM (SELECT {KEY_LIST}, CASE WHEN "Sponsored" = 'Yes' THEN 1 ELSE 0 END AS age,
        max("Rank") FILTER ("Sponsored" = 'No') AS "Organic Rank",
        max("Rank") FILTER ("Sponsored" = 'Yes') AS "Sponsored Rank"
      FROM renumbered GROUP BY ALL) a) p WHERE rn = 1""",
)
def keyword_merge(spark, d):
    tiles = A.keyword_tiles(spark, d)
    stored = keyword_panel(tiles.where(F.col("Sponsored") == "No"))
    return keyword_panel(tiles.where(F.col("Sponsored") == "Yes"), stored)
