"""The test tables seen as the inputs of the jobs, in Spark and as SQL text."""

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpanel.schemas import NOT_FOUND
from shelfpanel.sources.marketplaces import MARKETPLACE_SCHEMA

CODES = ["US", "CA", "GB", "DE", "FR", "IT", "ES", "MX"]
STOCK_TEXTS = [
    "In Stock", "Only 3 left in stock", "Nur noch 5 auf Lager", "Currently unavailable",
    "Usually ships within 2 to 3 days", NOT_FOUND,
]
ESCAPED_SIZE = "W" + "\\" * 4 + "X"
DOUBLE_SIZE = "W" + "\\" * 2 + "X"

# Blank code points as a class, for the SQL side.
BLANKS = (
    r"[\t\n\x0B\f\r \x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

# code, region, language, domain, postcode, best-seller wording, brand prefix and suffix
PLACES = [
    ("US", "US", "en-US", "shop.example", "10001", "Best Sellers Rank", "Visit the ", " Store"),
    ("CA", "CA", "en-CA", "ca.shop.example", "A1A 1A1", "Best Sellers Rank", "Visit the ", " Store"),
    ("GB", "GB", "en-GB", "gb.shop.example", "W2 4RT", "Best Sellers Rank", "Visit the ", " Store"),
    ("DE", "EU", "de-DE", "de.shop.example", "10115", "Bestseller-Rang", "Besuche den ", "-Store"),
    ("FR", "EU", "fr-FR", "fr.shop.example", "75001", "Classement", "Visiter la boutique ", ""),
    ("IT", "EU", "it-IT", "it.shop.example", "00161", "Posizione", "Visita lo Store di ", ""),
    ("ES", "EU", "es-ES", "es.shop.example", "28001", "Clasificación", "Visita la tienda de ", ""),
    ("MX", "MX", "es-MX", "mx.shop.example", "01000", "Clasificación", "Visita la tienda de ", ""),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``; a local session without it gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="panel-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def asin_of(number: Column) -> Column:
    return F.concat(F.lit("B"), F.lpad(number.cast("string"), 9, "0"))


def code_of(number: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in CODES]), F.pmod(number, F.lit(8)).cast("int"))


ASIN_SQL = "'B' || lpad(CAST({0} AS VARCHAR), 9, '0')"
CODE_SQL = "list_extract([" + ", ".join(f"'{c}'" for c in CODES) + "], CAST({0} % 8 AS INT) + 1)"


def marketplaces(spark: SparkSession) -> DataFrame:
    """The eight countries with made-up addresses."""
    rows = [
        (c, c, region, lang, domain, f"https://{domain}/dp/", zip_code, bsr, prefix, suffix,
         "Sponsored", "bought in past month", "with coupon", None)
        for c, region, lang, domain, zip_code, bsr, prefix, suffix in PLACES
    ]
    return spark.createDataFrame(rows, MARKETPLACE_SCHEMA)


PLACES_SQL = (
    "places(code, region, domain, zip_code, prefix, suffix) AS (VALUES "
    + ", ".join(f"('{c}', '{r}', '{d}', '{z}', '{p}', '{s}')" for c, r, _, d, z, _, p, s in PLACES)
    + ")"
)


def price_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel rows from line items: country of the supplier, listing of the part, month.

    Keys repeat, numbers are texts, and some cells are missing, blank, escaped or out of range.
    """
    line = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    cents = F.expr("CAST(round(l_extendedprice * 100) AS BIGINT) DIV CAST(l_quantity AS BIGINT)")
    unit = F.concat(
        F.expr("CAST(cents DIV 100 AS STRING)"), F.lit("."),
        F.lpad(F.expr("CAST(cents % 100 AS STRING)"), 2, "0"),
    )
    no, qty = F.col("l_linenumber"), F.col("l_quantity")
    price = F.when((no == 1) & (qty < 10), NOT_FOUND).otherwise(unit)
    joined = (
        line.withColumn("cents", cents)
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.select(
        F.col("n_name").alias("Country"),
        asin_of(F.col("l_partkey")).alias("ASIN"),
        F.trunc("l_shipdate", "month").alias("Date"),
        (F.col("l_orderkey") * 8 + no).alias("seq"),
        price.alias("Price"),
        F.when(
            F.col("l_discount") > 0.05,
            (F.col("l_extendedprice").cast("decimal(12,2)") + qty.cast("decimal(12,2)")).cast("string"),
        ).otherwise(NOT_FOUND).alias("List Price"),
        F.when(F.col("l_tax") > 0.06, unit).otherwise(NOT_FOUND).alias("PED"),
        qty.cast("int").cast("string").alias("Number of ratings"),
        F.round(F.col("l_tax") * 100).cast("int").cast("string").alias("Rating Stars"),
        F.when((no == 2) & (qty < 5), F.lit("  "))
        .when((no == 3) & (qty < 5), F.lit(None))
        .otherwise(F.concat(F.lit("Item "), F.col("l_partkey").cast("string"))).alias("Name"),
        F.col("s_name").alias("Brand"),
        F.when((no == 7) & (qty < 20), ESCAPED_SIZE).when(no == 7, DOUBLE_SIZE).otherwise("M").alias("Size Name"),
        F.concat(F.lit("https://shop.example/dp/"), asin_of(F.col("l_partkey"))).alias("Link"),
        F.concat("l_returnflag", F.lit("›"), "l_linestatus").alias("Product Category"),
    )


PANEL_SQL = f"""panel AS (
  SELECT n_name AS "Country", {ASIN_SQL.format('l_partkey')} AS "ASIN",
    CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date", l_orderkey * 8 + l_linenumber AS seq,
    CASE WHEN l_linenumber = 1 AND l_quantity < 10 THEN 'Not Found' ELSE unit END AS "Price",
    CASE WHEN l_discount > 0.05 THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2))
      + CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) ELSE 'Not Found' END AS "List Price",
    CASE WHEN l_tax > 0.06 THEN unit ELSE 'Not Found' END AS "PED",
    CAST(CAST(l_quantity AS INT) AS VARCHAR) AS "Number of ratings",
    CAST(CAST(round(l_tax * 100) AS INT) AS VARCHAR) AS "Rating Stars",
    CASE WHEN l_linenumber = 2 AND l_quantity < 5 THEN '  '
      WHEN l_linenumber = 3 AND l_quantity < 5 THEN NULL
      ELSE 'Item ' || CAST(l_partkey AS VARCHAR) END AS "Name",
    s_name AS "Brand",
    CASE WHEN l_linenumber = 7 AND l_quantity < 20 THEN '{ESCAPED_SIZE}'
      WHEN l_linenumber = 7 THEN '{DOUBLE_SIZE}' ELSE 'M' END AS "Size Name",
    'https://shop.example/dp/' || {ASIN_SQL.format('l_partkey')} AS "Link",
    l_returnflag || '›' || l_linestatus AS "Product Category"
  FROM (SELECT *, CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS unit
    FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS cents
      FROM lineitem) c) l
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""


def number_sql(column: str) -> str:
    """Text to double, null where the text is not a number."""
    return (
        f"CASE WHEN regexp_matches({column}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
        f"THEN TRY_CAST({column} AS DOUBLE) END"
    )


def state_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitored states from events: listing and country of the user, several rows a day."""
    e = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    user = F.col("user_id")
    return e.select(
        code_of(user).alias("Country"),
        asin_of(user).alias("ASIN"),
        F.to_date("ts").alias("Date"),
        "ts",
        F.when(F.col("event_type") == "error", NOT_FOUND).otherwise(F.col("event_type")).alias("Badge"),
        F.when(F.col("value") < 5, "Limited time deal").otherwise(NOT_FOUND).alias("Limited Time Deal"),
        F.when(k % 7 == 0, "Deal of the Day").otherwise(NOT_FOUND).alias("Deal"),
        F.when(k % 4 == 0, "Save 5%").when(k % 4 == 1, " Save 10% ").otherwise("").alias("Coupon"),
        F.get(F.array(*[F.lit(s) for s in STOCK_TEXTS]), k % 6).alias("Stock"),
    )


STATES_SQL = f"""states AS (
  SELECT {CODE_SQL.format('user_id')} AS "Country", {ASIN_SQL.format('user_id')} AS "ASIN",
    CAST(ts AS DATE) AS "Date", ts,
    CASE WHEN event_type = 'error' THEN 'Not Found' ELSE event_type END AS "Badge",
    CASE WHEN value < 5 THEN 'Limited time deal' ELSE 'Not Found' END AS "Limited Time Deal",
    CASE WHEN k % 7 = 0 THEN 'Deal of the Day' ELSE 'Not Found' END AS "Deal",
    CASE WHEN k % 4 = 0 THEN 'Save 5%' WHEN k % 4 = 1 THEN ' Save 10% ' ELSE '' END AS "Coupon",
    list_extract([{', '.join(f"'{s}'" for s in STOCK_TEXTS)}], k % 6 + 1) AS "Stock"
  FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INT) AS k FROM events) e)"""


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own listings from parts; economy parts are inactive."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        asin_of(key).alias("asin"),
        F.concat_ws("-", "p_name", key.cast("string")).alias("sku"),
        code_of(key).alias("sales_country"),
        F.when(F.col("p_type") == "ECONOMY", "Inactive").otherwise("Active").alias("status"),
    )


LISTINGS_SQL = f"""listings AS (
  SELECT {ASIN_SQL.format('p_partkey')} AS asin, p_name || '-' || CAST(p_partkey AS VARCHAR) AS sku,
    {CODE_SQL.format('p_partkey')} AS sales_country,
    CASE WHEN p_type = 'ECONOMY' THEN 'Inactive' ELSE 'Active' END AS status FROM part),
own AS (SELECT sales_country AS "Country", asin AS "ASIN", max(sku) AS sku FROM listings
  WHERE status = 'Active' AND asin IS NOT NULL GROUP BY 1, 2)"""


def competitor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Competing listings from line items: listing of the part, country of the order."""
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        code_of(F.col("l_orderkey")).alias("Country"), asin_of(F.col("l_partkey")).alias("ASIN")
    )


COMPETITORS_SQL = f"""competitors AS (
  SELECT {CODE_SQL.format('l_orderkey')} AS "Country", {ASIN_SQL.format('l_partkey')} AS "ASIN" FROM lineitem)"""


def keyword_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result tiles from events: keyword of the type, sponsored by event, rank by event order."""
    e = table(spark, sf_dir, "events")
    user = F.col("user_id")
    return e.select(
        F.date_format("ts", "yyyy-MM-dd").alias("Date"),
        code_of(user).alias("Country"),
        F.col("event_type").alias("Keyword"),
        F.col("event_id").alias("Rank"),
        asin_of(user).alias("ASIN"),
        F.concat(F.lit("Item "), user.cast("string")).alias("Title"),
        F.when(F.col("event_id") % 3 == 0, "Yes").otherwise("No").alias("Sponsored"),
        F.concat(F.lit("$"), (user % 50).cast("string"), F.lit(".99")).alias("Price"),
        # Reviews and deals differ between the tiles of one listing, so that a key has several rows.
        F.when((user + F.col("event_id")) % 11 != 0, (user * 7).cast("string")).alias("Num Reviews"),
        F.lit(NOT_FOUND).alias("Bought Past Month"),
        F.when(F.col("event_id") % 7 == 0, "Save 10%").when(user % 5 == 0, "Best Seller").otherwise(NOT_FOUND).alias("Deal"),
    )


TILES_SQL = f"""tiles AS (
  SELECT strftime(ts, '%Y-%m-%d') AS "Date", {CODE_SQL.format('user_id')} AS "Country",
    event_type AS "Keyword", event_id AS "Rank", {ASIN_SQL.format('user_id')} AS "ASIN",
    'Item ' || CAST(user_id AS VARCHAR) AS "Title",
    CASE WHEN event_id % 3 = 0 THEN 'Yes' ELSE 'No' END AS "Sponsored",
    '$' || CAST(user_id % 50 AS VARCHAR) || '.99' AS "Price",
    CASE WHEN (user_id + event_id) % 11 <> 0 THEN CAST(user_id * 7 AS VARCHAR) END AS "Num Reviews",
    'Not Found' AS "Bought Past Month",
    CASE WHEN event_id % 7 = 0 THEN 'Save 10%' WHEN user_id % 5 = 0 THEN 'Best Seller' ELSE 'Not Found' END AS "Deal"
  FROM events)"""


def run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collected rows of runs from orders: a run is a country and a day, an order is a row."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("Country"),
            F.col("o_orderdate").alias("ended_at"),
            F.col("o_orderkey").alias("seq"),
            asin_of(F.col("o_orderkey")).alias("ASIN"),
            F.col("o_orderstatus").alias("outcome"),
            F.floor(F.col("o_totalprice") / 1000).cast("long").alias("seconds"),
            (F.col("o_orderpriority") == "1-URGENT").alias("redirected"),
        )
    )


def runs_and_errors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = run_rows(spark, sf_dir)
    failed = F.col("outcome") == "F"
    runs = rows.groupBy("Country", "ended_at").agg(
        F.sum("seconds").alias("elapsed_seconds"),
        F.count("*").alias("requested"),
        F.count_if(~failed).alias("processed"),
        F.count_if(F.col("redirected") & ~failed).alias("redirects"),
        F.lit(0).cast("long").alias("removed"),
    )
    kind = F.when(failed, "failed").when(F.col("outcome") == "P", "price_ped")
    errors = rows.select("Country", "ended_at", "seq", "ASIN", kind.alias("kind")).where(
        F.col("kind").isNotNull()
    )
    return runs, errors


RUNS_SQL = f"""run_rows AS (
  SELECT n_name AS "Country", o_orderdate AS ended_at, o_orderkey AS seq,
    {ASIN_SQL.format('o_orderkey')} AS "ASIN", o_orderstatus AS outcome,
    CAST(floor(o_totalprice / 1000) AS BIGINT) AS seconds, o_orderpriority = '1-URGENT' AS redirected
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
runs AS (SELECT "Country", ended_at, CAST(sum(seconds) AS BIGINT) AS elapsed_seconds, count(*) AS requested,
    count(*) FILTER (outcome <> 'F') AS processed,
    count(*) FILTER (redirected AND outcome <> 'F') AS redirects,
    count(*) FILTER (outcome = 'F') AS n_failed, count(*) FILTER (outcome = 'P') AS n_price_ped
  FROM run_rows GROUP BY 1, 2)"""


def joined_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
