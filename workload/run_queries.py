"""Run quality, failures, targets and checks."""

from pyspark.sql import functions as F

from shelfpanel.operators import runs as ops
from shelfpanel.operators.failures import failure_ledger as ledger_of
from shelfpanel.operators.positions import session_positions, work_batches as batches_of
from shelfpanel.operators.targets import union_targets, with_product_urls
from shelfpanel.operators.verification import audit_sample as sample_of
from shelfpanel.operators.verification import (
    check_rates,
    currency_is_valid,
    currency_verdict,
    region_is_valid,
)
from shelfpanel.sources.marketplaces import dimension
from shelfpanel.sources.tables import active_listings, own_asins
from workload import adapters as A

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


SUMMARY_SQL = """SELECT substr(md5("Country" || '|' || strftime(ended_at, '%Y-%m-%d %H:%M:%S')), 1, 8) AS "Execution ID",
  strftime(ended_at, '%Y-%m-%d') AS "Date", strftime(ended_at, '%H:%M:%S') AS "Time", "Country",
  processed AS "Processed ASINs", requested AS "Total Requested",
  round(processed * 100.0 / requested, 1) AS "Success Rate (%)",
  round(elapsed_seconds / 60, 1) AS "Processing Time (min)",
  CASE WHEN processed > 0 THEN round(elapsed_seconds / processed, 2) ELSE 0.0 END AS "Avg Time per ASIN (s)",
  n_price_ped AS "Price/PED Errors", n_failed AS "Scraping Errors", redirects AS "Redirected ASINs",
  n_failed + n_price_ped AS "Total Errors",
  CASE WHEN processed * 100.0 / requested >= 95 THEN 'green' WHEN processed * 100.0 / requested >= 85 THEN 'amber'
    ELSE 'red' END AS tier,
  CASE WHEN n_failed + n_price_ped + redirects = 0 THEN 'Ran Successfully' ELSE 'Ran with Errors' END AS status,
  trim(CASE WHEN elapsed_seconds >= 3600 THEN CAST(elapsed_seconds // 3600 AS VARCHAR) || 'h ' ELSE '' END
    || CASE WHEN elapsed_seconds % 3600 >= 60 THEN CAST(elapsed_seconds % 3600 // 60 AS VARCHAR) || 'm ' ELSE '' END
    || CASE WHEN elapsed_seconds % 60 > 0 OR elapsed_seconds < 60 THEN CAST(elapsed_seconds % 60 AS VARCHAR) || 's'
      ELSE '' END) AS duration
FROM runs"""


@query("run_summary", A.joined_sql(A.RUNS_SQL) + SUMMARY_SQL)
def run_summary(spark, d):
    return ops.execution_summary(*A.runs_and_errors(spark, d), detailed=True)


@query(
    "error_topk",
    A.joined_sql(A.RUNS_SQL)
    + """SELECT strftime(ended_at, '%Y-%m-%d') AS "Date", strftime(ended_at, '%H:%M:%S') AS "Time", "Country", "ASIN",
      CASE outcome WHEN 'F' THEN 'Complete Scraping Failure' ELSE 'Price/PED Error' END AS "Error Type",
      CASE outcome WHEN 'F' THEN 'Failed after multiple retries' ELSE 'Both Price and PED fields empty/not found' END
        AS "Error Details"
    FROM (SELECT *, row_number() OVER (PARTITION BY "Country", ended_at, outcome ORDER BY seq, "ASIN") AS rn
      FROM run_rows WHERE outcome IN ('F', 'P')) r WHERE rn <= 10""",
)
def error_topk(spark, d):
    return ops.error_samples(A.runs_and_errors(spark, d)[1])


@query(
    "batch_rollup",
    A.joined_sql(A.RUNS_SQL)
    + """SELECT "Country", count(*) AS runs, count(*) FILTER (n_failed = 0) AS successes,
      count(*) FILTER (n_failed > 0) AS failures, CAST(sum(elapsed_seconds) AS BIGINT) AS elapsed_seconds
    FROM runs GROUP BY ROLLUP ("Country")""",
)
def batch_rollup(spark, d):
    runs = ops.with_error_counts(*A.runs_and_errors(spark, d))
    return ops.batch_rollup(runs.withColumn("success", F.col("n_failed") == 0))


REPORT_SQL = A.joined_sql(
    A.RUNS_SQL,
    """shown AS (SELECT "Country", ended_at,
    string_agg("ASIN", ', ' ORDER BY seq, "ASIN") FILTER (outcome = 'F') AS f,
    string_agg("ASIN", ', ' ORDER BY seq, "ASIN") FILTER (outcome = 'P') AS p
  FROM (SELECT *, row_number() OVER (PARTITION BY "Country", ended_at, outcome ORDER BY seq, "ASIN") AS rn
    FROM run_rows) r WHERE rn <= 3 GROUP BY 1, 2)""",
    f"summary AS ({SUMMARY_SQL})",
) + """SELECT s."Execution ID" AS run_id, s.tier, array_to_string(list_filter([repeat('=', 60),
    'Panel ' || r."Country" || ' - ' || s.status,
    'Extracted: ' || r.processed || '/' || r.requested || ' products (' || printf('%.1f', r.processed * 100.0 / r.requested) || '%)',
    repeat('-', 60), 'Finished at: ' || strftime(r.ended_at, '%Y-%m-%d %H:%M'), 'Processing time: ' || s.duration,
    '- Processed ASINs: ' || r.processed, '- Scraping errors: ' || (r.n_failed + r.n_price_ped + r.redirects),
    CASE WHEN r.n_price_ped > 0 THEN '   - Price/PED errors: ' || r.n_price_ped END,
    CASE WHEN r.redirects > 0 THEN '   - Redirected ASINs: ' || r.redirects END,
    CASE WHEN r.n_failed > 0 THEN '- Sample failed ASINs (showing first 3): ' || f END,
    CASE WHEN r.n_price_ped > 0 THEN '- Sample Price/PED errors (showing first 3): ' || p END, repeat('=', 60)],
    lambda x: x IS NOT NULL), chr(10)) AS report
  FROM runs r JOIN summary s ON s."Country" = r."Country" AND s."Date" = strftime(r.ended_at, '%Y-%m-%d')
  LEFT JOIN shown h ON h."Country" = r."Country" AND h.ended_at = r.ended_at"""


@query("run_report", REPORT_SQL)
def run_report(spark, d):
    lines = ops.run_report(*A.runs_and_errors(spark, d))
    # A report has at most 14 lines.
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"])
    return lines.groupBy("run_id", "tier").agg(F.array_join(ordered, "\n").alias("report"))


MESSAGES = {
    "error": "ZIP code mismatch", "view": "Network unreachable", "click": "read Timeout after 10 s",
    "signup": "element not found", "purchase": None,
}
ATTEMPTS_SQL = f"""attempts AS (SELECT strftime(ts, '%Y-%m-%d') AS run, {A.ASIN_SQL.format('user_id')} AS "ASIN",
    event_id AS seq, CASE event_type WHEN 'error' THEN 'zip_error' WHEN 'view' THEN 'network_error'
    WHEN 'click' THEN 'network_error' WHEN 'signup' THEN 'scraping_error' END AS reason FROM events)"""


@query(
    "failure_ledger",
    A.joined_sql(
        ATTEMPTS_SQL,
        """s AS (SELECT run, "ASIN", max(seq) FILTER (reason IS NULL) AS ok_at, max(seq) FILTER (reason IS NOT NULL) AS bad_at
      FROM attempts GROUP BY 1, 2),
    k AS (SELECT run, "ASIN", count(*) AS failures, min_by(reason, seq) AS reason, max_by(reason, seq) AS latest,
      coalesce(any_value(ok_at) > any_value(bad_at), false) AS recovered
      FROM attempts JOIN s USING (run, "ASIN")
      WHERE reason IS NOT NULL AND (ok_at IS NULL OR ok_at > bad_at OR seq > ok_at) GROUP BY 1, 2),
    l AS (SELECT run, "ASIN", reason, failures - 1 AS attempts, CASE WHEN failures > 1 THEN latest END AS last_error,
      CASE WHEN recovered THEN 'recovered' WHEN failures - 1 >= 3 THEN 'permanent' ELSE 'pending' END AS status
      FROM k WHERE failures > 0)""",
    )
    + """SELECT *, CASE WHEN status <> 'pending' THEN NULL
      WHEN reason = 'zip_error' THEN CASE attempts WHEN 0 THEN 'DELAYED' WHEN 1 THEN 'NEW_SESSION' ELSE 'SKIP' END
      WHEN reason = 'network_error' THEN CASE WHEN attempts < 2 THEN 'DELAYED' ELSE 'SKIP' END
      WHEN attempts < 1 THEN 'IMMEDIATE' ELSE 'NEW_SESSION' END AS next_action FROM l""",
)
def failure_ledger(spark, d):
    e = A.table(spark, d, "events")
    kind = F.col("event_type")
    message = F.lit(None).cast("string")
    for event, words in MESSAGES.items():
        if words:
            message = F.when(kind == event, words).otherwise(message)
    attempts = e.select(
        F.date_format("ts", "yyyy-MM-dd").alias("run"),
        A.asin_of(F.col("user_id")).alias("ASIN"),
        F.col("event_id").alias("seq"),
        message.alias("message"),
        (kind == "purchase").alias("ok"),
    )
    return ledger_of(attempts, ["run", "ASIN"])


@query(
    "targets_union",
    A.joined_sql(A.LISTINGS_SQL, A.COMPETITORS_SQL, A.PLACES_SQL)
    + """SELECT u."Country", u."ASIN", 'https://' || domain || '/dp/' || u."ASIN" || '?th=1' AS "Url"
    FROM (SELECT "Country", "ASIN" FROM own UNION SELECT "Country", "ASIN" FROM competitors) u
    JOIN places ON code = u."Country" """,
)
def targets_union(spark, d):
    own = own_asins(A.listing_rows(spark, d))
    return with_product_urls(union_targets(own, A.competitor_rows(spark, d)), A.marketplaces(spark))


ORDER_SQL = """substr(md5("ASIN"), 1, 3), "ASIN\""""


@query(
    "work_batches",
    A.joined_sql(A.COMPETITORS_SQL)
    + f"""SELECT "Country", "ASIN", CAST(ntile(7) OVER (PARTITION BY "Country" ORDER BY {ORDER_SQL}) AS INT) AS batch
    FROM (SELECT DISTINCT "Country", "ASIN" FROM competitors) c""",
)
def work_batches(spark, d):
    return batches_of(A.competitor_rows(spark, d).distinct(), 7)


POSITIONS_SQL = f"""spots AS (SELECT "Country", "ASIN", (rn - 1) // 50 + 1 AS session, CAST((rn - 1) % 50 AS INT) AS session_pos,
    CAST(substr("ASIN", 2) AS BIGINT) AS k FROM (SELECT *, row_number() OVER (PARTITION BY "Country" ORDER BY {ORDER_SQL}) AS rn
    FROM (SELECT DISTINCT "Country", "ASIN" FROM competitors) c) n),
  drawn AS (SELECT "Country", "ASIN", session, session_pos, k FROM spots WHERE session_pos > 0 AND (k * 7919 + 13) % 10000 <
    (CASE "Country" WHEN 'DE' THEN 4000 WHEN 'FR' THEN 2000 WHEN 'IT' THEN 2000 WHEN 'ES' THEN 2000 ELSE 1500 END)
    * CASE WHEN 50 - session_pos <= 10 THEN 2 ELSE 1 END)"""


def _drawn(spark, d):
    rows = session_positions(A.competitor_rows(spark, d).distinct(), 50)
    number = F.substring("ASIN", 2, 9).cast("long")
    return sample_of(rows, 50, draw=(number * 7919 + 13) % 10000)


@query(
    "audit_sample",
    A.joined_sql(A.COMPETITORS_SQL, POSITIONS_SQL) + 'SELECT "Country", "ASIN", session, session_pos FROM drawn',
)
def audit_sample(spark, d):
    return _drawn(spark, d)


@query(
    "check_rate",
    A.joined_sql(A.COMPETITORS_SQL, POSITIONS_SQL)
    + """SELECT "Country", count(*) AS checks, count(*) FILTER (k % 9 = 0) AS failed,
      round((count(*) - count(*) FILTER (k % 9 = 0)) * 100.0 / count(*), 2) AS success_rate FROM drawn GROUP BY 1""",
)
def check_rate(spark, d):
    number = F.substring("ASIN", 2, 9).cast("long")
    return check_rates(_drawn(spark, d), ["Country"], number % 9 == 0)


@query(
    "listings_distinct",
    A.joined_sql(A.LISTINGS_SQL)
    + """SELECT sales_country AS "Country", count(DISTINCT asin) AS asins, count(DISTINCT asin || '|' || sku) AS pairs
    FROM listings WHERE status = 'Active' AND asin IS NOT NULL GROUP BY 1""",
)
def listings_distinct(spark, d):
    listings = A.listing_rows(spark, d)
    pairs = active_listings(listings).distinct().groupBy("Country").agg(F.count("*").alias("pairs"))
    keys = own_asins(listings).groupBy("Country").agg(F.count("*").alias("asins"))
    return keys.join(pairs, "Country").select("Country", "asins", "pairs")


SYMBOLS = ["$", "£", " € ", "eur", "GBP", "", None, "R$", "usd"]


@query(
    "currency_check",
    f"""WITH c AS (SELECT list_extract([{', '.join(f"'{c}'" for c in A.CODES)}, 'BR'], CAST(c_custkey % 9 AS INT) + 1) AS "Country",
      list_extract(['$', '£', ' € ', 'eur', 'GBP', '', NULL, 'R$', 'usd'], CAST(c_nationkey % 9 AS INT) + 1) AS symbol,
      c_acctbal > 0 AS has_price FROM customer),
    n AS (SELECT *, CASE WHEN symbol IS NULL OR trim(symbol) = '' THEN NULL WHEN upper(trim(symbol)) IN ('USD', 'CAD', 'MXN') THEN '$'
      WHEN upper(trim(symbol)) = 'GBP' THEN '£' WHEN upper(trim(symbol)) = 'EUR' THEN '€' ELSE trim(symbol) END AS found,
      CASE WHEN "Country" IN ('US', 'CA', 'MX') THEN '$' WHEN "Country" = 'GB' THEN '£'
        WHEN "Country" IN ('DE', 'FR', 'IT', 'ES') THEN '€' END AS expected FROM c),
    v AS (SELECT *, CASE WHEN expected IS NULL THEN 'unmapped' WHEN found = expected THEN 'ok' WHEN found IS NOT NULL THEN 'wrong'
      WHEN has_price THEN 'missing_priced' ELSE 'missing_unpriced' END AS verdict FROM n)
    SELECT "Country", verdict, verdict IN ('ok', 'missing_unpriced', 'unmapped') AS valid, count(*) AS n FROM v GROUP BY ALL""",
)
def currency_check(spark, d):
    c = A.table(spark, d, "customer")
    country = F.get(F.array(*[F.lit(x) for x in [*A.CODES, "BR"]]), (F.col("c_custkey") % 9).cast("int"))
    symbol = F.get(F.array(*[F.lit(x) for x in SYMBOLS]), (F.col("c_nationkey") % 9).cast("int"))
    rows = c.select(country.alias("Country"), symbol.alias("symbol"), (F.col("c_acctbal") > 0).alias("has_price"))
    verdict = currency_verdict(F.col("Country"), F.col("symbol"), F.col("has_price"))
    judged = rows.select("Country", verdict.alias("verdict"))
    return judged.groupBy("Country", "verdict", currency_is_valid(F.col("verdict")).alias("valid")).agg(
        F.count("*").alias("n")
    )


PLACE_TEXTS = ["London W2 4", "Berlin 10115", "Brazil", "Berlin", "", None, "New York 10001", "A1A 1A1", "Roma 00161 ", "x 75001 y z"]
PLACE_LIST_SQL = ", ".join("NULL" if p is None else f"'{p}'" for p in PLACE_TEXTS)


@query(
    "region_check",
    A.joined_sql(
        A.PLACES_SQL,
        f"""c AS (SELECT {A.CODE_SQL.format('c_custkey')} AS code, list_extract([{PLACE_LIST_SQL}], CAST(c_nationkey % 10 AS INT) + 1)
      AS loc FROM customer),
    t AS (SELECT code, lower(coalesce(trim(loc), '')) AS loc, lower(zip_code) AS z,
      regexp_extract_all(lower(coalesce(loc, '')), '[a-z0-9]+') AS runs FROM c JOIN places USING (code)),
    v AS (SELECT code, loc, loc <> '' AND NOT contains(loc, 'brazil') AND (
      (len(runs) > 0 AND starts_with(regexp_replace(z, '[^a-z0-9]', '', 'g'),
        CASE WHEN len(runs) > 1 THEN runs[len(runs) - 1] || runs[len(runs)] ELSE runs[1] END))
      OR contains(loc, z) OR (regexp_matches(loc, '\\b[0-9]{{5}}\\b') AND contains(z, regexp_extract(loc, '\\b[0-9]{{5}}\\b')))) AS ok FROM t)""",
    )
    + """SELECT code AS "Country", loc AS location, ok AS valid, count(*) AS n FROM v GROUP BY ALL""",
)
def region_check(spark, d):
    c = A.table(spark, d, "customer").select(
        A.code_of(F.col("c_custkey")).alias("Country"),
        F.get(F.array(*[F.lit(p) for p in PLACE_TEXTS]), (F.col("c_nationkey") % 10).cast("int")).alias("loc"),
    )
    judged = c.join(dimension(A.marketplaces(spark), "zip_code"), "Country").select(
        "Country",
        F.lower(F.coalesce(F.trim("loc"), F.lit(""))).alias("location"),
        region_is_valid(F.col("loc"), F.col("zip_code")).alias("valid"),
    )
    return judged.groupBy("Country", "location", "valid").agg(F.count("*").alias("n"))
