"""Audit of the panel."""

from pyspark.sql import functions as F

from shelfpanel.functions.dates import event_text
from shelfpanel.operators import audit_checks as checks
from shelfpanel.operators.history import history_flags as flags_of
from shelfpanel.operators.history import recent_against_history
from shelfpanel.operators.keys import price_errors as errors_of
from shelfpanel.operators.outliers import iqr_outliers as outliers_of
from shelfpanel.plans.audit import audit_panel
from workload import adapters as A

QUERIES, ORACLES = {}, {}
TEXTS = ["Price", "List Price", "PED", "Number of ratings", "Rating Stars", "Name", "Brand", "Size Name", "Link",
         "Product Category"]
ESSENTIAL = ["Date", "ASIN", "Link", "Country", "Name", "Brand", "Price", "Product Category", "PED"]
PANEL = A.joined_sql(A.PANEL_SQL)


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query(
    "panel_dup_count",
    PANEL + """SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows, count(*) AS duplicate_keys
    FROM (SELECT count(*) AS n FROM panel GROUP BY "Country", "ASIN", "Date" HAVING count(*) > 1) g""",
)
def panel_dup_count(spark, d):
    return checks.duplicate_rows(A.price_panel(spark, d))


@query(
    "date_profile",
    PANEL + """SELECT strftime(min("Date"), '%Y-%m-%d') AS first_date, strftime(max("Date"), '%Y-%m-%d') AS last_date,
      CAST(date_diff('day', min("Date"), max("Date")) AS INT) AS span_days, count(DISTINCT "Date") AS dates,
      count(*) FILTER ("Date" IS NULL) AS invalid_dates FROM panel""",
)
def date_profile(spark, d):
    profile = checks.date_profile(A.price_panel(spark, d))
    return profile.withColumns({c: event_text(F.col(c)) for c in ("first_date", "last_date")})


@query(
    "sentinel_ratio",
    PANEL + "SELECT CAST(sum("
    + " + ".join(f"""CASE WHEN "{c}" = 'Not Found' THEN 1 ELSE 0 END""" for c in TEXTS)
    + ") AS BIGINT) AS sentinels, count(*) * 14 AS cells, round(CAST(sum("
    + " + ".join(f"""CASE WHEN "{c}" = 'Not Found' THEN 1 ELSE 0 END""" for c in TEXTS)
    + ") AS DOUBLE) / (count(*) * 14), 6) AS ratio, CAST(sum("
    + " + ".join(f"""CASE WHEN "{c}" = 'Not Found' THEN 1 ELSE 0 END""" for c in TEXTS)
    + ") AS DOUBLE) / (count(*) * 14) > 0.3 AS alert FROM panel",
)
def sentinel_ratio(spark, d):
    return checks.sentinel_ratio(A.price_panel(spark, d)).withColumn("ratio", F.round("ratio", 6))


@query(
    "escape_scan",
    PANEL + """, hits AS (SELECT "Country", "ASIN", "Date", 'Size Name' AS "column", "Size Name" AS value FROM panel
      WHERE regexp_matches("Size Name", '\\\\{4,}')
      UNION ALL SELECT "Country", "ASIN", "Date", 'Name', "Name" FROM panel WHERE regexp_matches("Name", '\\\\{4,}')),
    firsts AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY "Country", "ASIN", "Date", value) AS rn
      FROM hits)
    SELECT "column", (SELECT count(*) FROM hits h WHERE h."column" = f."column") AS rows,
      string_agg(value, ' | ' ORDER BY rn) AS examples FROM firsts f WHERE rn <= 2 GROUP BY 1""",
)
def escape_scan(spark, d):
    return checks.escape_scan(A.price_panel(spark, d))


@query(
    "missing_counts",
    PANEL + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column",
        count(*) FILTER ("{c}" IS NULL OR trim(CAST("{c}" AS VARCHAR)) = '') AS missing,
        count(*) FILTER (trim(CAST("{c}" AS VARCHAR)) = 'Not Found') AS not_found FROM panel"""
        for c in ESSENTIAL
    ),
)
def missing_counts(spark, d):
    return checks.missing_counts(A.price_panel(spark, d))


RATING, COUNT = A.number_sql('"Rating Stars"'), A.number_sql('"Number of ratings"')


@query(
    "range_rules",
    PANEL + f"""SELECT 'rating_out_of_range' AS rule, count(*) FILTER ({RATING} < 0 OR {RATING} > 5) AS rows FROM panel
    UNION ALL SELECT 'negative_rating_count', count(*) FILTER ({COUNT} < 0) FROM panel
    UNION ALL SELECT 'size_name_escape', count(*) FILTER (contains("Size Name", '\\\\')) FROM panel""",
)
def range_rules(spark, d):
    return checks.range_rules(A.price_panel(spark, d))


@query(
    "row_size",
    # Length of the row as stored text: each of the 14 cells in quotes with a mark after it, quotes inside doubled.
    PANEL + """SELECT count(*) AS rows, round(avg(strlen("Country") + strlen("ASIN") + 10 + strlen(CAST(seq AS VARCHAR))
      + strlen("Price") + strlen("List Price") + strlen("PED") + strlen("Number of ratings") + strlen("Rating Stars")
      + coalesce(strlen(replace("Name", '"', '""')), 0) + strlen("Brand") + strlen("Size Name")
      + strlen("Link") + strlen("Product Category") + 14 * 3), 3) AS avg_bytes, false AS alert FROM panel""",
)
def row_size(spark, d):
    return checks.row_size(A.price_panel(spark, d)).withColumn("avg_bytes", F.round("avg_bytes", 3))


OUTLIERS_SQL = (
    "vals AS ("
    + " UNION ALL ".join(
        f"""SELECT "Country", '{c}' AS "column", {A.number_sql(f'"{c}"')} AS v FROM panel"""
        for c in ("Price", "List Price", "Number of ratings", "PED")
    )
    + """), fences AS (SELECT "Country", "column", q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
    FROM (SELECT "Country", "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM vals
      WHERE v IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 20) q),
    outside AS (SELECT v."Country", v."column", round(lower, 6) AS lower, round(upper, 6) AS upper,
      count(*) AS outliers, min(v.v) AS min_outlier, max(v.v) AS max_outlier
      FROM vals v JOIN fences f ON v."Country" = f."Country" AND v."column" = f."column"
      WHERE v.v < f.lower OR v.v > f.upper GROUP BY 1, 2, 3, 4)"""
)


@query("iqr_outliers", PANEL + ", " + OUTLIERS_SQL + " SELECT * FROM outside")
def iqr_outliers(spark, d):
    found = outliers_of(A.price_panel(spark, d))
    return found.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


COMPARED_SQL = f"""nums AS (SELECT "Country", "ASIN", "Date", {A.number_sql('"Price"')} AS price,
    {A.number_sql('"Number of ratings"')} AS ratings, {A.number_sql('"PED"')} AS ped FROM panel),
  means AS (SELECT "Country", "ASIN", avg(price) AS avg_price, avg(ratings) AS avg_ratings, avg(ped) AS avg_ped
    FROM nums WHERE "Date" < (SELECT max("Date") FROM nums) GROUP BY 1, 2),
  compared AS (SELECT n.*, avg_price, avg_ratings, avg_ped FROM nums n
    JOIN means m ON n."Country" = m."Country" AND n."ASIN" = m."ASIN"
    WHERE n."Date" = (SELECT max("Date") FROM nums))"""
FLAGS_SQL = """flags AS (
    SELECT 'rating_drop' AS flag, "Country", "ASIN" FROM compared WHERE ratings < avg_ratings
    UNION ALL SELECT 'price_jump', "Country", "ASIN" FROM compared
    WHERE price > avg_price * 1.5 OR price < avg_price * 0.5)"""


@query(
    "history_means",
    PANEL + f""", {COMPARED_SQL} SELECT "Country", "ASIN", price, ratings, ped, round(avg_price, 4) AS avg_price,
      round(avg_ratings, 4) AS avg_ratings, round(avg_ped, 4) AS avg_ped, count(*) AS rows
    FROM compared GROUP BY ALL""",
)
def history_means(spark, d):
    compared = recent_against_history(A.price_panel(spark, d))
    return compared.withColumns({f"avg_{c}": F.round(f"avg_{c}", 4) for c in ("price", "ratings", "ped")})


@query(
    "history_flags",
    PANEL + f""", {COMPARED_SQL}, {FLAGS_SQL}
    SELECT flag, count(*) AS rows, min(struct_pack(c := "Country", a := "ASIN")).c AS example_country,
      min(struct_pack(c := "Country", a := "ASIN")).a AS example_asin FROM flags GROUP BY 1""",
)
def history_flags(spark, d):
    return flags_of(A.price_panel(spark, d))


def _card(category: str, item: str, count: str, source: str, detail: str = "''") -> str:
    return (
        f"SELECT '{category}' AS category, {item} AS item, 'warning' AS severity, CAST({count} AS BIGINT) AS \"count\", "
        f"{detail} AS detail FROM {source}"
    )


SCORE_SQL = " UNION ALL ".join(
    [
        _card("missing", f"'{c}'", f"""count(*) FILTER ("{c}" IS NULL OR trim(CAST("{c}" AS VARCHAR)) = '')""", "panel")
        for c in ESSENTIAL
    ]
    + [
        _card("not_found", f"'{c}'", f"""count(*) FILTER (trim(CAST("{c}" AS VARCHAR)) = 'Not Found')""", "panel")
        for c in ESSENTIAL
    ]
    + [
        _card("range_rule", "'rating_out_of_range'", f"count(*) FILTER ({RATING} < 0 OR {RATING} > 5)", "panel"),
        _card("range_rule", "'size_name_escape'", """count(*) FILTER (contains("Size Name", '\\\\'))""", "panel"),
        _card("escapes", "'Size Name'", """count(*) FILTER (regexp_matches("Size Name", '\\\\{4,}'))""", "panel"),
        _card(
            "duplicates", "'Country, ASIN, Date'", "coalesce(sum(n), 0)",
            '(SELECT count(*) AS n FROM panel GROUP BY "Country", "ASIN", "Date" HAVING count(*) > 1) g',
        ),
        _card(
            "outliers", """"Country" || '/' || "column\"""", "outliers", "outside",
            "concat_ws(' ', " + ", ".join(f"printf('%.2f', {c})" for c in ("min_outlier", "max_outlier")) + ")",
        ),
        """SELECT 'history', flag, 'warning', count(*), min(struct_pack(c := "Country", a := "ASIN")).c || '/'
          || min(struct_pack(c := "Country", a := "ASIN")).a FROM flags GROUP BY flag""",
    ]
)


@query(
    "audit_scorecard",
    PANEL + f", {OUTLIERS_SQL}, {COMPARED_SQL}, {FLAGS_SQL} SELECT * FROM ({SCORE_SQL}) s WHERE \"count\" > 0",
)
def audit_scorecard(spark, d):
    # The fences, which end the detail of an outlier, can lie midway between two cents; iqr_outliers compares them.
    found = audit_panel(A.price_panel(spark, d))
    seen = F.when(F.col("category") == "outliers", F.substring_index("detail", " ", 2)).otherwise(F.col("detail"))
    return found.withColumn("detail", seen)


@query(
    "numeric_coerce",
    PANEL + f"""SELECT "Country", count({A.number_sql('"Price"')}) AS prices, count({A.number_sql('"PED"')}) AS member_prices,
      round(sum({A.number_sql('"Price"')}), 2) AS price_sum, round(max({A.number_sql('"List Price"')}), 2) AS max_list
    FROM panel GROUP BY 1""",
)
def numeric_coerce(spark, d):
    from shelfpanel.functions.numbers import to_number

    price, ped, listed = (to_number(F.col(f"`{c}`")) for c in ("Price", "PED", "List Price"))
    return A.price_panel(spark, d).groupBy("Country").agg(
        F.count(price).alias("prices"),
        F.count(ped).alias("member_prices"),
        F.round(F.sum(price), 2).alias("price_sum"),
        F.round(F.max(listed), 2).alias("max_list"),
    )


@query(
    "price_errors",
    PANEL + """SELECT "Country", count(*) AS rows, count(DISTINCT "ASIN") AS asins FROM panel
    WHERE ("Price" IS NULL OR trim("Price") IN ('', 'Not Found')) AND ("PED" IS NULL OR trim("PED") IN ('', 'Not Found'))
    GROUP BY 1""",
)
def price_errors(spark, d):
    rows = errors_of(A.price_panel(spark, d))
    return rows.groupBy("Country").agg(
        F.count("*").alias("rows"), F.count_distinct("ASIN").alias("asins")
    )
