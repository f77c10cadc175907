"""Cleaning of single fields, keys and links."""

from pyspark.sql import functions as F

from shelfpanel.functions import addresses, dates, numbers, text
from shelfpanel.operators.keys import correct_redirects, unknown_countries
from shelfpanel.sources.marketplaces import dimension, merge_maps
from workload import adapters as A

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


BACKSLASHES = "\\" * 3
ZERO_WIDTH, HARD_SPACE = "\u200b", "\u00a0"


def junk_sql(column: str) -> str:
    return (
        f"replace(replace(replace({column}, ', ', ',' || chr(9) || '\"' || chr(160)), ' de ', ' {BACKSLASHES}de' || chr(8203) || ' '), "
        f"'. ', chr(13) || '.  ')"
    )


def junk(c):
    """Documents carry few control characters; put some at common places."""
    c = F.replace(c, F.lit(", "), F.lit(',\t"' + HARD_SPACE))
    c = F.replace(c, F.lit(" de "), F.lit(" \\\\\\de" + ZERO_WIDTH + " "))
    return F.replace(c, F.lit(". "), F.lit("\r.  "))


# The same code points as in the library, as a class for the SQL side.
INVISIBLES = r"[\x{FFFD}\x{FEFF}\x{200B}-\x{200F}\x{AD}]"
LOCATION_INVISIBLES = r"[\x{200B}-\x{200F}\x{202A}-\x{202E}\x{FEFF}]"
CLEAN_SQL = (
    f"trim(replace(regexp_replace(translate(regexp_replace(raw, '{INVISIBLES}', '', 'g'), "
    f"chr(10) || chr(9) || chr(13), '  '), '{A.BLANKS}+', ' ', 'g'), '\"', ''''))"
)
FINAL_SQL = (
    "regexp_replace(translate(regexp_replace(raw, '\\\\{2,}', '\\\\', 'g'), chr(13) || chr(10), '  '), "
    f"'^{A.BLANKS}+|{A.BLANKS}+$', '', 'g')"
)


@query(
    "text_clean",
    f"""WITH d AS (SELECT doc_id, {junk_sql('text')} AS raw FROM documents)
    SELECT doc_id, md5({CLEAN_SQL}) AS clean_md5, length({CLEAN_SQL}) AS clean_chars,
      md5({FINAL_SQL}) AS final_md5, length({FINAL_SQL}) AS final_chars FROM d""",
)
def text_clean(spark, d):
    raw = junk(F.col("text"))
    clean, final = text.clean_text(raw), text.final_clean(raw)
    return A.table(spark, d, "documents").select(
        "doc_id",
        F.md5(clean).alias("clean_md5"),
        F.length(clean).cast("long").alias("clean_chars"),
        F.md5(final).alias("final_md5"),
        F.length(final).cast("long").alias("final_chars"),
    )


NUMBER_TEXTS = {
    "money": "CASE WHEN k % 6 = 0 THEN 'none' ELSE CAST(CAST(floor(k / 1000) AS BIGINT) AS VARCHAR) || ',' "
    "|| lpad(CAST(k % 1000 AS VARCHAR), 3, '0') || '.50 x' END",
    "count": "CASE WHEN k % 7 = 0 THEN 'none' ELSE CAST(CAST(floor(k / 1000) AS BIGINT) AS VARCHAR) || '.' "
    "|| lpad(CAST(k % 1000 AS VARCHAR), 3, '0') || ' ratings' END",
    "rating": "CAST(k % 5 AS VARCHAR) || ',' || CAST(k % 10 AS VARCHAR) || ' von 5 Sternen'",
    "whole": "CASE WHEN k % 8 > 0 THEN CAST(CAST(floor(k / 1000) AS BIGINT) AS VARCHAR) || ',' "
    "|| lpad(CAST(k % 1000 AS VARCHAR), 3, '0') END",
}
NUMBER_ROWS = "n AS (SELECT k, " + ", ".join(f'{v} AS "{n}"' for n, v in NUMBER_TEXTS.items()) + (
    " FROM (SELECT o_orderkey AS k FROM orders) o)"
)


@query(
    "numeric_extract",
    f"""WITH {NUMBER_ROWS}
    SELECT k AS o_orderkey,
      coalesce(nullif(regexp_extract(replace("money", ',', ''), '[0-9]+\\.?[0-9]*'), ''), 'Not Found') AS money,
      coalesce(nullif(regexp_extract(replace(replace("count", ',', ''), '.', ''), '[0-9]+'), ''), 'Not Found') AS ratings,
      coalesce(nullif(regexp_extract(replace("rating", ',', '.'), '[0-9]+\\.?[0-9]*'), ''), 'Not Found') AS rating,
      coalesce(replace("whole" || '.99', ',', ''), 'Not Found') AS price FROM n""",
)
def numeric_extract(spark, d):
    texts = {n: v.replace("VARCHAR", "STRING") for n, v in NUMBER_TEXTS.items()}
    n = A.table(spark, d, "orders").select(F.col("o_orderkey").alias("k")).select(
        "k", *[F.expr(v).alias(name) for name, v in texts.items()]
    )
    return n.select(
        F.col("k").alias("o_orderkey"),
        numbers.first_number(F.col("money")).alias("money"),
        numbers.count_digits(F.col("count")).alias("ratings"),
        numbers.rating_number(F.col("rating")).alias("rating"),
        numbers.price_text(F.col("whole"), F.lit("99")).alias("price"),
    )


@query(
    "category_split",
    """WITH p AS (SELECT p_partkey, p_brand || ' ›' || p_type || '›' || p_name AS category,
      lower(p_type) || '_' || replace(p_name, ' ', '_') || '_o''neil''s_display_on_website' AS grp,
      ' #' || CAST(p_partkey AS VARCHAR) || ' in ' || p_type || ' (See Top 100) (x)' AS bsr FROM part)
    SELECT p_partkey, trim(split_part(category, '›', 1)) AS root_category,
      replace(category, '›', ' › ') AS category,
      array_to_string(list_transform(regexp_extract_all(replace(replace(grp, '_display_on_website', ''), '_', ' '),
        '[a-zA-Z]+|[^a-zA-Z]+'), lambda x: upper(x[1]) || lower(x[2:])), '') AS display_name,
      trim(split_part(bsr, ' (', 1)) AS bsr FROM p""",
)
def category_split(spark, d):
    p = A.table(spark, d, "part")
    category = F.concat("p_brand", F.lit(" ›"), "p_type", F.lit("›"), "p_name")
    group = F.concat(
        F.lower("p_type"), F.lit("_"), F.replace("p_name", F.lit(" "), F.lit("_")),
        F.lit("_o'neil's_display_on_website"),
    )
    bsr = F.concat(F.lit(" #"), F.col("p_partkey").cast("string"), F.lit(" in "), "p_type", F.lit(" (See Top 100) (x)"))
    return p.select(
        "p_partkey",
        text.root_category(category).alias("root_category"),
        text.spaced_category(category).alias("category"),
        text.display_name(group).alias("display_name"),
        text.rank_line(bsr).alias("bsr"),
    )


COUPONS = ["Coupon: Save 5% | Terms", "", "Extra: Save: 7%", "Save\n9% ", " | only terms", "Coupon: "]


@query(
    "coupon_clean",
    "WITH c AS (SELECT event_id, list_extract(["
    + ", ".join("'" + c.replace("\n", "' || chr(10) || '") + "'" for c in COUPONS)
    + """], CAST(event_id % 6 AS INT) + 1) || CASE WHEN event_id % 6 < 3 AND event_id % 6 <> 1 THEN event_type ELSE '' END AS raw
      FROM events), o AS (SELECT event_id, string_split(split_part(raw, '|', 1), ':') AS parts FROM c)
    SELECT event_id, coalesce(nullif(trim(regexp_replace(list_extract(parts, -1), '[\r\n]+', ' ', 'g')), ''), 'Not Found')
      AS coupon FROM o""",
)
def coupon_clean(spark, d):
    e = A.table(spark, d, "events")
    i = F.col("event_id") % 6
    raw = F.concat(
        F.get(F.array(*[F.lit(c) for c in COUPONS]), i.cast("int")),
        F.when((i < 3) & (i != 1), F.col("event_type")).otherwise(""),
    )
    return e.select("event_id", text.coupon_text(raw).alias("coupon"))


PED_SQL = """CASE l_linenumber % 4 WHEN 0 THEN 'Join Prime to buy this item at $' || member
      WHEN 1 THEN 'Exclusive Prime price' WHEN 2 THEN 'This price is exclusively for Amazon Prime members.'
      ELSE 'Not Found' END"""


@query(
    "prime_price",
    f"""WITH l AS (SELECT l_partkey, {PED_SQL} AS ped, price, listed FROM (SELECT l_partkey, l_linenumber,
      CAST(CAST(l_quantity AS INT) AS VARCHAR) || '.99' AS member, CAST(CAST(l_quantity AS INT) + 5 AS VARCHAR) || '.99' AS price,
      CAST(CAST(l_quantity AS INT) + 9 AS VARCHAR) || '.99' AS listed FROM lineitem) x),
    r AS (SELECT l_partkey, CASE WHEN contains(ped, 'Join Prime') THEN regexp_extract(ped, '[0-9].*') ELSE price END AS price,
      CASE WHEN contains(ped, 'Join Prime') THEN price ELSE listed END AS listed,
      CASE WHEN contains(ped, 'Join Prime') THEN regexp_extract(ped, '[0-9].*')
        WHEN ped = 'Not Found' THEN ped ELSE price END AS ped FROM l)
    SELECT l_partkey, price AS "Price", ped AS "PED", listed AS "List Price", count(*) AS n FROM r GROUP BY ALL""",
)
def prime_price(spark, d):
    qty = F.col("l_quantity").cast("int")

    def money(extra):
        return F.concat((qty + extra).cast("string"), F.lit(".99"))

    kind = F.col("l_linenumber") % 4
    ped = (
        F.when(kind == 0, F.concat(F.lit("Join Prime to buy this item at $"), money(0)))
        .when(kind == 1, "Exclusive Prime price")
        .when(kind == 2, "This price is exclusively for Amazon Prime members.")
        .otherwise("Not Found")
    )
    rows = A.table(spark, d, "lineitem").select(
        "l_partkey", ped.alias("ped"), money(5).alias("price"), money(9).alias("listed")
    )
    fixed = numbers.reconcile_prime(F.col("price"), F.col("ped"), F.col("listed"))
    return (
        rows.select("l_partkey", *[c.alias(n) for n, c in fixed.items()])
        .groupBy("l_partkey", "Price", "PED", "List Price")
        .agg(F.count("*").alias("n"))
    )


@query(
    "redirect_fix",
    f"""WITH l AS (SELECT {A.ASIN_SQL.format('l_partkey')} AS a, CASE l_linenumber
        WHEN 1 THEN {A.ASIN_SQL.format('l_partkey + 1')} WHEN 2 THEN ' ' || {A.ASIN_SQL.format('l_partkey')} || ' '
        WHEN 3 THEN lower({A.ASIN_SQL.format('l_partkey')}) WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'Not Found'
        ELSE {A.ASIN_SQL.format('l_partkey')} END AS page FROM lineitem),
    v AS (SELECT a, trim(page) AS page, coalesce(regexp_matches(trim(page), '^[A-Z0-9]{{10}}$'), false) AS ok FROM l),
    f AS (SELECT CASE WHEN ok THEN page ELSE a END AS "ASIN", ok AND page <> a AS redirected, NOT ok AS page_invalid FROM v)
    SELECT "ASIN", 'https://shop.example/dp/' || "ASIN" AS "Link", redirected, page_invalid, count(*) AS n
    FROM f GROUP BY ALL""",
)
def redirect_fix(spark, d):
    key = A.asin_of(F.col("l_partkey"))
    no = F.col("l_linenumber")
    page = (
        F.when(no == 1, A.asin_of(F.col("l_partkey") + 1))
        .when(no == 2, F.concat(F.lit(" "), key, F.lit(" ")))
        .when(no == 3, F.lower(key))
        .when(no == 4, "")
        .when(no == 5, F.lit(None).cast("string"))
        .when(no == 6, "Not Found")
        .otherwise(key)
    )
    rows = A.table(spark, d, "lineitem").select(key.alias("ASIN"), page.alias("ASIN Product Page"))
    fixed = correct_redirects(rows)
    link = addresses.product_url(F.lit("https://shop.example/dp/"), F.col("ASIN"))
    return fixed.groupBy("ASIN", link.alias("Link"), "redirected", "page_invalid").agg(
        F.count("*").alias("n")
    )


@query(
    "asin_from_url",
    f"""WITH p AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url || '/dp/' || {A.ASIN_SQL.format('page_id')} || '?th=1'
      ELSE url END AS url, CASE WHEN page_id % 3 = 0 THEN {A.ASIN_SQL.format('page_id + 1')} END AS seen FROM pages)
    SELECT page_id, coalesce(nullif(regexp_extract(url, '/dp/([A-Z0-9]{{10}})', 1), ''), seen, 'Not Found') AS asin FROM p""",
)
def asin_from_url(spark, d):
    n = F.col("page_id")
    url = F.when(
        n % 2 == 0, F.concat("url", F.lit("/dp/"), A.asin_of(n), F.lit("?th=1"))
    ).otherwise(F.col("url"))
    seen = F.when(n % 3 == 0, A.asin_of(n + 1))
    return A.table(spark, d, "pages").select("page_id", addresses.asin_from_url(url, seen).alias("asin"))


@query(
    "date_created",
    """WITH o AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%B %-d, %Y')
      WHEN 1 THEN strftime(o_orderdate, '%-d %B %Y') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 3 THEN strftime(o_orderdate, '%-d %b %Y') WHEN 4 THEN strftime(o_orderdate, '%-d. Monat %Y')
      ELSE 'Not Found' END AS t FROM orders)
    SELECT o_orderkey, coalesce(strftime(coalesce(try_strptime(t, '%B %d, %Y'), try_strptime(t, '%d %B %Y'),
      try_strptime(t, '%Y-%m-%d'), try_strptime(t, '%d %b %Y')), '%m/%d/%Y'), 'Not Found') AS "Date Created" FROM o""",
)
def date_created(spark, d):
    k, day = F.col("o_orderkey") % 6, F.col("o_orderdate")
    raw = (
        F.when(k == 0, F.date_format(day, "MMMM d, yyyy"))
        .when(k == 1, F.date_format(day, "d MMMM yyyy"))
        .when(k == 2, F.date_format(day, "yyyy-MM-dd"))
        .when(k == 3, F.date_format(day, "d MMM yyyy"))
        .when(k == 4, F.concat(F.date_format(day, "d"), F.lit(". Monat "), F.date_format(day, "yyyy")))
        .otherwise("Not Found")
    )
    return A.table(spark, d, "orders").select(
        "o_orderkey", dates.date_created(raw).alias("Date Created")
    )


@query(
    "bsr_split",
    """WITH p AS (SELECT p_partkey, string_split('#' || CAST(p_partkey AS VARCHAR) || ' in ' || p_type
      || CASE WHEN p_size % 4 > 0 THEN chr(10) || ' #' || CAST(p_size AS VARCHAR) || ' in ' || p_brand ELSE '' END
      || CASE WHEN p_size % 4 > 1 THEN chr(10) || '#7 in ' || p_name || ' ' ELSE '' END
      || CASE WHEN p_size % 4 > 2 THEN chr(10) || '#8 in Other' ELSE '' END, chr(10)) AS l FROM part)
    SELECT p_partkey, coalesce(trim(l[1]), 'Not Found') AS "BSR 1", coalesce(trim(l[2]), 'Not Found') AS "BSR 2",
      coalesce(trim(l[3]), 'Not Found') AS "BSR 3" FROM p""",
)
def bsr_split(spark, d):
    size = F.col("p_size")

    def more(n, *parts):
        return F.when(size % 4 > n, F.concat(F.lit("\n"), *parts)).otherwise("")

    block = F.concat(
        F.lit("#"), F.col("p_partkey").cast("string"), F.lit(" in "), "p_type",
        more(0, F.lit(" #"), size.cast("string"), F.lit(" in "), F.col("p_brand")),
        more(1, F.lit("#7 in "), F.col("p_name"), F.lit(" ")),
        more(2, F.lit("#8 in Other")),
    )
    lines = text.rank_lines(block)
    return A.table(spark, d, "part").select(
        "p_partkey", *[c.alias(f"BSR {i + 1}") for i, c in enumerate(lines)]
    )


@query(
    "brand_strip",
    A.joined_sql(A.PLACES_SQL)
    + f"""SELECT s_suppkey, code AS "Country", s_name AS "Brand", CAST(s_nationkey AS VARCHAR) || '_tools' AS category_gl
    FROM (SELECT *, {A.CODE_SQL.format('s_nationkey')} AS code FROM supplier) s JOIN places USING (code)""",
)
def brand_strip(spark, d):
    s = A.table(spark, d, "supplier").withColumn("Country", A.code_of(F.col("s_nationkey")))
    joined = s.join(dimension(A.marketplaces(spark), "brand_prefix", "brand_suffix"), "Country")
    shown = F.concat("brand_prefix", "s_name", "brand_suffix")
    gl = F.concat(F.lit("gl_"), F.col("s_nationkey").cast("string"), F.lit("_tools"))
    return joined.select(
        "s_suppkey", "Country",
        text.strip_brand(shown, F.col("brand_prefix"), F.col("brand_suffix")).alias("Brand"),
        text.category_code(gl).alias("category_gl"),
    )


@query(
    "unknown_country",
    A.joined_sql(A.PLACES_SQL)
    + """SELECT c."Country", count(*) AS customers FROM (SELECT list_extract(['US', 'CA', 'GB', 'DE', 'FR', 'IT', 'ES', 'MX',
      'BR', NULL], CAST(c_nationkey % 10 AS INT) + 1) AS "Country" FROM customer) c
    WHERE NOT EXISTS (SELECT 1 FROM places p WHERE p.code = c."Country") GROUP BY 1""",
)
def unknown_country(spark, d):
    codes = F.array(*[F.lit(c) for c in [*A.CODES, "BR", None]])
    rows = A.table(spark, d, "customer").select(
        F.get(codes, (F.col("c_nationkey") % 10).cast("int")).alias("Country")
    )
    rejected = unknown_countries(rows, A.marketplaces(spark))
    return rejected.groupBy("Country").agg(F.count("*").alias("customers"))


@query(
    "search_url",
    A.joined_sql(A.PLACES_SQL)
    + """SELECT p_partkey, 'https://' || domain || '/s?k=' || replace(url_encode(p_name || ' & ~*é ' || p_brand), '%20', '+')
      AS url FROM part JOIN places ON places.code = CASE WHEN p_size % 2 = 0 THEN 'US' ELSE 'DE' END""",
)
def search_url(spark, d):
    p = A.table(spark, d, "part").withColumn(
        "Country", F.when(F.col("p_size") % 2 == 0, "US").otherwise("DE")
    )
    keyword = F.concat("p_name", F.lit(" & ~*é "), "p_brand")
    return p.join(dimension(A.marketplaces(spark), "domain"), "Country").select(
        "p_partkey", addresses.search_url(F.col("domain"), keyword).alias("url")
    )


@query(
    "marketplace_config",
    """WITH s AS (SELECT s_suppkey, s_name, s_nationkey FROM supplier)
    SELECT s_suppkey, 'title' AS rule, 'ID' AS "by", 'title' AS value FROM s
    UNION ALL SELECT s_suppkey, 'price', 'CSS', 'price-' || CAST(s_nationkey AS VARCHAR) FROM s
    UNION ALL SELECT s_suppkey, 'deal', 'ID', s_name FROM s WHERE s_nationkey % 2 = 0""",
)
def marketplace_config(spark, d):
    def selector(by, value):
        return F.array(F.struct(F.lit(by).alias("by"), value.alias("value")))

    s = A.table(spark, d, "supplier")
    defaults = F.create_map(
        F.lit("title"), selector("ID", F.lit("title")), F.lit("price"), selector("ID", F.lit("price"))
    )
    own_price = selector("CSS", F.concat(F.lit("price-"), F.col("s_nationkey").cast("string")))
    overrides = F.when(
        F.col("s_nationkey") % 2 == 0,
        F.create_map(F.lit("price"), own_price, F.lit("deal"), selector("ID", F.col("s_name"))),
    ).otherwise(F.create_map(F.lit("price"), own_price))
    merged = s.select("s_suppkey", F.explode(merge_maps(defaults, overrides)).alias("rule", "selectors"))
    return merged.select("s_suppkey", "rule", F.inline("selectors"))


@query(
    "location_text",
    f"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(raw, '^{A.BLANKS}+|{A.BLANKS}+$', '', 'g'),
      '{A.BLANKS}+', ' ', 'g'), '{LOCATION_INVISIBLES}', '', 'g')) AS location_md5
    FROM (SELECT doc_id, {junk_sql('text')} AS raw FROM documents) d""",
)
def location_text(spark, d):
    return A.table(spark, d, "documents").select(
        "doc_id", F.md5(text.location_text(junk(F.col("text")))).alias("location_md5")
    )
