"""Fields of stored pages, result tiles, rule coverage, and the observation job end to end."""

from pyspark.sql import functions as F

from shelfpanel.functions import addresses, text
from shelfpanel.functions.text import lookup
from shelfpanel.operators import extraction as x
from shelfpanel.operators.selectors import rule
from shelfpanel.plans.clean import clean_observations
from shelfpanel.plans.pages import MEMBER_NOTES, extract_products, extract_search, observed_page_facts
from shelfpanel.plans.pages import selector_coverage as coverage_of
from shelfpanel.plans.verification import verify_pages
from shelfpanel.sources.marketplaces import dimension
from workload import adapters as A

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def text_sql(markup: str) -> str:
    """Visible text of markup, as SQL."""
    out = f"regexp_replace({markup}, '<[^>]*>', '', 'g')"
    for entity, char in x.ENTITIES.items():
        out = f"replace({out}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return f"trim(regexp_replace({out}, '{A.BLANKS}+', ' ', 'g'))"


PAGE_RULES = {
    "title": [rule("title")],
    "heading": [rule("h2"), rule("h1")],
    "language": [rule("html", attribute="lang")],
    "notice": [rule("div.ad"), rule("footer")],
    "bold": [rule("meta"), rule("//p/b")],
    "link": [rule("nav > ul > li > a", attribute="href")],
    "absent": [rule("h3"), rule("#none")],
}


@query(
    "page_fields",
    f"""SELECT page_id, {text_sql("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS title,
      {text_sql("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS heading,
      regexp_extract(html, '<html lang="([^"]*)"', 1) AS language,
      {text_sql("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</', 1)")} AS notice,
      '' AS bold, regexp_extract(html, '<nav><ul><li><a href="([^"]*)"', 1) AS link, 'Not Found' AS absent FROM pages""",
)
def page_fields(spark, d):
    pages = x.with_tags(A.table(spark, d, "pages").select("page_id", "html"))
    return x.extract_fields(pages, PAGE_RULES).select("page_id", *PAGE_RULES)


@query(
    "node_ids",
    """WITH h AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages),
    n AS (SELECT page_id, list_transform(links, lambda l, i: CASE WHEN i % 3 <> 1
      THEN l || '?node=' || CAST(page_id * 10 + i AS VARCHAR) || '&node=1' ELSE l END) AS links FROM h)
    SELECT page_id, coalesce(nullif(array_to_string(list_filter(list_transform(links,
      lambda l: regexp_extract(l, 'node=([0-9]+)', 1)), lambda v: v <> ''), '›'), ''), 'Not Found') AS nodes FROM n""",
)
def node_ids(spark, d):
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))

    def with_node(link, i):
        node = (F.col("page_id") * 10 + i + 1).cast("string")
        return F.when((i + 1) % 3 != 1, F.concat(link, F.lit("?node="), node, F.lit("&node=1"))).otherwise(link)

    return A.table(spark, d, "pages").select(
        "page_id", addresses.node_ids(F.transform(links, with_node)).alias("nodes")
    )


@query(
    "script_json",
    """SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'Not Found' ELSE 'TYPE_' || CAST(length(html) % 7 AS VARCHAR) END AS product_type,
      CASE WHEN page_id % 4 IN (0, 1) THEN 'Not Found' ELSE 'grp_' || CAST(page_id % 5 AS VARCHAR) END AS display_group
    FROM pages""",
)
def script_json(spark, d):
    n = F.col("page_id")
    ptd = F.concat(F.lit('"ptd" : "TYPE_'), (F.length("html") % 7).cast("string"), F.lit('"'))
    pgid = F.when(n % 4 == 1, "").otherwise(
        F.concat(F.lit(',\n"pgid":"grp_'), (n % 5).cast("string"), F.lit('"'))
    )
    block = F.concat(F.lit('var x = {"immutableParams" :\n {'), ptd, pgid, F.lit('}, "more": {}};var t='))
    html = F.when(n % 4 == 0, F.col("html")).otherwise(F.replace("html", F.lit("var t="), block))
    return A.table(spark, d, "pages").select(
        "page_id",
        addresses.script_value(html, "ptd").alias("product_type"),
        addresses.script_value(html, "pgid").alias("display_group"),
    )


@query(
    "feature_list",
    f"""SELECT page_id, coalesce(nullif(replace(array_to_string(list_filter(list_transform(
      regexp_extract_all(html, '(?s)<(?:li|p)>(.*?)</', 1),
      lambda m: replace({text_sql('m')}, '"', '''')), lambda v: v <> ''), ' | '), '–', '-'), ''), 'Not Found') AS features
    FROM pages""",
)
def feature_list(spark, d):
    """The job's item rule, on pages whose list items and paragraphs are made items of a feature block."""
    html = F.regexp_replace("html", r"(?s)<(?:li|p)>(.*?)</", "<li><span>$1</span></")
    # a paragraph that has no end tag ends at the next tag, as an item does
    pages = A.table(spark, d, "pages").select("page_id", F.regexp_replace(html, "</p>", "</li>").alias("html"))
    tagged = x.with_tags(pages)
    return tagged.select("page_id", text.feature_list(F.expr(x.inner_items(x.TAGS, "li", "span"))).alias("features"))


CANDIDATES = {
    "heading": [rule("h2"), rule("h1"), rule("title")],
    "bold": [rule("meta"), rule("p > b")],
    "spam": [rule("//h1[contains(., '&&&')]", "marks"), rule("//footer[contains(text(), 'der')]", "der"), rule("p")],
    "absent": [rule("h3"), rule("#none")],
}
# Where the candidates are found, written for SQL: condition and markup.
CANDIDATE_SQL = {
    "heading": [("false", "''"), ("true", "regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"), ("true", "regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")],
    "bold": [("true", "''"), ("contains(html, '<p><b>')", "'x'")],
    "spam": [
        ("contains(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '&amp;&amp;&amp;')", "'x'"),
        ("contains(regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1), 'der')", "'x'"), ("contains(html, '<p>')", "'x'"),
    ],
    "absent": [("false", "''"), ("false", "''")],
}


def _coverage_sql() -> str:
    parts = []
    for name, rules in CANDIDATES.items():
        found = [f"CASE WHEN {c} THEN {text_sql(m)} END" for c, m in CANDIDATE_SQL[name]]
        with_text = " ".join(f"WHEN v{i} <> '' THEN {i}" for i in range(1, len(rules) + 1))
        present = " ".join(f"WHEN v{i} IS NOT NULL THEN {i}" for i in range(1, len(rules) + 1))
        source = (
            f"(SELECT *, CASE {with_text} {present} END AS best FROM (SELECT "
            + ", ".join(f"{f} AS v{i + 1}" for i, f in enumerate(found))
            + " FROM pages) a) b"
        )
        for i, r in enumerate(rules, 1):
            parts.append(
                f"SELECT '{name}' AS field, {i} AS priority, '{r.name}' AS rule, count(*) FILTER (v{i} <> '') AS found, "
                f"count(*) FILTER (v{i} = '') AS found_empty, count(*) FILTER (v{i} IS NULL) AS absent, "
                f"count(*) FILTER (best = {i}) AS best FROM {source}"
            )
    return " UNION ALL ".join(parts)


@query("selector_coverage", _coverage_sql())
def selector_coverage(spark, d):
    return coverage_of(A.table(spark, d, "pages"), CANDIDATES)


def search_pages(spark, d):
    """Stored pages as search pages: every list item becomes a result tile.

    Items of up to three letters have no key; capital first letters mark sponsored tiles; the
    word length picks which deal markup a tile has.
    """
    item = r'<li><a href="/([^"]*)">([^<]*)</a></li>'
    tile = '<div data-asin="$1" data-component-type="s-search-result"><h2>$2</h2>'
    html = F.regexp_replace("html", r'<li><a href="/([^"]{1,3})">[^<]*</a></li>',
                            '<div data-asin="" data-component-type="s-search-result"></div>')
    html = F.regexp_replace(html, r'(?=<li><a href="/\p{Lu})', '<!--s-->')
    html = F.regexp_replace(
        html, rf"<!--s-->{item}",
        tile + '<span>Sponsored</span><span class="a-price"><span class="a-offscreen">$$1.50</span></span>'
        '<span class="a-badge-label-inner"></span></div>'.replace("$$", r"\$"),
    )
    html = F.regexp_replace(
        html, r'<li><a href="/([^"]{4,6})">([^<]*)</a></li>',
        tile + '<span class="x a-badge-text">Deal $2</span></div>',
    )
    html = F.regexp_replace(
        html, r'<li><a href="/([^"]{7,8})">([^<]*)</a></li>',
        tile + '<span class="s-coupon-unclipped">Save $2 with coupon now</span>'
        '<span>50+ bought in past month</span></div>',
    )
    html = F.regexp_replace(html, item, tile + '<span class="s-coupon-unclipped">plain</span></div>')
    return A.table(spark, d, "pages").select(
        A.code_of(F.col("page_id")).alias("Country"),
        F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("Keyword"),
        html.alias("html"),
    )


@query(
    "search_tiles",
    f"""WITH i AS (SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="/([^"]*)">[^<]*</a></li>', 1)) AS w,
      generate_subscripts(regexp_extract_all(html, '<li><a href="/([^"]*)">[^<]*</a></li>', 1), 1) AS r FROM pages)
    SELECT '2024-05-01' AS "Date", {A.CODE_SQL.format('page_id')} AS "Country",
      CASE page_id % 8 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'GB' WHEN 7 THEN 'MX' ELSE 'EU' END AS "Region",
      'page ' || page_id AS "Keyword",
      CAST(r AS INT) AS "Rank", w AS "ASIN", w AS "Title",
      CASE WHEN regexp_matches(w, '^\\p{{Lu}}') THEN 'Yes' ELSE 'No' END AS "Sponsored",
      CASE WHEN regexp_matches(w, '^\\p{{Lu}}') THEN '$1.50' ELSE 'Not Found' END AS "Price", 'Not Found' AS "Num Reviews",
      CASE WHEN length(w) IN (7, 8) AND NOT regexp_matches(w, '^\\p{{Lu}}') THEN '50+ bought in past month'
        ELSE 'Not Found' END AS "Bought Past Month",
      CASE WHEN regexp_matches(w, '^\\p{{Lu}}') THEN '' WHEN length(w) <= 6 THEN 'Deal ' || w
        WHEN length(w) <= 8 THEN 'Save ' || w ELSE 'Not Found' END AS "Deal"
    FROM i WHERE length(w) > 3""",
)
def search_tiles(spark, d):
    return extract_search(search_pages(spark, d), A.marketplaces(spark), F.lit("2024-05-01").cast("date"))


#: Header, date and its panel form, by country: the date is split over an inner table.
CREATED = {
    "US": ("Date First Available", "March 5,", " 2021"), "CA": ("Date First Available", "March 5,", " 2021"),
    "GB": ("Date first available", "5 March", " 2021"), "DE": ("Im Angebot von X seit", "5. März", " 2021"),
    "FR": ("Date de mise en ligne sur X", "5 mars", " 2021"), "IT": ("Disponibile su X a partire dal", "5 marzo", " 2021"),
    "ES": ("Producto en X desde", "5 marzo", " 2021"), "MX": ("Producto en X desde", "5 de marzo de", " 2021"),
}
NOTES = {c: note for note, countries in MEMBER_NOTES.items() for c in countries}


def product_pages(spark, d):
    """Stored pages with a product block whose values follow from the page: elements inside elements of the same name, a second list
    of features, tables in cells, empty elements, and members of every group of fields that is missing on some pages."""
    n = F.col("page_id")
    s = n.cast("string")
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    country = A.code_of(n)
    brand = F.concat("brand_prefix", F.lit("Maker "), s, "brand_suffix")
    created = [lookup({c: v[i] for c, v in CREATED.items()}, country) for i in range(3)]

    def on(condition, *parts):
        return F.when(condition, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])).otherwise("")

    block = F.concat(
        F.lit('<span id="productTitle" class="x"> <span>'), title, F.lit('</span> "A" <i>set</i></span><!-- <span id="productTitle">no</span> -->'),
        F.lit('<a id="bylineInfo" href="/m">'), brand, F.lit('</a><div id="availability"><div><span>'),
        F.when(n % 3 == 0, "In Stock").when(n % 3 == 1, "Only 3 left\nin stock").otherwise(""),
        F.lit('</span></div></div><span class="a-icon-alt">'), (n % 5).cast("string"),
        F.lit(',5 von 5</span><span id="acrCustomerReviewText">1.'), F.lpad((n % 1000).cast("string"), 3, "0"),
        F.lit(" ratings</span>"),
        on(n % 4 != 0,
           '<div id="corePriceDisplay_desktop_feature_div"><div><i>Now</i></div><span class="a-price-symbol">€</span><span class="a-price-whole">1,',
           F.lpad((n % 1000).cast("string"), 3, "0"),
           '<span class="a-price-decimal">.</span></span><div><span class="a-price-fraction">99</span></div></div>'),
        on(n % 4 == 1, '<span class="a-price a-text-price" data-a-strike="true"><span>$2,000</span>.50</span>'),
        F.lit('<div id="feature-bullets"><ul><li><span> one – <span>two</span> </span></li><li><span> </span></li><li><span>n '), s,
        F.lit('</span></li></ul><ul class="more"><li> <span>"more"</span></li></ul></div><ul><li><span>other</span></li></ul>'
              '<div id="wayfinding-breadcrumbs_feature_div"><div><a href="/b?node='), s,
        F.lit('">Home</a>›</div><a class="c" href="/b?x=1&amp;node=7">Box '), s,
        F.lit('</a></div><div class="a promoPriceBlockMessage"><div>Coupon: <b>Save 5%</b></div> | Terms</div>'),
        on(n % 2 == 0, '<div id="variation_color_name"><div class="a-row"><label>Color</label><span class="selection"> Red <b>', s, "</b></span></div></div>"),
        on(n % 2 == 1, '<span id="inline-twister-expanded-dimension-text-color_name">Blue</span><div id="variation_color_name"><div class="a-row"><span>no</span></div></div>'),
        on(n % 3 == 0, '<span id="inline-twister-expanded-dimension-text-size_name">XL</span>'),
        on(n % 3 == 1, '<a id="sellerProfileTriggerId">Seller &amp; ', s, "</a>"),
        F.lit('<input type="hidden" id="productCategory" value="gl_home">'),
        on(n % 5 == 0, '<span id="dealBadgeSupportingText">Limited <span>time</span> deal</span><span class="pep-pday-badge">Event</span>'),
        on(n % 5 == 1, '<div id="social-proofing-faceout-title-tk_bought"><span>50+ <b>bought</b></span><span> in past month</span></div>'
           '<span class="a-size-base gb-accordion-active a-text-bold">With Deal</span>'),
        on(n % 7 == 0, '<span class="x mvt-1 my-badge">Best <span>pick</span></span>'),
        on(n % 7 == 1, '<span class="mvt badge"> </span>'),
        on(n % 6 == 0, '<span class="a-size-base">nothing</span><span class="a-size-base">Only <span>', lookup(NOTES, country), "</span></span>"),
        on(n % 6 < 2, '<div id="primeExclusivePricingMessage"><span>Join Prime to buy this item at $8.50</span></div>'),
        F.lit('<table id="productDetails_detailBullets_sections1"><tr><th>Weight</th><td>1</td></tr><tr><th> <span>'),
        "bsr_search_text", F.lit(" </span></th><td><table><tr><td><span>#1,2 in <b>Home</b> (See Top 100)</span><br></td></tr></table><span>#"), s,
        F.lit(" in Boxes</span> <span>#9 in Lids</span></td></tr><tr><th> "), created[0], F.lit(" </th><td><table><tr><td>"), created[1],
        F.lit("</td></tr></table>"), created[2], F.lit('</td></tr></table><div id="glow-ingress-line2">Ort '),
        F.when(n % 9 == 0, "99999").otherwise(F.col("zip_code")),
        F.lit('</div><script>if (1 < 2) {"</div>"} var p = {"immutableParams":{"ptd":"BOX","pgid":"home_box_display_on_website"}}</script></body>'),
    )
    pages = A.table(spark, d, "pages").withColumn("Country", country)
    return pages.join(
        dimension(A.marketplaces(spark), "brand_prefix", "brand_suffix", "bsr_search_text", "zip_code"), "Country"
    ).select(
        "Country",
        A.asin_of(n).alias("ASIN"),
        F.concat(F.lit("https://shop.example/dp/"), A.asin_of(F.when(n % 10 == 0, n + 1).otherwise(n))).alias("url"),
        F.concat("html", block).alias("html"),
    )


NAME_SQL = text_sql("regexp_extract(html, '(?s)<title>(.*?)</title>', 1) || ' \"A\" set'")
PRODUCT_SQL = (
    A.joined_sql(A.PLACES_SQL)
    + f"""SELECT '05/01/2024' AS "Date", {A.ASIN_SQL.format('k')} AS "ASIN", code AS "Country",
      'https://' || domain || '/dp/' || {A.ASIN_SQL.format('k')} AS "Link",
      replace({NAME_SQL}, '"', '''') AS "Name",
      'Maker ' || page_id AS "Brand",
      CASE page_id % 3 WHEN 0 THEN 'In Stock' WHEN 1 THEN 'Only 3 left in stock' ELSE '' END AS "Stock",
      CAST(page_id % 5 AS VARCHAR) || '.5' AS "Rating Stars",
      '1' || lpad(CAST(page_id % 1000 AS VARCHAR), 3, '0') AS "Number of ratings",
      CASE WHEN page_id % 6 = 1 THEN '8.50' ELSE price END AS "Price",
      CASE WHEN page_id % 6 = 0 THEN 'Only ' || note WHEN page_id % 6 = 1 THEN '8.50' ELSE 'Not Found' END AS "PED",
      CASE WHEN page_id % 6 = 1 THEN price WHEN page_id % 4 = 1 THEN '2000.50' ELSE 'Not Found' END AS "List Price",
      'one - two | n ' || page_id || ' | ''more''' AS "Features", 'Home › Box ' || page_id AS "Product Category",
      'Home' AS "Root Category", 'home' AS "Product Category GL",
      page_id || ' › 7' AS "Product Category Nodes", 'Save 5%' AS "Coupon", '#1,2 in Home' AS "BSR 1",
      '#' || page_id || ' in Boxes' AS "BSR 2", '#9 in Lids' AS "BSR 3", 'BOX' AS "Product Type", 'Home Box' AS "DOW",
      CASE WHEN page_id % 7 = 0 THEN 'Best pick' ELSE 'Not Found' END AS "Badge",
      CASE WHEN page_id % 3 = 1 THEN 'Seller & ' || page_id ELSE 'Not Found' END AS "Merchant",
      CASE WHEN page_id % 2 = 0 THEN 'Red ' || page_id ELSE 'Blue' END AS "Color Name",
      CASE WHEN page_id % 3 = 0 THEN 'XL' ELSE 'Not Found' END AS "Size Name", '03/05/2021' AS "Date Created",
      CASE WHEN page_id % 5 = 0 THEN 'Limited time deal' ELSE 'Not Found' END AS "Limited Time Deal",
      CASE WHEN page_id % 5 = 0 THEN 'Event' ELSE 'Not Found' END AS "Prime",
      CASE WHEN page_id % 5 = 1 THEN '50+ bought' ELSE 'Not Found' END AS "Prev Month Qty",
      CASE WHEN page_id % 5 = 1 THEN 'With Deal' ELSE 'Not Found' END AS "Deal"
    FROM (SELECT *, {A.CODE_SQL.format('page_id')} AS code, CASE WHEN page_id % 10 = 0 THEN page_id + 1 ELSE page_id END AS k,
        CASE WHEN page_id % 4 = 0 THEN 'Not Found' ELSE '1' || lpad(CAST(page_id % 1000 AS VARCHAR), 3, '0') || '.99' END AS price
      FROM pages) p JOIN places USING (code)
      JOIN (VALUES {", ".join(f"('{c}', '{n}')" for c, n in NOTES.items())}) notes(code, note) USING (code)"""
)


@query("product_observations", PRODUCT_SQL)
def product_observations(spark, d):
    places = A.marketplaces(spark)
    observed = extract_products(product_pages(spark, d), places, F.lit("2024-05-01").cast("date"))
    return clean_observations(observed, places)


@query(
    "page_verification",
    f"""SELECT {A.CODE_SQL.format('page_id')} AS "Country", {A.ASIN_SQL.format('page_id')} AS "ASIN",
      CASE WHEN page_id % 4 = 0 THEN 'missing_unpriced' WHEN page_id % 8 IN (3, 4, 5, 6) THEN 'ok' ELSE 'wrong' END AS currency,
      page_id % 4 = 0 OR page_id % 8 IN (3, 4, 5, 6) AS currency_valid, page_id % 9 <> 0 AS region_valid FROM pages""",
)
def page_verification(spark, d):
    facts = observed_page_facts(product_pages(spark, d), ["Country", "ASIN"])
    return verify_pages(facts, A.marketplaces(spark)).select(
        "Country", "ASIN", "currency", "currency_valid", "region_valid"
    )
