"""Observations from stored product pages and tiles from stored search pages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpanel.functions import numbers, text
from shelfpanel.functions.addresses import asin_from_url, node_ids, object_value, script_object
from shelfpanel.functions.dates import event_text, panel_text
from shelfpanel.operators import extraction as x
from shelfpanel.operators.selectors import Rule, rule, settings_rules
from shelfpanel.schemas import OBSERVATION_COLUMNS, TILE_COLUMNS
from shelfpanel.sources.marketplaces import collected_rules, dimension

# Wording of a member-price note, and the countries that use it.
MEMBER_NOTES = {
    "exclusively for Amazon Prime members": ("US", "CA", "GB"),
    "Preis gilt ausschließlich für Prime-Mitglieder": ("DE",),
    "Prime": ("MX", "ES", "FR"),
    "riservata esclusivamente ai clienti Prime": ("IT",),
}
# Wording of the header of the "available since" cell, and the countries that use it.
DATE_HEADERS = {
    "Date First Available": ("US", "CA"),
    "Date first available": ("GB",),
    "Im Angebot von": ("DE",),
    "Producto en": ("ES", "MX"),
    "Date de mise en ligne": ("FR",),
    "Disponibile su": ("IT",),
}
# Where the fields of a product page are found if the settings say nothing.
PRODUCT_RULES = {
    "Color Name": [
        rule("#inline-twister-expanded-dimension-text-color_name"), rule("#variation_color_name > div.a-row > span"),
    ],
    "Size Name": [
        rule("#inline-twister-expanded-dimension-text-size_name"), rule("#variation_size_name > div.a-row > span"),
    ],
    "Brand": [rule("#bylineInfo")],
    "Name": [rule("//span[@id='productTitle']")],
    "Stock": [rule("//div[@id='availability']")],
    "Merchant": [rule("#sellerProfileTriggerId")],
    "Product Category": [rule("#wayfinding-breadcrumbs_feature_div")],
    "Product Category GL": [rule("#productCategory", attribute="value")],
    "Date Created": [
        rule(f"//th[contains(text(), '{header}')]/following-sibling::td", countries=c) for header, c in DATE_HEADERS.items()
    ],
    "Number of ratings": [rule("//span[@id='acrCustomerReviewText']")],
    "List Price": [rule("//span[contains(@class, 'a-price a-text-price') and @data-a-strike='true']")],
    "Limited Time Deal": [rule("#dealBadgeSupportingText")],
    "Prime": [rule("//span[@class='pep-pday-badge']")],
    "Prev Month Qty": [rule("//*[@id='social-proofing-faceout-title-tk_bought']/span[1]")],
    "Coupon": [rule(".promoPriceBlockMessage")],
    "Deal": [rule("//span[@class='a-size-base gb-accordion-active a-text-bold']")],
    "PED": [
        *[rule(f"//span[@class='a-size-base'][contains(., '{note}')]", countries=c) for note, c in MEMBER_NOTES.items()],
        rule("#primeExclusivePricingMessage"),
    ],
    "Rating Stars": [rule("//span[@class='a-icon-alt']")],
    "Badge": [rule("//span[contains(@class, 'mvt') and contains(@class, 'badge')]")],
}
# A field that is only read on request.
EXTRA_RULES = {"Freq Badge": [rule("//*[@id='NEW_1_nostos_badge']//p/span")]}
# Keys of the settings file for the fields that its rules may replace.
SETTINGS_KEYS = {
    "Color Name": "color_name", "Size Name": "size_name", "Brand": "brand", "Name": "product_title", "Stock": "stock",
    "Merchant": "merchant", "Product Category": "product_category", "Product Category GL": "product_category_gl",
    "Date Created": "date_created", "Number of ratings": "number_of_ratings", "List Price": "list_price",
    "Limited Time Deal": "limited_time_deal", "Prime": "prime_day_deal", "Prev Month Qty": "prev_month_qty", "Coupon": "coupon",
    "Deal": "deal", "PED": "ped", "Rating Stars": "rating_stars", "Freq Badge": "freq_returned_badge",
}
# Elements of a product page that fields are put together from, with their keys in the settings file.
PART_RULES = {
    "page_key": ("asin_product_page", [rule("//tr[th[contains(text(), 'ASIN')]]/td")]),
    "price": ("price_container", [rule("#corePriceDisplay_desktop_feature_div")]),
    "features": ("features", [rule("//*[@id='feature-bullets']/ul/li/span")]),
    "links": ("product_category_links", [rule("//div[@id='wayfinding-breadcrumbs_feature_div']//a")]),
    "ranks": ("bsr_container", [rule("#productDetails_detailBullets_sections1")]),
}
PRICE_WHOLE, PRICE_FRACTION = rule("span.a-price-whole").steps, rule("span.a-price-fraction").steps
# Places where deal and coupon texts have been seen, in order of preference.
CANDIDATE_RULES = {
    "Limited Time Deal": [
        rule("#dealBadgeSupportingText", "id dealBadgeSupportingText"),
        rule("#deal-badge-msg", "id deal-badge-msg"),
        rule("#dealBadgeDisplayFeature_feature_div span[class*='a-color-price']", "price in feature"),
        rule("#dealBadgeDisplayFeature_feature_div span[class*='a-text-bold']", "bold in feature"),
        rule("div#dealBadgeDisplayFeature_feature_div", "feature"),
        rule("span[class*='deal-badge']", "class part deal-badge"),
        rule(".dealBadge", "class dealBadge"),
        rule("[data-feature-name='dealBadge']", "feature name dealBadge"),
        rule("div#limitedTimeDealLabel_feature_div", "label feature"),
        rule("span#deal-badge-label", "id deal-badge-label"),
    ],
    "Coupon": [
        rule(".promoPriceBlockMessage", "class promoPriceBlockMessage"),
        rule("#couponBadgeRegular", "id couponBadgeRegular"),
        rule(".coupon-badge", "class coupon-badge"),
        rule("div#couponBadgeDisplayFeature_feature_div", "feature"),
        rule("span[class*='coupon']", "class part coupon"),
        rule("[data-feature-name='couponBadge']", "feature name couponBadge"),
        rule("div#promoPriceBlockMessage_feature_div", "promo feature"),
    ],
}
CURRENCY, LOCATION = rule("span.a-price-symbol"), rule("#glow-ingress-line2")
HAS_PRICE = rule("span[class*='a-price-whole']")

# Where the fields of a result tile are found.
TILE_START = rule("div[data-component-type='s-search-result']")
TILE_RULES = {
    "Title": [rule("h2")],
    "Price": [rule("span.a-price > span.a-offscreen")],
    "Num Reviews": [rule("span.a-size-base.s-underline-text")],
}
TILE_DEALS = {
    "top_badge": [rule("span.a-badge-label-inner")],
    "deal_badge": [rule("span.a-badge-text")],
    "coupon_badge": [rule("span.s-coupon-unclipped")],
}


def product_rules(settings: dict[str, dict], extra: bool = False) -> dict[str, list[Rule]]:
    """Rules of the product fields, those of the settings where they have any (``settings``: country to its merged rules)."""
    fields = PRODUCT_RULES | (EXTRA_RULES if extra else {})
    return {
        name: settings_rules(settings, SETTINGS_KEYS[name], listed, "value" if name == "Product Category GL" else None)
        if name in SETTINGS_KEYS else listed
        for name, listed in fields.items()
    }


def deal_rules(settings: dict[str, dict]) -> dict[str, list[Rule]]:
    """Rules of the deal rungs of a tile; a rung that neither the settings nor the defaults have is skipped."""
    found = {name: settings_rules(settings, name, TILE_DEALS.get(name, [])) for name in x.DEAL_RUNGS}
    return {name: rules for name, rules in found.items() if rules}


def _parts(settings: dict[str, dict]) -> dict[str, Rule]:
    """One rule for each part and group of countries, named ``part:number``."""
    out = {}
    for part, (key, default) in PART_RULES.items():
        for i, r in enumerate(settings_rules(settings, key, default)):
            steps = r.steps
            if part in ("features", "links") and len(steps) > 1:
                steps = steps[:1]  # the block; its items are read together
            out[f"{part}:{i}"] = Rule(r.name, steps, r.attribute, r.countries)
            if part == "price":
                for name, inner in (("whole", PRICE_WHOLE), ("fraction", PRICE_FRACTION)):
                    out[f"{name}:{i}"] = Rule(name, steps + inner, None, r.countries)
    return out


def _price(whole: Column, fraction: Column) -> Column:
    """Price from the texts of the whole and the fraction element of the price block."""
    return numbers.price_text(F.regexp_replace(whole, r"\.$", ""), fraction)


#: First header cell that holds the country's wording, among the tags of the details table, and the value cell after it.
RANK_HEAD = f"get(filter(_ranks_in, t -> t.step = 1 AND t.name = 'th' AND contains({x.shown(x.element_tags('t'))}, bsr_search_text)), 0)"
RANK_CELL = "CASE WHEN _head IS NOT NULL THEN get(filter(_ranks_in, t -> t.step = 1 AND t.name = 'td' AND t.at > _head.at), 0) END"
#: The text of the tags of a cell: breaks, list items and neighbouring spans begin a new line.
_NEXT = "get(_cell_in, i + 1)"
_BREAKS = (
    "t.name = 'br' OR t.name = 'li' AND t.step = -1 OR t.name = 'span' AND t.step = -1 AND trim(t.text) = '' "
    f"AND {_NEXT}.name = 'span' AND {_NEXT}.step = 1"
)
CELL_LINES = x.decoded(f"array_join(transform(_cell_in, (t, i) -> concat(CASE WHEN {_BREAKS} THEN '\\n' ELSE '' END, t.text)), '')")


def extract_products(
    pages: DataFrame,
    marketplaces: DataFrame,
    collected_on: Column,
    fields: dict[str, list[Rule]] | None = None,
) -> DataFrame:
    """One observation row per stored product page of a known country.

    ``pages``: Country, url, html and the requested key ``ASIN``. The page is cut into tags once; every field is a lookup in them, so this
    is one scan with no shuffle. Rules come from ``fields``, else from the ``rules`` of ``marketplaces`` (a small dimension, read
    when the plan is made), else from the defaults.
    """
    settings = collected_rules(marketplaces)
    fields = fields or product_rules(settings)
    parts = _parts(settings)
    places = dimension(marketplaces, "bsr_search_text", "brand_prefix", "brand_suffix")
    p = x.extract_fields(x.with_tags(pages.join(places, "Country")), fields, parts)

    def part(name: str) -> Column:
        return F.coalesce(*[F.col(f"`{c}`") for c in parts if c.startswith(name + ":")])

    # Each value that the next ones use more than once is a column of a projection of its own.
    blocks = ("features", "links", "ranks")
    p = p.withColumns({f"_{n}": part(n) for n in (*blocks, "whole", "fraction", "page_key")})
    p = p.withColumns({f"_{n}_in": F.expr(f"CASE WHEN _{n} IS NOT NULL THEN {x.element_tags(f'_{n}')} END") for n in blocks})
    p = p.withColumn("_head", F.expr(RANK_HEAD)).withColumn("_cell", F.expr(RANK_CELL))
    p = p.withColumn("_cell_in", F.expr(f"CASE WHEN _cell IS NOT NULL THEN {x.element_tags('_cell')} END"))
    plain = text.strip(F.regexp_replace(F.expr(CELL_LINES), r"\n\s*", "\n"))
    script = F.expr(f"get(filter({x.TAGS}, t -> t.name = 'script' AND contains(t.head, 'immutableParams')), 0).head")
    p = p.withColumns({"_lines": F.nullif(plain, F.lit("")), "_script": script_object(script)})
    lines = text.rank_lines(F.col("_lines"))
    out = {name: F.col(f"`{name}`") for name in fields}
    out["Brand"] = text.strip_brand(out["Brand"], F.col("brand_prefix"), F.col("brand_suffix"))
    out["Product Category GL"] = text.category_code(out["Product Category GL"])
    out["Rating Stars"] = numbers.rating_number(out["Rating Stars"])
    out["Badge"] = text.or_not_found(F.nullif(out["Badge"], F.lit("")))
    out.update(
        {
            "Date": panel_text(collected_on),
            "ASIN": F.col("ASIN"),
            "Link": F.col("url"),
            "Country": F.col("Country"),
            "ASIN Product Page": asin_from_url(F.col("url"), F.expr(x.element_text("_page_key"))),
            "BSR 1": lines[0],
            "BSR 2": lines[1],
            "BSR 3": lines[2],
            "Product Type": object_value(F.col("_script"), "ptd"),
            "DOW": object_value(F.col("_script"), "pgid"),
            "Product Category Nodes": node_ids(
                F.expr(f"transform(filter(_links_in, t -> t.step = 1 AND t.name = 'a'), t -> {x.attribute_of('t.head', 'href')})")
            ),
            "Price": _price(F.expr(x.element_text("_whole")), F.expr(x.element_text("_fraction"))),
            "Features": text.feature_list(F.expr(x.inner_items("_features_in", "li", "span"))),
        }
    )
    names = OBSERVATION_COLUMNS + [n for n in out if n not in OBSERVATION_COLUMNS]
    return p.select(*[out[n].alias(n) for n in names])


def extract_search(
    pages: DataFrame,
    marketplaces: DataFrame,
    collected_on: Column,
    tile_start: Rule = TILE_START,
    asin_attribute: str = "data-asin",
    fields: dict[str, list[Rule]] | None = None,
    deals: dict[str, list[Rule]] | None = None,
) -> DataFrame:
    """Result tiles of stored search pages; tiles without a key count for the rank only.

    ``pages``: Country, Keyword, html. ``Region`` is the sales region of the country. Deal rules come from ``deals``, else from the
    ``rules`` of ``marketplaces``, else from the defaults.
    """
    fields = fields or TILE_RULES
    deals = deal_rules(collected_rules(marketplaces)) if deals is None else deals
    texts = ["sponsored_text", "bought_text", "coupon_suffix_text"]
    places = dimension(marketplaces, "region", *texts)
    keep = ["Country", "Keyword", "region", *texts]
    t = x.tiles(x.with_tags(pages.join(places, "Country")), tile_start, keep)
    asin = text.strip(F.expr(x.attribute_of(f"get({x.TAGS}, 0).head", asin_attribute)))
    t = t.withColumn("ASIN", F.coalesce(asin, F.lit(""))).where(F.col("ASIN") != "")
    rungs = {f"{name}:{i}": r for name, rules in deals.items() for i, r in enumerate(rules)}
    t = x.extract_fields(t, fields, rungs)
    # spans that hold one text and nothing else
    spans = F.expr(
        f"transform(filter({x.TAGS}, (t, i) -> t.name = 'span' AND t.step = 1 AND get({x.TAGS}, i + 1).name = 'span' "
        f"AND get({x.TAGS}, i + 1).step = -1), t -> {x.decoded('t.text')})"
    )
    t = t.withColumn("_spans", F.transform(spans, text.strip)).withColumns(
        {f"_{name}": F.coalesce(*[F.col(f"`{c}`") for c in rungs if c.startswith(name + ":")]) for name in deals}
    )
    t = t.withColumns({f"_{name}_text": F.expr(x.element_text(f"_{name}")) for name in deals})
    sponsored = F.exists("_spans", lambda s: s.contains(F.col("sponsored_text")))
    bought = F.get(F.filter("_spans", lambda s: s.contains(F.col("bought_text"))), F.lit(0))
    out = {name: F.col(f"`{name}`") for name in fields}
    out.update(
        {
            "Date": event_text(collected_on),
            "Country": F.col("Country"),
            "Region": F.col("region"),
            "Keyword": F.col("Keyword"),
            "Rank": F.col("Rank"),
            "ASIN": F.col("ASIN"),
            "Sponsored": F.when(sponsored, "Yes").otherwise("No"),
            "Bought Past Month": text.or_not_found(bought),
            "Deal": x.deal_badge({name: F.col(f"_{name}_text") for name in deals}, F.col("coupon_suffix_text")),
        }
    )
    return t.select(*[out[n].alias(n) for n in [*TILE_COLUMNS, "Region"]])


def observed_page_facts(pages: DataFrame, keep: list[str]) -> DataFrame:
    """What the page checks need: currency symbol, whether a price is shown, location text."""
    found = x.found_elements(x.with_tags(pages), {"_symbol": CURRENCY, "_priced": HAS_PRICE, "_location": LOCATION})
    return found.select(
        *keep,
        F.expr(x.element_text("_symbol")).alias("symbol"),
        F.col("_priced").isNotNull().alias("has_price"),
        F.expr(x.element_text("_location")).alias("location"),
    )


def selector_coverage(
    pages: DataFrame, candidates: dict[str, list[Rule]] | None = None
) -> DataFrame:
    """How the candidate rules of each field do over the stored pages."""
    return x.rule_coverage(x.with_tags(pages), candidates or CANDIDATE_RULES)
