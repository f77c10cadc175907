"""Cleaning of collected observations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpanel.functions import numbers, text
from shelfpanel.functions.addresses import product_url
from shelfpanel.functions.dates import date_created
from shelfpanel.operators.keys import FLAGS, correct_redirects
from shelfpanel.schemas import ensure_columns, field, text_columns
from shelfpanel.sources.marketplaces import dimension

PAGE_TEXTS = [
    "Features", "Name", "Brand", "Product Category", "Stock", "Badge", "Merchant", "Coupon",
    "Date Created", "Size Name",
]
PRICES = ["Price", "PED", "List Price"]


def clean_observations(
    observations: DataFrame,
    marketplaces: DataFrame,
    list_price: str = "collected",
    separator: str = text.CATEGORY_SEPARATOR,
    keep_flags: bool = False,
) -> DataFrame:
    """Rows of known countries with cleaned fields, corrected keys and rebuilt links.

    ``list_price='as_price'`` starts the list price from the price. ``keep_flags`` keeps the
    columns ``Requested ASIN``, ``redirected`` and ``page_invalid`` for run quality.
    """
    # The inner join to the marketplaces below also drops rows of unknown countries.
    fixed = correct_redirects(ensure_columns(observations, ["ASIN Product Page"]))
    cleaned = fixed.withColumns({c: text.clean_text(field(c)) for c in PAGE_TEXTS if c in fixed.columns})

    have = set(cleaned.columns)
    rules = {}
    if "Date Created" in have:
        rules["Date Created"] = date_created(field("Date Created"))
    if "Product Category" in have:
        rules["Root Category"] = text.root_category(field("Product Category"), separator)
    for c in ("Product Category", "Product Category Nodes"):
        if c in have:
            rules[c] = text.spaced_category(field(c), separator)
    if "DOW" in have:
        rules["DOW"] = text.display_name(field("DOW"))
    if "BSR 1" in have:
        rules["BSR 1"] = text.rank_line(field("BSR 1"))
    if "Coupon" in have:
        rules["Coupon"] = text.coupon_text(field("Coupon"))
    if have.issuperset(PRICES):
        rules.update(
            numbers.reconcile_prime(
                F.col("Price"), F.col("PED"), field("List Price"), list_price == "as_price"
            )
        )
    if "List Price" in have:
        rules["List Price"] = numbers.first_number(rules.get("List Price", field("List Price")))
    if "Rating Stars" in have:
        rules["Rating Stars"] = numbers.first_number(field("Rating Stars"))
    if "Number of ratings" in have:
        rules["Number of ratings"] = numbers.count_digits(field("Number of ratings"))
    if "Size Name" in have:
        rules["Size Name"] = text.size_name(field("Size Name"))
    ruled = cleaned.withColumns(rules)

    places = dimension(marketplaces, "base_url")
    linked = ruled.drop("Link", "Is Match ASIN").join(places, "Country")
    linked = linked.withColumn("Link", product_url(F.col("base_url"), F.col("ASIN"))).drop("base_url")

    wanted = [c for c in observations.columns if c not in ("ASIN Product Page", "Is Match ASIN")]
    wanted += [c for c in ("Link", "Root Category") if c in linked.columns and c not in wanted]
    texts = set(text_columns(linked))
    flags = ["Requested ASIN", *FLAGS] if keep_flags else []
    return linked.select(
        *[(text.final_clean(field(c)) if c in texts else field(c)).alias(c) for c in wanted], *flags
    )
