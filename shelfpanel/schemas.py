"""Column lists and schemas of the tables the jobs read and write."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text put into a field that was looked for and not found on a page.
NOT_FOUND = "Not Found"
# Text that stands for "no value" in change events.
NO_VALUE = "null"

KEY_COLUMNS = ["Country", "ASIN", "Date"]
MONITORED_FIELDS = ["Badge", "Limited Time Deal", "Deal", "Coupon", "Stock"]
EVENT_COLUMNS = [
    "Date", "ASIN", "Country", "SKU", "Field", "Value_before", "Value_after", "Change_type",
]

OBSERVATION_COLUMNS = [
    "Date", "ASIN", "Link", "Country", "Color Name", "Size Name", "Brand", "Name", "Stock",
    "Merchant", "Product Category", "Product Category GL", "ASIN Product Page", "Date Created",
    "Number of ratings", "List Price", "Limited Time Deal", "Prime", "Prev Month Qty", "Coupon",
    "Deal", "PED", "BSR 1", "BSR 2", "BSR 3", "Product Type", "DOW", "Product Category Nodes",
    "Rating Stars", "Price", "Features", "Badge",
]
PANEL_COLUMNS = [c for c in OBSERVATION_COLUMNS if c != "ASIN Product Page"] + ["Root Category"]
KEYWORD_KEY = ["Date", "Country", "Keyword", "ASIN"]
TILE_COLUMNS = [
    "Date", "Country", "Keyword", "Rank", "ASIN", "Title", "Sponsored", "Price", "Num Reviews",
    "Bought Past Month", "Deal",
]

ESSENTIAL_COLUMNS = [
    "Date", "ASIN", "Link", "Country", "Name", "Brand", "Price", "Product Category", "PED",
]


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


OBSERVATION_SCHEMA = text_schema(OBSERVATION_COLUMNS)
PANEL_SCHEMA = text_schema(PANEL_COLUMNS)
LISTING_SCHEMA = text_schema(["asin", "sku", "sales_country", "status"])
COMPETITOR_SCHEMA = text_schema(["Country", "ASIN"])
KEYWORD_LIST_SCHEMA = text_schema(["Sales Region", "Keywords"])
EVENT_SCHEMA = text_schema(EVENT_COLUMNS)
KEYWORD_PANEL_SCHEMA = T.StructType(
    text_schema([c for c in TILE_COLUMNS if c not in ("Rank", "Sponsored")]).fields
    + [
        T.StructField("Organic Rank", T.LongType()),
        T.StructField("Sponsored Rank", T.LongType()),
    ]
)
SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("Execution ID", T.StringType()),
        T.StructField("Date", T.StringType()),
        T.StructField("Time", T.StringType()),
        T.StructField("Country", T.StringType()),
        T.StructField("Processed ASINs", T.LongType()),
        T.StructField("Total Requested", T.LongType()),
        T.StructField("Success Rate (%)", T.DoubleType()),
        T.StructField("Processing Time (min)", T.DoubleType()),
        T.StructField("Avg Time per ASIN (s)", T.DoubleType()),
        T.StructField("Price/PED Errors", T.LongType()),
        T.StructField("Scraping Errors", T.LongType()),
        T.StructField("Redirected ASINs", T.LongType()),
        T.StructField("Total Errors", T.LongType()),
    ]
)
ERROR_SCHEMA = text_schema(["Date", "Time", "Country", "ASIN", "Error Type", "Error Details"])


def field(name: str) -> Column:
    """Column by its exact name, also when the name holds a dot or a slash."""
    return F.col(f"`{name}`")


def ensure_columns(df: DataFrame, names: list[str], default: str = NOT_FOUND) -> DataFrame:
    """Add each column of ``names`` that ``df`` lacks, filled with ``default``."""
    absent = [n for n in names if n not in df.columns]
    return df.select("*", *[F.lit(default).alias(n) for n in absent]) if absent else df


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
