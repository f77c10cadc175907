"""The marketplace dimension: one row per country, from the nested settings file."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Currency symbol expected per country, and other ways a symbol is written.
CURRENCY_SYMBOLS = {
    "US": "$", "GB": "£", "DE": "€", "FR": "€", "IT": "€", "ES": "€", "CA": "$", "MX": "$",
}
CURRENCY_ALIASES = {
    "USD": "$", "CAD": "$", "GBP": "£", "EUR": "€", "MXN": "$", "$": "$", "£": "£", "€": "€",
}
# Share of a country's rows that are verified again.
CHECK_PROBABILITY = {
    "DE": 0.40, "FR": 0.20, "IT": 0.20, "ES": 0.20, "US": 0.15, "GB": 0.15, "CA": 0.15, "MX": 0.15,
}
DEFAULT_CHECK_PROBABILITY = 0.15

_SELECTOR = T.StructType([T.StructField("by", T.StringType()), T.StructField("value", T.StringType())])
RULE_MAP = T.MapType(T.StringType(), T.ArrayType(_SELECTOR))
_TEXT_MAP = T.MapType(T.StringType(), T.StringType())

MARKETPLACE_SCHEMA = T.StructType(
    [
        T.StructField("Country", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("language_code", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("base_url", T.StringType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("bsr_search_text", T.StringType()),
        T.StructField("brand_prefix", T.StringType()),
        T.StructField("brand_suffix", T.StringType()),
        T.StructField("sponsored_text", T.StringType()),
        T.StructField("bought_text", T.StringType()),
        T.StructField("coupon_suffix_text", T.StringType()),
        T.StructField("rules", RULE_MAP),
    ]
)

_MARKET_JSON = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in (
            "name", "sales_region_code", "language_code", "domain", "base_url", "zip_code",
            "bsr_search_text",
        )
    ]
    + [
        T.StructField("text_replacements", _TEXT_MAP),
        T.StructField("search_texts", _TEXT_MAP),
        T.StructField("xpaths", _TEXT_MAP),
        T.StructField("kw_xpaths", _TEXT_MAP),
    ]
)
_CONFIG_JSON = T.StructType(
    [
        T.StructField("default_xpaths", _TEXT_MAP),
        T.StructField("marketplaces", T.MapType(T.StringType(), _MARKET_JSON)),
    ]
)


def merge_maps(defaults, overrides):
    """Two maps as one; where both hold a key the second wins."""
    base = F.coalesce(defaults, F.create_map().cast(RULE_MAP))
    over = F.coalesce(overrides, F.create_map().cast(RULE_MAP))
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(over, k))
    return F.map_concat(kept, over)


def _rule_map(raw):
    """Map of JSON texts to map of selector lists; a single selector is a list of one."""

    def selectors(text):
        listed = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
        return F.from_json(listed, T.ArrayType(_SELECTOR))

    return F.transform_values(raw, lambda _, v: selectors(v))


def read_marketplaces(spark: SparkSession, path: str) -> DataFrame:
    """Countries of a settings file with their merged rules; no rows where the file is absent."""
    try:
        config = spark.read.schema(_CONFIG_JSON).json(path, multiLine=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MARKETPLACE_SCHEMA)
    return _countries(config)


def marketplaces_from_text(spark: SparkSession, settings: str) -> DataFrame:
    """The same from the text of a settings file."""
    parsed = spark.range(1).select(F.from_json(F.lit(settings), _CONFIG_JSON).alias("c"))
    return _countries(parsed.select("c.*"))


def _countries(config: DataFrame) -> DataFrame:
    rows = config.select("default_xpaths", F.explode("marketplaces").alias("Country", "m"))
    own_rules = F.coalesce(F.col("m.xpaths"), F.col("m.kw_xpaths"))
    return rows.select(
        "Country",
        F.col("m.name").alias("name"),
        F.col("m.sales_region_code").alias("region"),
        F.col("m.language_code").alias("language_code"),
        F.col("m.domain").alias("domain"),
        F.col("m.base_url").alias("base_url"),
        F.col("m.zip_code").alias("zip_code"),
        F.col("m.bsr_search_text").alias("bsr_search_text"),
        F.col("m.text_replacements")["brand_prefix"].alias("brand_prefix"),
        F.col("m.text_replacements")["brand_suffix"].alias("brand_suffix"),
        F.coalesce(F.col("m.search_texts")["sponsored_text"], F.lit("Sponsored")).alias("sponsored_text"),
        F.coalesce(F.col("m.search_texts")["bought_text"], F.lit("bought in past month")).alias("bought_text"),
        F.coalesce(F.col("m.search_texts")["coupon_suffix_text"], F.lit("with coupon")).alias("coupon_suffix_text"),
        merge_maps(_rule_map(F.col("default_xpaths")), _rule_map(own_rules)).alias("rules"),
    )


def collected_rules(marketplaces: DataFrame) -> dict[str, dict]:
    """Merged rules of each country, read to the driver: one row per country. Rules that are no selectors are left out."""
    if "rules" not in marketplaces.columns:
        return {}
    rows = marketplaces.select("Country", "rules").collect()
    return {r["Country"]: {k: v for k, v in (r["rules"] or {}).items() if v} for r in rows}


def dimension(marketplaces: DataFrame, *columns: str) -> DataFrame:
    """Columns of the marketplaces for a join, broadcast: one row per country.

    A frame made from local rows has no known size, and a join on the country that is not a
    broadcast would bring a whole country to one task.
    """
    return F.broadcast(marketplaces.select("Country", *columns))
