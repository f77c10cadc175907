"""Classification rules: stock, badges, changes, success tiers, failures."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfpanel.functions.text import is_missing, strip
from shelfpanel.schemas import NO_VALUE

# Stock classes and the patterns that lead to them, in order of precedence.
STOCK_PATTERNS = {
    "in_stock": [
        r"^in stock$", r"^en stock$", r"^auf lager$", r"^disponibilità immediata$", r"^in stock\b",
    ],
    "low_stock": [
        r"^only \d+", r"^nur noch \d+", r"^il ne reste plus que \d+", r"^solo \d+ rim",
        r"left in stock", r"auf lager\b",
    ],
    "unavailable": [
        r"unavailable", r"indisponible", r"non disponibile", r"no disponible", r"nicht verf",
    ],
    "ships_delayed": [
        r"ships within", r"usually ship", r"habituellement exp", r"expédié sous",
        r"within \d+ to \d+ day",
    ],
}
# Attempts allowed per key.
MAX_RETRIES = 3


def first_match(text: Column, rules: dict[str, list[str]], default: str) -> Column:
    """Name of the first rule group with a pattern found in ``text``."""
    chain = F
    for name, patterns in rules.items():
        chain = chain.when(text.rlike("|".join(f"(?:{p})" for p in patterns)), name)
    return chain.otherwise(default)


def stock_class(c: Column, rules: dict[str, list[str]] | None = None) -> Column:
    known = first_match(F.lower(strip(c)), rules or STOCK_PATTERNS, NO_VALUE)
    return F.when(is_missing(c), NO_VALUE).otherwise(known)


def badge_value(c: Column) -> Column:
    return F.when(is_missing(c), NO_VALUE).otherwise(strip(c))


def change_type(before: Column, after: Column) -> Column:
    """gained, lost or changed; null where nothing changed."""
    return (
        F.when(before == after, F.lit(None).cast("string"))
        .when(before == NO_VALUE, "gained")
        .when(after == NO_VALUE, "lost")
        .otherwise("changed")
    )


def success_tier(rate: Column) -> Column:
    return F.when(rate >= 95, "green").when(rate >= 85, "amber").otherwise("red")


def run_status(total_errors: Column) -> Column:
    return F.when(total_errors == 0, "Ran Successfully").otherwise("Ran with Errors")


def failure_reason(message: Column) -> Column:
    text = F.lower(F.coalesce(message, F.lit("")))
    return (
        F.when(text.contains("zip"), "zip_error")
        .when(text.contains("network") | text.contains("timeout"), "network_error")
        .otherwise("scraping_error")
    )


def next_action(reason: Column, attempts: Column) -> Column:
    """What to do with a failed key, from the kind of failure and the retries so far."""
    return (
        F.when(
            reason == "zip_error",
            F.when(attempts == 0, "DELAYED").when(attempts == 1, "NEW_SESSION").otherwise("SKIP"),
        )
        .when(reason == "network_error", F.when(attempts < 2, "DELAYED").otherwise("SKIP"))
        .otherwise(F.when(attempts < 1, "IMMEDIATE").otherwise("NEW_SESSION"))
    )
