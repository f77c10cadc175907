"""Ledger of failed keys."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpanel.functions.states import MAX_RETRIES, failure_reason, next_action
from shelfpanel.operators.dedup import first_per_group


def failure_ledger(
    attempts: DataFrame, by: list[str] | None = None, max_retries: int = MAX_RETRIES
) -> DataFrame:
    """State of every key that failed at least once.

    ``attempts`` has the key columns, ``seq``, ``message`` (null for a success) and ``ok``. A
    success closes the entry of its key and a failure after it opens a new one, so a key is
    recovered only if no failure follows its last success; it then shows all its failures, another
    key those of its open entry. ``attempts`` counts retries: failures after the first. Both passes
    reduce a key to sums and extremes before the shuffle.
    """
    by = by or ["ASIN"]
    failed = ~F.col("ok")
    closed = attempts.where("ok").groupBy(*by).agg(F.max("seq").alias("_closed"))
    last = attempts.where(failed).groupBy(*by).agg(F.max("seq").alias("_last"))
    # Only keys with a success have rows to leave out, and one row per key says which.
    bounds = last.join(closed, by, "left").select(
        *by,
        F.coalesce(F.col("_closed") > F.col("_last"), F.lit(False)).alias("recovered"),
        F.when(F.col("_closed") < F.col("_last"), F.col("_closed")).alias("_after"),
    )
    # Extremes of (seq, reason) pairs carry the first and last reason along.
    marked = attempts.where(failed).select(
        *by, "seq", F.struct("seq", failure_reason(F.col("message")).alias("reason")).alias("f")
    )
    open_rows = marked.join(bounds, by).where(F.col("_after").isNull() | (F.col("seq") > F.col("_after")))
    state = open_rows.groupBy(*by, "recovered").agg(
        F.count("f").alias("failures"),
        F.min("f")["reason"].alias("reason"),
        F.max("f")["reason"].alias("latest"),
    )
    retries = F.col("failures") - 1
    status = (
        F.when(F.col("recovered"), "recovered")
        .when(retries >= max_retries, "permanent")
        .otherwise("pending")
    )
    return state.where("failures > 0").select(
        *by,
        "reason",
        retries.alias("attempts"),
        F.when(retries > 0, F.col("latest")).alias("last_error"),
        status.alias("status"),
        F.when(status == "pending", next_action(F.col("reason"), retries)).alias("next_action"),
    )


def retryable(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("status") == "pending")


def ledger_counts(ledger: DataFrame, by: list[str]) -> DataFrame:
    return ledger.groupBy(*by).agg(F.count("*").alias("keys"))


def first_permanent(ledger: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """First permanent failures per group, for a report."""
    return first_per_group(ledger.where(F.col("status") == "permanent"), keys, ["ASIN"], n)
