"""Run summaries, error samples and report lines."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpanel.functions.addresses import run_key
from shelfpanel.functions.dates import event_text
from shelfpanel.functions.numbers import duration_text, percent
from shelfpanel.functions.states import run_status, success_tier
from shelfpanel.operators.dedup import first_per_group

RUN = ["Country", "ended_at"]
FAILED, PRICE_PED = "failed", "price_ped"
# Wording of the error samples.
ERROR_TYPE = {FAILED: "Complete Scraping Failure", PRICE_PED: "Price/PED Error"}
ERROR_DETAIL = {
    FAILED: "Failed after multiple retries",
    PRICE_PED: "Both Price and PED fields empty/not found",
}
SAMPLE_SIZE = 10
RULE_WIDTH = 60


def errors_from_lists(runs: DataFrame) -> DataFrame:
    """Error rows (run, seq, ASIN, kind) from runs that carry lists ``failed`` and ``price_ped``."""
    listed = F.array(
        *[F.struct(F.lit(k).alias("kind"), F.col(k).alias("keys")) for k in (FAILED, PRICE_PED)]
    )
    kinds = runs.select(*RUN, F.inline(listed))
    return kinds.select(*RUN, "kind", F.posexplode("keys").alias("seq", "ASIN"))


def with_error_counts(runs: DataFrame, errors: DataFrame) -> DataFrame:
    """Runs with the number of errors of each kind."""
    counts = errors.groupBy(*RUN).agg(
        F.count_if(F.col("kind") == FAILED).alias("n_failed"),
        F.count_if(F.col("kind") == PRICE_PED).alias("n_price_ped"),
    )
    joined = runs.join(counts, RUN, "left")
    return joined.withColumns(
        {n: F.coalesce(F.col(n), F.lit(0)) for n in ("n_failed", "n_price_ped")}
    )


def execution_summary(runs: DataFrame, errors: DataFrame, detailed: bool = False) -> DataFrame:
    """One summary row per run: counts, success rate, minutes and seconds per row.

    ``detailed`` adds what a message about the run shows: tier, status and duration text.
    """
    r = with_error_counts(runs, errors)
    seconds = F.col("elapsed_seconds")
    per_row = F.coalesce(
        F.try_divide(seconds, F.when(F.col("processed") > 0, F.col("processed"))), F.lit(0.0)
    )
    return r.select(
        run_key(F.col("Country"), F.date_format("ended_at", "yyyy-MM-dd HH:mm:ss")).alias("Execution ID"),
        event_text(F.col("ended_at")).alias("Date"),
        F.date_format("ended_at", "HH:mm:ss").alias("Time"),
        "Country",
        F.col("processed").alias("Processed ASINs"),
        F.col("requested").alias("Total Requested"),
        F.round(_rate(), 1).alias("Success Rate (%)"),
        F.round(seconds / 60, 1).alias("Processing Time (min)"),
        F.round(per_row, 2).alias("Avg Time per ASIN (s)"),
        F.col("n_price_ped").alias("Price/PED Errors"),
        F.col("n_failed").alias("Scraping Errors"),
        F.col("redirects").alias("Redirected ASINs"),
        (F.col("n_failed") + F.col("n_price_ped")).alias("Total Errors"),
        *(_message_fields() if detailed else []),
    )


def _rate() -> Column:
    return percent(F.col("processed"), F.col("requested"))


def _all_errors() -> Column:
    """Errors, redirects and removed rows: what makes a run one with errors."""
    return F.col("n_failed") + F.col("n_price_ped") + F.col("redirects") + F.col("removed")


def _message_fields() -> list[Column]:
    return [
        success_tier(_rate()).alias("tier"),
        run_status(_all_errors()).alias("status"),
        duration_text(F.col("elapsed_seconds")).alias("duration"),
    ]


def error_samples(errors: DataFrame, n: int = SAMPLE_SIZE) -> DataFrame:
    """First ``n`` errors of each kind per run."""
    kind = F.col("kind")
    firsts = first_per_group(errors, [*RUN, "kind"], ["seq", "ASIN"], n)
    return firsts.select(
        event_text(F.col("ended_at")).alias("Date"),
        F.date_format("ended_at", "HH:mm:ss").alias("Time"),
        "Country",
        "ASIN",
        F.when(kind == FAILED, ERROR_TYPE[FAILED]).otherwise(ERROR_TYPE[PRICE_PED]).alias("Error Type"),
        F.when(kind == FAILED, ERROR_DETAIL[FAILED]).otherwise(ERROR_DETAIL[PRICE_PED]).alias("Error Details"),
    )


def batch_rollup(runs: DataFrame) -> DataFrame:
    """Runs, successes, failures and time per country, and over all (Country null)."""
    return runs.rollup("Country").agg(
        F.count("*").alias("runs"),
        F.count_if("success").alias("successes"),
        F.count_if(~F.col("success")).alias("failures"),
        F.sum("elapsed_seconds").alias("elapsed_seconds"),
    )


def run_report(runs: DataFrame, errors: DataFrame, title: str = "Panel") -> DataFrame:
    """Report lines per run (run_id, line_no, line)."""
    shown = first_per_group(errors, [*RUN, "kind"], ["seq", "ASIN"], 3)
    names = shown.groupBy(*RUN).agg(
        *[
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("seq", "ASIN")))),
                    lambda s: s["ASIN"],
                ),
                ", ",
            ).alias(f"sample_{k}")
            for k in (FAILED, PRICE_PED)
        ]
    )
    r = with_error_counts(runs, errors).join(names, RUN, "left")
    total, rate = _all_errors(), _rate()
    any_error = total > 0

    def text(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    lines = [
        F.lit("=" * RULE_WIDTH),
        text(f"{title} ", F.col("Country"), " - ", run_status(total)),
        text(
            "Extracted: ", F.col("processed"), "/", F.col("requested"), " products (",
            F.format_string("%.1f", rate), "%)",
        ),
        F.lit("-" * RULE_WIDTH),
        text("Finished at: ", F.date_format("ended_at", "yyyy-MM-dd HH:mm")),
        text("Processing time: ", duration_text(F.col("elapsed_seconds"))),
        text("- Processed ASINs: ", F.col("processed")),
        text("- Scraping errors: ", total),
        F.when(F.col("n_price_ped") > 0, text("   - Price/PED errors: ", F.col("n_price_ped"))),
        F.when(F.col("redirects") > 0, text("   - Redirected ASINs: ", F.col("redirects"))),
        F.when(
            F.col("removed") > 0,
            text("   - Rows removed (ASIN not found on page): ", F.col("removed")),
        ),
        F.when(
            any_error & (F.col("n_failed") > 0),
            text("- Sample failed ASINs (showing first 3): ", F.col(f"sample_{FAILED}")),
        ),
        F.when(
            any_error & (F.col("n_price_ped") > 0),
            text("- Sample Price/PED errors (showing first 3): ", F.col(f"sample_{PRICE_PED}")),
        ),
        F.lit("=" * RULE_WIDTH),
    ]
    run_id = run_key(F.col("Country"), F.date_format("ended_at", "yyyy-MM-dd HH:mm:ss"))
    return r.select(
        run_id.alias("run_id"),
        success_tier(rate).alias("tier"),
        F.posexplode(F.array_compact(F.array(*lines))).alias("line_no", "line"),
    )
