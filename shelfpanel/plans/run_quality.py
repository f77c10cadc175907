"""Quality of collection runs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpanel.operators import runs as ops
from shelfpanel.operators.keys import price_errors
from shelfpanel.schemas import ERROR_SCHEMA, SUMMARY_SCHEMA
from shelfpanel.sources.sinks import append_report, replace_runs


def price_ped_rows(cleaned: DataFrame, run: list[str]) -> DataFrame:
    """Error rows for cleaned observations with neither price nor member price."""
    return price_errors(cleaned).select(
        *run, F.lit(0).alias("seq"), "ASIN", F.lit(ops.PRICE_PED).alias("kind")
    )


def run_quality(runs: DataFrame, errors: DataFrame, title: str = "Panel") -> dict[str, DataFrame]:
    """Summary rows, error samples and report lines of runs.

    ``runs``: Country, ended_at, elapsed_seconds, requested, processed, redirects, removed.
    ``errors``: Country, ended_at, seq, ASIN, kind (``failed`` or ``price_ped``).
    """
    return {
        "summary": ops.execution_summary(runs, errors),
        "samples": ops.error_samples(errors),
        "report": ops.run_report(runs, errors, title),
    }


def store_run_quality(tables: dict[str, DataFrame], folder: str) -> None:
    """Storing a run again replaces its rows in all three."""
    replace_runs(tables["summary"], f"{folder}/execution_summary", tables["summary"], SUMMARY_SCHEMA)
    replace_runs(tables["samples"], f"{folder}/error_samples", tables["summary"], ERROR_SCHEMA)
    append_report(tables["report"], f"{folder}/reports")


