"""Audit of a stored panel: every check as rows of one scorecard."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpanel.operators import audit_checks as checks
from shelfpanel.operators.history import history_flags
from shelfpanel.operators.outliers import iqr_outliers
from shelfpanel.schemas import ESSENTIAL_COLUMNS, field, text_columns

COLUMNS = ["category", "item", "severity", "count", "detail"]
CRITICAL, WARNING = "critical", "warning"


def _row(category: str, item, severity: str, count: Column, detail: Column | None = None) -> Column:
    return F.struct(
        F.lit(category).alias("category"),
        (F.lit(item) if isinstance(item, str) else item).alias("item"),
        F.lit(severity).alias("severity"),
        count.cast("long").alias("count"),
        (detail if detail is not None else F.lit("")).cast("string").alias("detail"),
    )


def _single_pass(panel: DataFrame) -> DataFrame:
    """All checks that only count, from one scan with one row of partial sums per task."""
    texts = text_columns(panel)
    essential = [c for c in ESSENTIAL_COLUMNS if c in panel.columns]
    day = checks.date_of(panel)
    rules = {
        n: c for n, c in checks.range_rule_columns().items()
        if {"rating_out_of_range": "Rating Stars", "negative_rating_count": "Number of ratings",
            "size_name_escape": "Size Name"}[n] in panel.columns
    }
    sentinels = sum((checks.is_sentinel(field(c)).cast("long") for c in texts), F.lit(0))
    one_row = checks.with_states(panel, essential).agg(
        F.count("*").alias("rows"),
        F.sum(sentinels).alias("sentinels"),
        F.avg(checks.row_bytes(panel)).alias("avg_bytes"),
        F.count_if(day.isNull()).alias("invalid_dates"),
        *checks.counters(essential),
        *[F.count_if(c).alias(n) for n, c in rules.items()],
        *[
            F.count_if(checks.has_corrupt_escape(field(c))).alias(f"escape_{i}")
            for i, c in enumerate(texts)
        ],
    )
    ratio = F.coalesce(
        F.try_divide(F.col("sentinels"), F.col("rows") * F.lit(len(panel.columns))), F.lit(0.0)
    )
    rows = [
        _row("empty", "panel", CRITICAL, F.when(F.col("rows") == 0, 1).otherwise(0)),
        _row("dates", "invalid", WARNING, F.col("invalid_dates")),
        _row(
            "sentinel_ratio", "panel", WARNING,
            F.when(ratio > checks.MAX_SENTINEL_RATIO, 1).otherwise(0), F.round(ratio, 4),
        ),
        _row(
            "row_size", "panel", WARNING,
            F.coalesce(F.when(F.col("avg_bytes") > checks.MAX_ROW_KB * 1024, 1), F.lit(0)),
            F.round("avg_bytes", 1),
        ),
        *[_row("missing", c, WARNING, F.col(f"missing_{i}")) for i, c in enumerate(essential)],
        *[_row("not_found", c, WARNING, F.col(f"not_found_{i}")) for i, c in enumerate(essential)],
        *[_row("range_rule", n, WARNING, F.col(n)) for n in rules],
        *[_row("escapes", c, WARNING, F.col(f"escape_{i}")) for i, c in enumerate(texts)],
    ]
    return one_row.select(F.inline(F.array(*rows)))


def audit_panel(panel: DataFrame, per_country_history: bool = False) -> DataFrame:
    """Findings of the panel (category, item, severity, count, detail); no row means no finding.

    ``Date`` may be a date or panel text. Duplicates, outliers and history have passes of their
    own because they need their own shuffles.
    """
    typed = panel.withColumn("Date", checks.date_of(panel))
    duplicates = checks.duplicate_rows(typed).select(
        F.inline(F.array(_row("duplicates", "Country, ASIN, Date", WARNING, F.col("duplicate_rows"))))
    )
    outliers = iqr_outliers(typed).select(
        F.inline(
            F.array(
                _row(
                    "outliers",
                    F.concat_ws("/", "Country", "column"),
                    WARNING,
                    F.col("outliers"),
                    F.concat_ws(
                        " ",
                        *[F.format_string("%.2f", c) for c in ("min_outlier", "max_outlier", "lower", "upper")],
                    ),
                )
            )
        )
    )
    history = history_flags(typed, per_country_history).select(
        F.inline(
            F.array(
                _row(
                    "history", F.col("flag"), WARNING, F.col("rows"),
                    F.concat_ws("/", "example_country", "example_asin"),
                )
            )
        )
    )
    findings = _single_pass(panel).unionByName(duplicates).unionByName(outliers).unionByName(history)
    return findings.where(F.col("count") > 0).select(*COLUMNS)


def audit_verdict(findings: DataFrame) -> DataFrame:
    """Number of findings and whether the panel holds up (no critical one)."""
    return findings.agg(
        F.count_if(F.col("severity") == CRITICAL).alias("critical"),
        F.count_if(F.col("severity") == WARNING).alias("warnings"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_count"),
        (F.count_if(F.col("severity") == CRITICAL) == 0).alias("valid"),
    )
