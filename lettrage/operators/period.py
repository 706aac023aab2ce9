"""Reconciliation period: resolution, filtering, summary.

The automatic period is one row of bounds computed by one partial aggregate per source. Filtering
takes the two dates as literals (`resolve` fetches that single row), so the range reaches the scan
of the sources as a pushed filter.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as fx
from ..functions import scalars as s

DATE_OF = {"erp": "erp_date", "rci": "rci_date", "pdf": "pdf_invoice_date"}


@dataclass(frozen=True)
class PeriodConfig:
    enabled: bool = True
    mode: str = "auto"
    days_before: int = 3
    days_after: int = 1
    fallback_days: int = 7


@dataclass(frozen=True)
class Period:
    start: date | None
    end: date | None
    mode: str
    source: str

    @property
    def label(self) -> str:
        if self.start is None or self.end is None:
            return fx.NO_PERIOD_LABEL
        return f"{self.start.isoformat()} -> {self.end.isoformat()}"


DISABLED = Period(None, None, "disabled", "disabled")


def _day_of(frame: DataFrame, column: str):
    types = dict(frame.dtypes)
    return s.day(column, types[column]) if column in types else F.lit(None).cast("date")


def period_bounds(erp: DataFrame, rci: DataFrame, pdf: DataFrame, config: PeriodConfig = PeriodConfig()) -> DataFrame:
    """One row: start, end, mode and source of the automatic period; nulls if no date is usable."""
    parts = [
        frame.select(F.lit(src).alias("src"), _day_of(frame, DATE_OF[src]).alias("day"))
        for src, frame in (("erp", erp), ("rci", rci), ("pdf", pdf))
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    own = lambda src: F.when(F.col("src") == src, F.col("day"))
    one = union.agg(
        F.max(own("erp")).alias("erp_hi"),
        F.min(own("rci")).alias("rci_lo"), F.max(own("rci")).alias("rci_hi"),
        F.min(own("pdf")).alias("pdf_lo"), F.max(own("pdf")).alias("pdf_hi"),
        F.count_if(F.col("src") == "rci").alias("rci_rows"),
    )
    fallback = max(config.fallback_days, 1)
    by_rci = F.col("rci_lo").isNotNull()
    by_pdf = F.col("pdf_lo").isNotNull() & (F.col("rci_rows") == 0)
    by_erp = F.col("erp_hi").isNotNull()
    before, after = config.days_before, config.days_after
    return one.select(
        F.when(by_rci, F.date_sub("rci_lo", before))
        .when(by_pdf, F.date_sub("pdf_lo", before))
        .otherwise(F.date_sub("erp_hi", fallback - 1))
        .alias("start_date"),
        F.when(by_rci, F.date_add("rci_hi", after))
        .when(by_pdf, F.date_add("pdf_hi", after))
        .otherwise(F.col("erp_hi"))
        .alias("end_date"),
        F.when(by_rci | by_pdf, "auto").when(by_erp, "fallback").alias("mode"),
        F.when(by_rci, "rci_txt").when(by_pdf, "pdf").when(by_erp, "erp").alias("source"),
    )


def _given_day(spark, text: str) -> date:
    try:
        return date.fromisoformat(str(text))
    except ValueError:
        day = spark.range(1).select(s.date_value(F.lit(str(text))).alias("day")).first().day
    if day is None:
        raise ValueError(f"not a date: {text}")
    return day


def manual_period(spark, date_from: str | None, date_to: str | None) -> Period:
    """Period given by the caller; both dates are needed, in order."""
    if not date_from or not date_to:
        raise ValueError("date_from and date_to must be given together")
    start, end = _given_day(spark, date_from), _given_day(spark, date_to)
    if start > end:
        raise ValueError("date_from must not be after date_to")
    return Period(start, end, "manual", "cli")


def resolve(
    erp: DataFrame,
    rci: DataFrame,
    pdf: DataFrame,
    config: PeriodConfig = PeriodConfig(),
    date_from: str | None = None,
    date_to: str | None = None,
) -> Period:
    """Period as two dates. The automatic one runs one aggregate and fetches its single row."""
    if not config.enabled:
        return DISABLED
    if date_from or date_to:
        return manual_period(erp.sparkSession, date_from, date_to)
    if config.mode.strip().lower() != "auto":
        raise ValueError(f"unknown period mode: {config.mode}")
    row = period_bounds(erp, rci, pdf, config).first()
    if row.source is None:
        raise ValueError("no usable date in any source to derive the period from")
    return Period(row.start_date, row.end_date, row.mode, row.source)


def keep_in_period(erp: DataFrame, period: Period) -> DataFrame:
    """ERP rows dated inside the period; undated rows are dropped."""
    if period.start is None:
        return erp
    return erp.filter(_day_of(erp, "erp_date").between(F.lit(period.start), F.lit(period.end)))


def tag_period(bank: DataFrame, src: str, period: Period) -> DataFrame:
    """All bank rows with ``date_filter_status``; rows outside also get a comment."""
    if period.start is None:
        return bank
    day = _day_of(bank, DATE_OF[src])
    tagged = bank.withColumn(
        "date_filter_status",
        F.when(day.isNull(), "date_missing_kept")
        .when(day.between(F.lit(period.start), F.lit(period.end)), "in_period")
        .otherwise("out_of_period"),
    )
    return tagged.withColumn(
        "commentaire_audit",
        F.when(F.col("date_filter_status") == "out_of_period", fx.COMMENT_OUT_OF_PERIOD_ROW),
    )


def split_period(bank: DataFrame, src: str, period: Period) -> tuple[DataFrame, DataFrame]:
    """Kept rows (inside or undated) and rows outside the period."""
    if period.start is None:
        return bank, bank.limit(0)
    tagged = tag_period(bank, src, period)
    late = F.col("date_filter_status") == "out_of_period"
    return tagged.filter(~late).drop("commentaire_audit"), tagged.filter(late)


def period_summary(erp: DataFrame, rci: DataFrame, pdf: DataFrame, period: Period) -> DataFrame:
    """One row: counts before, after and excluded, undated rows kept, and the two alerts."""
    enabled = period.start is not None
    parts = []
    for src, frame in (("erp", erp), ("rci", rci), ("pdf", pdf)):
        parts.append(frame.select(F.lit(src).alias("src"), _day_of(frame, DATE_OF[src]).alias("day")))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    undated = F.col("day").isNull()
    inside = F.col("day").between(F.lit(period.start), F.lit(period.end)) if enabled else F.lit(True)
    kept = F.when(undated, (F.col("src") != "erp") | F.lit(not enabled)).otherwise(inside)
    measures = []
    for src in ("erp", "rci", "pdf"):
        own = F.col("src") == src
        measures += [
            F.count_if(own).alias(f"{src}_rows_before_date_filter"),
            F.count_if(own & kept).alias(f"{src}_rows_after_date_filter"),
        ]
        if src != "erp":
            measures.append(F.count_if(own & undated & F.lit(enabled)).alias(f"{src}_rows_missing_date_kept"))
    one = rows.agg(*measures)
    before = lambda src: F.col(f"{src}_rows_before_date_filter")
    after = lambda src: F.col(f"{src}_rows_after_date_filter")
    return one.select(
        F.lit(enabled).alias("date_filter_enabled"),
        F.lit(period.mode).alias("date_filter_mode"),
        F.lit(period.source).alias("date_filter_source"),
        F.lit(period.start.isoformat() if enabled else None).cast("string").alias("reconciliation_start_date"),
        F.lit(period.end.isoformat() if enabled else None).cast("string").alias("reconciliation_end_date"),
        F.lit(period.label).alias("reconciliation_period"),
        *[
            column
            for src in ("erp", "rci", "pdf")
            for column in (before(src), after(src), (before(src) - after(src)).alias(f"{src}_rows_excluded_by_date"))
        ],
        (before("rci") + before("pdf")).alias("rci_pdf_rows_before_date_filter"),
        (after("rci") + after("pdf")).alias("rci_pdf_rows_after_date_filter"),
        (before("rci") + before("pdf") - after("rci") - after("pdf")).alias("rci_pdf_rows_excluded_by_date"),
        "rci_rows_missing_date_kept",
        "pdf_rows_missing_date_kept",
        (F.lit(enabled) & (before("rci") > 0) & (after("rci") == 0)).alias("no_rci_flux_in_period_alert"),
        (F.lit(enabled and period.source == "rci_txt") & (before("pdf") > after("pdf"))).alias(
            "pdf_period_mismatch_alert"
        ),
    )
