"""Dashboard tables: recomputed summary, key figures, alerts, distributions, tops and trend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as fx
from ..functions import scalars as s
from ..functions import wording as w
from ..sources.history import latest_run, pivot_metrics

# fixed values: metric names that may hold a count, in order of preference
STATUS_METRICS = {
    fx.OK: ["status_ok", "matched_invoices", "ok"],
    fx.MISSING: ["status_manquante_rci", "unmatched_erp", "missing_rci", "manquante_rci"],
    fx.OUT_OF_SCOPE: ["status_hors_scope_rci", "out_of_scope_rci", "hors_scope_rci"],
    fx.AMOUNT_GAP: ["status_anomalie_montant", "amount_anomalies", "anomalie_montant"],
    fx.DATE_GAP: ["status_anomalie_date", "date_anomalies", "anomalie_date"],
    fx.DUPLICATE: ["status_doublon", "duplicates", "doublon"],
    fx.BANK_ONLY: ["status_rci_seulement", "unmatched_rci", "rci_seulement"],
    fx.OUT_OF_PERIOD: [
        "total_rci_pdf_out_of_period", "rci_out_of_period", "status_rci_hors_periode",
        "rci_pdf_rows_excluded_by_date", "rci_rows_excluded_by_date", "rci_txt_rows_excluded_by_date",
    ],
}
GAP_METRICS = {
    "critical_gaps": ["critical_gaps", "severity_critique"],
    "high_gaps": ["high_gaps", "severity_elevee"],
    "medium_gaps": ["medium_gaps", "severity_moyenne"],
}
_OTHER = [
    "rci_rows_before_date_filter", "rci_rows_after_date_filter", "no_rci_flux_in_period_alert",
    "pdf_period_mismatch_alert", "low_matching_rate_alert", "total_impacted_amount",
]


def _whole(text: Column) -> Column:
    return F.coalesce(s.lenient_number(text, drop_commas=True).try_cast("bigint"), F.lit(0).cast("bigint"))


def _first_whole(names: list[str]) -> Column:
    return _whole(F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names]))


def _truth(name: str) -> Column:
    text = F.lower(F.trim(F.coalesce(F.col(name), F.lit(""))))
    return ~text.isin("false", "0", "no", "non", "n", "")


def dashboard_summary(metrics: DataFrame) -> DataFrame:
    """One row recomputed from ``(metric, value)`` rows; the rate is null when no feed is in the period."""
    names = list(dict.fromkeys([n for v in (*STATUS_METRICS.values(), *GAP_METRICS.values()) for n in v] + _OTHER))
    wide = pivot_metrics(metrics, names)
    count = {status: _first_whole(found) for status, found in STATUS_METRICS.items()}
    total = lambda statuses: sum((count[n] for n in statuses[1:]), count[statuses[0]])
    no_feed = _truth("no_rci_flux_in_period_alert") | (
        (_whole(F.col("rci_rows_before_date_filter")) > 0) & (_whole(F.col("rci_rows_after_date_filter")) == 0)
    )
    matchable = total(fx.MATCHABLE)
    rate = F.when(~no_feed, F.coalesce(F.try_divide(count[fx.OK], matchable), F.lit(0.0)))
    return wide.select(
        total(fx.ANALYSED).alias("erp_analyzed_invoices"),
        total(fx.ANALYSED).alias("reconciled_invoices"),
        matchable.alias("erp_matchable_invoices"),
        count[fx.OK].alias("matched_invoices"),
        count[fx.MISSING].alias("unmatched_erp"),
        count[fx.OUT_OF_SCOPE].alias("out_of_scope_rci"),
        count[fx.AMOUNT_GAP].alias("amount_anomalies"),
        count[fx.DATE_GAP].alias("date_anomalies"),
        count[fx.DUPLICATE].alias("duplicates"),
        count[fx.BANK_ONLY].alias("unmatched_rci"),
        count[fx.OUT_OF_PERIOD].alias("rci_out_of_period"),
        total(fx.GAPS).alias("gaps_detected"),
        no_feed.alias("dashboard_no_rci_flux_in_period"),
        ((count[fx.OUT_OF_PERIOD] > 0) & (count[fx.OK] == 0)).alias("dashboard_period_mismatch"),
        rate.alias("matching_rate"),
        F.coalesce(s.lenient_number("total_impacted_amount", True), F.lit(0.0)).alias("total_impacted_amount"),
        *[_first_whole(found).alias(name) for name, found in GAP_METRICS.items()],
        _truth("pdf_period_mismatch_alert").alias("pdf_period_mismatch_alert"),
        _truth("low_matching_rate_alert").alias("low_matching_rate_alert"),
    )


def history_latest_summary(history: DataFrame) -> DataFrame:
    """Counts, impact and rate of the last run of the history."""
    count = lambda statuses: F.count_if(F.col("status").isin(list(statuses)))
    ok, matchable = count([fx.OK]), count([*fx.GAPS, fx.OK])
    return latest_run(history).agg(
        count(fx.ANALYSED).alias("erp_analyzed_invoices"),
        count(fx.ANALYSED).alias("reconciled_invoices"),
        matchable.alias("erp_matchable_invoices"),
        count([fx.OUT_OF_SCOPE]).alias("out_of_scope_rci"),
        ok.alias("matched_invoices"),
        count([fx.MISSING]).alias("unmatched_erp"),
        count([fx.OUT_OF_PERIOD]).alias("rci_out_of_period"),
        count(fx.GAPS).alias("gaps_detected"),
        F.coalesce(F.sum(_amount("montant_impacte")), F.lit(0)).alias("total_impacted_amount"),
        F.coalesce(F.try_divide(ok, matchable), F.lit(0.0)).alias("matching_rate"),
    )


def _amount(name: str) -> Column:
    return F.translate(F.col(name).cast("string"), ",", "").try_cast(s.MONEY)


def _listed(one: DataFrame, entries: list[tuple[str, Column]]) -> DataFrame:
    rows = [
        F.struct(F.lit(i).alias("place"), F.lit(label).alias("label"), value.cast("double").alias("value"))
        for i, (label, value) in enumerate(entries, start=1)
    ]
    return one.select(F.inline(F.array(*rows)))


def kpi_dashboard(summary: DataFrame) -> DataFrame:
    """Key figures of the dashboard; the severity figures only if one of them is not zero."""
    c = F.col
    # fixed values: labels
    head = [
        ("Factures ERP analysées", c("erp_analyzed_invoices")),
        ("Factures dans le périmètre RCI", c("erp_matchable_invoices")),
        ("Factures OK", c("matched_invoices")),
        ("Factures manquantes RCI", c("unmatched_erp")),
        ("Factures hors périmètre RCI", c("out_of_scope_rci")),
        ("RCI hors période", c("rci_out_of_period")),
        ("Écarts détectés", c("gaps_detected")),
        ("Montant impacté total", c("total_impacted_amount")),
        ("Taux de rapprochement", c("matching_rate")),
    ]
    tail = [
        ("Écarts critiques", c("critical_gaps")),
        ("Écarts élevés", c("high_gaps")),
        ("Écarts moyens", c("medium_gaps")),
    ]
    some = (c("critical_gaps") + c("high_gaps") + c("medium_gaps")).alias("some")
    listed = _listed(summary.select("*", some), head + tail).withColumn("tail", F.col("place") > len(head))
    any_gap = summary.select(some > 0).scalar()
    return listed.filter(~F.col("tail") | any_gap).drop("tail")


def kpi_missing(documents: DataFrame) -> DataFrame:
    of = lambda column, value: F.count_if(F.col(column) == value)
    one = documents.agg(
        of("categorie", fx.MISSING_INVOICE).alias("a"), of("categorie", fx.MISSING_CREDIT).alias("b"),
        F.coalesce(F.sum(F.abs("montant_impacte")), F.lit(0)).alias("c"),
        of("severity", "CRITIQUE").alias("d"), of("severity", "ELEVEE").alias("e"), of("severity", "MOYENNE").alias("f"),
    )
    # fixed values: labels
    labels = [
        "Factures absentes RCI", "Avoirs absents RCI", "Montant total absent", "Écarts critiques", "Écarts élevés",
        "Écarts moyens",
    ]
    return _listed(one, list(zip(labels, map(F.col, "abcdef"))))


def kpi_action_plan(plan: DataFrame) -> DataFrame:
    # fixed values: labels
    labels = dict(zip(fx.SEVERITIES[:5], ["Critiques", "Élevées", "Moyennes", "À vérifier", "Information"]))
    one = plan.agg(*[F.count_if(F.col("severity") == n).alias(n) for n in labels])
    return _listed(one, [(label, F.col(n)) for n, label in labels.items()])


def dashboard_alerts(summary: DataFrame) -> DataFrame:
    """Alerts whose condition holds, in order: ``(place, class, message)``."""
    c = F.col
    low = c("matching_rate").isNotNull() & (
        c("low_matching_rate_alert") | ((c("matching_rate") < fx.LOW_RATE) & (c("erp_matchable_invoices") > 0))
    )
    count = lambda name, text: F.concat(c(name).cast("string"), F.lit(text))
    # fixed values: alert texts
    alerts = [
        (c("dashboard_no_rci_flux_in_period"), "warning",
         F.lit("Aucun flux RCI dans la période sélectionnée. Les lignes RCI chargées sont hors période.")),
        (c("dashboard_period_mismatch"), "danger",
         F.lit("Attention : le fichier RCI chargé ne correspond pas à la période sélectionnée.")),
        (c("pdf_period_mismatch_alert"), "warning",
         F.lit("Attention : les PDF chargés ne correspondent pas à la période du flux RCI.")),
        ((c("rci_out_of_period") > 0) & ~c("dashboard_period_mismatch"), "info",
         count("rci_out_of_period", " ligne(s) RCI/PDF sont hors période de rapprochement.")),
        (low, "warning", F.lit("Le taux de rapprochement est inférieur au seuil de vigilance de 70 %.")),
        (c("critical_gaps") > 0, "danger",
         count("critical_gaps", " écart(s) critique(s) nécessitent une action prioritaire.")),
    ]
    entries = [
        F.when(when, F.struct(F.lit(i).alias("place"), F.lit(kind).alias("class"), text.alias("message")))
        for i, (when, kind, text) in enumerate(alerts, start=1)
    ]
    return summary.select(F.inline(F.array_compact(F.array(*entries))))


# ---------------------------------------------------------------- distributions and tops

def dist_status(rows: DataFrame) -> DataFrame:
    """Rows per status in chart order, unknown statuses after it."""
    name = F.trim("status")
    counted = rows.filter(~s.is_blank("status")).groupBy(name.alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("place", w.rank("status", fx.STATUS_ORDER)).orderBy("place", "status")


def impact_by_status(rows: DataFrame) -> DataFrame:
    """Signed impact per status in chart order, zeros dropped."""
    summed = rows.filter(~s.is_blank("status")).groupBy(F.trim("status").alias("status")).agg(
        F.sum("montant_impacte").alias("montant_impacte")
    )
    return summed.filter(F.col("montant_impacte") != 0).withColumn(
        "place", w.rank("status", fx.STATUS_ORDER)
    ).orderBy("place", "status")


def dist_severity(rows: DataFrame, include_ok: bool = True) -> DataFrame:
    names = fx.SEVERITIES if include_ok else fx.SEVERITIES[:-1]
    counted = rows.groupBy(w.known_severity().alias("severity")).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("severity").isin(names)).withColumn(
        "place", w.rank("severity", fx.SEVERITIES)
    ).orderBy("place")


def customer_label(frame: DataFrame) -> Column:
    names = [F.nullif(F.col(c), F.lit("")) for c in ("customer_name", "normalized_customer_name") if c in frame.columns]
    return F.trim(F.coalesce(*names, F.lit(fx.NO_NAME_CHART)))


def _top(values: DataFrame, column: str, limit: int) -> DataFrame:
    return values.orderBy(F.abs(column).desc(), "customer").limit(limit)


def top_customers_amount(plan: DataFrame, limit: int = fx.TOP_CHART) -> DataFrame:
    """Customers with the largest impact among missing documents and severe gaps."""
    severe = (F.col("status") == fx.MISSING) | F.col("severity").isin("CRITIQUE", "ELEVEE", "MOYENNE")
    label = customer_label(plan).alias("customer")
    summed = plan.filter(severe).groupBy(label).agg(F.sum("montant_impacte").alias("montant_impacte"))
    return _top(summed.filter((F.col("customer") != "") & (F.col("montant_impacte") != 0)), "montant_impacte", limit)


def top_customers_count(plan: DataFrame, limit: int = fx.TOP_CHART) -> DataFrame:
    """Customers with most gaps."""
    label = customer_label(plan).alias("customer")
    counted = plan.filter(F.col("severity") != "OK").groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return _top(counted.filter(F.col("customer") != ""), "n", limit)


def top_out_of_scope(suggestions: DataFrame, by: str, limit: int = fx.TOP_CHART) -> DataFrame:
    """Out-of-scope customers with most documents (``nombre_factures``) or amount (``montant_total_erp``)."""
    label = customer_label(suggestions).alias("customer")
    summed = suggestions.groupBy(label).agg(F.sum(by).alias(by))
    return _top(summed.filter(F.col("customer") != ""), by, limit)


def history_trend(history: DataFrame) -> DataFrame:
    """Impact, gaps and matching rate per processing day; the rate is null without matchable rows."""
    count = lambda statuses: F.count_if(F.trim("status").isin(list(statuses)))
    day = F.substring(F.trim("processing_date"), 1, 10)
    return (
        history.groupBy(day.alias("day"))
        .agg(
            F.coalesce(F.sum(_amount("montant_impacte")), F.lit(0)).alias("impacted_amount"),
            count(fx.GAPS).alias("gap_count"),
            F.round(F.try_divide(count([fx.OK]), count(fx.MATCHABLE)), 4).alias("matching_rate"),
        )
        .filter((F.col("day") != ""))
        .orderBy("day")
    )
