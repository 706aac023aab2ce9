"""Queries over period, coverage, matching and the tables derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettrage.functions import fixed as fx
from lettrage.operators import coverage as cov
from lettrage.operators import matching as m
from lettrage.operators import names, overlap, period as per, selections as sel

from . import views as v
from .registry import query
from .sql import CLOSEST, FROM, SOURCES, TO, recon, with_

PERIOD = lambda spark: per.manual_period(spark, *v.PERIOD)


def covered_erp(spark: SparkSession, sf: str) -> DataFrame:
    listed = cov.coverage_values(v.coverage_list(spark, sf), ["code"], ["nom"])
    return cov.flag_coverage(v.erp(spark, sf), listed)


def period_sources(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """ERP rows in the period, bank rows tagged."""
    period = PERIOD(spark)
    return (
        per.keep_in_period(covered_erp(spark, sf), period),
        per.tag_period(v.rci(spark, sf), "rci", period),
        per.tag_period(v.pdf(spark, sf), "pdf", period),
    )


def working(spark: SparkSession, sf: str) -> DataFrame:
    return m.matched(*period_sources(spark, sf))


def reconciled(spark: SparkSession, sf: str) -> DataFrame:
    return m.reconcile(*period_sources(spark, sf))


# ---------------------------------------------------------------- period

@query("period_manual", with_(SOURCES, f"""
  SELECT {FROM} AS start_date, {TO} AS end_date, 'manual' AS mode, 'cli' AS source, row_no, dt AS erp_date FROM erp
  WHERE dt BETWEEN {FROM} AND {TO}"""))
def _(spark, sf):
    period = PERIOD(spark)
    kept = per.keep_in_period(v.erp(spark, sf).select("row_ord", "erp_date"), period)
    return kept.select(
        F.lit(period.start).alias("start_date"), F.lit(period.end).alias("end_date"), F.lit(period.mode).alias("mode"),
        F.lit(period.source).alias("source"), F.col("row_ord").alias("row_no"), "erp_date",
    )


@query("period_auto", with_(SOURCES, """
  SELECT min(dt) - 3 AS start_date, max(dt) + 1 AS end_date, 'auto' AS mode, 'rci_txt' AS source FROM rci"""))
def _(spark, sf):
    return per.period_bounds(v.erp(spark, sf), v.rci(spark, sf), v.pdf(spark, sf))


@query("period_fallback", with_(SOURCES, """
  SELECT max(dt) - 6 AS start_date, max(dt) AS end_date, 'fallback' AS mode, 'erp' AS source, 'undated_rci' AS situation FROM erp
  UNION ALL SELECT min(dt) - 3, max(dt) + 1, 'auto', 'pdf', 'no_rci' FROM pdf"""))
def _(spark, sf):
    erp, rci, pdf = v.erp(spark, sf), v.rci(spark, sf), v.pdf(spark, sf)
    undated = rci.withColumn("rci_date", F.lit(None).cast("date"))
    return per.period_bounds(erp, undated, pdf).withColumn("situation", F.lit("undated_rci")).unionByName(
        per.period_bounds(erp, rci.filter("false"), pdf).withColumn("situation", F.lit("no_rci"))
    )


@query("erp_in_period", with_(SOURCES, f"""
  SELECT row_no AS row_ord, inv AS invoice_number, dt AS erp_date FROM erp WHERE dt BETWEEN {FROM} AND {TO}"""))
def _(spark, sf):
    return per.keep_in_period(v.erp(spark, sf), PERIOD(spark)).select("row_ord", "invoice_number", "erp_date")


@query("source_period_split", with_(SOURCES, f"""
  , s AS (SELECT 'rci' AS src, inv, dt FROM rci UNION ALL SELECT 'pdf', inv, dt FROM pdf)
  SELECT src, inv AS invoice_number, dt AS day,
    CASE WHEN dt IS NULL THEN 'date_missing_kept' WHEN dt BETWEEN {FROM} AND {TO} THEN 'in_period' ELSE 'out_of_period' END AS date_filter_status,
    CASE WHEN dt NOT BETWEEN {FROM} AND {TO} THEN 'Hors période de rapprochement' END AS commentaire_audit FROM s"""))
def _(spark, sf):
    period, parts = PERIOD(spark), []
    for src, frame in (("rci", v.rci(spark, sf)), ("pdf", v.pdf(spark, sf))):
        kept, late = per.split_period(frame, src, period)
        both = kept.unionByName(late, allowMissingColumns=True)
        parts.append(both.select(
            F.lit(src).alias("src"), "invoice_number", F.col(per.DATE_OF[src]).alias("day"), "date_filter_status",
            "commentaire_audit",
        ))
    return parts[0].unionByName(parts[1])


_PERIOD_COUNTS = f"""
  , c AS (SELECT
    (SELECT count(*) FROM erp) AS eb, (SELECT count(*) FROM erp WHERE dt BETWEEN {FROM} AND {TO}) AS ea,
    (SELECT count(*) FROM rci) AS rb, (SELECT count(*) FROM rci WHERE dt IS NULL OR dt BETWEEN {FROM} AND {TO}) AS ra,
    (SELECT count(*) FROM rci WHERE dt IS NULL) AS rn,
    (SELECT count(*) FROM pdf) AS pb, (SELECT count(*) FROM pdf WHERE dt IS NULL OR dt BETWEEN {FROM} AND {TO}) AS pa,
    (SELECT count(*) FROM pdf WHERE dt IS NULL) AS pn)"""


def _period_select(enabled: bool) -> str:
    if enabled:
        head = """TRUE AS date_filter_enabled, 'manual' AS date_filter_mode, 'cli' AS date_filter_source,
    '1996-01-01' AS reconciliation_start_date, '2000-12-31' AS reconciliation_end_date,
    '1996-01-01 -> 2000-12-31' AS reconciliation_period"""
        ea, ra, pa, rn, pn = "ea", "ra", "pa", "rn", "pn"
    else:
        head = """FALSE AS date_filter_enabled, 'disabled' AS date_filter_mode, 'disabled' AS date_filter_source,
    CAST(NULL AS VARCHAR) AS reconciliation_start_date, CAST(NULL AS VARCHAR) AS reconciliation_end_date,
    'filtre desactive' AS reconciliation_period"""
        ea, ra, pa, rn, pn = "eb", "rb", "pb", "CAST(0 AS BIGINT)", "CAST(0 AS BIGINT)"
    return f"""SELECT {head},
    eb AS erp_rows_before_date_filter, {ea} AS erp_rows_after_date_filter, eb - {ea} AS erp_rows_excluded_by_date,
    rb AS rci_rows_before_date_filter, {ra} AS rci_rows_after_date_filter, rb - {ra} AS rci_rows_excluded_by_date,
    pb AS pdf_rows_before_date_filter, {pa} AS pdf_rows_after_date_filter, pb - {pa} AS pdf_rows_excluded_by_date,
    rb + pb AS rci_pdf_rows_before_date_filter, {ra} + {pa} AS rci_pdf_rows_after_date_filter,
    rb + pb - {ra} - {pa} AS rci_pdf_rows_excluded_by_date,
    {rn} AS rci_rows_missing_date_kept, {pn} AS pdf_rows_missing_date_kept,
    FALSE AS no_rci_flux_in_period_alert, FALSE AS pdf_period_mismatch_alert FROM c"""


@query("period_summary", with_(SOURCES + _PERIOD_COUNTS, _period_select(True)))
def _(spark, sf):
    return per.period_summary(v.erp(spark, sf), v.rci(spark, sf), v.pdf(spark, sf), PERIOD(spark))


@query("period_disabled", with_(SOURCES + _PERIOD_COUNTS, _period_select(False)))
def _(spark, sf):
    erp, rci, pdf = v.erp(spark, sf), v.rci(spark, sf), v.pdf(spark, sf)
    return per.period_summary(erp, rci, pdf, per.resolve(erp, rci, pdf, per.PeriodConfig(enabled=False)))


# ---------------------------------------------------------------- coverage

@query("coverage_flag", with_(SOURCES, """
  SELECT row_no AS row_ord, inv AS invoice_number, c % 5 <> 0 AS is_rci_covered FROM erp"""))
def _(spark, sf):
    return covered_erp(spark, sf).select("row_ord", "invoice_number", "is_rci_covered")


# ---------------------------------------------------------------- aggregates per source

@query("agg_erp", with_(SOURCES, """
  SELECT inv AS invoice_number, min(kind) AS document_type_erp, CAST(min(c) AS VARCHAR) AS customer_code, min(name) AS customer_name,
    bool_or(c % 5 <> 0) AS is_rci_covered, arg_min(amt, row_no) / 100.0 AS amount_erp, min(dt) AS erp_date,
    min(file || ':' || sheet) AS source_erp, count(*) AS erp_count, count(*) > 1 AND count(DISTINCT amt) > 1 AS erp_duplicate_conflict
  FROM erp GROUP BY inv"""))
def _(spark, sf):
    return m.aggregate_source(covered_erp(spark, sf), "erp")


@query("agg_rci", with_(SOURCES, """
  SELECT inv AS invoice_number, kind AS document_type_rci, amt / 100.0 AS amount_rci, dt AS rci_date, file AS source_rci,
    CAST(1 AS BIGINT) AS rci_count, FALSE AS rci_duplicate_conflict FROM rci"""))
def _(spark, sf):
    return m.aggregate_source(v.rci(spark, sf), "rci")


@query("agg_pdf", with_(SOURCES, """
  SELECT inv AS invoice_number, kind AS document_type_pdf, amt / 100.0 AS amount_pdf, dt AS pdf_invoice_date, due AS due_date,
    'ENTREE BATCH' AS origin, 'releve.pdf:p' || page AS source_pdf, CAST(1 AS BIGINT) AS pdf_count,
    FALSE AS pdf_duplicate_conflict FROM pdf"""))
def _(spark, sf):
    return m.aggregate_source(v.pdf(spark, sf), "pdf")


def _repeated_bank(spark, sf):
    """Bank rows with a second copy of some: other file, and for some another amount or date."""
    k = F.col("row_ord")
    rci = v.rci(spark, sf)
    copies = rci.filter(k % 6 == 0).select(
        (k + 10_000_000).alias("row_ord"), F.lit("rci_9.txt").alias("source_file"), "invoice_number",
        F.when(k % 18 == 6, F.date_add("rci_date", 2)).otherwise(F.col("rci_date")).alias("rci_date"), "dealer_code",
        F.when(k % 18 == 12, F.col("amount_rci") * 2).otherwise(F.col("amount_rci")).cast("decimal(18,2)").alias("amount_rci"),
    )
    return rci.unionByName(copies)


@query("duplicate_conflict", with_(SOURCES, """
  SELECT inv AS invoice_number, CAST(CASE WHEN k % 6 = 0 THEN 2 ELSE 1 END AS BIGINT) AS rci_count, amt / 100.0 AS amount_rci,
    (k % 18 = 12 AND amt <> 0) OR (k % 18 = 6 AND dt IS NOT NULL) AS rci_duplicate_conflict FROM rci"""))
def _(spark, sf):
    return m.aggregate_source(_repeated_bank(spark, sf), "rci").select(
        "invoice_number", "rci_count", "amount_rci", "rci_duplicate_conflict"
    )


@query("source_labels", with_(SOURCES, """
  SELECT inv AS invoice_number, file || CASE WHEN k % 6 = 0 THEN '; rci_9.txt' ELSE '' END AS source_rci FROM rci"""))
def _(spark, sf):
    return m.aggregate_source(_repeated_bank(spark, sf), "rci").select("invoice_number", "source_rci")


@query("consolidate_bank", with_(SOURCES, """
  SELECT COALESCE(r.inv, p.inv) AS invoice_number, COALESCE(p.kind, r.kind) AS document_type_consolidated, r.amt / 100.0 AS amount_rci,
    p.amt / 100.0 AS amount_pdf, r.dt AS rci_date, p.dt AS pdf_invoice_date, p.due AS due_date,
    CASE WHEN p.inv IS NOT NULL THEN 'ENTREE BATCH' END AS origin, r.file AS source_rci, 'releve.pdf:p' || p.page AS source_pdf,
    CAST(r.inv IS NOT NULL AS BIGINT) AS rci_count, CAST(p.inv IS NOT NULL AS BIGINT) AS pdf_count,
    FALSE AS rci_duplicate_conflict, FALSE AS pdf_duplicate_conflict, FALSE AS consolidated_duplicate_conflict
  FROM rci r FULL OUTER JOIN pdf p ON r.inv = p.inv"""))
def _(spark, sf):
    return m.consolidate(v.rci(spark, sf), v.pdf(spark, sf))


@query("bank_conflict", with_(SOURCES, """
  SELECT COALESCE(r.inv, p.inv) AS invoice_number,
    COALESCE(CASE WHEN r.inv IS NOT NULL AND p.inv IS NOT NULL THEN r.kind <> CASE WHEN p.k % 9 = 0 THEN 'AVOIR' ELSE p.kind END END, FALSE)
      AS consolidated_duplicate_conflict
  FROM rci r FULL OUTER JOIN pdf p ON r.inv = p.inv"""))
def _(spark, sf):
    from lettrage.functions import scalars as s

    pdf = v.pdf(spark, sf).withColumn(
        "document_type", F.when(F.col("row_ord") % 9 == 0, "AVOIR").otherwise(s.document_type("invoice_number"))
    )
    return m.consolidate(v.rci(spark, sf), pdf).select("invoice_number", "consolidated_duplicate_conflict")


# ---------------------------------------------------------------- matching

_ALL = ", ".join(fx.RECONCILIATION_COLUMNS)


@query("reconcile_rows", with_(recon(), f"SELECT {_ALL} FROM recon"))
def _(spark, sf):
    return m.in_report_order(reconciled(spark, sf))


@query("status_decision", with_(recon(), """
  SELECT inv AS invoice_number, late, in_e AS in_erp, in_b AS in_bank, covered AS is_rci_covered, status FROM measured"""))
def _(spark, sf):
    return working(spark, sf).select(
        "invoice_number", "late", (F.col("erp_count") > 0).alias("in_erp"),
        (F.col("rci_count") + F.col("pdf_count") > 0).alias("in_bank"), "is_rci_covered", "status",
    )


@query("date_anomaly", with_(recon(), """
  SELECT inv AS invoice_number, dt AS erp_date, COALESCE(pdt, rdt) AS bank_date, due AS due_date FROM measured WHERE status = 'ANOMALIE_DATE'"""))
def _(spark, sf):
    return working(spark, sf).filter("status = 'ANOMALIE_DATE'").select(
        "invoice_number", "erp_date", F.coalesce("pdf_invoice_date", "rci_date").alias("bank_date"), "due_date"
    )


@query("amount_gap", with_(recon(), """
  SELECT inv AS invoice_number, late, amt / 100.0 AS amount_erp, COALESCE(pamt, ramt) / 100.0 AS bank_amount, gap / 100.0 AS amount_gap FROM measured"""))
def _(spark, sf):
    return working(spark, sf).select(
        "invoice_number", "late", "amount_erp", F.coalesce("amount_pdf", "amount_rci").alias("bank_amount"), "amount_gap"
    )


@query("impact", with_(recon(), "SELECT inv AS invoice_number, status, impact / 100.0 AS montant_impacte FROM measured"))
def _(spark, sf):
    return working(spark, sf).select("invoice_number", "status", "montant_impacte")


@query("out_of_period_rows", with_(recon(), """
  SELECT invoice_number, document_type, rci_date, pdf_invoice_date, amount_rci, amount_pdf, source_rci, source_pdf, status,
    montant_impacte, commentaire_audit FROM recon WHERE status = 'RCI_HORS_PERIODE'"""))
def _(spark, sf):
    # the two late frames given apart, as a caller with split sources would
    period = PERIOD(spark)
    erp = per.keep_in_period(covered_erp(spark, sf), period)
    rci, rci_late = per.split_period(v.rci(spark, sf), "rci", period)
    pdf, pdf_late = per.split_period(v.pdf(spark, sf), "pdf", period)
    rows = m.reconcile(erp, rci, pdf, rci_out_of_period=rci_late, pdf_out_of_period=pdf_late)
    return sel.with_status(rows, ["RCI_HORS_PERIODE"]).select(fx.OUT_OF_PERIOD_COLUMNS)


@query("anomaly_rows", with_(recon(), """
  SELECT severity, 'reconciliation' AS source_type, invoice_number, status, status || ' - ' || action_recommandee AS message
  FROM recon WHERE status NOT IN ('OK', 'HORS_SCOPE_RCI', 'RCI_HORS_PERIODE')
  UNION ALL SELECT 'blocking', 'pdf', NULL, NULL, '2 fichier(s) requis manquant(s) dans la source pdf.'"""))
def _(spark, sf):
    return m.anomaly_rows(reconciled(spark, sf), {"pdf": 2})


# ---------------------------------------------------------------- overlap and tracing

@query("matching_overlap", with_(SOURCES, f"""
  , e AS (SELECT DISTINCT inv FROM erp), r AS (SELECT DISTINCT inv FROM rci), p AS (SELECT DISTINCT inv FROM pdf),
  f AS (SELECT inv, inv IN (SELECT inv FROM e) AS ie, inv IN (SELECT inv FROM r) AS ir, inv IN (SELECT inv FROM p) AS ip
        FROM (SELECT inv FROM e UNION SELECT inv FROM r UNION SELECT inv FROM p)),
  n AS (SELECT (SELECT count(*) FROM erp) AS er, (SELECT count(*) FROM rci) AS rr, (SELECT count(*) FROM pdf) AS pr,
    count(*) FILTER (ie) AS ek, count(*) FILTER (ir) AS rk, count(*) FILTER (ip) AS pk, count(*) FILTER (ie AND ir) AS i1,
    count(*) FILTER (ie AND ip) AS i2, count(*) FILTER (ie AND (ir OR ip)) AS i3, count(*) FILTER (ie AND NOT ir AND NOT ip) AS o1,
    count(*) FILTER (ir AND NOT ie) AS o2 FROM f),
  t AS (SELECT
    (SELECT string_agg(inv, ', ' ORDER BY inv) FROM (SELECT inv FROM f WHERE ie AND ir ORDER BY inv LIMIT 20)) AS s1,
    (SELECT string_agg(inv, ', ' ORDER BY inv) FROM (SELECT inv FROM f WHERE ie AND NOT ir AND NOT ip ORDER BY inv LIMIT 20)) AS s2,
    (SELECT string_agg(inv, ', ' ORDER BY inv) FROM (SELECT inv FROM f WHERE ir AND NOT ie ORDER BY inv LIMIT 20)) AS s3,
    (SELECT string_agg(inv, ', ' ORDER BY inv) FROM (SELECT inv FROM f WHERE ip AND NOT ie ORDER BY inv LIMIT 20)) AS s4)
  SELECT er AS total_erp_rows, ek AS total_erp_unique_invoices, ek AS total_erp_unique_invoice_numbers, rr AS total_rci_txt_rows,
    rk AS total_rci_txt_unique_invoices, rr AS total_rci_rows, rk AS total_rci_unique_invoice_numbers, pr AS total_pdf_rows,
    pk AS total_pdf_unique_invoices, i1 AS intersection_erp_rci_txt, i1 AS intersection_erp_rci, i2 AS intersection_erp_pdf,
    i3 AS intersection_erp_rci_consolidated, o1 AS only_erp_count, o2 AS only_rci_count, s1 AS sample_common_erp_rci_txt,
    s1 AS sample_common_invoices, s2 AS sample_only_erp, s3 AS sample_only_rci_txt, s3 AS sample_only_rci, s4 AS sample_only_pdf
  FROM n, t"""))
def _(spark, sf):
    return overlap.matching_overlap(v.erp(spark, sf), v.rci(spark, sf), v.pdf(spark, sf))


@query("keys_intersect", with_(SOURCES, "SELECT inv AS invoice_number FROM erp INTERSECT SELECT inv FROM rci"))
def _(spark, sf):
    return overlap.keys_in_both(v.erp(spark, sf), v.rci(spark, sf))


@query("keys_only_erp", with_(SOURCES, """
  SELECT inv AS invoice_number FROM erp EXCEPT (SELECT inv FROM rci UNION SELECT inv FROM pdf)"""))
def _(spark, sf):
    return overlap.keys_only_in(v.erp(spark, sf), v.rci(spark, sf), v.pdf(spark, sf))


_ASKED = ["VF100001", "fvf 100003", "AAF100007", "VF100005", "inconnue"]


@query("invoice_presence", with_(SOURCES, """
  , a AS (SELECT unnest(['VF100001', 'VF100003', 'AAF100007', 'VF100005', 'INCONNUE']) AS inv)
  SELECT inv AS invoice_number, CASE WHEN inv IN (SELECT inv FROM erp) THEN 'oui' ELSE 'non' END AS erp,
    CASE WHEN inv IN (SELECT inv FROM rci) THEN 'oui' ELSE 'non' END AS rci,
    CASE WHEN inv IN (SELECT inv FROM pdf) THEN 'oui' ELSE 'non' END AS pdf FROM a"""))
def _(spark, sf):
    asked = spark.createDataFrame([(x,) for x in _ASKED], "invoice string")
    return overlap.invoice_presence(asked, v.erp(spark, sf), v.rci(spark, sf), v.pdf(spark, sf))


_TRACED = ["source_file", "source_erp", "source_rci", "source_pdf", "customer_name", "amount_erp", "amount_rci", "amount_pdf", "amount_gap",
           "montant_impacte", "erp_date", "rci_date", "pdf_invoice_date", "due_date", "origin", "status", "severity", "action_recommandee"]


# the records of every stage, and the reason of the status
@query("invoice_trace", with_(recon(), """
  , want AS (SELECT 'VF100022' AS inv), n AS (SELECT NULL::VARCHAR AS t, NULL::DOUBLE AS x, NULL::DATE AS d),
  final AS (SELECT *, CASE status
      WHEN 'OK' THEN 'presente ERP et RCI/PDF, montant ERP=' || amount_erp || ', montant RCI=' || COALESCE(amount_rci::VARCHAR, 'NULL') || ', montant PDF='
        || COALESCE(amount_pdf::VARCHAR, 'NULL') || ', ecart=' || amount_gap || '; dans la tolerance.'
      WHEN 'MANQUANTE_RCI' THEN 'presente ERP mais absente RCI/PDF; montant impacte=' || montant_impacte || '. Action: ' || action_recommandee
      WHEN 'RCI_SEULEMENT' THEN 'presente RCI/PDF mais absente ERP; montant impacte=' || montant_impacte || '. Action: ' || action_recommandee
      WHEN 'ANOMALIE_MONTANT' THEN 'ecart montant hors tolerance; ecart=' || amount_gap || ', montant impacte=' || montant_impacte || '. Action: ' || action_recommandee
      WHEN 'ANOMALIE_DATE' THEN 'date incoherente ou manquante; montant impacte=' || montant_impacte || '. Action: ' || action_recommandee
      WHEN 'DOUBLON' THEN 'doublon conflictuel detecte; montant impacte=' || montant_impacte || '. Action: ' || action_recommandee
      WHEN 'HORS_SCOPE_RCI' THEN 'facture ERP hors perimetre RCI; pas d''ecart impacte. Action: ' || action_recommandee
      ELSE 'statut ' || status || '; Action: ' || action_recommandee END AS reason FROM recon JOIN want ON inv = invoice_number)
  SELECT 'ERP' AS stage, inv AS invoice_number, t AS reason, file AS source_file, t AS source_erp, t AS source_rci, t AS source_pdf, name AS customer_name,
    amt / 100.0 AS amount_erp, x AS amount_rci, x AS amount_pdf, x AS amount_gap, x AS montant_impacte, dt AS erp_date, d AS rci_date, d AS pdf_invoice_date,
    d AS due_date, t AS origin, t AS status, t AS severity, t AS action_recommandee FROM erp JOIN want USING (inv), n
  UNION ALL SELECT 'RCI TXT', inv, t, file, t, t, t, t, x, amt / 100.0, x, x, x, d, dt, d, d, t, t, t, t FROM rci JOIN want USING (inv), n
  UNION ALL SELECT 'PDF', inv, t, 'releve.pdf', t, t, t, t, x, x, amt / 100.0, x, x, d, d, dt, due, 'ENTREE BATCH', t, t, t FROM pdf JOIN want USING (inv), n
  UNION ALL SELECT 'RCI consolide', inv, t, t, t, CASE WHEN in_r THEN rfile END, CASE WHEN in_p THEN 'releve.pdf:p' || page END, t, x, ramt / 100.0, pamt / 100.0,
    x, x, d, rdt, pdt, due, CASE WHEN in_p THEN 'ENTREE BATCH' END, t, t, t FROM bank JOIN want USING (inv), n
  UNION ALL SELECT 'Statut final', invoice_number, reason, t, source_erp, source_rci, source_pdf, customer_name, amount_erp, amount_rci, amount_pdf, amount_gap,
    montant_impacte, erp_date, rci_date, pdf_invoice_date, due_date, origin, status, severity, action_recommandee FROM final, n"""))
def _(spark, sf):
    trace = overlap.invoice_trace(
        "FVF 100022", v.erp(spark, sf), v.rci(spark, sf), v.pdf(spark, sf), reconciled(spark, sf)
    )
    kinds = {c: "double" for c in _TRACED if c.startswith(("amount", "montant"))} | {c: "date" for c in _TRACED if c.endswith("_date")}
    return trace.select("stage", "invoice_number", "reason", *[F.get_json_object("record", f"$.{c}").cast(kinds.get(c, "string")).alias(c) for c in _TRACED])


@query("closest_name_ratio", with_("RECURSIVE " + recon() + CLOSEST, """
  SELECT invoice_number, erp_date, customer_name, upper(customer_name) AS normalized_customer_name, amount_erp, status,
    near AS closest_reference_name, score AS closest_reference_similarity,
    CASE WHEN score IS NULL THEN 'Référentiel RCI indisponible pour comparaison'
      WHEN score >= 0.8 THEN 'Nom proche du référentiel RCI - vérifier une différence de libellé'
      ELSE 'Aucun reclassement automatique - validation métier nécessaire' END AS commentaire_audit
  FROM recon LEFT JOIN closest ON folded = upper(customer_name) WHERE status = 'HORS_SCOPE_RCI'"""))
def _(spark, sf):
    return names.out_of_scope_audit(reconciled(spark, sf), v.listed_names(spark, sf))


# ---------------------------------------------------------------- selections

@query("status_slice", with_(recon(), """
  SELECT invoice_number, status, montant_impacte FROM recon
  WHERE status IN ('MANQUANTE_RCI', 'RCI_SEULEMENT', 'ANOMALIE_MONTANT', 'ANOMALIE_DATE', 'DOUBLON')"""))
def _(spark, sf):
    return sel.with_status(reconciled(spark, sf), fx.GAPS).select("invoice_number", "status", "montant_impacte")


@query("filter_results", with_(recon(), """
  SELECT invoice_number, status, customer_name, erp_date FROM recon WHERE status = 'OK' AND upper(customer_name) LIKE '%CUSTOMER#0000001%'
    AND COALESCE(COALESCE(erp_date, rci_date, pdf_invoice_date) BETWEEN DATE '1997-01-01' AND DATE '1999-06-30', TRUE)"""))
def _(spark, sf):
    rows = sel.filter_results(reconciled(spark, sf), "OK", "customer#0000001", "1997-01-01", "1999-06-30")
    return rows.select("invoice_number", "status", "customer_name", "erp_date")


@query("filter_action_plan", with_(recon(), """
  SELECT severity, invoice_number, status, customer_name, montant_impacte FROM recon
  WHERE severity = 'ELEVEE' AND status = 'MANQUANTE_RCI' AND upper(customer_name) LIKE '%1%'"""))
def _(spark, sf):
    plan = sel.filter_action_plan(sel.action_plan(reconciled(spark, sf)), "ELEVEE", "MANQUANTE_RCI", "1")
    return plan.select("severity", "invoice_number", "status", "customer_name", "montant_impacte")


@query("filter_missing", with_(recon(), """
  SELECT 'Facture absente' AS categorie, severity, invoice_number, erp_date, severity IN ('CRITIQUE', 'ELEVEE') AS included_in_corrective_batch
  FROM recon WHERE status = 'MANQUANTE_RCI' AND document_type = 'FACTURE' AND severity IN ('CRITIQUE', 'ELEVEE')
    AND erp_date >= DATE '1997-03-01'"""))
def _(spark, sf):
    from lettrage.plans import missing

    documents = missing.missing_list(sel.mark_batch(reconciled(spark, sf)))
    picked = sel.filter_missing(
        documents, categorie=fx.MISSING_INVOICE, date_from="1997-03-01", included_in_corrective_batch=True
    )
    return picked.select("categorie", "severity", "invoice_number", "erp_date", "included_in_corrective_batch")


@query("filter_facets", with_(recon(), """
  SELECT DISTINCT 'severity' AS facet, severity AS value, CAST(CASE severity WHEN 'CRITIQUE' THEN 0 WHEN 'ELEVEE' THEN 1 WHEN 'MOYENNE' THEN 2
    WHEN 'A_VERIFIER' THEN 3 WHEN 'INFORMATION' THEN 4 ELSE 99 END AS BIGINT) AS place FROM recon
  UNION ALL SELECT DISTINCT 'status', status, 0 FROM recon
  UNION ALL SELECT DISTINCT 'customer_name', customer_name, 0 FROM recon WHERE customer_name IS NOT NULL"""))
def _(spark, sf):
    return sel.facets(reconciled(spark, sf), "severity", "status", "customer_name")


@query("batch_flag", with_(recon(), """
  SELECT invoice_number, status, severity, status = 'MANQUANTE_RCI' AND severity IN ('CRITIQUE', 'ELEVEE') AS included_in_corrective_batch FROM recon"""))
def _(spark, sf):
    return sel.mark_batch(reconciled(spark, sf)).select("invoice_number", "status", "severity", "included_in_corrective_batch")


@query("action_plan", with_(recon(), """
  SELECT severity, invoice_number, erp_date, customer_name, amount_erp, amount_rci, amount_pdf, montant_impacte, status,
    action_recommandee, source_erp, source_rci, source_pdf FROM recon WHERE severity NOT IN ('OK', 'INFORMATION')"""))
def _(spark, sf):
    return sel.action_plan(reconciled(spark, sf)).select(fx.ACTION_PLAN_COLUMNS)
