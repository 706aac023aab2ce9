"""Queries over reports, run summary, dashboard tables, exports and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from lettrage.functions import fixed as fx
from lettrage.operators import matching as m
from lettrage.operators import coverage as cov
from lettrage.operators import names, selections as sel
from lettrage.plans import audit, dashboard as dash, missing, summary as summ
from lettrage.plans.run import RunConfig, run
from lettrage.sources import exports, history as hist
from lettrage.sources.shared import stored

from . import views as v
from .q_matching import PERIOD, covered_erp, period_sources, reconciled
from .registry import query, scratch
from .sql import CLOSEST, FROM, TO, recon, with_

R = recon()

# ---------------------------------------------------------------- counts and summaries

query("status_counts", with_(R, "SELECT status, count(*) AS n FROM recon GROUP BY status"))(
    lambda spark, sf: summ.status_counts(reconciled(spark, sf))
)

query("severity_counts", with_(R, """
  , o AS (SELECT unnest(['CRITIQUE', 'ELEVEE', 'MOYENNE', 'A_VERIFIER', 'INFORMATION', 'OK']) AS severity)
  SELECT o.severity, count(r.severity) AS n FROM o LEFT JOIN recon r USING (severity) GROUP BY o.severity"""))(
    lambda spark, sf: summ.severity_counts(reconciled(spark, sf))
)

_METRICS = """
  , kept AS (SELECT (SELECT count(*) FROM erp WHERE dt BETWEEN {a} AND {b}) AS er,
      (SELECT count(DISTINCT file) FROM erp WHERE dt BETWEEN {a} AND {b}) AS ef,
      (SELECT count(*) FROM rci WHERE COALESCE(dt BETWEEN {a} AND {b}, TRUE)) AS rr,
      (SELECT count(DISTINCT file) FROM rci WHERE COALESCE(dt BETWEEN {a} AND {b}, TRUE)) AS rf,
      (SELECT count(*) FROM pdf WHERE dt BETWEEN {a} AND {b}) AS pr),
  s AS (SELECT count(*) FILTER (status = 'OK') AS ok, count(*) FILTER (status = 'MANQUANTE_RCI') AS mi,
      count(*) FILTER (status = 'HORS_SCOPE_RCI') AS hs, count(*) FILTER (status = 'RCI_HORS_PERIODE') AS hp,
      count(*) FILTER (status = 'RCI_SEULEMENT') AS rs, count(*) FILTER (status = 'ANOMALIE_MONTANT') AS am,
      count(*) FILTER (status = 'ANOMALIE_DATE') AS ad, count(*) FILTER (status = 'DOUBLON') AS db,
      count(*) FILTER (severity = 'CRITIQUE') AS sc, count(*) FILTER (severity = 'ELEVEE') AS se,
      count(*) FILTER (severity = 'MOYENNE') AS sm, count(*) FILTER (severity = 'A_VERIFIER') AS sv,
      count(*) FILTER (severity = 'INFORMATION') AS si,
      count(*) FILTER (is_rci_covered AND status NOT IN ('RCI_SEULEMENT', 'RCI_HORS_PERIODE')) AS cov FROM recon),
  t AS (SELECT CAST(sum(abs(amt)) AS BIGINT) / 100.0 AS ctl, CAST(sum(impact) AS BIGINT) / 100.0 AS imp,
      CAST(sum(impact) FILTER (status = 'MANQUANTE_RCI') AS BIGINT) / 100.0 AS mimp FROM measured)
""".format(a=FROM, b=TO)
_SUMMARY = """ef AS erp_files, er AS erp_rows, rf AS rci_files, rr AS rci_rows, CAST(1 AS BIGINT) AS pdf_files, pr AS pdf_rows,
    hp AS rci_out_of_period, hp AS total_rci_pdf_out_of_period, ok + mi + hs + am + ad + db AS erp_analyzed_invoices,
    ok + mi + hs + am + ad + db AS reconciled_invoices, ok AS matched_invoices, mi AS unmatched_erp, rs AS unmatched_rci,
    hs AS out_of_scope_rci, cov AS rci_covered_invoices, am AS amount_anomalies, ad AS date_anomalies, db AS duplicates,
    sc AS severity_critique, se AS severity_elevee, sm AS severity_moyenne, sv AS severity_a_verifier, si AS severity_information,
    sc AS critical_gaps, se AS high_gaps, sm AS medium_gaps, sv AS reference_review_lines, si AS information_lines,
    ctl AS total_controlled_amount, imp AS total_amount_gap, imp AS total_impacted_amount, mimp AS missing_rci_amount,
    ok + mi + am + ad + db AS erp_matchable_invoices, round(ok / (ok + mi + am + ad + db), 4) AS matching_rate,
    mi + rs + am + ad + db AS gaps_detected, mi + rs + am + ad + db AS anomalies, CAST(1 AS DOUBLE) AS amount_tolerance_mad,
    ok AS status_ok, mi AS status_manquante_rci, hs AS status_hors_scope_rci, hp AS status_rci_hors_periode,
    rs AS status_rci_seulement, am AS status_anomalie_montant, ad AS status_anomalie_date, db AS status_doublon"""


def run_summary(spark, sf):
    erp, rci, pdf = period_sources(spark, sf)
    kept = "date_filter_status <> 'out_of_period'"
    return summ.run_summary(m.reconcile(erp, rci, pdf), erp, rci.filter(kept), pdf.filter(kept))


query("run_summary", with_(R + _METRICS, f"SELECT {_SUMMARY} FROM kept, s, t"))(run_summary)

# every metric as text
query("export_summary_long", with_(R + _METRICS, f"""
  , summary AS (SELECT {_SUMMARY} FROM kept, s, t),
  texts AS (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM (SELECT * REPLACE (
    printf('%.2f', total_controlled_amount) AS total_controlled_amount, printf('%.2f', total_amount_gap) AS total_amount_gap,
    printf('%.2f', total_impacted_amount) AS total_impacted_amount, printf('%.2f', missing_rci_amount) AS missing_rci_amount) FROM summary))
  UNPIVOT texts ON COLUMNS(*) INTO NAME metric VALUE value"""))(
    lambda spark, sf: summ.metric_rows(run_summary(spark, sf))
)


@query("metric_pivot", with_(R, """
  SELECT CAST(count(*) FILTER (status = 'OK') AS VARCHAR) AS matched_invoices,
    CAST(count(*) FILTER (status = 'MANQUANTE_RCI') AS VARCHAR) AS unmatched_erp, CAST(NULL AS VARCHAR) AS inconnu FROM recon"""))
def _(spark, sf):
    metrics = summ.metric_rows(summ.run_metrics(reconciled(spark, sf)))
    return hist.pivot_metrics(metrics, ["matched_invoices", "unmatched_erp", "inconnu"])


# ---------------------------------------------------------------- audit

_DATES = """
  , x AS (
    SELECT COALESCE(CAST(erp_date AS VARCHAR), 'DATE_NON_RENSEIGNEE') AS erp_date, 1 AS e, status,
      CASE WHEN montant_impacte = 0 THEN abs(amount_erp) ELSE montant_impacte END AS lost FROM recon
    WHERE status NOT IN ('RCI_HORS_PERIODE', 'RCI_SEULEMENT')
    UNION ALL
    SELECT CAST(COALESCE(rci_date, pdf_invoice_date) AS VARCHAR), 0, status, 0 FROM recon
    WHERE COALESCE(rci_date, pdf_invoice_date) IS NOT NULL
      AND (status = 'RCI_HORS_PERIODE' OR source_rci IS NOT NULL OR amount_rci IS NOT NULL)),
  g AS (SELECT erp_date, count(*) FILTER (e = 1) AS n, count(*) FILTER (e = 1 AND status = 'OK') AS ok,
      count(*) FILTER (e = 1 AND status = 'MANQUANTE_RCI') AS mi, count(*) FILTER (e = 1 AND status = 'HORS_SCOPE_RCI') AS hs,
      COALESCE(CAST(sum(round(lost * 100)) FILTER (e = 1 AND status = 'MANQUANTE_RCI') AS BIGINT), 0) / 100.0 AS lost,
      count(*) FILTER (e = 0 AND status <> 'RCI_HORS_PERIODE') AS rc, count(*) FILTER (e = 0 AND status = 'RCI_HORS_PERIODE') AS rh
    FROM x GROUP BY erp_date)"""
query("audit_dates", with_(R + _DATES, """
  SELECT erp_date, n AS nombre_total_factures_erp, ok AS nombre_ok, mi AS nombre_manquante_rci, hs AS nombre_hors_scope_rci,
    lost AS montant_manquant_rci, rc AS rci_count, rh AS rci_hors_periode_count,
    CASE WHEN n - hs > 0 THEN round(ok / (n - hs), 4) ELSE 0.0 END AS taux_rapprochement_date FROM g"""))(
    lambda spark, sf: audit.audit_dates(reconciled(spark, sf))
)
query("counts_by_date", with_(R + _DATES, """
  SELECT * FROM (SELECT erp_date, unnest(['OK', 'MANQUANTE_RCI', 'RCI_HORS_PERIODE']) AS status, unnest([ok, mi, rh]) AS n FROM g) WHERE n > 0"""))(
    lambda spark, sf: audit.counts_by_date(reconciled(spark, sf))
)


def _unfiltered(spark, sf):
    return m.reconcile(covered_erp(spark, sf), v.rci(spark, sf), v.pdf(spark, sf))


query("audit_missing", with_(recon(period=False), f"""
  SELECT invoice_number, erp_date, customer_name, customer_code, amount_erp, is_rci_covered, status, montant_impacte, source_erp,
    COALESCE(erp_date BETWEEN {FROM} AND {TO}, FALSE) AS date_in_filter,
    CASE WHEN COALESCE(erp_date BETWEEN {FROM} AND {TO}, FALSE) THEN 'Dans la période filtrée'
      ELSE 'Hors période filtrée - vérifier filtre date' END AS commentaire_audit
  FROM recon WHERE status = 'MANQUANTE_RCI'"""))(
    lambda spark, sf: audit.audit_missing(_unfiltered(spark, sf), PERIOD(spark))
)


@query("audit_alerts", with_(recon(period=False), f"""
  , a AS (SELECT count(*) FILTER (status = 'OK') AS ok,
      count(*) FILTER (status IN ('OK', 'MANQUANTE_RCI', 'ANOMALIE_MONTANT', 'ANOMALIE_DATE', 'DOUBLON')) AS ma,
      count(*) FILTER (status = 'HORS_SCOPE_RCI') AS hs,
      count(*) FILTER (status = 'MANQUANTE_RCI' AND NOT COALESCE(erp_date BETWEEN {FROM} AND {TO}, FALSE)) AS late FROM recon)
  SELECT round(ok / ma, 4) AS matching_rate, late AS missing_rci_out_of_period, round(hs / (ma + hs), 4) AS out_of_scope_rci_percent,
    round(ok / ma, 4) < 0.7 AS low_matching_rate_alert, late > 0 AS missing_rci_out_of_period_alert,
    hs / (ma + hs) > 0.2 AS out_of_scope_rate_alert, FALSE AS no_rci_flux_in_period_alert,
    concat_ws(' | ', CASE WHEN late > 0 THEN 'Des MANQUANTE_RCI ont une date ERP hors période filtrée.' END,
      CASE WHEN round(ok / ma, 4) < 0.7 THEN 'Le taux de rapprochement est inférieur à 70%.' END,
      CASE WHEN hs / (ma + hs) > 0.2 THEN 'Plus de 20% des factures sont hors périmètre RCI.' END) AS audit_alerts FROM a"""))
def _(spark, sf):
    return audit.audit_alerts(_unfiltered(spark, sf), PERIOD(spark)).withColumn("audit_alerts", F.array_join("audit_alerts", " | "))


query("audit_top_clients", with_(R, """
  SELECT customer_name, count(*) AS n FROM recon WHERE status = 'HORS_SCOPE_RCI' GROUP BY customer_name
  ORDER BY n DESC, customer_name LIMIT 20"""))(
    lambda spark, sf: audit.top_out_of_scope_clients(reconciled(spark, sf))
)

# ---------------------------------------------------------------- missing documents, batch, dealers

_MISSING = """
  , missing AS (SELECT CASE document_type WHEN 'FACTURE' THEN 'Facture absente' ELSE 'Avoir absent' END AS categorie, severity,
      invoice_number, document_type, erp_date, due_date, customer_code, customer_name, amount_erp, montant_impacte, status,
      action_recommandee, severity IN ('CRITIQUE', 'ELEVEE') AS included_in_corrective_batch, source_erp, source_rci, source_pdf,
      'Présent dans le batch ERP mais absent du batch RCI.' AS commentaire_audit
    FROM recon WHERE status = 'MANQUANTE_RCI')
"""
marked = lambda spark, sf: sel.mark_batch(reconciled(spark, sf))

query("missing_list", with_(R + _MISSING, "SELECT * FROM missing"))(
    lambda spark, sf: missing.missing_list(marked(spark, sf))
)

_CENTS = "CAST(COALESCE(sum(round(montant_impacte * 100)), 0) AS BIGINT) / 100.0"
_MISSING_SUM = f"""
  count(*) AS missing_rci_total_count, count(*) FILTER (categorie = 'Facture absente') AS missing_rci_invoice_count,
    count(*) FILTER (categorie = 'Avoir absent') AS missing_rci_credit_note_count, CAST(0 AS BIGINT) AS missing_rci_unknown_count,
    {_CENTS} AS missing_rci_total_amount, {_CENTS} AS total_absent_rci_amount,
    count(*) FILTER (severity = 'CRITIQUE') AS missing_rci_critical_count, count(*) FILTER (severity = 'ELEVEE') AS missing_rci_high_count,
    count(*) FILTER (severity = 'MOYENNE') AS missing_rci_medium_count"""
query("missing_summary", with_(R + _MISSING, f"SELECT {_MISSING_SUM} FROM missing"))(
    lambda spark, sf: missing.missing_summary(marked(spark, sf))
)

query("batch_records", with_(R + _MISSING, f"""
  SELECT {", ".join(fx.CONTROL_COLUMNS)} FROM missing WHERE included_in_corrective_batch"""))(
    lambda spark, sf: missing.batch_records(marked(spark, sf)).select(fx.CONTROL_COLUMNS)
)

query("batch_summary", with_(R + _MISSING, f"""
  SELECT count(*) > 0 AS corrective_batch_generated, count(*) AS corrective_batch_invoice_count, {_CENTS} AS corrective_batch_total_amount,
    'Fichier candidat à valider par l’équipe facturation avant transmission à RCI.' AS warning
  FROM missing WHERE included_in_corrective_batch"""))(
    lambda spark, sf: missing.batch_summary(marked(spark, sf))
)

_abs = lambda c: f"CAST(COALESCE(sum(round(abs({c}) * 100)), 0) AS BIGINT) / 100.0 AS {c}"
query("dealer_summary", with_(R, """
  SELECT COALESCE(customer_code, 'NON RENSEIGNE') AS customer_code, COALESCE(customer_name, 'NON RENSEIGNE') AS customer_name, count(*) AS total, """
  + ", ".join(f'count(*) FILTER (status = \'{n}\') AS "{n}"' for n in fx.STATUS_ORDER) + ", "
  + ", ".join(_abs(c) for c in ("amount_erp", "amount_rci", "amount_pdf", "amount_gap", "montant_impacte"))
  + " FROM recon GROUP BY 1, 2"))(
    lambda spark, sf: missing.dealer_summary(reconciled(spark, sf))
)

_SUGGEST = """
  , sugg AS (SELECT customer_name, count(*) AS nombre_factures,
      CAST(sum(round(abs(amount_erp) * 100)) AS BIGINT) / 100.0 AS montant_total_erp
    FROM recon WHERE status = 'HORS_SCOPE_RCI' GROUP BY customer_name)
"""


def suggestions(spark, sf):
    return missing.reference_suggestions(names.out_of_scope_audit(reconciled(spark, sf), v.listed_names(spark, sf)))


query("reference_suggestions", with_("RECURSIVE " + R + CLOSEST + _SUGGEST, """
  SELECT customer_name, nombre_factures, montant_total_erp, COALESCE(near, '') AS closest_reference_name,
    COALESCE(CAST(score AS VARCHAR), '') AS closest_reference_similarity,
    'Vérifier si le concessionnaire doit être ajouté au référentiel RCI.' AS suggestion_action
  FROM sugg LEFT JOIN closest ON folded = upper(customer_name)"""))(suggestions)

# ---------------------------------------------------------------- indicators and dashboard


@query("report_indicators", with_(R + _METRICS + _MISSING + f", ms AS (SELECT {_MISSING_SUM} FROM missing)", """
  , v AS (SELECT * FROM s, ms), l AS (
  SELECT 2 AS place, 'Nombre total de factures/avoirs ERP analysés' AS indicateur, ok + mi + hs + am + ad + db AS n FROM v
  UNION ALL SELECT 3, 'Nombre de factures présentes dans RCI', ok + am + ad + db FROM v
  UNION ALL SELECT 4, 'Nombre de factures absentes RCI', missing_rci_invoice_count FROM v
  UNION ALL SELECT 5, 'Nombre d''avoirs absents RCI', missing_rci_credit_note_count FROM v
  UNION ALL SELECT 7, 'Nombre d''écarts critiques', missing_rci_critical_count FROM v
  UNION ALL SELECT 8, 'Nombre d''écarts élevés', missing_rci_high_count FROM v
  UNION ALL SELECT 9, 'Nombre d''écarts moyens', missing_rci_medium_count FROM v
  UNION ALL SELECT 11, 'Factures dans le périmètre RCI', ok + mi + am + ad + db FROM v
  UNION ALL SELECT 12, 'Factures hors périmètre RCI', hs FROM v
  UNION ALL SELECT 13, 'Écarts détectés', mi + rs + am + ad + db FROM v
  UNION ALL SELECT 14, 'RCI seulement', rs FROM v
  UNION ALL SELECT 15, 'RCI hors période', hp FROM v
  UNION ALL SELECT 16, 'Total lignes RCI/PDF hors période', hp FROM v)
  SELECT CAST(place AS BIGINT) AS place, indicateur, CAST(n AS VARCHAR) AS valeur FROM l
  UNION ALL SELECT 1, 'Période de rapprochement', '1996-01-01 -> 2000-12-31'
  UNION ALL SELECT 6, 'Montant total absent RCI', printf('%.2f', missing_rci_total_amount) FROM ms
  UNION ALL SELECT 10, 'Taux de rapprochement', CAST(round(ok / (ok + mi + am + ad + db), 4) AS VARCHAR) FROM s
  UNION ALL SELECT 17, 'Alerte aucun flux RCI dans la période', CASE WHEN rr = 0 THEN 'Oui' ELSE 'Non' END FROM kept
  UNION ALL SELECT 18, 'Alerte PDF hors période RCI', 'Non'
  UNION ALL SELECT 19, 'Batch correctif candidat généré', CASE WHEN count(*) > 0 THEN 'Oui' ELSE 'Non' END FROM missing WHERE included_in_corrective_batch
  UNION ALL SELECT 20, 'Nombre factures incluses batch correctif', CAST(count(*) AS VARCHAR) FROM missing WHERE included_in_corrective_batch
  UNION ALL SELECT 21, 'Montant total inclus batch correctif', printf('%.2f', CAST(sum(round(montant_impacte * 100)) AS BIGINT) / 100.0) FROM missing WHERE included_in_corrective_batch"""))
def _(spark, sf):
    config = RunConfig(date_from=v.PERIOD[0], date_to=v.PERIOD[1])
    listed = cov.coverage_values(v.coverage_list(spark, sf), ["code"], ["nom"])
    done = run(v.erp(spark, sf), v.rci(spark, sf), v.pdf(spark, sf), listed, config).stored(scratch(spark))
    return summ.report_indicators(done.summary())


def _dash(spark, sf):
    return dash.dashboard_summary(summ.metric_rows(summ.run_metrics(reconciled(spark, sf))))


query("dashboard_summary", with_(R + _METRICS, """
  SELECT ok + mi + hs + am + ad + db AS erp_analyzed_invoices, ok + mi + hs + am + ad + db AS reconciled_invoices,
    ok + mi + am + ad + db AS erp_matchable_invoices, ok AS matched_invoices, mi AS unmatched_erp, hs AS out_of_scope_rci,
    am AS amount_anomalies, ad AS date_anomalies, db AS duplicates, rs AS unmatched_rci, hp AS rci_out_of_period,
    mi + rs + am + ad + db AS gaps_detected, FALSE AS dashboard_no_rci_flux_in_period, FALSE AS dashboard_period_mismatch,
    ok / (ok + mi + am + ad + db) AS matching_rate, imp AS total_impacted_amount, sc AS critical_gaps, se AS high_gaps,
    sm AS medium_gaps, FALSE AS pdf_period_mismatch_alert, FALSE AS low_matching_rate_alert FROM s, t"""))(_dash)

_KPI = lambda pairs, source: " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS place, '{label}' AS label, CAST({value} AS DOUBLE) AS value FROM {source}"
    for i, (label, value) in enumerate(pairs, start=1)
)
query("kpi_dashboard", with_(R + _METRICS, _KPI([
    ("Factures ERP analysées", "ok + mi + hs + am + ad + db"), ("Factures dans le périmètre RCI", "ok + mi + am + ad + db"),
    ("Factures OK", "ok"), ("Factures manquantes RCI", "mi"), ("Factures hors périmètre RCI", "hs"), ("RCI hors période", "hp"),
    ("Écarts détectés", "mi + rs + am + ad + db"), ("Montant impacté total", "imp"),
    ("Taux de rapprochement", "ok / (ok + mi + am + ad + db)"), ("Écarts critiques", "sc"), ("Écarts élevés", "se"),
    ("Écarts moyens", "sm"),
], "s, t")))(lambda spark, sf: dash.kpi_dashboard(_dash(spark, sf)))

query("kpi_missing", with_(R + _MISSING + f", ms AS (SELECT {_MISSING_SUM} FROM missing)", _KPI([
    ("Factures absentes RCI", "missing_rci_invoice_count"), ("Avoirs absents RCI", "missing_rci_credit_note_count"),
    ("Montant total absent", "missing_rci_total_amount"), ("Écarts critiques", "missing_rci_critical_count"),
    ("Écarts élevés", "missing_rci_high_count"), ("Écarts moyens", "missing_rci_medium_count"),
], "ms")))(lambda spark, sf: dash.kpi_missing(missing.missing_documents(marked(spark, sf))))

query("kpi_action_plan", with_(R + _METRICS, _KPI([
    ("Critiques", "sc"), ("Élevées", "se"), ("Moyennes", "sm"), ("À vérifier", "sv"), ("Information", "0"),
], "s")))(lambda spark, sf: dash.kpi_action_plan(sel.action_plan(reconciled(spark, sf))))

query("dashboard_alerts", with_(R + _METRICS, """
  SELECT CAST(4 AS BIGINT) AS place, 'info' AS class, hp || ' ligne(s) RCI/PDF sont hors période de rapprochement.' AS message FROM s WHERE hp > 0
  UNION ALL SELECT 5, 'warning', 'Le taux de rapprochement est inférieur au seuil de vigilance de 70 %.' FROM s
    WHERE ok / (ok + mi + am + ad + db) < 0.7
  UNION ALL SELECT 6, 'danger', sc || ' écart(s) critique(s) nécessitent une action prioritaire.' FROM s WHERE sc > 0"""))(
    lambda spark, sf: dash.dashboard_alerts(_dash(spark, sf))
)

_PLACE = "CAST(list_position(['OK','MANQUANTE_RCI','HORS_SCOPE_RCI','RCI_HORS_PERIODE','RCI_SEULEMENT','ANOMALIE_MONTANT','ANOMALIE_DATE','DOUBLON'], status) - 1 AS BIGINT) AS place"
query("dist_status", with_(R, f"SELECT status, count(*) AS n, {_PLACE} FROM recon GROUP BY status"))(
    lambda spark, sf: dash.dist_status(reconciled(spark, sf))
)
query("impact_by_status", with_(R, f"""
  SELECT status, {_CENTS} AS montant_impacte, {_PLACE} FROM recon GROUP BY status HAVING sum(montant_impacte) <> 0"""))(
    lambda spark, sf: dash.impact_by_status(reconciled(spark, sf))
)
query("dist_severity", with_(R, """
  SELECT severity, count(*) AS n, CAST(list_position(['CRITIQUE','ELEVEE','MOYENNE','A_VERIFIER','INFORMATION','OK'], severity) - 1 AS BIGINT) AS place
  FROM recon GROUP BY severity"""))(lambda spark, sf: dash.dist_severity(reconciled(spark, sf)))

query("top_customers_amount", with_(R, f"""
  SELECT COALESCE(customer_name, 'Non renseigné') AS customer, {_CENTS} AS montant_impacte FROM recon
  WHERE severity IN ('CRITIQUE', 'ELEVEE', 'MOYENNE') GROUP BY 1 HAVING sum(montant_impacte) <> 0
  ORDER BY montant_impacte DESC, customer LIMIT 10"""))(
    lambda spark, sf: dash.top_customers_amount(sel.action_plan(reconciled(spark, sf)))
)
query("top_customers_count", with_(R, """
  SELECT COALESCE(customer_name, 'Non renseigné') AS customer, count(*) AS n FROM recon
  WHERE severity NOT IN ('OK', 'INFORMATION') GROUP BY 1 ORDER BY n DESC, customer LIMIT 10"""))(
    lambda spark, sf: dash.top_customers_count(sel.action_plan(reconciled(spark, sf)))
)


@query("top_out_of_scope", with_(R + _SUGGEST, """
  SELECT 'count' AS chart, customer_name AS customer, CAST(nombre_factures AS DOUBLE) AS value
  FROM (SELECT * FROM sugg ORDER BY nombre_factures DESC, customer_name LIMIT 10)
  UNION ALL SELECT 'amount', customer_name, montant_total_erp FROM (SELECT * FROM sugg ORDER BY montant_total_erp DESC, customer_name LIMIT 10)"""))
def _(spark, sf):
    found = stored(suggestions(spark, sf), "suggestions")  # two charts, one name search
    chart = lambda name, by: dash.top_out_of_scope(found, by).select(
        F.lit(name).alias("chart"), "customer", F.col(by).cast("double").alias("value")
    )
    return chart("count", "nombre_factures").unionByName(chart("amount", "montant_total_erp"))


# ---------------------------------------------------------------- history

def history(spark, sf):
    """One run per year of the row's date, with the DOUBLON rows repeated."""
    rows = reconciled(spark, sf)
    year = F.coalesce(F.year(F.coalesce("erp_date", "rci_date", "pdf_invoice_date")), F.lit(1999)).cast("string")
    stamped = hist.history_rows(rows.withColumn("year", year), F.concat("year", F.lit("1231_2130")), F.concat("year", F.lit("-12-31")))
    times = F.when(F.col("status") == "DOUBLON", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return stamped.select("*", F.explode(times).alias("time")).drop("time")


_HISTORY = """
  , y AS (SELECT *, CAST(COALESCE(year(COALESCE(erp_date, rci_date, pdf_invoice_date)), 1999) AS VARCHAR) AS yr FROM recon),
  h1 AS (SELECT yr || '-12-31' AS processing_date, yr || '1231_2130' AS processing_run_id, invoice_number, document_type,
      COALESCE(customer_code, '') AS customer_code, COALESCE(customer_name, '') AS customer_name,
      CASE WHEN is_rci_covered THEN 'True' WHEN NOT is_rci_covered THEN 'False' ELSE '' END AS is_rci_covered,
      COALESCE(CAST(amount_erp AS VARCHAR), '') AS amount_erp, COALESCE(CAST(amount_rci AS VARCHAR), '') AS amount_rci,
      COALESCE(CAST(amount_pdf AS VARCHAR), '') AS amount_pdf, COALESCE(CAST(amount_gap AS VARCHAR), '') AS amount_gap,
      CAST(montant_impacte AS VARCHAR) AS montant_impacte, COALESCE(CAST(erp_date AS VARCHAR), '') AS erp_date,
      COALESCE(CAST(pdf_invoice_date AS VARCHAR), '') AS pdf_invoice_date, COALESCE(CAST(due_date AS VARCHAR), '') AS due_date,
      COALESCE(origin, '') AS origin, status, priority, severity, 'False' AS included_in_corrective_batch, action_recommandee FROM y),
  hist AS (SELECT * FROM h1 UNION ALL SELECT * FROM h1 WHERE status = 'DOUBLON')
"""


# 1992 is stored in an older layout without two columns; 1995 and 1996 are appended twice
@query("history_append", with_(R + _HISTORY, """
  SELECT * REPLACE (CASE WHEN processing_date LIKE '1992%' THEN '' ELSE origin END AS origin,
    CASE WHEN processing_date LIKE '1992%' THEN '' ELSE due_date END AS due_date) FROM h1"""))
def _(spark, sf):
    rows, path = stored(history(spark, sf), "history-rows"), scratch(spark)
    year = F.substring("processing_run_id", 1, 4).cast("int")
    older = rows.filter(year == 1992).dropDuplicates().drop("origin", "due_date")
    older.write.partitionBy("processing_run_id").parquet(path)
    hist.append_to(path, rows.filter(year.between(1993, 1996)))
    hist.append_to(path, rows.filter(year >= 1995))
    return hist.read_history(spark, path)


@query("latest_stored_run", with_(R + _HISTORY, "SELECT * FROM h1 WHERE processing_date = (SELECT max(processing_date) FROM h1)"))
def _(spark, sf):
    rows, path = stored(history(spark, sf), "history-rows"), scratch(spark)
    year = F.substring("processing_run_id", 1, 4).cast("int")
    hist.append_to(path, rows.filter(year >= 1996))
    hist.append_to(path, rows.filter(year < 1996))
    return hist.latest_stored_run(spark, path)


query("latest_run_rows", with_(R + _HISTORY, """
  SELECT * FROM hist WHERE processing_run_id = (SELECT max(processing_run_id) FROM hist)"""))(
    lambda spark, sf: hist.latest_run(history(spark, sf))
)

query("history_latest_summary", with_(R + _HISTORY, """
  , l AS (SELECT status, CAST(montant_impacte AS DOUBLE) AS imp FROM hist WHERE processing_run_id = (SELECT max(processing_run_id) FROM hist)),
  n AS (SELECT count(*) FILTER (status NOT IN ('RCI_SEULEMENT', 'RCI_HORS_PERIODE')) AS a,
    count(*) FILTER (status NOT IN ('HORS_SCOPE_RCI', 'RCI_HORS_PERIODE')) AS ma, count(*) FILTER (status = 'HORS_SCOPE_RCI') AS hs,
    count(*) FILTER (status = 'OK') AS ok, count(*) FILTER (status = 'MANQUANTE_RCI') AS mi, count(*) FILTER (status = 'RCI_HORS_PERIODE') AS hp,
    count(*) FILTER (status NOT IN ('OK', 'HORS_SCOPE_RCI', 'RCI_HORS_PERIODE')) AS g, CAST(sum(round(imp * 100)) AS BIGINT) / 100.0 AS imp FROM l)
  SELECT a AS erp_analyzed_invoices, a AS reconciled_invoices, ma AS erp_matchable_invoices, hs AS out_of_scope_rci, ok AS matched_invoices,
    mi AS unmatched_erp, hp AS rci_out_of_period, g AS gaps_detected, imp AS total_impacted_amount,
    CASE WHEN ma > 0 THEN ok / ma ELSE 0.0 END AS matching_rate FROM n"""))(
    lambda spark, sf: dash.history_latest_summary(history(spark, sf))
)

query("history_trend", with_(R + _HISTORY, """
  SELECT processing_date AS day, CAST(sum(round(CAST(montant_impacte AS DOUBLE) * 100)) AS BIGINT) / 100.0 AS impacted_amount,
    count(*) FILTER (status NOT IN ('OK', 'HORS_SCOPE_RCI', 'RCI_HORS_PERIODE')) AS gap_count,
    CASE WHEN count(*) FILTER (status NOT IN ('HORS_SCOPE_RCI', 'RCI_HORS_PERIODE', 'RCI_SEULEMENT')) > 0 THEN
      round(count(*) FILTER (status = 'OK') / count(*) FILTER (status NOT IN ('HORS_SCOPE_RCI', 'RCI_HORS_PERIODE', 'RCI_SEULEMENT')), 4) END AS matching_rate
  FROM hist GROUP BY processing_date"""))(lambda spark, sf: dash.history_trend(history(spark, sf)))

# ---------------------------------------------------------------- exports

query("batch_txt_lines", with_(R + _MISSING, """
  SELECT concat_ws(';', invoice_number, CAST(erp_date AS VARCHAR), customer_name, CAST(amount_erp AS VARCHAR), CAST(montant_impacte AS VARCHAR), severity) AS value
  FROM missing WHERE included_in_corrective_batch"""))(
    lambda spark, sf: exports.batch_lines(missing.batch_records(marked(spark, sf)))
)

query("export_control", with_(R + _MISSING, """
  SELECT invoice_number, CAST(erp_date AS VARCHAR) AS erp_date, customer_name, CAST(amount_erp AS VARCHAR) AS amount_erp,
    CAST(montant_impacte AS VARCHAR) AS montant_impacte, severity, status, action_recommandee, 'true' AS included_in_corrective_batch
  FROM missing WHERE included_in_corrective_batch"""))(
    lambda spark, sf: exports.control_rows(missing.batch_records(marked(spark, sf)))
)

_shown = {
    "amount_erp": "CAST(amount_erp AS VARCHAR)", "montant_impacte": "CAST(montant_impacte AS VARCHAR)",
    "included_in_corrective_batch": "CASE WHEN included_in_corrective_batch THEN 'true' ELSE 'false' END",
    "erp_date": "COALESCE(CAST(erp_date AS VARCHAR), '')", "due_date": "''", "source_rci": "''", "source_pdf": "''",
}
query("export_missing_headers", with_(R + _MISSING, "SELECT " + ", ".join(
    f'{_shown.get(c, c)} AS "{title}"' for c, title in fx.MISSING_HEADERS.items()) + " FROM missing"))(
    lambda spark, sf: exports.missing_rows(missing.missing_documents(marked(spark, sf)))
)

_NULLS = lambda names: ", ".join(f"NULL AS {n}" for n in names)


@query("export_source_rows", with_(R, f"""
  , x AS (
    SELECT 'erp' AS source_type, file AS source_file, sheet AS source_sheet, CAST(NULL AS BIGINT) AS page, inv AS invoice_number, dt AS erp_date,
      CAST(c AS VARCHAR) AS customer_code, name AS customer_name, c % 5 <> 0 AS is_rci_covered, amt / 100.0 AS amount_erp,
      CAST(NULL AS DATE) AS rci_date, CAST(NULL AS VARCHAR) AS dealer_code, CAST(NULL AS DOUBLE) AS amount_rci, CAST(NULL AS DATE) AS pdf_invoice_date,
      CAST(NULL AS DATE) AS due_date, CAST(NULL AS DOUBLE) AS amount_pdf, CAST(NULL AS VARCHAR) AS origin, CAST(NULL AS VARCHAR) AS date_filter_status
    FROM erp WHERE dt BETWEEN {FROM} AND {TO}
    UNION ALL SELECT 'rci', file, NULL, NULL, inv, NULL, NULL, NULL, NULL, NULL, dt, CAST(c AS VARCHAR), amt / 100.0, NULL, NULL, NULL, NULL,
      CASE WHEN dt IS NULL THEN 'date_missing_kept' WHEN dt BETWEEN {FROM} AND {TO} THEN 'in_period' ELSE 'out_of_period' END FROM rci
    UNION ALL SELECT 'pdf', 'releve.pdf', NULL, page, inv, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, dt, due, amt / 100.0, 'ENTREE BATCH',
      CASE WHEN dt BETWEEN {FROM} AND {TO} THEN 'in_period' ELSE 'out_of_period' END FROM pdf)
  SELECT *, source_file AS file_name, 'extracted' AS status,
    CASE WHEN date_filter_status = 'out_of_period' THEN 'Hors période de rapprochement' END AS commentaire_audit FROM x"""))
def _(spark, sf):
    erp, rci, pdf = period_sources(spark, sf)
    return exports.source_rows(erp=erp, rci=rci, pdf=pdf)
