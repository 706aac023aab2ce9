from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lettrage.functions import fixed as fx
from lettrage.operators import coverage as cov
from lettrage.operators import matching as m
from lettrage.operators import overlap, period as per, selections as sel

ERP = "row_ord long, source_file string, source_sheet string, invoice_number string, customer_code string, customer_name string, amount_erp double, erp_date string"
RCI = "row_ord long, source_file string, invoice_number string, amount_rci double, rci_date string"
PDF = "row_ord long, source_file string, page int, invoice_number string, amount_pdf string, pdf_invoice_date string, due_date string, origin string"
DAY, DUE = "2026-05-15", "2026-08-01"


def frames(spark, erp=(), rci=(), pdf=()):
    e = spark.createDataFrame([(i, "erp.xlsx", "Factures", inv, "50", "CLIENT", a, d) for i, (inv, a, d) in enumerate(erp)], ERP)
    r = spark.createDataFrame([(i, "rci.txt", inv, a, d) for i, (inv, a, d) in enumerate(rci)], RCI)
    p = spark.createDataFrame([(i, "daily.pdf", 2, inv, a, d, due, "ENTREE BATCH") for i, (inv, a, d, due) in enumerate(pdf)], PDF)
    return e, r, p


def by_invoice(rows):
    return {r.invoice_number: r for r in rows.collect()}


def test_statement_outranks_feed(spark):
    rows = m.reconcile(*frames(spark, [("FVF385380", 100.5, DAY)], [("VF385380", 100.4, "2026-05-14")], [("VF385380", "100,00", DAY, DUE)]))
    assert rows.columns == fx.RECONCILIATION_COLUMNS
    row = rows.first()
    assert (row.invoice_number, row.status, row.severity, row.amount_gap) == ("VF385380", "OK", "OK", Decimal("0.50"))
    assert (row.pdf_invoice_date, row.origin, row.source_erp, row.source_pdf) == (
        date(2026, 5, 15), "ENTREE BATCH", "erp.xlsx:Factures", "daily.pdf:p2")


def test_each_status(spark):
    rows = by_invoice(m.reconcile(*frames(
        spark,
        [("VF1000", 100.0, DAY), ("VF2000", 100.0, DAY), ("VF3000", 100.0, DAY), ("VF4000", 100.0, DAY), ("VF4000", 110.0, DAY)],
        [("VF2000", 150.0, DAY), ("VF3000", 100.0, "2026-05-14"), ("VF4000", 100.0, DAY), ("VF5000", 100.0, DAY)],
        [("VF2000", "150", DAY, DUE), ("VF3000", "100", "2026-05-14", DUE), ("VF4000", "100", DAY, DUE), ("VF5000", "100", DAY, DUE)],
    )))
    assert {k: r.status for k, r in rows.items()} == {
        "VF1000": "MANQUANTE_RCI", "VF2000": "ANOMALIE_MONTANT", "VF3000": "ANOMALIE_DATE", "VF4000": "DOUBLON", "VF5000": "RCI_SEULEMENT"}
    assert rows["VF4000"].montant_impacte == 100 and rows["VF2000"].montant_impacte == 50
    assert rows["VF5000"].is_rci_covered is None


def test_credit_signs_and_tolerance(spark):
    rows = by_invoice(m.reconcile(*frames(
        spark, [("AAF31700", 865.79, DAY), ("VF1", 101.0, DAY), ("VF2", 101.01, DAY), ("VF3", None, DAY)],
        [("AAF31700", 865.79, DAY), ("VF1", 100.0, DAY), ("VF2", 100.0, DAY), ("VF3", 1.0, DAY)],
        [("AAF31700", "865,79-", DAY, DUE)])))
    credit = rows["AAF31700"]
    assert credit.document_type == "AVOIR" and credit.status == "OK"
    assert credit.amount_erp == credit.amount_rci == credit.amount_pdf == Decimal("-865.79")
    assert [rows[k].status for k in ("VF1", "VF2", "VF3")] == ["OK", "ANOMALIE_MONTANT", "ANOMALIE_MONTANT"]


def test_identical_duplicates_merge(spark):
    rows = m.reconcile(*frames(spark, [("VF1", 100.0, DAY), ("VF1", -100.0, DAY)], [("VF1", 100.0, DAY)]))
    assert [r.status for r in rows.collect()] == ["OK"]


def test_conflict_without_bank_side_stays_missing(spark):
    rows = m.reconcile(*frames(spark, [("VF1", 100.0, DAY), ("VF1", 250.0, DAY)]))
    assert [(r.status, r.montant_impacte) for r in rows.collect()] == [("MANQUANTE_RCI", 100)]


def test_type_conflict_between_bank_sources(spark):
    erp, rci, pdf = frames(spark, [("VF1", 100.0, DAY)], [("VF1", 100.0, DAY)], [("VF1", "100", DAY, DUE)])
    rows = m.reconcile(erp, rci, pdf.withColumn("document_type", F.lit("AVOIR")))
    assert rows.first().status == "DOUBLON"


def test_labels_in_reading_order(spark):
    erp = spark.createDataFrame(
        [(2, "b.csv", "S1", "VF1", 5.0), (0, "a.csv", "S2", "VF1", 5.0), (1, "a.csv", "S2", "VF1", 5.0)],
        "row_ord long, source_file string, source_sheet string, invoice_number string, amount_erp double")
    row = m.aggregate_source(erp, "erp").first()
    assert row.source_erp == "a.csv:S2; b.csv:S1" and row.erp_count == 3 and row.is_rci_covered is True


def test_out_of_period_rows_stand_apart(spark):
    erp, rci, pdf = frames(spark, [("VF1", 100.0, DAY)], [("VF1", 100.0, "2026-01-01"), ("VF2", 50.0, None)])
    period = per.manual_period(spark, "2026-05-01", "2026-05-31")
    tagged = per.tag_period(rci, "rci", period)
    rows = m.reconcile(per.keep_in_period(erp, period), tagged, pdf)
    assert sorted((r.invoice_number, r.status) for r in rows.collect()) == [
        ("VF1", "MANQUANTE_RCI"), ("VF1", "RCI_HORS_PERIODE"), ("VF2", "RCI_SEULEMENT")]
    late = rows.filter("status = 'RCI_HORS_PERIODE'").first()
    assert late.montant_impacte == 0 and late.amount_gap is None and late.commentaire_audit == fx.COMMENT_OUT_OF_PERIOD


def test_coverage(spark):
    erp, _, _ = frames(spark, [("VF1", 1.0, DAY)])
    rows = spark.createDataFrame([("000050", "x"), (None, "Société Étoile")], "code string, nom string")
    listed = cov.coverage_values(rows, ["code"], ["nom"])
    flag = lambda frame, c: cov.flag_coverage(frame, c).first().is_rci_covered
    assert flag(erp, listed) is True
    other = erp.withColumn("customer_code", F.lit("7"))
    assert flag(other, listed) is False
    assert flag(other.withColumn("customer_name", F.lit("societe  etoile")), listed) is True
    assert flag(other, listed.filter("false")) is True and flag(other, None) is True


def test_one_shuffle_carries_the_match(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = m.reconcile(*frames(spark, [("VF1", 1.0, DAY)]))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_hot_invoice_and_partitioning_do_not_change_the_result(spark, sf):
    from checks import views as v

    erp, rci, pdf = v.erp(spark, sf), v.rci(spark, sf), v.pdf(spark, sf)
    hot = spark.range(3000).select(
        (F.col("id") + 50_000_000).alias("row_ord"), F.concat(F.lit("rci_"), (F.col("id") % 3 + 7).cast("string")).alias("source_file"),
        F.lit("VF100001").alias("invoice_number"), F.lit(None).cast("date").alias("rci_date"), F.lit("1").alias("dealer_code"),
        F.lit(None).cast("decimal(18,2)").alias("amount_rci"))
    rci = rci.unionByName(hot)
    one = m.reconcile(erp, rci, pdf)
    wide = m.reconcile(erp.repartition(13), rci.repartition(7, "source_file"), pdf.repartition(3))
    assert one.exceptAll(wide).count() == 0 and wide.exceptAll(one).count() == 0
    row = one.filter("invoice_number = 'VF100001'").first()
    assert row.source_rci == "rci_1.txt; rci_7; rci_8; rci_9"


def test_invariants(spark, sf):
    from checks.q_matching import reconciled

    rows = reconciled(spark, sf)
    counts = {r.status: r["count"] for r in rows.groupBy("status").count().collect()}
    # counts recorded for the test tables
    assert counts == {"OK": 836, "MANQUANTE_RCI": 45, "HORS_SCOPE_RCI": 9, "ANOMALIE_MONTANT": 70, "ANOMALIE_DATE": 73,
                      "DOUBLON": 31, "RCI_SEULEMENT": 84, "RCI_HORS_PERIODE": 332}
    inside = rows.filter("status <> 'RCI_HORS_PERIODE'")
    assert inside.count() == inside.select("invoice_number").distinct().count()
    assert sel.action_plan(rows).filter("severity in ('OK', 'INFORMATION')").count() == 0


def test_overlap_takes_one_hash_exchange_and_no_window(spark):
    erp, rci, pdf = frames(spark, [("VF1", 1.0, DAY), ("VF2", 1.0, DAY), ("bad", 1.0, DAY)], [("VF2", 1.0, DAY), ("VF9", 1.0, DAY)])
    found = overlap.matching_overlap(erp, rci, pdf)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(") == 1 and "Window" not in plan and "Join" not in plan and plan.count("SinglePartition") == 1
    row = found.first()
    assert (row.total_erp_rows, row.total_erp_unique_invoices, row.intersection_erp_rci, row.only_erp_count, row.only_rci_count) == (3, 2, 1, 1, 1)
    assert (row.sample_common_invoices, row.sample_only_erp, row.sample_only_rci, row.sample_only_pdf) == ("VF2", "VF1", "VF9", "")


def test_period_rules(spark):
    erp, rci, pdf = frames(spark, [("VF1", 1.0, "2026-05-10")], [("VF1", 1.0, "2026-05-15")], [("VF1", "1", "2026-06-01", None)])
    assert per.resolve(erp, rci, pdf) == per.Period(date(2026, 5, 12), date(2026, 5, 16), "auto", "rci_txt")
    assert per.resolve(erp, rci.limit(0), pdf).source == "pdf"
    undated = rci.withColumn("rci_date", F.lit(None).cast("string"))
    assert per.resolve(erp, undated, pdf) == per.Period(date(2026, 5, 4), date(2026, 5, 10), "fallback", "erp")
    for bad in (("2026-05-02", "2026-05-01"), ("2026-05-02", None), ("x", "2026-05-02")):
        with pytest.raises(ValueError):
            per.resolve(erp, rci, pdf, date_from=bad[0], date_to=bad[1])
    with pytest.raises(ValueError):
        per.resolve(erp.limit(0), undated, pdf)
