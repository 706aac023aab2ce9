import random
from datetime import date
from decimal import Decimal
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from lettrage.functions import fixed as fx
from lettrage.functions import wording as w
from lettrage.operators import names, selections as sel
from lettrage.plans import audit, dashboard as dash, missing, summary as summ
from lettrage.plans.run import RunConfig, run
from lettrage.sources import exports, history as hist


def rows_of(spark, *records):
    """Reconciliation rows from sparse dicts."""
    types = {c: "string" for c in fx.RECONCILIATION_COLUMNS}
    types.update({c: "decimal(18,2)" for c in ("amount_erp", "amount_rci", "amount_pdf", "amount_gap", "montant_impacte")})
    types.update({c: "date" for c in ("erp_date", "rci_date", "pdf_invoice_date", "due_date")})
    types.update({c: "boolean" for c in ("is_rci_covered", "included_in_corrective_batch")})
    schema = ", ".join(f"{c} {t}" for c, t in types.items())
    data = [tuple(Decimal(str(r[c])) if types[c].startswith("dec") and r.get(c) is not None else r.get(c) for c in types) for r in records]
    frame = spark.createDataFrame(data, schema)
    return frame.withColumn("severity", F.coalesce("severity", w.severity("status", F.coalesce("montant_impacte", F.lit(0)))))


@pytest.mark.parametrize("amount, expected", [(100000, "CRITIQUE"), (250000, "CRITIQUE"), (20000, "ELEVEE"), (99999.99, "ELEVEE"), (19999.99, "MOYENNE")])
def test_severity_of_missing_documents(spark, amount, expected):
    assert rows_of(spark, {"status": "MANQUANTE_RCI", "montant_impacte": amount}).first().severity == expected


def test_action_plan_order(spark):
    rows = rows_of(
        spark, {"invoice_number": "A", "status": "OK"}, {"invoice_number": "B", "status": "ANOMALIE_DATE", "montant_impacte": 9},
        {"invoice_number": "C", "status": "MANQUANTE_RCI", "montant_impacte": 100000}, {"invoice_number": "E", "status": "DOUBLON", "montant_impacte": 5},
        {"invoice_number": "D", "status": "DOUBLON", "montant_impacte": 5}, {"invoice_number": "F", "status": "RCI_HORS_PERIODE"},
        {"invoice_number": "G", "status": "HORS_SCOPE_RCI"})
    assert [r.invoice_number for r in sel.action_plan(rows).collect()] == ["C", "D", "E", "B", "G"]
    assert sel.action_plan(rows, True).count() == 6
    assert sel.action_plan(rows).first().action_recommandee == fx.ACTION["MANQUANTE_RCI"]


def test_missing_and_batch(spark):
    rows = sel.mark_batch(rows_of(
        spark, {"invoice_number": "AAF2", "status": "MANQUANTE_RCI", "montant_impacte": 30000},
        {"invoice_number": "VF1", "status": "MANQUANTE_RCI", "montant_impacte": 150000, "document_type": "FACTURE", "customer_name": "A;B\nC", "amount_erp": 150000, "erp_date": date(2026, 5, 1)},
        {"invoice_number": "VF3", "status": "MANQUANTE_RCI", "montant_impacte": 10}, {"invoice_number": "VF4", "status": "OK"}))
    assert [(r.categorie, r.invoice_number) for r in missing.missing_list(rows).collect()] == [
        ("Facture absente", "VF1"), ("Facture absente", "VF3"), ("Avoir absent", "AAF2")]
    one = missing.missing_summary(rows).first()
    assert (one.missing_rci_total_count, one.missing_rci_invoice_count, one.missing_rci_credit_note_count, one.missing_rci_total_amount) == (3, 2, 1, 180010)
    assert [r.invoice_number for r in missing.batch_records(rows).collect()] == ["VF1", "AAF2"]
    assert exports.batch_lines(missing.batch_records(rows)).first().value == "VF1;2026-05-01;A,B C;150000.0;150000.0;CRITIQUE"
    empty = missing.batch_summary(rows.filter("status = 'OK'")).first()
    assert empty.corrective_batch_generated is False and empty.warning == fx.NO_BATCH_MESSAGE


def test_audit_dates_and_alerts(spark):
    day = date(2026, 5, 1)
    rows = rows_of(
        spark, {"status": "OK", "erp_date": day, "rci_date": day, "source_rci": "r"},
        {"status": "MANQUANTE_RCI", "erp_date": day, "amount_erp": 70, "montant_impacte": 0}, {"status": "HORS_SCOPE_RCI", "erp_date": day},
        {"status": "RCI_HORS_PERIODE", "rci_date": date(2026, 1, 1)}, {"status": "MANQUANTE_RCI", "amount_erp": 5, "montant_impacte": 5})
    found = {r.erp_date: r for r in audit.audit_dates(rows).collect()}
    assert set(found) == {"2026-05-01", "2026-01-01", fx.NO_DATE}
    may = found["2026-05-01"]
    assert (may.nombre_total_factures_erp, may.nombre_ok, may.montant_manquant_rci, may.taux_rapprochement_date, may.rci_count) == (3, 1, 70, 0.5, 1)
    assert found["2026-01-01"].rci_hors_periode_count == 1
    from lettrage.operators.period import Period

    alert = audit.audit_alerts(rows, Period(day, day, "manual", "cli"), no_feed=True).first()
    assert alert.missing_rci_out_of_period == 1 and alert.matching_rate == 0.3333
    assert alert.audit_alerts == [fx.ALERT_MISSING_PERIOD, fx.ALERT_LOW_RATE, fx.ALERT_SCOPE, fx.ALERT_NO_FEED]


def test_dashboard_without_feed(spark):
    metrics = spark.createDataFrame(
        [("status_ok", "0"), ("unmatched_erp", "3"), ("rci_rows_before_date_filter", "5"), ("rci_rows_after_date_filter", "0"),
         ("rci_out_of_period", "4"), ("severity_critique", "2"), ("total_impacted_amount", "1,234.5")], "metric string, value string")
    one = dash.dashboard_summary(metrics)
    row = one.first()
    assert row.matching_rate is None and row.dashboard_no_rci_flux_in_period and row.dashboard_period_mismatch
    assert (row.unmatched_erp, row.critical_gaps, row.total_impacted_amount) == (3, 2, 1234.5)
    assert [r["class"] for r in dash.dashboard_alerts(one).collect()] == ["warning", "danger", "danger"]
    assert dash.kpi_dashboard(one).count() == 12


def closest(customers, listed):
    out = {}
    for customer in customers:
        best, score = None, 0.0
        for name in sorted(listed):
            ratio = SequenceMatcher(None, customer, name).ratio()
            if ratio > score:
                best, score = name, ratio
        if best:
            out[customer] = best, round(score, 4)
    return out


def one_column(spark, values):
    return spark.createDataFrame([(x,) for x in values], "value string")


@pytest.mark.parametrize("part", [16, 4096])
def test_closest_names_against_brute_force(spark, monkeypatch, part):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ABCDE 12é汉") for _ in range(rng.randint(3, 12))).strip() or "A"
    customers, listed = {word() for _ in range(60)}, {word() for _ in range(300)}
    long = "LONG NAME OF A COMPANY " * 12
    customers |= {"Z", "ZZ", "CUSTOMER 000012", long + "X", long[:70], "\U0001f600 A"}
    listed |= {f"CUSTOMER {i:06}" for i in range(100, 260, 3)} | {long, long[5:150], "A" * 64, "A" * 63 + "B", "B" + "A" * 64}
    monkeypatch.setattr(names, "PART", part)
    rows = names.closest_names(one_column(spark, [*customers, None, "", *list(customers)[:9]]), one_column(spark, [*listed, None, "", *list(listed)[:9]])).collect()
    assert len(rows) == len({r.customer for r in rows})
    found = {r.customer: (r.closest_reference_name, r.closest_reference_similarity) for r in rows}
    assert found == closest(customers, listed)


def test_closest_names_of_empty_tables(spark):
    some, none = one_column(spark, ["A"]), one_column(spark, [])
    assert names.closest_names(some, none).count() == names.closest_names(none, some).count() == names.closest_names(none, none).count() == 0


def test_verified_pairs_grow_with_the_customers_and_not_with_their_product(spark, monkeypatch):
    monkeypatch.setattr(names, "PART", 256)
    for scale in (1, 10):
        listed = [f"CUSTOMER {i:09}" for i in range(600 * scale) if i % 5 in (3, 4)]
        customers = [f"CUSTOMER {i:09}" for i in range(600 * scale) if i % 5 == 0]
        found = names.search(one_column(spark, customers), one_column(spark, listed))
        assert found.agg(F.sum("verified")).first()[0] <= 3 * len(customers)


def test_history_append_is_idempotent(spark, tmp_path):
    rows = rows_of(spark, {"invoice_number": "VF1", "status": "OK", "amount_erp": 100}, {"invoice_number": "VF2", "status": "DOUBLON"})
    path = str(tmp_path / "history")
    for run_id in ("20260514_2130", "20260515_2130", "20260515_2130"):
        hist.append_to(path, hist.history_rows(rows, run_id, run_id[:8]))
    stored = spark.read.schema(", ".join(f"{c} string" for c in fx.HISTORY_COLUMNS)).parquet(path)
    assert stored.count() == 4 and hist.latest_run(stored).count() == 2
    assert stored.filter("invoice_number = 'VF1'").first().amount_erp == "100.0"
    old = stored.drop("severity")
    assert hist.append_history(old, stored).count() == 8 and hist.append_history(stored, stored).count() == 4


def history_of(spark, *runs):
    rows = rows_of(spark, *({"invoice_number": f"VF{i}", "status": "OK", "amount_erp": i} for i in range(20)))
    return [hist.history_rows(rows, run, f"{run[:4]}-{run[4:6]}-{run[6:8]}") for run in runs]


def test_a_crashed_append_leaves_no_half_run(spark, tmp_path, monkeypatch):
    path, (first, second) = str(tmp_path / "history"), history_of(spark, "20260514_2130", "20260515_2130")
    hist.append_to(path, first)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:  # before the manifest: nothing of it is ever seen
        broken.setattr(hist.Store, "commit", crash)
        with pytest.raises(OSError):
            hist.append_to(path, second)
    assert hist.read_history(spark, path).count() == 20
    settle = hist.Store.settle
    with monkeypatch.context() as broken:  # after the manifest: the next reader finishes what was begun
        calls = []
        broken.setattr(hist.Store, "settle", lambda store: crash() if calls else (calls.append(1), settle(store)))
        with pytest.raises(OSError):
            hist.append_to(path, second.repartition(3))
    assert len(list((tmp_path / "history").glob("processing_run_id=*"))) == 1
    moved = hist.Store(spark, path)
    manifest = next(n for n in moved.listed("_commits") if n.endswith(".json") and n != "last.json")
    half = moved.read("_commits", manifest)["files"][0]
    moved.files.mkdirs(moved.at(half.split("/")[0]))
    moved.files.rename(moved.at("_staged", manifest.removesuffix(".json"), half), moved.at(half))  # lost between two moves
    assert hist.read_history(spark, path).count() == 40 and hist.read_history(spark, path).distinct().count() == 40
    hist.append_to(path, second)
    assert hist.read_history(spark, path).count() == 40


def test_repeats_are_found_by_digest_alone(spark, tmp_path):
    path, (first, second) = str(tmp_path / "history"), history_of(spark, "20260514_2130", "20260515_2130")
    first.drop("origin", "due_date").write.partitionBy("processing_run_id").parquet(path)  # an older layout, without digests
    for _ in range(2):
        hist.append_to(path, first.unionByName(second).unionByName(second))
    assert hist.read_history(spark, path).count() == 40
    plan = hist.stored_digests(spark, path, ["20260515_2130"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<digest_high:bigint,digest_low:bigint>" in plan


def test_the_last_run_is_read_from_its_partition(spark, tmp_path):
    path, runs = str(tmp_path / "history"), history_of(spark, "20260514_2130", "20260515_2130", "20260513_0700")
    assert hist.latest_stored_run(spark, path).count() == 0
    for rows in runs:
        hist.append_to(path, rows)
    last = hist.latest_stored_run(spark, path)
    assert {r[0] for r in last.select("processing_run_id").collect()} == {"20260515_2130"} and last.count() == 20
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, hist.latest_run(hist.read_history(spark, path)).collect()))
    assert len(last.inputFiles()) >= 1 and "20260515_2130" in last._jdf.queryExecution().executedPlan().toString()
    assert last.rdd.getNumPartitions() == 1
    (tmp_path / "history" / "_commits" / "last.json").unlink()
    assert hist.latest_stored_run(spark, path).count() == 20


def test_full_run_writes_every_export(spark, sf, tmp_path):
    from checks.q_text import full_inputs

    config = RunConfig(run_id="20260515_213000", date_from="1996-01-01", date_to="2000-12-31")
    done = run(*full_inputs(spark, sf), config).stored(str(tmp_path))
    done.write(str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir()} == {
        "run_summary", "source_rows", "reconciliation", "missing", "reference_suggestions", "matching_overlap", "anomalies",
        "action_plan", "dealers", "out_of_period", "audit_dates", "audit_missing", "audit_out_of_scope", "batch", "batch_control", "history"}
    read = lambda name: spark.read.option("sep", ";").option("header", True).csv(str(tmp_path / "out" / name / "run_id=20260515_213000"))
    metrics = {r.metric: r.value for r in read("run_summary").collect()}
    assert int(metrics["reconciled_invoices"]) == sum(int(metrics[f"status_{n.lower()}"]) for n in fx.ANALYSED)
    assert metrics["reconciliation_period"] == "1996-01-01 -> 2000-12-31"
    assert read("reconciliation").count() == done.rows.count()
    # the text sources hold no second copies, so no duplicate can arise
    assert {r.status for r in summ.status_counts(done.rows).collect()} == set(fx.STATUS_ORDER) - {"DOUBLON"}


def counted(spark, rows):
    """The rows, and how many of them have been computed."""
    seen = spark.sparkContext.accumulator(0)

    def read(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(read, rows.schema), seen


def test_last_run_computes_its_rows_once(spark):
    rows, seen = counted(spark, spark.createDataFrame([("2026-01-01", "a", 1), ("2026-01-02", "b", 2), ("2026-01-02", "b", 3)],
                                                      "processing_date string, processing_run_id string, n int"))
    assert sorted(r["n"] for r in hist.latest_run(rows).collect()) == [2, 3] and seen.value == 3


def test_two_charts_take_one_name_search(spark, monkeypatch):
    from checks import q_reports
    from checks.registry import QUERIES

    rows, seen = counted(spark, spark.createDataFrame([("A", 3, 1.0), ("B", 1, 9.0)], "customer_name string, nombre_factures bigint, montant_total_erp double"))
    monkeypatch.setattr(q_reports, "suggestions", lambda spark, sf: rows)
    found = sorted(map(tuple, QUERIES["top_out_of_scope"](spark, "").collect()))
    assert found == [("amount", "A", 1.0), ("amount", "B", 9.0), ("count", "A", 3.0), ("count", "B", 1.0)] and seen.value == 2


def test_many_visits_take_larger_chunks():
    assert [names.chunk_size(n, 8) for n in (0, 128, 64_000, 10**7)] == [128, 128, 1000, 2048]
    outline = names.Outline([{"part": 1, "least": "AB", "shortest": 2, "longest": 2, "letters": ["A", "B"], "masks": [[1], [2]]}])
    assert outline.mask("A") is outline.mask("A") and outline.mask("A").tolist() == [[1]] and outline.mask("C") is None
