import random
from contextlib import contextmanager
from datetime import date
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from lettrage.operators import feed_lines as feed
from lettrage.operators import reference, sheets, statement_lines as stmt
from lettrage.sources import text

FEED = [
    "HLOT-QX0077120250310",
    "D     0 OUTILS Y        BRT            7K2            SAP061200415      2025030720250307     00000004219950000000421995                00000003516630000000070332                                       VF271906",
    "D     0 OUTILS Y        BRT            8K2            SAP061200388      2025030720250307     00000000758200000000075820                00000000631830000000012637                                       AAF20418",
    "D une ligne sans numero",
    "D x 29042026 1.234,50 VF 1234 9,99",
    "D VF77 20260501 5.25",
    "D 20260429-0000000000500 VF78",
]


def feed_frame(spark):
    return spark.createDataFrame([("f", i, x) for i, x in enumerate(FEED)], "source_file string, row_ord int, line string")


def test_feed_lines(spark):
    rows = {r.invoice_number: r for r in feed.parse_feed(feed_frame(spark)).collect()}
    assert set(rows) == {"VF271906", "AAF20418", "VF1234", "VF77", "VF78"}
    first = rows["VF271906"]
    assert (first.document_type, first.rci_date, first.dealer_code, first.amount_rci) == (
        "FACTURE", date(2025, 3, 7), "61200415", Decimal("4219.95"))
    assert rows["AAF20418"].amount_rci == Decimal("758.20") and rows["AAF20418"].document_type == "AVOIR"
    # nearest decimal amount, and a date after the invoice when none precedes it
    assert rows["VF1234"].amount_rci == Decimal("9.99") and rows["VF1234"].rci_date == date(2026, 4, 29)
    assert rows["VF77"].rci_date == date(2026, 5, 1) and rows["VF77"].amount_rci == Decimal("5.25")
    assert rows["VF78"].amount_rci == Decimal("-5.00")
    assert [r.row_ord for r in feed.feed_rejects(feed_frame(spark)).collect()] == [3]


def test_patterns_read_the_same_by_plain_classes(spark):
    parts = ["VF12", "fvf 7", "aaf\t9", "xVF1", "VF3x", "VF\u00a04", "\u00e9VF5", "VF6\u00e9", "SAP00012345", "sap 123456 ", "_VF8", "VF9_", "\u0660VF1", "VF\u0661", "-", " ", "\x1f", "\x0b", "\x85"]
    rng = random.Random(3)
    lines = spark.createDataFrame([("".join(rng.choice(parts) for _ in range(rng.randint(1, 5))),) for _ in range(3000)], "line string")
    for pattern in (feed.INVOICE, feed.DEALER, stmt.INVOICE):
        assert lines.filter(feed.read_by(pattern, F.col("line"), lambda p: F.regexp_instr("line", F.lit(p))) != F.regexp_instr("line", F.lit(pattern))).count() == 0
    plan = feed.located(feed_frame(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length" in plan


def test_inputs_of_the_full_run_are_landed_once(spark, sf):
    from checks.q_text import full_inputs

    for frame in full_inputs(spark, sf):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "o_orderkey" not in plan and "c_custkey" not in plan


def test_statement_lines(spark):
    lines = [
        "TIERS NUMERO CODE EMISSION ECHEANCE TYPE CHASSIS SOMME SAISIE",
        "000031 VF270115 KD04 03/02/25 20/04/25 OUT 2.464,07 SAISIE LOT",
        "000031 AAF20502 KD04 03/02/25 20/04/25 OUT 318,44- SAISIE LOT",
        "TOTAL DU TIERS : 000031 FACTURE : 1 AVOIR : 1 2.145,63",
        "000052 FVF270188 KD04 03/02/2025 20/04/2025 BERLINE VF1QWERTY98765432 2.047.613,18 SAISIE MANUELLE",
        "note 000052 VF270189 KD04 03/02/2025 -- BERLINE 10,00",
    ]
    frame = spark.createDataFrame([("p", 1, x) for x in lines], "source_file string, page int, line string")
    rows = {r.invoice_number: r for r in stmt.parse_statement(frame).collect()}
    assert set(rows) == {"VF270115", "AAF20502", "VF270188", "VF270189"}
    a, b, c, d = (rows[k] for k in ("VF270115", "AAF20502", "VF270188", "VF270189"))
    assert (a.dealer_code, a.cf_code, a.pdf_invoice_date, a.due_date, a.model, a.chassis_number, a.amount_pdf, a.origin) == (
        "000031", "KD04", date(2025, 2, 3), date(2025, 4, 20), "OUT", None, Decimal("2464.07"), "SAISIE LOT")
    assert b.amount_pdf == Decimal("-318.44") and b.document_type == "AVOIR"
    assert (c.model, c.chassis_number, c.amount_pdf, c.origin) == ("BERLINE", "VF1QWERTY98765432", Decimal("2047613.18"), "SAISIE MANUELLE")
    assert (d.dealer_code, d.due_date, d.model, d.amount_pdf, d.origin) == ("000052", None, "BERLINE", Decimal("10.00"), None)


def sheet(spark, *rows, name="s.xlsx"):
    return spark.createDataFrame(
        [(name, "S", i, list(r)) for i, r in enumerate(rows)], "source_file string, source_sheet string, row_idx bigint, cells array<string>")


def test_titled_erp_sheet(spark):
    rows = sheet(
        spark,
        ["No facture", "Date facture", "Total TTC", "N° donneur d'ordre", "Client", "Code département", "Code marque", "Type Commande Vente"],
        ["FVF271330", "21/11/25", "3.402.117,09", "61200777", "OLIVIER ET FILS", "QT", "MIXTE", "STOCK"],
        ["XYZ9", "21/11/25", "12,00", "888", "SANS NUMERO", "QT", "MIXTE", "STOCK"],
    )
    (row,) = sheets.standardise_erp(rows).drop("row_ord").collect()
    assert row.asDict() == {
        "source_file": "s.xlsx", "source_sheet": "S", "invoice_number": "VF271330", "document_type": "FACTURE",
        "erp_date": date(2025, 11, 21), "customer_code": "61200777", "customer_name": "OLIVIER ET FILS",
        "amount_erp": Decimal("3402117.09"), "department_code": "QT", "brand_code": "MIXTE", "sales_order_type": "STOCK"}


def test_headerless_sheet_and_its_fallback(spark):
    bare = sheet(
        spark, [None] * 15,
        ["2025-03-07", "BZ11002", "FVF271744", "61200500", "MARTIN PRO", "61200500", "MARTIN PRO", "5", "2 918,60", "QT",
         "MIXTE", "KLMN", "RETRAIT SITE", None, None],
        ["BZ11002", None, "AAF20433", "2025-03-07", None, "61200321", "A B C D", "RT", None, "120.25", "144.30", None, "KLMN", "1", "FVF270001"],
    )
    rows = {r.invoice_number: r for r in sheets.standardise_erp(bare).collect()}
    assert rows["VF271744"].sales_order_type == "RETRAIT SITE" and rows["VF271744"].amount_erp == Decimal("2918.60")
    credit = rows["AAF20433"]
    assert (credit.erp_date, credit.customer_code, credit.amount_erp, credit.sales_order_type) == (
        date(2025, 3, 7), "61200321", Decimal("144.30"), "RT")
    # untitled, but not in the known positions: read by content
    other = sheet(spark, [None, None, None], ["VF1", "x", "15/05/2026"], ["VF2", "y", "16/05/2026"], name="t.xlsx")
    found = sheets.standardise_erp(other.unionByName(bare)).filter("source_file = 't.xlsx'").collect()
    assert sorted((r.invoice_number, r.erp_date) for r in found) == [("VF1", date(2026, 5, 15)), ("VF2", date(2026, 5, 16))]


def test_bank_tables(spark):
    rows = sheet(spark, ["Document", "Accounting date", "Code concession", "Total"], ["AAF20502", "20250203", "SAP061200388", "-318,44"], ["x", None, None, None])
    (row,) = sheets.standardise_rci(rows).collect()
    assert (row.invoice_number, row.rci_date, row.dealer_code, row.amount_rci, row.raw_line) == (
        "AAF20502", date(2025, 2, 3), "61200388", Decimal("-318.44"), "AAF20502 | 20250203 | SAP061200388 | -318,44")


def test_column_sample_is_limited_before_the_shuffle(spark, sf):
    from checks import views as v

    plan = sheets.column_scores(v.erp_sheets(spark, sf), "erp")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def coverage_of(spark, *rows):
    return sorted((r.kind, r.value) for r in reference.load_coverage(sheet(spark, *rows)).collect())


def test_coverage_lists(spark):
    assert coverage_of(spark, ["Affaires"], ["Garage Alpha"], ["Garage Beta"]) == [("name", "GARAGE ALPHA"), ("name", "GARAGE BETA")]
    assert ("name", "SOCIETE ETOILE") in coverage_of(spark, ["Nom"], ["Société Étoile"], ["Client Nord"])
    assert coverage_of(spark, ["Garage Alpha"], ["Garage Beta"]) == [("name", "GARAGE ALPHA"), ("name", "GARAGE BETA")]
    shifted = [["Liste affaires couvertes RCI", None], ["Code client", "Raison sociale"], ["000123", "Garage Alpha"], ["000456", "Garage Beta"]]
    assert coverage_of(spark, *shifted) == [("code", "123"), ("code", "456"), ("name", "GARAGE ALPHA"), ("name", "GARAGE BETA")]
    (role,) = reference.sheet_roles(sheet(spark, *shifted)).collect()
    assert (role.strategy, role.header_row, role.codes, role.names) == ("detected_header_row", 1, [0], [1])
    audit = reference.audit_rows(sheet(spark, *shifted)).orderBy("row_number").collect()
    assert [(r.row_number, r.raw_values, r.normalized_code) for r in audit] == [
        (3, '["000123", "Garage Alpha"]', "123"), (4, '["000456", "Garage Beta"]', "456")]


def test_title_words_meet_a_bound_key(spark):
    plan = reference.header_rows(sheet(spark, ["Code client", "Nom"], ["1", "A"]))._jdf.queryExecution().optimizedPlan().toString()
    scans = plan.count("LogicalRDD") + plan.count("LocalRelation")
    assert plan.count("lower(") <= 2 * scans and plan.count("upper(") <= 2 * scans


def test_tables_of_one_row_group_are_dealt_over_tasks(spark, tmp_path):
    from checks import views

    rows = [(k, k % 7) for k in range(2 * views.TASK_ROWS + 1)] + [(None, None), (5, 5)]
    spark.createDataFrame(rows, "k long, c long").coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    table = views.table(spark, str(tmp_path), "t")
    assert table.rdd.getNumPartitions() == 3 and sorted(map(repr, table.collect())) == sorted(f"Row(k={k}, c={c})" for k, c in rows)
    sizes = [n for (n,) in table.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).select("n").collect()]
    assert max(sizes) < 1.2 * len(rows) / 3


def test_rank_over_blocks(spark):
    rows = spark.range(0, 400_000, 3).select(F.lit("a").alias("key"), F.col("id").alias("row_idx"))
    ranked = reference.ranked(rows, ["key"], "row_idx", "place")
    assert ranked.filter("place <> row_idx / 3").count() == 0 and ranked.count() == 133_334


def test_delimited_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿N° facture;Date facture;Montant;Client\nFVF1;15/05/26;1.000,50;Société €uro\n;;;\n".encode("utf-8"))
    (tmp_path / "b.csv").write_bytes("N° facture,Date facture,Montant,Client\nVF2,15/05/2026,123.45,Cœur €\nVF3,NA,7,\n".encode("cp1252"))
    rows = text.read_delimited(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    found = {r.invoice_number: r for r in sheets.standardise_erp(rows).collect()}
    assert set(found) == {"VF1", "VF2", "VF3"}
    assert (found["VF1"].customer_name, found["VF1"].amount_erp) == ("SOCIÉTÉ €URO", Decimal("1000.50"))
    assert (found["VF2"].customer_name, found["VF2"].amount_erp) == ("CŒUR €", Decimal("123.45"))
    assert found["VF3"].erp_date is None


def test_row_order_survives_file_splits(spark, tmp_path):
    n = 20_000
    (tmp_path / "big.csv").write_text("Facture;Date;Total\n" + "".join(f"VF{i};2026-05-15;{i}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 17))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = text.read_delimited(spark, str(tmp_path / "big.csv"))
        assert rows.rdd.getNumPartitions() > 2
        keys = [r[0] for r in rows.orderBy("row_idx").select(F.get("cells", F.lit(0))).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert keys == ["Facture"] + [f"VF{i}" for i in range(n)]


def test_feed_scan_decodes_single_byte_lines(spark, tmp_path):
    (tmp_path / "f.txt").write_bytes("D préfixe VF1\n".encode("cp1252") + "D œ VF2\n".encode("utf-8"))
    rows = text.read_feed_lines(spark, str(tmp_path)).orderBy("row_ord").collect()
    assert [r.line for r in rows] == ["D préfixe VF1", "D œ VF2"]


def test_delimited_files_lose_nothing(spark, tmp_path):
    for folder, lines in (("a", ["Facture;Client;Montant", 'VF1;"A ""B;C"" D";1,00', 'VF2;"deux\nlignes;x";2,00;"en ""plus"""']),
                          ("b", ["Montant;Facture;Client", "3,00;VF3;z;trop"])):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.csv").write_text("\n".join(lines) + "\n")
    rows = text.read_delimited(spark, [str(tmp_path / "a" / "x.csv"), str(tmp_path / "b" / "x.csv")])
    cells = sorted([c for c in r.cells if c is not None] for r in rows.filter("row_idx > 0").collect())
    assert cells == [["3,00", "VF3", "z", "trop"], ["VF1", 'A "B;C" D', "1,00"], ["VF2", "deux\nlignes;x", "2,00", 'en "plus"']]
    found = {r.invoice_number: (r.source_file, r.amount_erp) for r in sheets.standardise_erp(rows).collect()}
    assert found == {f"VF{i}": ("x.csv", Decimal(f"{i}.00")) for i in (1, 2, 3)}


QUOTED_LINES = [
    "", "a;b;c", '"a";b', 'a;"b', 'b";c', '"', '""', '";"', 'x"y;z', 'x"y;"z', '"a""b"', '"a""', 'a;"";b', 'a;"""', '"a"x"b;c', '"a;b"";c', "plain", ';;"', '"x"tail;"open',
]


def ends_inside(state, line, delimiter):
    """Character by character: 0 at a field's begin, 1 in a bare field, 2 in a quoted one, 3 behind its quote."""
    at = 2 if state else 0
    for char in line:
        if at == 2:
            at = 3 if char == '"' else 2
        elif at == 3 and char == '"':
            at = 2
        elif char == delimiter:
            at = 0
        else:
            at = 2 if at == 0 and char == '"' else 1
    return int(at == 2)


@pytest.mark.parametrize("delimiter", [";", "^", "\t", "]"])
def test_what_a_line_does_to_the_quote_state(delimiter):
    rule = text.QuoteState(delimiter)
    rng = random.Random(4)
    lines = [x.replace(";", delimiter) for x in QUOTED_LINES] + ["".join(rng.choice(f'a"{delimiter}') for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    for line in lines:
        for state in (0, 1):
            # behind a closing quote the rest of the field is bare up to the delimiter
            assert rule.after(state, line) == ends_inside(state, line, delimiter), (state, line)


@pytest.mark.parametrize("delimiter", [";", "^", "\t", "]"])
def test_effects_of_lines_follow_the_quote_state(spark, delimiter):
    rng = random.Random(5)
    lines = [x.replace(";", delimiter) for x in QUOTED_LINES] + ["".join(rng.choice(f'a"{delimiter}') for _ in range(rng.randint(0, 9))) for _ in range(2000)]
    lines += ['"' + '""' * 100_000 + delimiter, ('"a""b"' + delimiter) * 50_000 + '"open']  # no deep stack
    found = spark.createDataFrame([(x,) for x in lines], "line string").select("line", text.QuoteState(delimiter).effect(F.col("line")).alias("effect")).collect()
    for row in found:
        effect = np.array([row.effect])
        assert [int(text.states_after(effect, s)[0]) for s in (0, 1)] == [ends_inside(s, row.line, delimiter) for s in (0, 1)], row.line[:80]
    effects, state = np.array([r.effect for r in found]), 1
    for row, after in zip(found, text.states_after(effects, 1)):
        state = ends_inside(state, row.line, delimiter)
        assert state == after


def test_files_are_described_without_sorting_their_lines(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text('Facture;Texte\nVF1;"x\ny"\n')
    plans, listed = [], DataFrame.toLocalIterator
    monkeypatch.setattr(DataFrame, "toLocalIterator", lambda self, *a: plans.append(self._jdf.queryExecution().executedPlan().toString()) or listed(self, *a))
    rows = text.read_delimited(spark, str(tmp_path)).orderBy("row_idx").collect()
    assert [r.cells for r in rows] == [["Facture", "Texte"], ["VF1", "x\ny"]]
    assert "ObjectHashAggregate" in plans[0] and "SortAggregate" not in plans[0]


def test_lines_of_split_records_pass_python_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Facture;Texte\nVF1;"x\ny"\n')
    plan = text.read_delimited(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "MapIn" not in plan


@contextmanager
def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_lines_are_read_in_splits(spark, tmp_path, end):
    rng = random.Random(7)
    rows = [[f"VF{i}", end.join("x" * rng.randint(0, 60) + '"' * rng.randint(0, 2) for _ in range(rng.choice([1, 1, 2, 5]))), rng.choice(["", "a;b", "Société"])] for i in range(3000)]
    rows[700][1] = end.join(["a line inside one long value"] * 1500)  # longer than several splits
    rows[1500][1] = end * 9000
    quoted = lambda v: '"' + v.replace('"', '""') + '"' if any(c in v for c in '";\r\n') else v
    body = end.join(";".join(map(quoted, r)) for r in [["Facture", "Texte", "Nom"], *rows]) + end
    (tmp_path / "long.csv").write_bytes(body.encode())
    (tmp_path / "plain.csv").write_bytes(b"Facture;Texte;Nom\nVF1;x;y\n")
    shown = lambda frame: [[x or "" for x in r[0]] for r in frame.filter("source_file = 'long.csv'").orderBy("row_idx").select("cells").collect()]
    with small_splits(spark, 1 << 14):
        frame = text.read_delimited(spark, str(tmp_path))
        assert len(text.inside_quotes(spark, [str(tmp_path / "long.csv")], ";")) >= 3
        assert text.records_over_lines(spark, [str(tmp_path / "long.csv")], ";").filter("text <> ''").count() == 3001
        assert shown(frame) == [["Facture", "Texte", "Nom"], *rows]
    assert shown(text.read_delimited(spark, str(tmp_path))) == [["Facture", "Texte", "Nom"], *rows]


def test_records_over_lines_in_a_single_byte_file_with_an_open_end(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('Facture;Client\nVF1;"é\nœ"\n\nVF2;"jamais fermé\nVF3;x\n'.encode("cp1252"))
    rows = [[c for c in r.cells if c is not None] for r in text.read_delimited(spark, str(tmp_path)).orderBy("row_idx").collect()]
    assert rows[:2] == [["Facture", "Client"], ["VF1", "é\nœ"]] and rows[2][0] == "VF2" and len(rows) == 3


@pytest.mark.parametrize("delimiter", list(";,\t|^~:#"))
def test_any_steady_delimiter_is_found(spark, tmp_path, delimiter):
    lines = ["N° d'ordre de facture;Date facture (jour/mois);Total TTC;Client"] + [f"VF{i};{i % 28 + 1:02}/05/2026 10.30;1.000,50;Société n° {i} - d'Or & fils" for i in range(1, 40)]
    (tmp_path / "a.csv").write_text("\n".join(x.replace(";", delimiter) if delimiter != "," else x.replace("1.000,50", "1000.50").replace(";", ",") for x in lines) + "\n")
    found = {r.invoice_number: r.customer_name for r in sheets.standardise_erp(text.read_delimited(spark, str(tmp_path))).collect()}
    assert len(found) == 39 and found["VF7"] == "SOCIÉTÉ N° 7 - D'OR & FILS"


def test_one_column_files_stay_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Affaires: liste\nA:B:C\nD\nE\nF-G\n")
    rows = text.read_delimited(spark, str(tmp_path)).orderBy("row_idx").collect()
    assert [r.cells for r in rows] == [["Affaires: liste"], ["A:B:C"], ["D"], ["E"], ["F-G"]]
