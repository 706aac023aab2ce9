"""Queries over the value functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lettrage.functions import fixed as fx
from lettrage.functions import scalars as s
from lettrage.functions import wording as w
from lettrage.sources import history as hist

from . import views as v
from .registry import query
from .sql import BASE, RAW, recon, with_


@query("norm_invoice", with_(RAW, "SELECT k, facture, inv AS invoice_number FROM raw"))
def _(spark, sf):
    return v.erp_raw(spark, sf).select("k", "facture", s.invoice_number("facture").alias("invoice_number"))


@query("doc_type", with_(RAW, """
  SELECT k, kind AS document_type, CASE WHEN k % 5 = 0 THEN 'UNKNOWN' ELSE kind END AS spoiled FROM raw"""))
def _(spark, sf):
    k = F.col("k")
    spoiled = F.when(k % 5 == 0, F.concat(F.col("facture"), F.lit("/1"))).otherwise(F.col("facture"))
    return v.erp_raw(spark, sf).select(
        "k", s.document_type("facture").alias("document_type"), s.document_type(spoiled).alias("spoiled")
    )


@query("parse_amount", with_(RAW, """
  SELECT k, montant, sg * cents / 100.0 AS amount, -cents / 100.0 AS bracketed, cents / 100.0 AS spaced,
         CASE WHEN k % 2 = 0 THEN NULL ELSE cents / 100.0 END AS pointed FROM raw"""))
def _(spark, sf):
    k = F.col("k")
    digits = F.regexp_replace("montant", "-$", "")
    bracketed = F.concat(F.lit("( "), digits, F.lit(" )"))
    spaced = F.concat(F.translate(digits, ".", " "), F.lit(" MAD"))
    point = F.concat(F.translate(digits, ".,", " ."), F.when(k % 2 == 0, ",1,2").otherwise(" EUR"))
    return v.erp_raw(spark, sf).select(
        "k", "montant", s.amount("montant").alias("amount"), s.amount(bracketed).alias("bracketed"),
        s.amount(spaced).alias("spaced"), s.amount(point).alias("pointed"),
    )


@query("norm_date", with_(RAW, """
  SELECT k, date_text, CASE WHEN k % 41 <> 0 THEN d END AS day, d AS iso_time,
         CASE WHEN k % 3 = 0 THEN NULL ELSE d END AS dashed FROM raw"""))
def _(spark, sf):
    k = F.col("k")
    iso = F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit("T09:30:00Z"))
    dashed = F.when(k % 3 == 0, F.concat(F.date_format("d", "yyyy"), F.lit("-13-45"))).otherwise(F.date_format("d", "d-M-yyyy"))
    return v.erp_raw(spark, sf).select(
        "k", "date_text", s.date_value("date_text").alias("day"), s.date_value(iso).alias("iso_time"),
        s.date_value(dashed).alias("dashed"),
    )


@query("excel_serial_date", with_(BASE, """
  SELECT k, d AS whole, CASE WHEN k % 10 = 0 THEN NULL ELSE d END AS guarded FROM base"""))
def _(spark, sf):
    k = F.col("k")
    days = F.datediff("d", F.lit(fx.EXCEL_EPOCH).cast("date")).cast("double")
    guarded = F.when(k % 20 == 0, -days).when(k % 10 == 0, days * 1e6).otherwise(days + 0.75)
    return v.orders(spark, sf).select("k", s.excel_serial(days).alias("whole"), s.excel_serial(guarded).alias("guarded"))


@query("norm_text", """
  SELECT c_custkey, upper(c_name || ' ' || c_mktsegment) AS text FROM customer""")
def _(spark, sf):
    text = F.concat(F.lit(" \t"), F.lower("c_name"), F.lit("  \n"), F.col("c_mktsegment"), F.lit("  "))
    return v.table(spark, sf, "customer").select("c_custkey", s.text_value(text).alias("text"))


@query("optional_text", """
  SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR)
    WHEN c_custkey % 3 = 1 THEN c_custkey || '.05' ELSE upper(c_name) END AS text FROM customer""")
def _(spark, sf):
    c = F.col("c_custkey")
    text = F.when(c % 10 == 0, "   ").when(c % 3 == 0, F.concat(c.cast("string"), F.lit(".0"))).when(
        c % 3 == 1, F.concat(c.cast("string"), F.lit(".05"))
    ).otherwise(F.concat(F.lit(" "), F.lower("c_name")))
    return v.table(spark, sf, "customer").select("c_custkey", s.optional_text(text).alias("text"))


@query("null_markers", """
  SELECT c_custkey, c_custkey % 8 < 6 AS is_marker, c_custkey % 8 < 2 AS blank FROM customer""")
def _(spark, sf):
    marks = F.array(*[F.lit(x) for x in (None, "  ", "none", " NULL ", "NaN", "nat", "0", "nan.")])
    text = F.get(marks, (F.col("c_custkey") % 8).cast("int"))
    return v.table(spark, sf, "customer").select(
        "c_custkey", s.is_null_marker(text).alias("is_marker"), s.is_blank(text).alias("blank")
    )


@query("signed_amount", with_(BASE, """
  SELECT k, CASE k % 3 WHEN 0 THEN -cents WHEN 1 THEN cents ELSE sg * cents END / 100.0 AS amount FROM base"""))
def _(spark, sf):
    k = F.col("k")
    kind = F.get(F.array(F.lit("AVOIR"), F.lit("FACTURE"), F.lit("UNKNOWN")), (k % 3).cast("int"))
    value = (F.col("sg") * F.col("cents")).cast("decimal(20,0)") / 100
    return v.orders(spark, sf).select("k", s.signed(value, kind).alias("amount"))


_HARD_NAMES = ["أحمد إبراهيم", "Йошкар Ёлка", "ﬁn ﬀ Ĳ", "Ａｂｃ　Ｄ", "Ελλάς Ά", "ザ ｶﾞ", "Łódź Øre", "x̨́y", "№ 5", "½ ㎏ …", "한글 각"]
_FOLDED = ["احمد ابراهيم", "ИОШКАР ЕЛКА", "FIN FF IJ", "ABC D", "ΕΛΛΑΣ Α", "サ カ", "ŁODZ ØRE", "XY", "NO 5", "1⁄2 KG ...", "\u1112\u1161\u11ab\u1100\u1173\u11af \u1100\u1161\u11a8"]


@query("fold_name", f"""
  SELECT c_custkey, upper(strip_accents('Société Étoile Ça ' || c_name)) AS name,
    {_FOLDED!r}[1 + c_custkey % 11] || ' ' || c_custkey AS hard FROM customer""")
def _(spark, sf):
    text = F.concat(F.lit("Société  Étoile Ça "), F.col("c_name"))
    hard = F.get(F.array(*map(F.lit, _HARD_NAMES)), (F.col("c_custkey") % 11).cast("int"))
    return v.table(spark, sf, "customer").select(
        "c_custkey", s.folded_name(text).alias("name"), s.folded_name(F.concat_ws(" ", hard, F.col("c_custkey").cast("string"))).alias("hard")
    )


@query("ref_code", """
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS code, '0A' || c_custkey AS mixed FROM customer""")
def _(spark, sf):
    c = F.col("c_custkey").cast("string")
    return v.table(spark, sf, "customer").select(
        "c_custkey", s.reference_code(F.concat(F.lit("000-"), F.lpad(c, 9, "0"))).alias("code"),
        s.reference_code(F.concat(F.lit(" 0à "), c)).alias("mixed"),
    )


@query("dealer_code", """
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS feed, 'SAP' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS statement
  FROM customer""")
def _(spark, sf):
    text = F.concat(F.lit(" sap-"), F.lpad(F.col("c_custkey").cast("string"), 12, "0"))
    return v.table(spark, sf, "customer").select(
        "c_custkey", s.feed_dealer(text).alias("feed"), s.statement_dealer(text).alias("statement")
    )


@query("canonical_header", """
  SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'numerofacture' WHEN 1 THEN 'numerofacture' WHEN 2 THEN 'numerofacture'
    ELSE 'codedepartement' END || c_custkey AS key FROM customer""")
def _(spark, sf):
    title = F.get(F.array(*map(F.lit, ["N° facture ", "No. facture-", "n Facture", "Code  Département/"])), (F.col("c_custkey") % 4).cast("int"))
    return v.table(spark, sf, "customer").select(
        "c_custkey", s.header_key(F.concat(title, F.col("c_custkey").cast("string"))).alias("key")
    )


@query("date_token", with_(BASE, """
  , r AS (SELECT *, k % 2 = 1 AND day(d) IN (19, 20) AS misread FROM base) -- 19.. and 20.. are taken for a year
  SELECT k, CASE WHEN k % 5 = 4 OR misread THEN NULL ELSE d END AS day,
    -- a small number is taken for an Excel serial first
    CASE WHEN k % 5 IN (1, 2, 3) AND k % 2 = 1 AND day(d) < 3 THEN DATE '1899-12-30' + CAST(strftime(d, '%d%m%Y') AS INTEGER)
      WHEN k % 5 = 0 OR (k % 5 <> 4 AND NOT misread) THEN d END AS table_day FROM r"""))
def _(spark, sf):
    k = F.col("k")
    bad = F.when(k % 2 == 0, "99999999").otherwise("19991345")
    token = F.when(k % 5 == 4, bad).when(k % 2 == 0, F.date_format("d", "yyyyMMdd")).otherwise(F.date_format("d", "ddMMyyyy"))
    cell = F.when(k % 5 == 0, F.date_format("d", "dd.MM.yyyy")).otherwise(token)
    return v.orders(spark, sf).select("k", s.date_token(token).alias("day"), s.table_date(cell).alias("table_day"))


@query("parse_bool", """
  SELECT c_custkey, CASE WHEN c_custkey % 7 < 3 THEN TRUE WHEN c_custkey % 7 < 5 THEN FALSE END AS flag,
         c_custkey % 7 NOT IN (3, 4) AS with_default FROM customer""")
def _(spark, sf):
    words = F.array(*[F.lit(x) for x in ("oui", " TRUE ", "1", "Non", "off", "peut-être", None)])
    text = F.get(words, (F.col("c_custkey") % 7).cast("int"))
    return v.table(spark, sf, "customer").select(
        "c_custkey", s.boolean(text).alias("flag"), s.boolean(text, True).alias("with_default")
    )


@query("lenient_number", with_(BASE, """
  SELECT k, CASE WHEN k % 4 < 2 THEN cents / 100.0 END AS number, CASE WHEN k % 4 < 2 THEN cents / 1.0 END AS dropped FROM base"""))
def _(spark, sf):
    k = F.col("k")
    plain = (F.col("cents").cast("decimal(20,0)") / 100).cast("decimal(18,2)").cast("string")
    text = F.when(k % 4 < 2, plain).when(k % 4 == 2, "NaN").otherwise("")
    return v.orders(spark, sf).select(
        "k", s.lenient_number(text).alias("number"), s.lenient_number(F.translate(text, ".", ","), True).alias("dropped")
    )


@query("value_class", """
  SELECT c_custkey, TRUE AS name_is_name, FALSE AS name_is_code, FALSE AS code_is_name, TRUE AS code_is_code,
         c_custkey > 9 AS short_is_code FROM customer""")
def _(spark, sf):
    c = F.col("c_custkey").cast("string")
    name, code = F.replace(F.col("c_name"), F.lit("#"), F.lit(" ")), F.concat(F.lit("50-"), c)
    return v.table(spark, sf, "customer").select(
        "c_custkey", s.looks_like_name(name).alias("name_is_name"), s.looks_like_code(name).alias("name_is_code"),
        s.looks_like_name(code).alias("code_is_name"), s.looks_like_code(code).alias("code_is_code"),
        s.looks_like_code(c).alias("short_is_code"),
    )


@query("raw_line", with_(RAW, """
  SELECT k, concat_ws(' | ', facture, CASE WHEN k % 41 <> 0 THEN date_text END, montant) AS raw_line FROM raw"""))
def _(spark, sf):
    cells = F.array("facture", F.lit("  "), "date_text", F.lit(None).cast("string"), "montant")
    return v.erp_raw(spark, sf).select("k", s.raw_line(cells).alias("raw_line"))


@query("processing_date", with_(BASE, """
  SELECT k, CASE k % 4 WHEN 3 THEN DATE '2026-05-15' ELSE d END AS day FROM base"""))
def _(spark, sf):
    k = F.col("k")
    generated = F.when(k % 4 == 0, F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit("T21:30:00.123+00:00"))).when(k % 4 == 3, "hier")
    run = F.when(k % 4 == 1, F.concat(F.date_format("d", "yyyyMMdd"), F.lit("_213000"))).when(
        k % 4 == 2, F.concat(F.date_format("d", "yyyyMMdd"), F.lit("_2130"))
    ).otherwise("essai")
    return v.orders(spark, sf).select("k", hist.processing_date(generated, run, date(2026, 5, 15)).alias("day"))


@query("priority_action", with_(recon(), """
  SELECT invoice_number, status, priority, action_recommandee,
    'Analyser l''écart et définir une action de régularisation.' AS other_action FROM recon"""))
def _(spark, sf):
    from .q_matching import reconciled

    return reconciled(spark, sf).select(
        "invoice_number", "status", w.priority("status").alias("priority"), w.action("status").alias("action_recommandee"),
        w.action(F.concat("status", F.lit("?"))).alias("other_action"),
    )


@query("severity", with_(recon(), """
  SELECT invoice_number, status, montant_impacte, severity, 'A_VERIFIER' AS other FROM recon"""))
def _(spark, sf):
    from .q_matching import reconciled

    return reconciled(spark, sf).select(
        "invoice_number", "status", "montant_impacte", w.severity(F.lower("status"), "montant_impacte").alias("severity"),
        w.severity(F.concat("status", F.lit("?")), "montant_impacte").alias("other"),
    )


@query("missing_category", with_(BASE, """
  SELECT k, CASE WHEN k % 10 = 0 THEN 'Non déterminé' WHEN k % 7 = 0 THEN 'Avoir absent' ELSE 'Facture absente' END AS categorie,
    CASE WHEN k % 7 = 0 THEN 'Avoir absent' ELSE 'Facture absente' END AS by_type FROM base"""))
def _(spark, sf):
    k = F.col("k")
    kind, number = s.document_type("inv"), F.when(k % 10 == 0, "ZZ 1").otherwise(F.col("inv"))
    return v.orders(spark, sf).select(
        "k", w.missing_category(F.lit(None).cast("string"), number).alias("categorie"),
        w.missing_category(kind, number).alias("by_type"),
    )


@query("explain_status", with_(recon(), """
  SELECT invoice_number, CASE status
    WHEN 'OK' THEN 'presente ERP et RCI/PDF, montant ERP=' || amount_erp || ', montant RCI=' || COALESCE(CAST(amount_rci AS VARCHAR), 'None')
      || ', montant PDF=' || COALESCE(CAST(amount_pdf AS VARCHAR), 'None') || ', ecart=' || amount_gap || '; dans la tolerance.'
    WHEN 'MANQUANTE_RCI' THEN 'presente ERP mais absente RCI/PDF; montant impacte=' || montant_impacte || '. Action: ' || action_recommandee
    WHEN 'RCI_SEULEMENT' THEN 'presente RCI/PDF mais absente ERP; montant impacte=' || montant_impacte || '. Action: ' || action_recommandee
    WHEN 'ANOMALIE_MONTANT' THEN 'ecart montant hors tolerance; ecart=' || amount_gap || ', montant impacte=' || montant_impacte || '. Action: ' || action_recommandee
    WHEN 'ANOMALIE_DATE' THEN 'date incoherente ou manquante; montant impacte=' || montant_impacte || '. Action: ' || action_recommandee
    WHEN 'DOUBLON' THEN 'doublon conflictuel detecte; montant impacte=' || montant_impacte || '. Action: ' || action_recommandee
    WHEN 'HORS_SCOPE_RCI' THEN 'facture ERP hors perimetre RCI; pas d''ecart impacte. Action: ' || action_recommandee
    ELSE 'statut ' || status || '; Action: ' || action_recommandee END AS explanation FROM recon"""))
def _(spark, sf):
    from .q_matching import reconciled

    return reconciled(spark, sf).select("invoice_number", w.explanation().alias("explanation"))
