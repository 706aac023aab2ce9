"""Queries over file scans, feed and statement lines, sheets and coverage lists, and the full run."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from lettrage.functions import fixed as fx
from lettrage.operators import feed_lines as feed
from lettrage.operators import reference, selections as sel, sheets, statement_lines as stmt
from lettrage.plans.run import RunConfig, run
from lettrage.sources import text
from lettrage.sources.shared import stored

from . import views as v
from .registry import query, scratch
from .sql import BASE, RAW, SOURCES, french, recon, with_

# ---------------------------------------------------------------- files


def titled(title: str):
    """Every file of a text written by tasks begins with its title line."""

    def lines(batches):
        for i, batch in enumerate(batches):
            if i == 0:
                yield pa.RecordBatch.from_arrays([pa.array([title], batch.schema[0].type)], schema=batch.schema)
            yield batch

    return lines


# names with doubled quotes, delimiters and line ends; files of one name in two folders, with other column orders and
# rows wider than their titles
@query("scan_delimited", with_(RAW, """
  SELECT k % 4 AS file, CAST(k AS VARCHAR) AS k, facture, date_text, montant,
    nom || CASE k % 5 WHEN 0 THEN ' "A;B", ""' WHEN 1 THEN chr(10) || 'suite "fin' ELSE '' END AS nom,
    CASE WHEN k % 4 = 3 AND k % 3 = 0 THEN 'plus' END AS extra FROM raw"""))
def _(spark, sf):
    folder, k = scratch(spark), F.col("k")
    odd = F.when(k % 5 == 0, ' "A;B", ""').when(k % 5 == 1, '\nsuite "fin').otherwise("")
    rows = stored(v.erp_raw(spark, sf).select("k", "facture", "date_text", "montant", F.concat("nom", odd).alias("nom")), "rows-to-write")
    tasks = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    exact = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for i, (sep, encoding) in enumerate([(";", "UTF-8"), (",", "ISO-8859-1")]):
        rows.filter(k % 4 == i).write.options(sep=sep, encoding=encoding, **exact).csv(f"{folder}/{i}")
    orders = [["k", "facture", "date_text", "montant", "nom"], ["nom", "montant", "k", "facture", "date_text"]]
    quoted = lambda c: F.coalesce(F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))
    for side, order in enumerate(orders):
        wide = F.when((k % 3 == 0) & (k % 4 == 3), ";plus").otherwise("")
        lines = rows.filter(k % 4 == 2 + side).repartition(tasks, "k").select(F.concat(F.concat_ws(";", *[quoted(c) for c in order]), wide).alias("value"))
        lines.mapInArrow(titled(";".join(order)), "value string").write.text(f"{folder}/sides/side={side}")
    cells = text.read_delimited(spark, [f"{folder}/0", f"{folder}/1", f"{folder}/sides/side=0", f"{folder}/sides/side=1"])
    cells = cells.filter("row_idx > 0").withColumn("turned", F.contains(F.col("source_path"), F.lit("/side=1/")))
    at = lambda place: F.get("cells", F.lit(place))
    shown = [F.when(F.col("turned"), at(orders[1].index(c))).otherwise(at(i)).alias(c) for i, c in enumerate(orders[0])]
    named = cells.select(*shown, at(5).alias("extra"))
    return named.withColumn("file", k.cast("bigint") % 4)


@query("scan_any_delimiter", with_(RAW, "SELECT k % 3 AS file, CAST(k AS VARCHAR) AS k, facture, date_text, montant, nom FROM raw"))
def _(spark, sf):
    folder, columns = scratch(spark), ["k", "facture", "date_text", "montant", "nom"]
    rows = v.erp_raw(spark, sf).select(columns)
    for i, delimiter in enumerate("^~:"):
        rows.filter(F.col("k") % 3 == i).write.options(sep=delimiter, header=True).csv(f"{folder}/{i}")
    cells = text.read_delimited(spark, [f"{folder}/{i}" for i in range(3)]).filter("row_idx > 0")
    named = cells.select(*[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(columns)])
    return named.withColumn("file", F.col("k").cast("bigint") % 3)


_FEED = SOURCES + """,
feed AS (SELECT k, inv, kind, dt, c, file, amt, lpad(CAST(abs(amt) AS VARCHAR), 13, '0') AS field,
    COALESCE(strftime(dt, '%Y%m%d'), '        ') AS day FROM rci),
lines AS (SELECT k, file, CASE WHEN k % 37 = 0
    THEN 'D SAP' || lpad(CAST(c AS VARCHAR), 12, '0') || ' ' || day || ' 1,00 x ' || (abs(amt) // 100) || ',' || lpad(CAST(abs(amt) % 100 AS VARCHAR), 2, '0') || ' # ' || inv
    ELSE 'D     0 PIECES          SAP' || lpad(CAST(c AS VARCHAR), 12, '0') || '      ' || day || day || '     ' || field || field || '      ' || inv END AS line
  FROM feed),
parsed AS (SELECT *, CASE WHEN dt IS NOT NULL THEN dt WHEN k % 37 <> 0 AND right(field, 1) = '2'
    THEN try_cast('2000-' || substr(field, 11, 2) || '-' || substr(field, 9, 2) AS DATE) END AS read_dt FROM feed)
"""


@query("scan_feed_lines", with_(_FEED, """
  SELECT line FROM lines UNION ALL SELECT 'D ligne detail sans facture exploitable' FROM lines WHERE k % 50 = 0
  UNION ALL SELECT DISTINCT 'H' || file FROM lines"""))
def _(spark, sf):
    folder = scratch(spark)
    v.feed_lines(spark, sf).select(F.col("line").alias("value")).write.text(folder)
    return text.read_feed_lines(spark, folder).select("line")


# one file per range of 4,000 and 3,000 keys, so their number follows the table
@query("source_inventory", with_(RAW, """
  , n AS (SELECT count(DISTINCT k // 4000) AS e, count(DISTINCT k // 3000) AS r FROM raw)
  SELECT 'erp' AS source_type, e AS n_files, greatest(5 - e, 0) AS missing FROM n UNION ALL SELECT 'rci', r, greatest(4 - r, 0) FROM n
  UNION ALL SELECT 'pdf', 0, 1"""))
def _(spark, sf):
    folder, rows = scratch(spark), v.erp_raw(spark, sf).select("k", "facture")
    keys = v.orders(spark, sf).agg(F.max("k").alias("k")).first()["k"]
    dealt = lambda size: rows.repartitionById(keys // size + 1, F.floor(F.col("k") / size).cast("int"))
    dealt(4000).write.option("header", True).csv(f"{folder}/erp")
    dealt(3000).select("facture").write.text(f"{folder}/rci")
    dealt(4000).select("facture").write.text(f"{folder}/pdf")
    extensions = {"erp": [".csv", ".xlsx"], "rci": [".TXT"], "pdf": [".pdf"]}
    return text.source_inventory(spark, folder, extensions, {"erp": 5, "rci": 4, "pdf": 1})


@query("union_sources", with_(SOURCES, """
  SELECT file AS source_file, sheet AS source_sheet, inv AS invoice_number, amt / 100.0 AS amount_erp, CAST(NULL AS VARCHAR) AS department_code FROM erp
  UNION ALL SELECT file, NULL, inv, NULL, NULL FROM rci"""))
def _(spark, sf):
    frames = [v.erp(spark, sf), v.rci(spark, sf)]
    return sel.union_sources(frames, ["source_file", "source_sheet", "invoice_number", "amount_erp", "department_code"])


# ---------------------------------------------------------------- feed lines

query("feed_parse", with_(_FEED, """
  SELECT p.file AS source_file, p.k AS row_ord, p.inv AS invoice_number, p.kind AS document_type, p.read_dt AS rci_date,
    CAST(p.c AS VARCHAR) AS dealer_code, abs(p.amt) / 100.0 AS amount_rci, l.line AS raw_line FROM parsed p JOIN lines l USING (k)"""))(
    lambda spark, sf: feed.parse_feed(v.feed_lines(spark, sf))
)


@query("feed_date", with_(_FEED, """
  SELECT k AS row_ord, read_dt AS rci_date, COALESCE(dt, CASE WHEN k % 37 <> 0 THEN read_dt END) AS trailing FROM parsed"""))
def _(spark, sf):
    lines = v.feed_lines(spark, sf)
    # the invoice moved to the front: no token precedes it, so any token of the line counts
    moved = F.regexp_replace("line", r"^(.*?)\s+(?:# )?((?:VF|AAF)\d+)$", "D $2 $1")
    trailing = feed.located(lines.withColumn("line", moved)).select("row_ord", feed.feed_date().alias("trailing"))
    return feed.located(lines).select("row_ord", feed.feed_date().alias("rci_date")).join(trailing, "row_ord")


query("feed_amount_fixed", with_(_FEED, """
  SELECT k AS row_ord, CASE WHEN k % 37 <> 0 THEN abs(amt) / 100.0 END AS amount FROM feed"""))(
    lambda spark, sf: feed.located(v.feed_lines(spark, sf)).select("row_ord", feed.fixed_width_amount().alias("amount"))
)
query("feed_amount_nearest", with_(_FEED, """
  SELECT k AS row_ord, CASE WHEN k % 37 = 0 THEN abs(amt) / 100.0 END AS amount FROM feed"""))(
    lambda spark, sf: feed.located(v.feed_lines(spark, sf)).select("row_ord", feed.nearest_decimal_amount().alias("amount"))
)
query("feed_rejects", with_(_FEED, """
  SELECT file AS source_file, k AS row_ord, 'D ligne detail sans facture exploitable' AS line FROM lines WHERE k % 50 = 0"""))(
    lambda spark, sf: feed.feed_rejects(v.feed_lines(spark, sf))
)

# ---------------------------------------------------------------- statement lines

_STMT = SOURCES + f""",
st AS (SELECT *, {french('amt')} || CASE WHEN k % 7 = 0 THEN '-' ELSE '' END AS txt,
    CASE WHEN k % 29 <> 0 THEN strftime(dt + 75, '%d/%m/%y') ELSE '--' END AS due_txt,
    CASE WHEN k % 3 = 0 THEN 'VF1abc' || k || ' ' ELSE '' END AS chassis FROM pdf),
stl AS (SELECT *, lpad(CAST(c AS VARCHAR), 6, '0') || ' ' || inv || ' PR01 ' || strftime(dt, '%d/%m/%Y') || ' ' || due_txt || ' PIE ' || chassis || txt || ' Entree batch' AS line FROM st)
"""
query("stmt_useful", with_(_STMT, "SELECT k AS row_ord, page, line AS squeezed FROM stl"))(
    lambda spark, sf: stmt.useful(v.statement_lines(spark, sf)).select(
        "row_ord", "page", F.trim(F.regexp_replace("line", r"\s+", " ")).alias("squeezed"))
)
query("stmt_parse", with_(_STMT, """
  SELECT 'releve.pdf' AS source_file, page, k AS row_ord, lpad(CAST(c AS VARCHAR), 6, '0') AS dealer_code, inv AS invoice_number,
    kind AS document_type, 'PR01' AS cf_code, dt AS pdf_invoice_date, due AS due_date, 'PIE' AS model,
    CASE WHEN k % 3 = 0 THEN 'VF1ABC' || k END AS chassis_number, amt / 100.0 AS amount_pdf, 'ENTREE BATCH' AS origin, line AS raw_line FROM stl"""))(
    lambda spark, sf: stmt.parse_statement(v.statement_lines(spark, sf))
)


@query("stmt_fallback", with_(_STMT, """
  SELECT k AS row_ord, lpad(CAST(c AS VARCHAR), 6, '0') AS dealer_code, inv AS invoice_number, dt AS pdf_invoice_date, due AS due_date,
    CASE WHEN k % 3 = 0 THEN 'VF1ABC' || k END AS chassis_number, amt / 100.0 AS amount_pdf, 'ENTREE BATCH' AS origin FROM stl"""))
def _(spark, sf):
    # a leading remark takes every line out of the layout
    lines = v.statement_lines(spark, sf).withColumn(
        "line", F.when(F.startswith(F.col("line"), F.lit("TOTAL")), F.col("line")).otherwise(F.concat(F.lit("cf. note "), "line"))
    )
    return stmt.parse_statement(lines).select(
        "row_ord", "dealer_code", "invoice_number", "pdf_invoice_date", "due_date", "chassis_number", "amount_pdf", "origin"
    )


# ---------------------------------------------------------------- ERP and bank sheets

_SHEETS = RAW + """,
sh AS (SELECT *, k % 4 AS v, ['export_a.xlsx','export_a.xlsx','export_b.xlsx','export_c.csv'][k % 4 + 1] AS file,
    ['TITRES','LIBRE','Feuil1','CSV'][k % 4 + 1] AS sheet FROM raw),
std AS (SELECT file AS source_file, sheet AS source_sheet, k + 1 AS id, inv AS invoice_number, kind AS document_type,
    CASE WHEN k % 41 <> 0 THEN d END AS erp_date, CASE WHEN v < 3 THEN code END AS customer_code, upper(nom) AS customer_name,
    sg * cents / 100.0 AS amount_erp, CASE WHEN v IN (1, 3) OR (v = 2 AND k % 7 <> 0) THEN 'PR' END AS department_code,
    CASE WHEN v = 1 OR (v = 2 AND k % 7 <> 0) THEN 'DIVERS' END AS brand_code,
    CASE WHEN v = 1 THEN 'URGENT' WHEN v = 2 THEN CASE WHEN k % 7 = 0 THEN 'FG' ELSE 'LIVRAISON DIR' END END AS sales_order_type
  FROM sh WHERE NOT (v = 3 AND k % 9 = 0))
"""
_KEYS = ["source_file", "source_sheet"]
_TARGETS = list(fx.ERP_ALIASES)

query("drop_empty", with_(_SHEETS, """
  SELECT file AS source_file, sheet AS source_sheet, k + 1 AS row_idx, array_to_string(list_transform(CASE v
    WHEN 0 THEN [facture, date_text, montant, code, nom]
    WHEN 1 THEN [date_text, facture, code, nom, montant, 'PR', 'DIVERS', 'URGENT']
    WHEN 2 THEN CASE WHEN k % 7 = 0
      THEN ['AX', NULL, facture, date_text, NULL, code, nom, 'FG', NULL, CASE WHEN k % 3 = 0 THEN montant END, CASE WHEN k % 3 <> 0 THEN montant END, NULL, 'MCPR']
      ELSE [date_text, 'AX', facture, code, nom, code, nom, '3', montant, 'PR', 'DIVERS', 'MCPR', 'LIVRAISON DIR'] END
    ELSE [CASE WHEN k % 9 = 0 THEN 'ABC' || k ELSE facture END, date_text, montant, nom, 'PR'] END, lambda x: coalesce(x, '')), '|') AS cells
  FROM sh"""))(
    lambda spark, sf: sheets.drop_empty(v.erp_sheets(spark, sf)).select(
        "source_file", "source_sheet", "row_idx", F.array_join(F.transform("cells", lambda c: F.coalesce(c, F.lit(""))), "|").alias("cells"))
)

_LAYOUT = """SELECT * FROM (VALUES
    ('export_a.xlsx', 'TITRES', {t}), ('export_a.xlsx', 'LIBRE', {l}), ('export_b.xlsx', 'Feuil1', {b}), ('export_c.csv', 'CSV', {c}))
  AS x(source_file, source_sheet, {names})"""
_big = lambda values: ", ".join("CAST(NULL AS BIGINT)" if x is None else f"CAST({x} AS BIGINT)" for x in values)
_N = [None] * 8

query("alias_map", with_(_SHEETS, _LAYOUT.format(
    t=_big([0, 1, 2, 3, 4, None, None, None]), l=_big(_N), b=_big(_N), c=_big([0, 1, 2, None, 3, 4, None, None]), names=", ".join(_TARGETS))
    + " WHERE EXISTS (SELECT 1 FROM sh)"))(
    lambda spark, sf: sheets.alias_roles(v.erp_sheets(spark, sf), "erp").select(*_KEYS, *_TARGETS)
)
# the headerless sheet is inferred too, though it is read by position
query("column_roles", with_(_SHEETS, _LAYOUT.format(
    t=_big([0, 1, 2]), l=_big([1, 0, 4]), b=_big([2, 0, 8]), c=_big([0, 1, 2]), names="invoice_number, erp_date, amount_erp")
    + " WHERE EXISTS (SELECT 1 FROM sh)"))(
    lambda spark, sf: sheets.column_roles(v.erp_sheets(spark, sf), "erp").select(
        *_KEYS, "invoice_number", "erp_date", "amount_erp")
)
query("neighbour_roles", with_(_SHEETS, _LAYOUT.format(
    t=_big([3, 4, None, None, None]), l=_big([2, 3, 5, 6, 7]), b=_big([3, 4, 9, 10, 11]), c=_big([None, 3, 4, None, None]),
    names="customer_code, customer_name, department_code, brand_code, sales_order_type") + " WHERE EXISTS (SELECT 1 FROM sh)"))(
    lambda spark, sf: sheets.column_roles(v.erp_sheets(spark, sf), "erp").select(
        *_KEYS, "customer_code", "customer_name", "department_code", "brand_code", "sales_order_type")
)

# scores of the columns of the bank tables over their first 50 non-blank values
query("column_scores", with_(SOURCES, f"""
  , b AS (SELECT k, k % 2 AS v, inv, dt, c, {french('amt')} || CASE WHEN k % 7 = 0 THEN '-' ELSE '' END AS txt FROM rci),
  cells AS (
    SELECT v, k, CASE v WHEN 0 THEN 0 ELSE 3 END AS pos, 1 AS inv_s, 0 AS dat_s, 0 AS amt_s, 1 AS dea_s FROM b
    UNION ALL SELECT v, k, 1, 0, 1, CASE v WHEN 0 THEN 1 ELSE 0 END, 1 FROM b WHERE dt IS NOT NULL
    UNION ALL SELECT v, k, CASE v WHEN 0 THEN 2 ELSE 0 END, 0, 0, 0, CAST(c > 9 AS INTEGER) FROM b
    UNION ALL SELECT v, k, CASE v WHEN 0 THEN 3 ELSE 2 END, 0, 0, 1, 1 FROM b),
  top AS (SELECT *, row_number() OVER (PARTITION BY v, pos ORDER BY k) AS n FROM cells)
  SELECT CASE v WHEN 0 THEN 'banque_a.csv' ELSE 'banque_b.xlsx' END AS source_file, CASE v WHEN 0 THEN 'CSV' ELSE 'Feuil1' END AS source_sheet,
    CAST(pos AS BIGINT) AS pos, count(*) AS sampled, CAST(sum(inv_s) AS BIGINT) AS invoice_score, CAST(sum(dat_s) AS BIGINT) AS date_score,
    CAST(sum(amt_s) AS BIGINT) AS amount_score, CAST(sum(dea_s) AS BIGINT) AS dealer_score FROM top WHERE n <= 50 GROUP BY v, pos"""))(
    lambda spark, sf: sheets.column_scores(v.rci_sheets(spark, sf), "rci").drop("source_path")
)

query("erp_standardise", with_(_SHEETS, "SELECT * FROM std"))(
    lambda spark, sf: sheets.standardise_erp(v.erp_sheets(spark, sf)).withColumn("id", F.col("row_ord.id")).drop("row_ord")
)


@query("erp_headerless", with_(_SHEETS, "SELECT * FROM std WHERE source_sheet = 'Feuil1'"))
def _(spark, sf):
    rows = v.erp_sheets(spark, sf)
    bare = sheets.bare_rows(rows, sheets.alias_roles(rows, "erp"))
    return bare.withColumn("id", F.col("row_ord.id")).drop("row_ord", "source_path")


query("rci_standardise", with_(SOURCES, f"""
  , b AS (SELECT *, {french('amt')} || CASE WHEN k % 7 = 0 THEN '-' ELSE '' END AS txt, 'SAP' || lpad(CAST(c AS VARCHAR), 9, '0') AS dl,
      strftime(dt, '%Y%m%d') AS d1, day(dt) || '/' || month(dt) || '/' || year(dt) AS d2 FROM rci)
  SELECT CASE k % 2 WHEN 0 THEN 'banque_a.csv' ELSE 'banque_b.xlsx' END AS source_file, k + 1 AS id, inv AS invoice_number, kind AS document_type,
    dt AS rci_date, CAST(c AS VARCHAR) AS dealer_code, amt / 100.0 AS amount_rci,
    CASE k % 2 WHEN 0 THEN concat_ws(' | ', inv, d1, dl, txt) ELSE concat_ws(' | ', dl, d2, txt, inv) END AS raw_line FROM b"""))(
    lambda spark, sf: sheets.standardise_rci(v.rci_sheets(spark, sf)).withColumn("id", F.col("row_ord.id")).drop("row_ord")
)

# ---------------------------------------------------------------- coverage lists

_REF = """
ref AS (SELECT c_custkey AS c, c_custkey % 5 AS v, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS code, replace(c_name, '#', ' ') AS name,
    ['ref_a.xlsx','ref_a.xlsx','ref_b.xlsx','ref_b.xlsx'][c_custkey % 5] AS file, ['AFFAIRES','TITRE','LISTE','CONTENU'][c_custkey % 5] AS sheet
  FROM customer WHERE c_custkey % 5 <> 0),
keys AS (SELECT DISTINCT v, file AS source_file, sheet AS source_sheet FROM ref)
"""
query("coverage_values", with_(_REF, """
  SELECT DISTINCT 'code' AS kind, CAST(c AS VARCHAR) AS value FROM ref WHERE v <> 3
  UNION ALL SELECT DISTINCT 'name', upper(name) FROM ref"""))(
    lambda spark, sf: reference.load_coverage(v.reference_sheets(spark, sf))
)
query("header_row", with_(_REF, """
  SELECT source_file, source_sheet, CAST(CASE v WHEN 1 THEN 0 WHEN 2 THEN 1 END AS BIGINT) AS header_row FROM keys"""))(
    lambda spark, sf: reference.header_rows(v.reference_sheets(spark, sf)).drop("source_path")
)


# row 0 of the titled sheet is a remark that holds a word for names
@query("reference_roles_header", with_(_REF, """
  SELECT source_file, source_sheet, CAST(p.pos AS BIGINT) AS pos, CASE WHEN v = 1 THEN p.role WHEN v = 2 AND p.pos = 0 THEN 'name' END AS top_by_title,
    CASE WHEN v IN (1, 2) THEN p.role END AS low_by_title
  FROM keys, (VALUES (0, 'code'), (1, 'name')) AS p(pos, role) WHERE v <> 3 OR p.pos = 0"""))
def _(spark, sf):
    profile = reference.column_profile(v.reference_sheets(spark, sf))
    roles = reference.header_roles(reference.header_roles(profile, "top"), "low")
    return roles.select(*_KEYS, "pos", "top_by_title", "low_by_title")


@query("reference_roles_content", with_(_REF, """
  SELECT source_file, source_sheet, CAST(p.pos AS BIGINT) AS pos, CASE WHEN v = 3 THEN 'name' ELSE p.role END AS top_by_content
  FROM keys, (VALUES (0, 'code'), (1, 'name')) AS p(pos, role) WHERE v <> 3 OR p.pos = 0"""))
def _(spark, sf):
    profile = reference.column_profile(v.reference_sheets(spark, sf))
    return reference.content_roles(profile, "top").select(*_KEYS, "pos", "top_by_content")


query("reference_strategy", with_(_REF, """
  SELECT source_file, source_sheet, CASE v WHEN 1 THEN 'default_header' WHEN 2 THEN 'detected_header_row' WHEN 3 THEN 'single_text_column_raw'
    ELSE 'content_detection_default' END AS strategy, count(*) AS useful_rows FROM keys JOIN ref USING (v) GROUP BY ALL"""))(
    lambda spark, sf: reference.useful_rows(v.reference_sheets(spark, sf)).drop("source_path")
)
query("reference_audit_rows", with_(_REF, """
  SELECT file AS source_file, sheet, c // 5 + CASE v WHEN 2 THEN 3 ELSE 2 END AS row_number,
    CASE v WHEN 3 THEN '["' || name || '"]' ELSE '["' || code || '", "' || name || '"]' END AS raw_values,
    CASE WHEN v = 3 THEN '' ELSE code END AS detected_code, name AS detected_name,
    CASE WHEN v = 3 THEN '' ELSE CAST(c AS VARCHAR) END AS normalized_code, upper(name) AS normalized_name FROM ref"""))(
    lambda spark, sf: reference.audit_rows(v.reference_sheets(spark, sf))
)

# ---------------------------------------------------------------- full run

def full_inputs(spark, sf):
    """All sources from their text forms, which are landed once: sheets are read several times to learn their columns."""
    landed = lambda view: stored(view(spark, sf), f"landed-{view.__name__}")
    erp = sheets.standardise_erp(landed(v.erp_sheets))
    rci = feed.parse_feed(landed(v.feed_lines))
    pdf = stmt.parse_statement(landed(v.statement_lines))
    return erp, rci, pdf, reference.load_coverage(landed(v.reference_sheets))


# ERP rows as the sheets carry them (no second copies, spoiled numbers dropped, coverage by code, or by
# a name without prefix), bank dates as the feed shows them
_FULL = BASE + """,
feed AS (SELECT *, sg * (cents + CASE WHEN k % 11 = 0 THEN 500 WHEN k % 11 = 1 THEN 50 ELSE 0 END) AS amt,
    CASE WHEN k % 43 <> 0 THEN d + CAST(CASE WHEN k % 13 = 0 THEN 1 ELSE 0 END AS INTEGER) END AS fd FROM base WHERE k % 10 <> 3),
rci AS (SELECT k, inv, kind, amt, CASE WHEN fd IS NOT NULL THEN fd WHEN k % 37 <> 0 AND abs(amt) % 10 = 2
      THEN try_cast('2000-' || substr(lpad(CAST(abs(amt) AS VARCHAR), 13, '0'), 11, 2) || '-' || substr(lpad(CAST(abs(amt) AS VARCHAR), 13, '0'), 9, 2) AS DATE) END AS dt,
    c, 'rci_' || (k % 2) || '.txt' AS file FROM feed),
pdf AS (SELECT k, inv, kind, sg * (cents + CASE WHEN k % 19 = 0 THEN 300 ELSE 0 END) AS amt, d AS dt,
    CASE WHEN k % 29 <> 0 THEN d + 75 END AS due, k % 5 + 1 AS page, c FROM base WHERE k % 10 IN (0, 1, 2) OR k % 20 = 3),
erp AS (SELECT k AS row_no, k, inv, kind, sg * cents AS amt, CASE WHEN k % 41 <> 0 THEN d END AS dt,
    CASE WHEN k % 4 < 3 THEN '000' || c END AS c, upper(CASE WHEN c % 4 = 0 THEN 'Société ' ELSE '' END || replace(name, '#', ' ')) AS name,
    ['export_a.xlsx','export_a.xlsx','export_b.xlsx','export_c.csv'][k % 4 + 1] AS file, ['TITRES','LIBRE','Feuil1','CSV'][k % 4 + 1] AS sheet,
    (k % 4 < 3 AND c % 5 IN (1, 2, 4)) OR (c % 4 <> 0 AND c % 5 <> 0) AS covered
  FROM base WHERE k % 23 <> 5 AND NOT (k % 4 = 3 AND k % 9 = 0))
"""


def full(spark, sf):
    erp, rci, pdf, listed = full_inputs(spark, sf)
    return run(erp, rci, pdf, listed, RunConfig(run_id="20260515_213000", date_from=v.PERIOD[0], date_to=v.PERIOD[1]))


query("full_run", with_(recon(sources=_FULL), """
  SELECT * EXCLUDE (included_in_corrective_batch), status = 'MANQUANTE_RCI' AND severity IN ('CRITIQUE', 'ELEVEE') AS included_in_corrective_batch FROM recon"""))(
    lambda spark, sf: full(spark, sf).rows
)


# what the run writes, read back: rows of each table, and the title line of the batch file
@query("run_outputs", with_(recon(sources=_FULL), """
  , flagged AS (SELECT *, status = 'MANQUANTE_RCI' AND severity IN ('CRITIQUE', 'ELEVEE') AS batched FROM recon)
  SELECT 'reconciliation' AS output, count(*) AS n FROM recon
  UNION ALL SELECT 'action_plan', count(*) FROM recon WHERE severity NOT IN ('OK', 'INFORMATION')
  UNION ALL SELECT 'out_of_period', count(*) FROM recon WHERE status = 'RCI_HORS_PERIODE'
  UNION ALL SELECT 'audit_missing', count(*) FROM recon WHERE status = 'MANQUANTE_RCI'
  UNION ALL SELECT 'audit_out_of_scope', count(*) FROM recon WHERE status = 'HORS_SCOPE_RCI'
  UNION ALL SELECT 'batch_control', count(*) FROM flagged WHERE batched
  UNION ALL SELECT 'batch: invoice_number;erp_date;customer_name;amount_erp;montant_impacte;severity', count(*) FROM flagged WHERE batched
  UNION ALL SELECT 'history', count(*) FROM recon"""))
def _(spark, sf):
    from lettrage.sources import history as hist

    folder = scratch(spark)
    done = full(spark, sf).stored(folder)
    done.write(folder)
    csv = lambda name: spark.read.options(sep=";", header=True).csv(f"{folder}/{name}/run_id=20260515_213000")
    lines = spark.read.options(header=True, sep="\x01", quote="").csv(f"{folder}/batch/run_id=20260515_213000")
    count = lambda frame, name: frame.groupBy().agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("n"))
    names = ["reconciliation", "action_plan", "out_of_period", "audit_missing", "audit_out_of_scope", "batch_control"]
    parts = [count(csv(n), n) for n in names] + [count(lines, f"batch: {lines.columns[0]}"), count(hist.read_history(spark, f"{folder}/history"), "history")]
    for part in parts[1:]:
        parts[0] = parts[0].unionByName(part)
    return parts[0]
