"""Oracle SQL blocks: the derived sources and the reconciliation stated again for DuckDB."""

FROM, TO = "DATE '1996-01-01'", "DATE '2000-12-31'"

BASE = """
base AS (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE 1 END AS sg,
         (CASE WHEN o_orderkey % 7 = 0 THEN 'AAF' ELSE 'VF' END) || CAST(o_orderkey + 100000 AS VARCHAR) AS inv,
         CASE WHEN o_orderkey % 7 = 0 THEN 'AVOIR' ELSE 'FACTURE' END AS kind, c_name AS name
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey)
"""

ERP = BASE + """,
erp AS (
  SELECT k AS row_no, k, inv, kind, sg * cents AS amt, CASE WHEN k % 41 <> 0 THEN d END AS dt, c, name,
         'erp_' || (k % 3) || '.csv' AS file, 'S' || (k % 2) AS sheet, c % 5 <> 0 AS covered
  FROM base WHERE k % 23 <> 5
  UNION ALL
  SELECT k + 10000000, k, inv, kind, sg * (cents + CASE WHEN k % 34 = 0 THEN 0 ELSE 1000 END),
         CASE WHEN k % 41 <> 0 THEN d END, c, name, 'erp_' || (k % 3) || '.csv', 'S' || (k % 2), c % 5 <> 0
  FROM base WHERE k % 23 <> 5 AND k % 17 = 0)
"""

SOURCES = ERP + """,
rci AS (
  SELECT k, inv, kind, sg * (cents + CASE WHEN k % 11 = 0 THEN 500 WHEN k % 11 = 1 THEN 50 ELSE 0 END) AS amt,
         CASE WHEN k % 43 <> 0 THEN d + CAST(CASE WHEN k % 13 = 0 THEN 1 ELSE 0 END AS INTEGER) END AS dt,
         c, 'rci_' || (k % 2) || '.txt' AS file
  FROM base WHERE k % 10 <> 3),
pdf AS (
  SELECT k, inv, kind, sg * (cents + CASE WHEN k % 19 = 0 THEN 300 ELSE 0 END) AS amt, d AS dt,
         CASE WHEN k % 29 <> 0 THEN d + 75 END AS due, k % 5 + 1 AS page, c
  FROM base WHERE k % 10 IN (0, 1, 2) OR k % 20 = 3)
"""


def recon(period: bool = True, sources: str = SOURCES) -> str:
    """Sources and the classified rows as ``recon``."""
    inside = f"dt BETWEEN {FROM} AND {TO}" if period else "TRUE"
    late = f"COALESCE(dt NOT BETWEEN {FROM} AND {TO}, FALSE)" if period else "FALSE"
    return sources + f""",
ea AS (
  SELECT inv, arg_min(kind, row_no) AS kind, arg_min(amt, row_no) AS amt, arg_min(dt, row_no) AS dt,
         arg_min(c, row_no) AS c, arg_min(name, row_no) AS name, bool_or(covered) AS covered,
         min(file || ':' || sheet) AS label, count(*) AS n,
         count(*) > 1 AND (count(DISTINCT amt) > 1 OR count(DISTINCT dt) > 1) AS conflict
  FROM erp WHERE {inside} GROUP BY inv),
bank AS (
  SELECT COALESCE(r.inv, p.inv) AS inv, COALESCE(r.kind, p.kind) AS kind, r.amt AS ramt, p.amt AS pamt,
         r.dt AS rdt, p.dt AS pdt, p.due, r.file AS rfile, p.page, r.inv IS NOT NULL AS in_r,
         p.inv IS NOT NULL AS in_p, COALESCE(r.late, p.late) AS late
  FROM (SELECT *, {late} AS late FROM rci) r
  FULL OUTER JOIN (SELECT *, {late} AS late FROM pdf) p ON r.inv = p.inv AND r.late = p.late),
joined AS (
  SELECT COALESCE(e.inv, b.inv) AS inv, COALESCE(e.kind, b.kind) AS kind, e.c, e.name, e.covered, e.amt,
         b.ramt, b.pamt, e.amt - COALESCE(b.pamt, b.ramt) AS gap, e.dt, b.rdt, b.pdt, b.due, b.in_r, b.in_p,
         e.label, b.rfile, b.page, e.inv IS NOT NULL AS in_e, b.inv IS NOT NULL AS in_b, e.conflict, FALSE AS late
  FROM ea e FULL OUTER JOIN (SELECT * FROM bank WHERE NOT late) b ON e.inv = b.inv
  UNION ALL
  SELECT inv, kind, NULL, NULL, NULL, NULL, ramt, pamt, NULL, NULL, rdt, pdt, due, in_r, in_p, NULL, rfile, page,
         FALSE, TRUE, FALSE, TRUE
  FROM bank WHERE late),
classed AS (
  SELECT *, CASE
    WHEN late THEN 'RCI_HORS_PERIODE'
    WHEN in_e AND NOT in_b THEN CASE WHEN covered THEN 'MANQUANTE_RCI' ELSE 'HORS_SCOPE_RCI' END
    WHEN NOT in_e THEN 'RCI_SEULEMENT'
    WHEN conflict THEN 'DOUBLON'
    WHEN gap IS NULL OR abs(gap) > 100 THEN 'ANOMALIE_MONTANT'
    WHEN dt IS NULL OR COALESCE(pdt, rdt) IS NULL OR dt <> COALESCE(pdt, rdt) OR (in_p AND due IS NULL)
      THEN 'ANOMALIE_DATE'
    ELSE 'OK' END AS status
  FROM joined),
measured AS (
  SELECT *, COALESCE(CASE
    WHEN status IN ('MANQUANTE_RCI', 'ANOMALIE_DATE') THEN abs(amt)
    WHEN status = 'RCI_SEULEMENT' THEN abs(COALESCE(pamt, ramt))
    WHEN status = 'DOUBLON' THEN abs(COALESCE(amt, pamt, ramt))
    WHEN status = 'ANOMALIE_MONTANT' THEN abs(gap) END, 0) AS impact
  FROM classed),
recon AS (
  SELECT inv AS invoice_number, kind AS document_type, CAST(c AS VARCHAR) AS customer_code, name AS customer_name,
    covered AS is_rci_covered, amt / 100.0 AS amount_erp, ramt / 100.0 AS amount_rci, pamt / 100.0 AS amount_pdf,
    gap / 100.0 AS amount_gap, impact / 100.0 AS montant_impacte, dt AS erp_date, rdt AS rci_date,
    pdt AS pdf_invoice_date, due AS due_date, CASE WHEN in_p THEN 'ENTREE BATCH' END AS origin, status,
    CASE WHEN status IN ('OK', 'RCI_HORS_PERIODE', 'HORS_SCOPE_RCI') THEN 'BASSE'
         WHEN status IN ('ANOMALIE_DATE', 'RCI_SEULEMENT') THEN 'MOYENNE' ELSE 'HAUTE' END AS priority,
    CASE status WHEN 'OK' THEN 'OK'
      WHEN 'MANQUANTE_RCI' THEN CASE WHEN impact >= 10000000 THEN 'CRITIQUE' WHEN impact >= 2000000 THEN 'ELEVEE' ELSE 'MOYENNE' END
      WHEN 'RCI_HORS_PERIODE' THEN 'INFORMATION' WHEN 'ANOMALIE_MONTANT' THEN 'ELEVEE' WHEN 'DOUBLON' THEN 'ELEVEE'
      WHEN 'ANOMALIE_DATE' THEN 'MOYENNE' WHEN 'RCI_SEULEMENT' THEN 'MOYENNE' ELSE 'A_VERIFIER' END AS severity,
    FALSE AS included_in_corrective_batch,
    CASE status WHEN 'OK' THEN 'Aucune action requise.'
      WHEN 'MANQUANTE_RCI' THEN 'Vérifier la transmission vers RCI et préparer un renvoi si nécessaire.'
      WHEN 'HORS_SCOPE_RCI' THEN 'Vérifier si le concessionnaire doit être ajouté au référentiel RCI.'
      WHEN 'RCI_HORS_PERIODE' THEN 'Contrôler la période du fichier RCI/PDF chargé.'
      WHEN 'ANOMALIE_MONTANT' THEN 'Comparer le montant ERP avec le montant RCI.'
      WHEN 'ANOMALIE_DATE' THEN 'Comparer la date ERP avec la date RCI/PDF.'
      WHEN 'DOUBLON' THEN 'Vérifier les doublons dans les fichiers source.'
      WHEN 'RCI_SEULEMENT' THEN 'Vérifier origine côté RCI ou historique ERP.' END AS action_recommandee,
    label AS source_erp, CASE WHEN in_r THEN rfile END AS source_rci,
    CASE WHEN in_p THEN 'releve.pdf:p' || page END AS source_pdf,
    CASE WHEN late THEN 'Flux RCI/PDF hors période de rapprochement' END AS commentaire_audit
  FROM measured)
"""


def with_(block: str, select: str) -> str:
    return f"WITH {block} {select}"


# French number text of absolute cents: thousands dots, decimal comma
def french(cents: str) -> str:
    whole = f"CAST(abs({cents}) // 100 AS VARCHAR)"
    dotted = (
        f"CASE WHEN length({whole}) > 6 THEN left({whole}, -6) || '.' || left(right({whole}, 6), 3) || '.' || right({whole}, 3) "
        f"WHEN length({whole}) > 3 THEN left({whole}, -3) || '.' || right({whole}, 3) ELSE {whole} END"
    )
    return f"(({dotted}) || ',' || lpad(CAST(abs({cents}) % 100 AS VARCHAR), 2, '0'))"


RAW = BASE + f""",
raw AS (
  SELECT *, CASE WHEN k % 7 = 0 THEN inv WHEN k % 3 = 0 THEN 'FVF ' || (k + 100000) WHEN k % 3 = 1 THEN lower(inv) ELSE inv END AS facture,
    CASE WHEN k % 41 = 0 THEN NULL WHEN k % 4 = 0 THEN strftime(d, '%d/%m/%Y') WHEN k % 4 = 1 THEN strftime(d, '%Y-%m-%d')
      WHEN k % 4 = 2 THEN CAST(d - DATE '1899-12-30' AS VARCHAR) ELSE strftime(d, '%d/%m/%y') END AS date_text,
    {french('cents')} || CASE WHEN k % 7 = 0 THEN '-' ELSE '' END AS montant,
    '000' || CAST(c AS VARCHAR) AS code, CASE WHEN c % 4 = 0 THEN 'Société ' ELSE '' END || replace(name, '#', ' ') AS nom
  FROM base WHERE k % 23 <> 5)
"""


def _longest(a: str, b: str) -> str:
    """The longest substring of a that b holds, the first in a among equals, as 1000 * length - start; null if there is none."""
    spans = f"flatten(list_transform(range(1, length({a}) + 1), lambda i: list_transform(range(1, length({a}) - i + 2), lambda n: [i, n])))"
    return f"list_max(list_transform(list_filter({spans}, lambda x: contains({b}, substr({a}, x[1], x[2]))), lambda x: x[2] * 1000 - x[1]))"


# The closest listed name of every out-of-scope customer: all pairs, matching blocks by recursion left and right of the longest one
CLOSEST = f""",
asked AS (SELECT DISTINCT upper(customer_name) AS folded FROM recon WHERE status = 'HORS_SCOPE_RCI'),
listed AS (SELECT DISTINCT upper(c_name) AS name FROM customer WHERE c_custkey % 5 IN (3, 4)),
seg(folded, name, a, b, code) AS (
  SELECT folded, name, folded, name, {_longest('folded', 'name')} FROM asked, listed
  UNION ALL
  SELECT folded, name, a, b, {_longest('a', 'b')} FROM (
    SELECT folded, name, unnest([left(a, i - 1), substr(a, i + n)]) AS a, unnest([left(b, j - 1), substr(b, j + n)]) AS b FROM (
      SELECT *, strpos(b, substr(a, i, n)) AS j FROM (
        SELECT *, (code + 999) // 1000 AS n, (code + 999) // 1000 * 1000 - code AS i FROM seg WHERE code IS NOT NULL)))
  WHERE a <> '' AND b <> ''),
scored AS (SELECT folded, name, 2.0 * sum((code + 999) // 1000) / (length(folded) + length(name)) AS score FROM seg GROUP BY folded, name HAVING score > 0),
closest AS (
  SELECT folded, min(name) AS near, round(any_value(score), 4) AS score
  FROM scored JOIN (SELECT folded, max(score) AS score FROM scored GROUP BY folded) USING (folded, score) GROUP BY folded)
"""
