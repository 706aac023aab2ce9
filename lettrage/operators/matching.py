"""Matching of ERP, bank feed and statement rows on the normalised invoice number.

The three sources share one key, so they are stacked into one tagged table and reduced by one
``groupBy``: a single shuffle in place of two full outer joins. Every aggregate keeps a state of
fixed size (ordered first value by ``min_by``, conflicts by ``min <> max``) and is combined before
the shuffle, so an invoice number that holds a large share of all rows reaches its reducer as a few
rows per map task. The only growing state is the set of distinct file labels, which is the result
itself.

Row order. "First" means first in reading order. A source may bring it as ``row_ord`` (a number, or
the struct the readers attach); rows of one file are contiguous and files come in name order, so
labels are listed by file, then by sheet or page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as fx
from ..functions import scalars as s
from ..functions import wording as w

ERP, RCI, PDF = "erp", "rci", "pdf"

_AMOUNT = {ERP: "amount_erp", RCI: "amount_rci", PDF: "amount_pdf"}
_DATE = {ERP: "erp_date", RCI: "rci_date", PDF: "pdf_invoice_date"}
_PART = {ERP: "source_sheet", PDF: "page"}
_TAGGED = [
    "src", "late", "invoice_number", "row_ord", "kind", "amount", "day", "code", "name", "covered",
    "due", "origin", "label",
]


def prepared(frame: DataFrame, src: str) -> DataFrame:
    """One source in the common tagged shape; rows without a valid invoice number are dropped."""
    types = dict(frame.dtypes)
    text = lambda c: F.col(c).cast("string") if c in types else F.lit(None).cast("string")
    invoice = s.invoice_number(F.col("invoice_number").cast("string"))
    file = s.first_present(*[text(c) for c in ("source_file", "file_name")])
    part, part_column = F.lit(None).cast("string"), _PART.get(src)
    if part_column:
        part = s.blank_to_null(text(part_column))
    shown = F.concat(F.lit(":p"), part) if src == PDF else F.concat(F.lit(":"), part)
    position = F.col("sheet_ord") if "sheet_ord" in types else F.lit(0)
    if src == PDF and part_column in types:
        position = F.col(part_column).try_cast("int")
    kind = s.blank_to_null(text("document_type")) if "document_type" in types else F.lit(None).cast("string")
    value = lambda c: s.money(c, types[c]) if c in types else F.lit(None).cast(s.MONEY)
    day = lambda c: s.day(c, types[c]) if c in types else F.lit(None).cast("date")
    covered = F.lit(None).cast("boolean")
    if src == ERP and "is_rci_covered" in types:
        covered = s.boolean("is_rci_covered")
    late = F.lit(False)
    if src != ERP and "date_filter_status" in types:
        late = F.coalesce(F.col("date_filter_status") == "out_of_period", F.lit(False))
    return frame.select(
        F.lit(src).alias("src"),
        late.alias("late"),
        invoice.alias("invoice_number"),
        (F.col("row_ord") if "row_ord" in types else F.monotonically_increasing_id()).alias("row_ord"),
        kind.alias("kind"),
        value(_AMOUNT[src]).alias("amount"),
        day(_DATE[src]).alias("day"),
        (s.blank_to_null(text("customer_code")) if src == ERP else F.lit(None).cast("string")).alias("code"),
        (s.blank_to_null(text("customer_name")) if src == ERP else F.lit(None).cast("string")).alias("name"),
        covered.alias("covered"),
        (day("due_date") if src == PDF else F.lit(None).cast("date")).alias("due"),
        (s.blank_to_null(text("origin")) if src == PDF else F.lit(None).cast("string")).alias("origin"),
        F.when(
            file.isNotNull(),
            F.struct(
                F.lower(file).alias("file"),
                F.coalesce(position, F.lit(0)).cast("int").alias("position"),
                F.concat(file, F.coalesce(shown, F.lit(""))).alias("label"),
            ),
        ).alias("label"),
    ).filter(F.col("invoice_number").isNotNull())


def stacked(*parts: DataFrame) -> DataFrame:
    """Tagged union; orders of different shape are brought to one struct."""
    types = {dict(p.dtypes)["row_ord"] for p in parts}
    if len(types) > 1:
        parts = [p.withColumn("row_ord", _as_struct(p)) for p in parts]
    union = parts[0].select(_TAGGED)
    for part in parts[1:]:
        union = union.unionByName(part.select(_TAGGED))
    return union


def _as_struct(frame: DataFrame) -> Column:
    order = F.col("row_ord")
    if not dict(frame.dtypes)["row_ord"].startswith("struct"):
        return F.struct(
            F.lit("").alias("file"), F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("block"),
            order.cast("bigint").alias("id"),
        )
    return order


# ---------------------------------------------------------------- aggregates of one source

def _aggregates(src: str, tagged: bool) -> list[Column]:
    of_source = F.col("src") == src
    own = (lambda c: F.when(of_source, F.col(c))) if tagged else F.col
    p = lambda name: f"{src}_{name}"

    def first(name: str) -> Column:
        return F.min_by(F.col(name), F.when(own(name).isNotNull(), F.col("row_ord"))).alias(p(name))

    def ends(name: str, value: Column) -> list[Column]:
        return [F.min(value).alias(p(name + "_lo")), F.max(value).alias(p(name + "_hi"))]

    kept = [
        F.count(own("invoice_number")).alias(p("count")),
        first("kind"), first("amount"), first("day"),
        F.collect_set(own("label")).alias(p("labels")),
        *ends("kind", F.upper(F.trim(own("kind")))),
        *ends("amount", own("amount")),
        *ends("size", F.abs(own("amount"))),
        *ends("day", own("day")),
    ]
    if src == ERP:
        kept += [first("code"), first("name"), F.bool_or(own("covered")).alias(p("covered"))]
    if src == PDF:
        kept += [first("due"), first("origin")]
    return kept


def _finished(src: str) -> list[tuple[str, Column]]:
    """Result columns of one source from its aggregates."""
    g = lambda name: F.col(f"{src}_{name}")
    present = g("count") > 0
    kind = F.when(present, F.coalesce(g("kind"), s.kind_of_number("invoice_number")))
    split = lambda name: F.coalesce(g(name + "_lo") != g(name + "_hi"), F.lit(False))
    amounts_differ = F.when(kind.isin(fx.AVOIR, fx.FACTURE), split("size")).otherwise(split("amount"))
    conflict = (g("count") > 1) & (amounts_differ | split("kind") | split("day"))
    labels = F.array_join(F.array_distinct(F.transform(F.array_sort(g("labels")), lambda x: x["label"])), "; ")
    columns = [
        (f"document_type_{src}", kind),
        (_AMOUNT[src], s.signed(g("amount"), kind)),
        (_DATE[src], g("day")),
        (f"source_{src}", F.when(F.size(g("labels")) > 0, labels)),
        (f"{src}_count", g("count")),
        (f"{src}_duplicate_conflict", conflict),
    ]
    if src == ERP:
        columns[1:1] = [
            ("customer_code", g("code")),
            ("customer_name", g("name")),
            ("is_rci_covered", F.when(present, F.coalesce(g("covered"), F.lit(True)))),
        ]
    if src == PDF:
        columns[3:3] = [("due_date", g("due")), ("origin", g("origin"))]
    return columns


def aggregate_source(frame: DataFrame, src: str) -> DataFrame:
    """One row per invoice of one source: first values, labels, row count and conflict flag."""
    grouped = prepared(frame, src).groupBy("invoice_number").agg(*_aggregates(src, tagged=False))
    return grouped.select("invoice_number", *[c.alias(n) for n, c in _finished(src)])


# ---------------------------------------------------------------- bank side and matching

def _bank_columns() -> list[tuple[str, Column]]:
    kinds_differ = F.coalesce(F.col("document_type_rci") != F.col("document_type_pdf"), F.lit(False))
    return [
        (
            "document_type_consolidated",
            F.coalesce("document_type_pdf", "document_type_rci", s.kind_of_number("invoice_number")),
        ),
        (
            "consolidated_duplicate_conflict",
            F.col("rci_duplicate_conflict") | F.col("pdf_duplicate_conflict") | kinds_differ,
        ),
    ]


def consolidate(rci: DataFrame, pdf: DataFrame) -> DataFrame:
    """Feed and statement side by side, one row per invoice."""
    grouped = (
        stacked(prepared(rci, RCI), prepared(pdf, PDF))
        .groupBy("invoice_number")
        .agg(*_aggregates(RCI, True), *_aggregates(PDF, True))
    )
    sides = grouped.select("invoice_number", *[c.alias(n) for src in (RCI, PDF) for n, c in _finished(src)])
    return sides.withColumns(dict(_bank_columns())).select(
        "invoice_number", "document_type_consolidated", "amount_rci", "amount_pdf", "rci_date",
        "pdf_invoice_date", "due_date", "origin", "source_rci", "source_pdf", "rci_count", "pdf_count",
        "rci_duplicate_conflict", "pdf_duplicate_conflict", "consolidated_duplicate_conflict",
    )


def _facts() -> Column:
    """What the decision needs, by name."""
    same_day = F.col("erp_date") == F.coalesce("pdf_invoice_date", "rci_date")
    return F.struct(
        "late", "amount_erp", "amount_rci", "amount_pdf", "is_rci_covered",
        (F.col("erp_count") > 0).alias("in_erp"),
        ((F.col("rci_count") > 0) | (F.col("pdf_count") > 0)).alias("in_bank"),
        (F.col("erp_duplicate_conflict") | F.col("consolidated_duplicate_conflict")).alias("conflict"),
        F.coalesce(same_day, F.lit(False)).alias("same_day"),
        ((F.col("pdf_count") > 0) & F.col("due_date").isNull()).alias("undue"),
        F.when(
            ~F.col("late"), (F.col("amount_erp") - F.coalesce("amount_pdf", "amount_rci")).cast(s.MONEY)
        ).alias("gap"),
    )


def _status(x: Column, tolerance) -> Column:
    limit = F.lit(str(tolerance)).cast("decimal(18,6)")
    return (
        F.when(x["late"], fx.OUT_OF_PERIOD)
        .when(x["in_erp"] & ~x["in_bank"] & ~x["is_rci_covered"], fx.OUT_OF_SCOPE)
        .when(x["in_erp"] & ~x["in_bank"], fx.MISSING)
        .when(~x["in_erp"], fx.BANK_ONLY)
        .when(x["conflict"], fx.DUPLICATE)
        .when(F.coalesce(F.abs(x["gap"]) > limit, F.lit(True)), fx.AMOUNT_GAP)
        .when(x["undue"] | ~x["same_day"], fx.DATE_GAP)
        .otherwise(fx.OK)
    )


def _impact(x: Column, status: Column) -> Column:
    size = lambda *names: F.coalesce(F.abs(F.coalesce(*[x[n] for n in names])), F.lit(0)).cast(s.MONEY)
    return (
        F.when(status.isin(fx.MISSING, fx.DATE_GAP), size("amount_erp"))
        .when(status == fx.BANK_ONLY, size("amount_pdf", "amount_rci"))
        .when(status == fx.DUPLICATE, size("amount_erp", "amount_pdf", "amount_rci"))
        .when(status == fx.AMOUNT_GAP, size("gap"))
        .otherwise(F.lit(0))
        .cast(s.MONEY)
    )


def _decision(tolerance) -> Column:
    """Gap, status, impact and severity as one struct.

    Each value is bound before the next one names it. Written as a chain of columns, a filter on the
    severity would be pushed below the chain with every mention of the status and the impact spelt
    out again.
    """
    graded = lambda y: F.struct(
        y["gap"].alias("amount_gap"), y["status"].alias("status"), y["impact"].alias("montant_impacte"),
        w.severity(y["status"], y["impact"]).alias("severity"),
    )
    weighed = lambda x, status: s.let(
        F.struct(x["gap"].alias("gap"), status.alias("status"), _impact(x, status).alias("impact")), graded
    )
    return s.let(_facts(), lambda x: s.let(_status(x, tolerance), lambda status: weighed(x, status)))


def matched(
    erp: DataFrame,
    rci: DataFrame,
    pdf: DataFrame,
    tolerance=fx.DEFAULT_TOLERANCE,
    rci_out_of_period: DataFrame | None = None,
    pdf_out_of_period: DataFrame | None = None,
) -> DataFrame:
    """All working columns of the match, one row per invoice and period side.

    Bank rows outside the period are those with ``date_filter_status = 'out_of_period'`` in the
    bank frames, or the rows of the two optional frames. They form rows of their own.
    """
    parts = [prepared(erp, ERP), prepared(rci, RCI), prepared(pdf, PDF)]
    for frame, src in ((rci_out_of_period, RCI), (pdf_out_of_period, PDF)):
        if frame is not None:
            parts.append(prepared(frame, src).withColumn("late", F.lit(True)))
    grouped = stacked(*parts).groupBy("invoice_number", "late").agg(
        *_aggregates(ERP, True), *_aggregates(RCI, True), *_aggregates(PDF, True)
    )
    sides = grouped.select(
        "invoice_number", "late", *[c.alias(n) for src in (ERP, RCI, PDF) for n, c in _finished(src)]
    ).withColumns(dict(_bank_columns()))
    return sides.select("*", _decision(tolerance).alias("decision")).select(
        *sides.columns, "decision.amount_gap", "decision.status", "decision.montant_impacte", "decision.severity"
    )


def reconcile(
    erp: DataFrame,
    rci: DataFrame,
    pdf: DataFrame,
    tolerance=fx.DEFAULT_TOLERANCE,
    rci_out_of_period: DataFrame | None = None,
    pdf_out_of_period: DataFrame | None = None,
) -> DataFrame:
    """The reconciliation table: one classified row per invoice, 24 columns, in no given order."""
    rows = matched(erp, rci, pdf, tolerance, rci_out_of_period, pdf_out_of_period)
    return rows.withColumns(
        {
            "document_type": F.coalesce(
                "document_type_erp", "document_type_consolidated", s.kind_of_number("invoice_number")
            ),
            "priority": w.priority("status"),
            "included_in_corrective_batch": F.lit(False),
            "action_recommandee": w.action("status"),
            "commentaire_audit": F.when(F.col("late"), fx.COMMENT_OUT_OF_PERIOD),
        }
    ).select(fx.RECONCILIATION_COLUMNS)


def in_report_order(rows: DataFrame) -> DataFrame:
    """Rows by status, then invoice number."""
    return rows.orderBy("status", "invoice_number")


def missing_source_rows(spark, missing_required: dict[str, int]) -> DataFrame:
    """One blocking anomaly per source type that lacks required files."""
    rows = [
        ("blocking", kind, None, None, f"{n} fichier(s) requis manquant(s) dans la source {kind}.")
        for kind, n in missing_required.items()
    ]
    return spark.createDataFrame(
        rows, "severity string, source_type string, invoice_number string, status string, message string"
    )


def anomaly_rows(rows: DataFrame, missing_required: dict[str, int] | None = None) -> DataFrame:
    """Rows that need attention, after the blocking ones for missing sources."""
    found = rows.filter(~F.col("status").isin(fx.NOT_ANOMALIES)).select(
        w.known_severity().alias("severity"),
        F.lit("reconciliation").alias("source_type"),
        "invoice_number",
        "status",
        F.concat_ws(" - ", "status", "action_recommandee").alias("message"),
    )
    if missing_required:
        found = missing_source_rows(rows.sparkSession, missing_required).unionByName(found)
    return found
