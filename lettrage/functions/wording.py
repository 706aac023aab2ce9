"""Priority, severity, category and explanation of a reconciled invoice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as fx
from .scalars import _c, no_spaces


def _table(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def lookup(key, values: dict[str, str], otherwise: str | None = None) -> Column:
    """Value of a key in a small fixed mapping.

    A map lookup names the key once, where a CASE would repeat the expression behind it per branch
    as soon as a filter is pushed below the projection.
    """
    found = F.try_element_at(_table(values), _c(key))
    return F.coalesce(found, F.lit(otherwise)) if otherwise is not None else found


def rank(key, order: list[str]) -> Column:
    """Position of the key in a fixed order, 99 when it is not listed."""
    return F.coalesce(F.try_element_at(_table({name: i for i, name in enumerate(order)}), _c(key)), F.lit(99))


def priority(status) -> Column:
    return lookup(status, fx.PRIORITY)


def action(status) -> Column:
    return lookup(status, fx.ACTION, fx.ACTION_OTHERWISE)


def severity(status, impact) -> Column:
    """Severity of a status; missing documents are graded by the size of the impact."""
    size = F.abs(_c(impact))
    graded = F.when(size >= fx.CRITICAL_FROM, "CRITIQUE").when(size >= fx.HIGH_FROM, "ELEVEE").otherwise("MOYENNE")
    grades = F.create_map(
        F.lit(fx.OK), F.lit("OK"), F.lit(fx.MISSING), graded, F.lit(fx.OUT_OF_PERIOD), F.lit("INFORMATION"),
        F.lit(fx.AMOUNT_GAP), F.lit("ELEVEE"), F.lit(fx.DUPLICATE), F.lit("ELEVEE"),
        F.lit(fx.DATE_GAP), F.lit("MOYENNE"), F.lit(fx.BANK_ONLY), F.lit("MOYENNE"),
    )
    return F.coalesce(F.try_element_at(grades, F.upper(F.trim(_c(status)))), F.lit("A_VERIFIER"))


def known_severity() -> Column:
    """The row's severity, worked out again where it is empty."""
    return F.coalesce("severity", severity("status", "montant_impacte"))


def missing_category(kind, invoice) -> Column:
    kind, number = F.upper(F.trim(_c(kind))), F.upper(no_spaces(invoice))
    return (
        F.when(kind == fx.FACTURE, fx.MISSING_INVOICE)
        .when(kind == fx.AVOIR, fx.MISSING_CREDIT)
        .when(number.rlike("^F?VF"), fx.MISSING_INVOICE)
        .when(number.rlike("^AAF"), fx.MISSING_CREDIT)
        .otherwise(fx.MISSING_UNKNOWN)
    )


def batch_candidate() -> Column:
    """A missing document urgent enough for the corrective batch."""
    return (F.col("status") == fx.MISSING) & known_severity().isin("CRITIQUE", "ELEVEE")


def _shown(name: str) -> Column:
    # amounts print without trailing zeros beyond the first decimal, absent ones as None
    text = F.regexp_replace(F.col(name).cast("decimal(18,2)").cast("string"), r"(\.[0-9])0$", "$1")
    return F.coalesce(text, F.lit("None"))


def explanation() -> Column:
    """Sentence that gives the reason of a status."""
    status, gap, impact = F.col("status"), _shown("amount_gap"), _shown("montant_impacte")
    act = F.col("action_recommandee")
    said = lambda text, *parts: F.format_string(text, *parts)
    return (
        F.when(
            status == fx.OK,
            said(
                "presente ERP et RCI/PDF, montant ERP=%s, montant RCI=%s, montant PDF=%s, ecart=%s; "
                "dans la tolerance.",
                _shown("amount_erp"), _shown("amount_rci"), _shown("amount_pdf"), gap,
            ),
        )
        .when(status == fx.MISSING,
              said("presente ERP mais absente RCI/PDF; montant impacte=%s. Action: %s", impact, act))
        .when(status == fx.BANK_ONLY,
              said("presente RCI/PDF mais absente ERP; montant impacte=%s. Action: %s", impact, act))
        .when(status == fx.AMOUNT_GAP,
              said("ecart montant hors tolerance; ecart=%s, montant impacte=%s. Action: %s", gap, impact, act))
        .when(status == fx.DATE_GAP,
              said("date incoherente ou manquante; montant impacte=%s. Action: %s", impact, act))
        .when(status == fx.DUPLICATE,
              said("doublon conflictuel detecte; montant impacte=%s. Action: %s", impact, act))
        .when(status == fx.OUT_OF_SCOPE,
              said("facture ERP hors perimetre RCI; pas d'ecart impacte. Action: %s", act))
        .otherwise(said("statut %s; Action: %s", status, act))
    )
