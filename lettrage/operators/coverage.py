"""Coverage of customers by the reference list.

The list is a table ``(kind, value)`` of distinct normalised codes and names. No side is forced to
be broadcast: the adaptive planner measures the list and broadcasts it only under its threshold,
else it joins by shuffle and splits the partition of a customer that holds many rows. The left joins
cannot multiply rows because the values are distinct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s


def coverage_values(rows: DataFrame, codes: list[str], names: list[str]) -> DataFrame:
    """Distinct ``(kind, value)`` of the code and name columns of a coverage list."""
    entries = F.array(
        *[F.struct(F.lit("code").alias("kind"), s.reference_code(c).alias("value")) for c in codes],
        *[F.struct(F.lit("name").alias("kind"), s.folded_name(c).alias("value")) for c in names],
    )
    return rows.select(F.inline(entries)).filter(F.col("value") != "").distinct()


def flag_coverage(erp: DataFrame, coverage: DataFrame | None, enabled: bool = True) -> DataFrame:
    """ERP rows with ``is_rci_covered``: by code first, else by folded name.

    Without a list, with the check disabled or with an empty list every row is covered; the row
    count of the list is a scalar subquery of the same plan.
    """
    if coverage is None or not enabled:
        return erp.withColumn("is_rci_covered", F.lit(True))
    key = lambda kind: coverage.filter(F.col("kind") == kind).select(
        F.col("value").alias(f"_{kind}"), F.lit(True).alias(f"_{kind}_hit")
    )
    blank = lambda c: F.nullif(c, F.lit(""))
    empty = coverage.agg(F.count(F.lit(1))).scalar() == 0
    flagged = (
        erp.withColumn("_c", blank(s.reference_code("customer_code")))
        .withColumn("_n", blank(s.folded_name("customer_name")))
        .join(key("code"), F.col("_c") == F.col("_code"), "left")
        .join(key("name"), F.col("_n") == F.col("_name"), "left")
    )
    return flagged.withColumn(
        "is_rci_covered", F.coalesce("_code_hit", "_name_hit", empty)
    ).drop("_c", "_n", "_code", "_code_hit", "_name", "_name_hit")
