"""Positions of regular-expression matches as array columns, in code points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettrage.llm.shared import prefix_sums

EMPTY = "array<struct<start:bigint,end:bigint,match:string,before:string,after:string>>"


def find_spans(frame: DataFrame, text: str, finders: dict[str, tuple[str, str]], context: int = 0) -> DataFrame:
    """The frame with one array column per finder, name -> (test, pattern): the leftmost non-overlapping matches as
    (start, end, match, before, after), ``end`` exclusive, with up to ``context`` characters on both sides. A text that
    doesn't match ``test``, a cheap pattern that every text with a match also matches, gets an empty array at once.

    The text is cut at the matches; running sums over the lengths of gaps and matches give the positions.
    """
    columns = frame.columns

    def cut(name: str, test: str, pattern: str) -> list[Column]:
        hit = F.col(text).rlike(test)
        return [
            F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias(f"{name}_matches"),
            F.when(hit, F.split(text, pattern, -1)).alias(f"{name}_gaps"),
        ]

    cuts = frame.select("*", *[c for name, (test, pattern) in finders.items() for c in cut(name, test, pattern)])
    summed = cuts.select("*", *[
        prefix_sums(F.zip_with(
            F.slice(F.col(f"{n}_gaps"), F.lit(1), F.size(f"{n}_matches")), F.col(f"{n}_matches"), lambda g, m: F.length(g) + F.length(m)
        )).alias(f"{n}_ends") for n in finders
    ])

    def spans(name: str) -> Column:
        gaps, ends = F.col(f"{name}_gaps"), F.col(f"{name}_ends")

        def span(match: Column, i: Column) -> Column:
            near = lambda side: F.lit("") if not context else side
            return F.struct(
                (ends[i] - F.length(match)).alias("start"), ends[i].alias("end"), match.alias("match"),
                near(F.right(gaps[i], F.lit(context))).alias("before"), near(F.left(gaps[i + 1], F.lit(context))).alias("after"),
            )

        return F.coalesce(F.transform(f"{name}_matches", span), F.array().cast(EMPTY)).alias(name)

    return summed.select(*columns, *[spans(n) for n in finders])


def joined(spans: Column) -> Column:
    """``kind:start:end`` of an array of (start, rank, end, kind), by start, then rank, then end."""
    return F.array_join(F.transform(
        F.sort_array(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ), ",")


def ranked(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
    ))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")
