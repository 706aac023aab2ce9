"""Personal data: candidate spans from loose generators, judged by boosted trees, beside strictly validated base spans.

Generators propose overlapping spans with high recall. Every candidate has format features (digits, separators, length)
and context features (what stands before and after), all in a few bins. One aggregate over the whole corpus counts
the candidates of each combination of bins, and how many of them lie on a validated base span; that table, whose size is
bounded by the bins, is what the boosted trees are fitted on, and documents of the held-out fold calibrate the score that
reaches the wanted precision per kind. The trees are scored as one SQL expression per candidate. Candidates beyond the
base spans with a score at or above the threshold become additional spans; base spans always stay.

Defined cases: null text is empty; a document without matches has empty lists; repeated rows are repeated results; with no
candidates at all, or none whose held-out precision reaches the target, nothing is added; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettrage.llm.shared import stored
from lettrage.llm.spans import digits_of, find_spans, ranked

# Kinds in their order and patterns. Possessive quantifiers and the tests before a match give the same
# matches as the plain patterns, without backtracking over long runs.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": ("@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9][\x20-]?[0-9]", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
GENERATORS = {
    "at": ("@|(?i:[\\[(]at[\\])])", r"[\p{L}\p{N}._%+-]{1,64}(?:@|\x20?[\[(](?i:at)[\])]\x20?)[\p{L}\p{N}.-]{1,255}"),
    "number": (r"[0-9].{0,2}[0-9]", r"\+?[(]?[0-9](?:[\x20().:/-]{0,2}[0-9]){6,30}+"),
    "quad": (r"[0-9][.,:-][0-9]", r"[0-9]{1,3}(?:[.,:-][0-9]{1,3}){3}"),
}
CONTEXT = 24
PRECISION = 0.95
ROUNDS, RATE, LEAF = 24, 0.4, 5.0
HELD_OUT = 5
FEATURES = ("generator", "digits", "groups", "plus", "separator", "length", "left", "right")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right: every second digit from the right is doubled."""
    n = F.length(digits)

    def worth(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when((n - i) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda total, i: total + worth(i)) % 10 == 0


def valid(kind: str, spans: Column) -> Column:
    def size(s: Column) -> Column:
        return F.length(digits_of(s["match"]))

    if kind == "ip":
        part = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(0)) <= 255)
        return F.filter(spans, lambda s: F.forall(F.split(s["match"], r"\."), part))
    if kind == "card":
        sized = F.filter(spans, lambda s: (F.length(s["match"]) <= 37) & size(s).between(12, 19))
        return F.filter(sized, lambda s: luhn(digits_of(s["match"])))
    if kind == "phone":
        return F.filter(spans, lambda s: size(s).between(9, 15))
    return spans


def candidate_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, base, candidates``: validated spans as (start, rank, end, kind), and what the generators propose with its
    features. A candidate lies ``on`` the base if it meets a base span."""
    found = find_spans(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", {**BASE, **GENERATORS}, CONTEXT)
    base = found.select("doc_id", *[ranked(valid(k, F.col(k)), i, k).alias(k) for i, k in enumerate(KINDS)], *GENERATORS)

    def features(number: int, s: Column) -> Column:
        match, digits = s["match"], F.length(digits_of(s["match"]))
        seps = F.array_distinct(F.split(F.regexp_replace(match, r"[\p{L}\p{N}@+%_]", ""), ""))
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(number).alias("generator"),
            F.when(digits < 7, 0).when(digits < 9, 1).when(digits < 12, 2).when(digits < 16, 3).when(digits == 16, 4).when(digits < 20, 5).otherwise(6).alias("digits"),
            F.least(F.size(F.split(match, r"[^\p{L}\p{N}]+")), F.lit(6)).alias("groups"),
            match.startswith("+").cast("int").alias("plus"),
            F.when(F.size(seps) > 1, 5).when(match.contains("-"), 1).when(match.contains("."), 2).when(match.contains(" "), 3)
            .when(match.contains(":"), 4).otherwise(0).alias("separator"),
            F.least(F.floor(F.length(match) / 6).cast("int"), F.lit(6)).alias("length"),
            F.when(s["before"] == "", 0).when(s["before"].rlike(r"(?i)(tel|phone|call|mail|card|contact|ip|addr)[^\n]{0,12}$"), 1)
            .when(s["before"].rlike(r"[=:\"']\x20*$"), 2).when(s["before"].rlike(r"[\p{L}.,]\x20$"), 3).when(s["before"].rlike(r"[\p{N}.-]$"), 4)
            .otherwise(5).alias("left"),
            F.when(s["after"] == "", 0).when(s["after"].rlike(r"^\x20\p{L}"), 1).when(s["after"].rlike(r"^[.,;]?(\x20|$)"), 2)
            .when(s["after"].rlike(r"^[\p{N}-]"), 3).otherwise(4).alias("right"),
        )

    proposed = base.select(
        "doc_id", F.concat(*KINDS).alias("base"),
        F.concat(*[F.transform(g, partial(features, n)) for n, g in enumerate(GENERATORS)]).alias("proposed"),
    )
    meets = lambda c: F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    return proposed.select(
        "doc_id", "base", F.transform("proposed", lambda c: F.struct(
            c["start"].alias("start"), c["end"].alias("end"), *[c[f].alias(f) for f in FEATURES], meets(c).alias("on")
        )).alias("candidates"),
    )


@dataclass
class Trees:
    """Boosted trees of two levels over binned features, with the threshold of each generator."""

    prior: float
    trees: list
    thresholds: dict

    def margin(self, x: tuple) -> float:
        total = self.prior
        for (f, cut), sides in self.trees:
            (g, deep), leaves = sides[x[f] > cut]
            total += leaves[x[g] > deep]
        return total

    def expression(self, c: Column) -> Column:
        """The margin of a candidate as SQL, or the lowest double where its generator has no threshold."""
        total = F.lit(self.prior)
        for (f, cut), sides in self.trees:
            arms = [F.when(c[FEATURES[g]] > deep, leaves[1]).otherwise(leaves[0]) for (g, deep), leaves in sides]
            total = total + F.when(c[FEATURES[f]] > cut, arms[1]).otherwise(arms[0])
        return total

    def accepted(self, c: Column) -> Column:
        yes = F.lit(False)
        for generator, least in self.thresholds.items():
            yes = yes | ((c["generator"] == generator) & (self.expression(c) >= least))
        return yes


def best_split(rows: list, gradients: list, hessians: list) -> tuple:
    """The (feature, cut) with the largest gain, and the two leaf values."""
    whole_g, whole_h = sum(gradients), sum(hessians)
    best = (-1.0, (0, 10**6), (-whole_g / (whole_h + LEAF),) * 2)
    for f in range(len(FEATURES)):
        bins: dict[int, list[float]] = {}
        for x, g, h in zip(rows, gradients, hessians):
            bin_ = bins.setdefault(x[f], [0.0, 0.0])
            bin_[0] += g
            bin_[1] += h
        left_g = left_h = 0.0
        for cut in sorted(bins)[:-1]:
            left_g, left_h = left_g + bins[cut][0], left_h + bins[cut][1]
            right_g, right_h = whole_g - left_g, whole_h - left_h
            gain = left_g**2 / (left_h + LEAF) + right_g**2 / (right_h + LEAF)
            if gain > best[0] + 1e-12:
                best = (gain, (f, cut), (-left_g / (left_h + LEAF), -right_g / (right_h + LEAF)))
    return best


def boost(table: list[tuple[tuple, float, float]]) -> tuple[float, list]:
    """Trees for rows of (features, positives, candidates), by Newton steps on the logistic loss."""
    rows = [x for x, _, _ in table]
    ones, all_ = sum(p for _, p, _ in table), sum(n for _, _, n in table)
    prior = math.log((ones + 1) / (all_ - ones + 1))
    margins, trees = [prior] * len(rows), []
    for _ in range(ROUNDS):
        chance = [1 / (1 + math.exp(-m)) for m in margins]
        g = [n * p - y for (_, y, n), p in zip(table, chance)]
        h = [n * p * (1 - p) for (_, _, n), p in zip(table, chance)]
        _, (f, cut), _ = best_split(rows, g, h)
        sides = []
        for side in (False, True):
            part = [i for i, x in enumerate(rows) if (x[f] > cut) == side]
            _, split, leaves = best_split([rows[i] for i in part], [g[i] for i in part], [h[i] for i in part])
            sides.append((split, tuple(RATE * v for v in leaves)))
        trees.append(((f, cut), sides))
        margins = [m + sides[x[f] > cut][1][x[sides[x[f] > cut][0][0]] > sides[x[f] > cut][0][1]] for m, x in zip(margins, rows)]
    return prior, trees


def fit(spans: DataFrame, precision: float = PRECISION) -> Trees:
    """The model from the counts of all candidates of the corpus. The table that reaches the driver has one row per
    combination of bins, 3 x 7 x 6 x 2 x 6 x 7 x 6 x 5 x 2 at most, and in practice a few hundred."""
    counted = (
        spans.select((F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0).alias("held"), F.explode("candidates").alias("c"))
        .groupBy("held", *[F.col(f"c.{f}").alias(f) for f in FEATURES])
        .agg(F.sum(F.col("c.on").cast("bigint")).alias("ones"), F.count(F.lit(1)).alias("n"))
    )
    rows = sorted((bool(r["held"]), tuple(r[f] for f in FEATURES), float(r["ones"]), float(r["n"])) for r in counted.collect())
    train = [(x, y, n) for held, x, y, n in rows if not held]
    if not train:
        return Trees(0.0, [], {})
    model = Trees(*boost(train), {})
    for generator in range(len(GENERATORS)):
        judged = sorted(((model.margin(x), y, n) for held, x, y, n in rows if held and x[0] == generator), reverse=True)
        ones = seen = 0.0
        for k, (margin, y, n) in enumerate(judged):
            ones, seen = ones + y, seen + n
            last = k + 1 == len(judged) or judged[k + 1][0] < margin
            if last and ones >= precision * seen:
                model.thresholds[generator] = margin - 1e-9
    return model


def kind_of(c: Column) -> Column:
    """The kind an added candidate is reported as."""
    return (
        F.when(c["generator"] == 0, "email").when(c["generator"] == 2, "ip").when(c["plus"] == 1, "phone")
        .when(c["digits"] >= 3, "card").otherwise("phone")
    )


def find_pii(docs: DataFrame, model: Trees | None = None, precision: float = PRECISION) -> DataFrame:
    """``doc_id, base, spans``: arrays of (start, rank, end, kind); ``spans`` holds the base and what the trees add."""
    spans = stored(candidate_spans(docs), "candidate-spans")  # read for fitting, then for judging
    model = model or fit(spans, precision)

    def span(c: Column) -> Column:
        kind = kind_of(c)
        rank = F.array_position(F.array(*map(F.lit, KINDS)), kind).cast("int") - 1
        return F.struct(c["start"].alias("start"), rank.alias("rank"), c["end"].alias("end"), kind.alias("kind"))

    added = F.transform(F.filter("candidates", lambda c: ~c["on"] & model.accepted(c)), span)
    return spans.select("doc_id", "base", F.array_distinct(F.concat("base", added)).alias("spans"))
