"""Secret scanning over an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger, a folder of Parquet files, holds one
row per blob and scan: the rule versions applied and the spans found. A scan reads only blobs for which a rule version
is missing, applies only the missing ones, appends what it found, and joins the findings of all scans back to the paths.

Defined cases: null text is empty; a blob that several paths or versions share is scanned once and reported for each;
repeated rows are reported as often as they occur; an empty table gives no rows; other columns are ignored.
Rules that share a version name across different patterns are the caller's mistake: a changed rule needs a new version.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettrage.llm.spans import find_spans, ranked


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches are findings if group ``group`` has at least ``least`` characters."""

    name: str
    version: int
    test: str
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def id(self) -> str:
        return f"{self.name}@{self.version}"


# The patterns of the base kinds. The lengths of ``access`` and ``hex`` are part of their patterns, as a
# match of either ends where its run of characters ends, and a shorter run holds no longer one.
BASE = (
    Rule("assign", 1, "(?i:passw|secret|token|api_?key)",
         r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 12),
    Rule("access", 1, "AKIA", r"AKIA[A-Z0-9]{14,}+"),
    Rule("hex", 1, "[0-9a-f]{16}", r"[0-9a-f]{16,}+"),
)
MORE = (
    Rule("private_key", 1, "-----BEGIN ", r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
    Rule("forge_token", 1, "gh[pousr]_", r"gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("chat_token", 1, "xox[abprs]-", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("web_token", 1, r"eyJ", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
)
RULES = BASE + MORE

LEDGER = "blob string, rules array<string>, findings array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def read_ledger(spark, ledger: str) -> DataFrame:
    """The ledger's rows; no rows where the folder does not exist yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def unseen(versions: DataFrame, known: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, text, todo``: each blob once that lacks a rule version, with the versions it lacks. Copies are combined
    before the shuffle, so a blob that fills a third of all rows arrives as one row per task."""
    wanted = F.array(*[F.lit(r.id) for r in rules])
    blobs = versions.groupBy("blob").agg(F.first("text").alias("text"))
    seen = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    todo = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").withColumn("todo", todo).filter(F.size("todo") > 0).select("blob", "text", "todo")


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The ledger rows of these blobs."""
    finders = {r.name: (r.test, r.pattern) for r in rules}
    spans = find_spans(blobs, "text", finders)

    def found(rank: int, rule: Rule) -> Column:
        hits = F.col(rule.name)
        if rule.least:
            hits = F.filter(hits, lambda s: F.length(F.regexp_extract(s["match"], rule.pattern, rule.group)) >= rule.least)
        return F.when(F.array_contains("todo", rule.id), ranked(hits, rank, rule.name)).otherwise(
            F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
        )

    return spans.select(
        "blob", F.col("todo").alias("rules"), F.concat(*[found(i, r) for i, r in enumerate(rules)]).alias("findings")
    )


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``path, blob, findings`` of every row of ``versions`` (path, text) after the ledger has been brought up to date."""
    spark = versions.sparkSession
    addressed = versions.select("path", F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    new = scan_blobs(unseen(addressed, read_ledger(spark, ledger), rules), rules)
    new.write.mode("append").parquet(ledger)
    wanted = [r.id for r in rules]
    current = read_ledger(spark, ledger).filter(F.arrays_overlap("rules", F.array(*map(F.lit, wanted))))
    names = [r.name for r in rules]
    found = (
        current.select("blob", F.filter("findings", lambda s: s["kind"].isin(names)).alias("findings"))
        .filter(F.size("findings") > 0).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("findings"))).alias("findings"))
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return addressed.select("path", "blob").join(found, "blob", "left").select("path", "blob", F.coalesce("findings", none).alias("findings"))
