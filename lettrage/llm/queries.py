"""The registered queries of the training-data operators, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettrage.llm import (
    chat_format, decontaminate, fill_in_middle, filter_audit, jaccard_join, language, license_scan, line_dedup, neighbours, packing, pii,
    secret_scan, token_files,
)
from lettrage.llm.shared import documents, shared_folder
from lettrage.llm.spans import joined

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, 7 + length(replace(replace(replace(role, '%', '%25'), ':', '%3A'), '<', '%3C')) + 8 + length(text)
    + length(regexp_extract_all(text, '###|</turn>')) AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id"""


@query("op1_chat_format", CHAT_SQL)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text"
    )
    hard = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(hard)))


LINES_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs)),
held AS (SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT l.*, h.first IS NOT NULL AND h.first <> l.doc_id AS gone FROM lines l LEFT JOIN held h ON l.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query("op10_line_dedup", LINES_SQL)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(table(spark, sf, "documents"))
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def span_counts(kinds: tuple[str, ...]) -> list:
    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return [count(k) for k in kinds]


@query("op2_pii")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find_pii(documents(table(spark, sf, "documents")))
    return found.select("doc_id", *span_counts(pii.KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query("op4_secret_scan")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(table(spark, sf, "documents"))
    found = secret_scan.scan(docs.select(F.col("doc_id").alias("path"), "text"), shared_folder(spark, "blob-ledger"))
    kinds = tuple(r.name for r in secret_scan.BASE)
    rows = found.select(F.col("path").alias("doc_id"), "findings", F.filter("findings", lambda s: s["kind"].isin(*kinds)).alias("base"))
    return rows.select(
        "doc_id", *span_counts(kinds), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans")
    )


@query("op3_token_files")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf, "documents"))


@query("op7_packing")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


@query("op8_language")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    filters = language.fit(docs.filter(~language.held_out()))
    judged = language.predict(docs, filters)
    return judged.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query("op9_decontaminate")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


GROUPS_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM worded),
sized AS (SELECT doc_id, len(s) AS n, s FROM sets),
spread AS (SELECT doc_id, n, unnest(s) AS shingle FROM sized),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS common
  FROM spread x JOIN spread y ON x.shingle = y.shingle AND x.doc_id < y.doc_id AND 100 * x.n >= 85 * y.n AND 100 * y.n >= 85 * x.n
  GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 85 * (na + nb - common)),
ties AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM sized UNION SELECT r.a, t.b FROM reach r JOIN ties t ON r.b = t.a)
SELECT s.doc_id, s.n AS n_shingles, min(r.b) AS component_id FROM sized s JOIN reach r ON s.doc_id = r.a GROUP BY ALL"""


@query("op6_jaccard_join", GROUPS_SQL)
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf, "documents"))


@query("op5_neighbours")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.search(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


AUDIT_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
worded AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM docs),
marks AS (SELECT doc_id AS of, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {
    'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w), 'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
    'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)} AS f
  FROM worded LEFT JOIN marks ON doc_id = of),
cells AS (
  SELECT part, good, toxic, concat(CASE WHEN f.A THEN 'A' END, CASE WHEN f.B THEN 'B' END, CASE WHEN f.C THEN 'C' END, CASE WHEN f.D THEN 'D' END,
    CASE WHEN f.E THEN 'E' END) AS failed, count(*) AS n FROM judged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.l NOT IN (b.l, c.l, d.l, e.l) AND b.l NOT IN (c.l, d.l, e.l) AND c.l NOT IN (d.l, e.l) AND d.l <> e.l),
steps AS (SELECT filter_order, step, filter_order[step] AS letter, left(filter_order, step - 1) AS before FROM orders, range(1, 6) r(step)),
placed AS (
  SELECT part, filter_order, step::INTEGER AS step, letter, good, toxic, failed, n, contains(failed, letter) AS fails,
    translate(before, failed, '') <> before AS gone FROM cells, steps),
report AS (
  SELECT part, filter_order, step, letter, coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (failed = letter), 0)::BIGINT AS unique_fails, coalesce(sum(n) FILTER (fails AND NOT gone AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (fails AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost FROM placed GROUP BY ALL)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM report"""


@query("op11_filter_audit", AUDIT_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(filter_audit.failures(table(spark, sf, "documents")), table(spark, sf, "labels"))


MIDDLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
hashed AS (
  SELECT doc_id, t, w, len(w) AS n, ('0x' || h[1:8])::BIGINT % (len(w) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(w) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM docs),
pieces AS (
  SELECT *, array_to_string(w[1:least(a, b)], '') AS p, array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS m,
    array_to_string(w[greatest(a, b) + 1:], '') AS s FROM hashed)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM pieces"""


@query("op12_fill_in_middle", MIDDLE_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    rows = fill_in_middle.restored(fill_in_middle.to_fill_in_middle(table(spark, sf, "documents")))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256")
    )


@query("op13_license_scan")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.digests(license_scan.find_licenses(table(spark, sf, "documents")))
