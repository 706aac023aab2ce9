"""Chat formatting with a round trip through the template's grammar.

A conversation is rendered as ``### role: text\\n</turn>\\n`` per turn, with every control string inside a text escaped, also
where a parser could do without. The rendered text is parsed again and compared with the source. A conversation that differs fails the
job, so no text is ever altered silently; the escape is made so that none does.

Escaping puts one backslash before the run of backslashes, possibly none, in front of a control string; reading takes
one away. Roles are percent-encoded where they hold ``%``, ``:`` or ``<``.

Defined cases: null role or text is empty; null ``conv_id`` is one conversation; equal turn numbers are ordered by role
and text; a null turn comes first; repeated rows are repeated turns; an empty table gives no rows; other columns of the
input are ignored. One conversation becomes one value, so it has to fit into a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettrage.llm.shared import prefix_sums

# Fixed values of the template.
HEAD = "### "
SEPARATOR = ": "
END = "\n</turn>\n"
CONTROL = "###|</turn>"
LOSS_ROLE = "assistant"

ESCAPE = rf"(?<!\\)(\\*+)({CONTROL})"
UNESCAPE = rf"(?<!\\)\\(\\*+)({CONTROL})"
ROLE_CODES = (("%", "%25"), (":", "%3A"), ("<", "%3C"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"\\$1$2")


def unescape(body: Column) -> Column:
    return F.regexp_replace(body, UNESCAPE, "$1$2")


def encode_role(role: Column) -> Column:
    for char, code in ROLE_CODES:
        role = F.replace(role, F.lit(char), F.lit(code))
    return role


def decode_role(role: Column) -> Column:
    for char, code in reversed(ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(char))
    return role


def render(turns: Column, body) -> Column:
    """The turns (role, text) as one string; ``body`` gives the text as it is written."""
    pieces = F.transform(turns, lambda t: F.concat(F.lit(HEAD), encode_role(t["role"]), F.lit(SEPARATOR), body(t["text"]), F.lit(END)))
    return F.array_join(pieces, "")


def bodies(rendered: Column) -> Column:
    """The parser's first step: (role, body as written, characters before the body, all characters) of each turn."""
    parts = F.split(rendered, END, -1)
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def read(part: Column) -> Column:
        head = F.substring_index(part, SEPARATOR, 1)
        lead = F.length(head) + len(SEPARATOR)
        return F.struct(
            F.when(part.startswith(HEAD), decode_role(F.substring(head, len(HEAD) + 1, 2**31 - 1))).alias("role"),
            part.substr(lead + 1, F.length(part)).alias("body"),
            lead.alias("lead"), (F.length(part) + len(END)).alias("chars"),
        )

    return F.transform(turns, read)


def parsed(rendered: Column) -> Column:
    """The turns (role, text) that the rendered string stands for."""
    return F.transform(bodies(rendered), lambda t: F.struct(t["role"].alias("role"), unescape(t["body"]).alias("text")))


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``turns`` as read back (role, text), and ``loss``, the spans
    of the assistants' texts in ``formatted`` as (start, end) in code points, end exclusive, with their unescaped text."""
    turn = F.struct(
        F.col("turn").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    source = (
        rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("ordered"))
        .select("conv_id", F.transform("ordered", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"))
    )
    escaped = lambda text: F.when(text.rlike(CONTROL), escape(text)).otherwise(text)
    chosen = source.select("conv_id", "source", render(F.col("source"), escaped).alias("formatted"))
    read = chosen.withColumn("bodies", bodies(F.col("formatted")))
    back = read.select(
        "conv_id", "source", "formatted", "bodies",
        F.transform("bodies", lambda t: F.struct(t["role"].alias("role"), unescape(t["body"]).alias("text"))).alias("turns"),
        prefix_sums(F.transform("bodies", lambda t: t["chars"])).alias("ends"),
    )
    checked = F.when(F.col("turns") == F.col("source"), F.col("turns")).otherwise(
        F.raise_error(F.concat(F.lit("conversation does not survive the round trip: "), F.col("conv_id").cast("string")))
    )

    def span(t: Column, i: Column) -> Column:
        begin = F.col("ends")[i] - t["chars"] + t["lead"]
        return F.struct(t["role"].alias("role"), begin.alias("start"), (begin + F.length(t["body"])).alias("end"), unescape(t["body"]).alias("text"))

    loss = F.transform(
        F.filter(F.transform("bodies", span), lambda t: t["role"] == LOSS_ROLE),
        lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), t["text"].alias("text")),
    )
    return back.select("conv_id", "formatted", checked.alias("turns"), loss.alias("loss"))


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and checksums of formatted conversations, taken from what was read back."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = formatted.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), said.alias("said"),
        F.array_join(F.transform("loss", lambda t: t["text"]), "").alias("learned"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    return read.select(
        "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
    )
