"""Chat formatting: typed content parts flattened by a visitor into one training string.

A turn is ``<turn>role</role>body</turn>``. Its content is a list of typed
parts; the visitor keeps their order, writes a text part escaped and any other
part as a placeholder ``<|kind:ordinal|>``, and records the attachment
reference with the number of tokens the placeholder expands to. Control
strings start with ``</`` or ``<|``, so a backslash between these two
characters (and a doubled backslash for each literal one) makes escaping
reversible and leaves no control string inside a text.

Everything is built-in DataFrame functions. Offsets come from a running sum
over the turns of a conversation, so the cost is linear in its length.

Defined cases: null text or null parts are empty, a null role is empty, a null
``conv_id`` is a conversation of its own, rows that tie on ``turn`` go by role,
then text; repeated rows stay separate turns; an empty table gives no rows;
other columns are ignored. A part of unknown kind is kept as an attachment of
that kind; a null part is an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, ROLE_END, TURN_END = "<turn>", "</role>", "</turn>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Reversible; the result holds neither ``</`` nor ``<|``."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("</"), F.lit("<\\/")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _visit(parts: Column) -> Column:
    """Flatten the parts of one turn: struct(body, attachments)."""
    attached = F.filter(parts, lambda p: p["kind"] != "text")

    def one(p: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(parts, F.lit(1), i), lambda q: q["kind"] != "text"))
        mark = F.concat(F.lit("<|"), escape(p["kind"]), F.lit(":"), before.cast("string"), F.lit("|>"))
        return F.when(p["kind"] == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(mark)

    return F.struct(F.array_join(F.transform(parts, one), "").alias("body"), attached.alias("attached"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """Format each conversation of (conv_id, turn, role, text[, parts]).

    ``parts``, where the input has it, is array<struct<kind, text, ref,
    n_tokens>> and comes before ``text``; a row without parts is one text
    part. Returns conv_id, formatted, loss_spans (code-point start and
    exclusive end of each assistant body), attachments (turn ordinal, kind,
    ref, n_tokens, in order) and expanded_tokens.

    One shuffle, by conv_id. A conversation becomes one string, so it has to
    fit a row; conversations themselves spread over all tasks.
    """
    plain = F.array(F.struct(F.lit("text").alias("kind"), F.coalesce("text", F.lit("")).alias("text"),
                             F.lit(None).cast("string").alias("ref"), F.lit(0).cast("long").alias("n_tokens")))
    if "parts" in turns.columns:
        typed = F.transform("parts", lambda p: F.struct(
            F.coalesce(p["kind"], F.lit("text")).alias("kind"), p["text"].alias("text"),
            p["ref"].alias("ref"), F.coalesce(p["n_tokens"], F.lit(0)).cast("long").alias("n_tokens")))
        parts = F.when(F.col("parts").isNotNull(), typed).otherwise(plain)
    else:
        parts = plain
    base = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("_text"), parts.alias("_parts"))
    seen = base.withColumn("_v", _visit(F.col("_parts")))
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(ROLE_END))
    order = Window.partitionBy("conv_id").orderBy(
        F.asc_nulls_first("turn"), "role", "_text", "_v.body")
    whole = F.concat(head, F.col("_v.body"), F.lit(TURN_END))
    placed = (seen.select("conv_id", "turn", "role", "_text", "_v", whole.alias("_s"),
                          F.length(head).alias("_head"))
              .withColumn("_n", F.row_number().over(order))
              .withColumn("_at", F.coalesce(F.sum(F.length("_s").cast("long")).over(
                  order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    start = F.col("_at") + F.col("_head")
    rows = F.sort_array(F.collect_list(F.struct(
        "_n", "_s", F.col("role").alias("role"), start.alias("start"),
        (start + F.length("_v.body")).alias("end"), F.col("_v.attached").alias("attached"))))
    grouped = placed.groupBy("conv_id").agg(rows.alias("_rows"))
    attachments = F.flatten(F.transform("_rows", lambda r: F.transform(
        r["attached"], lambda a: F.struct(r["_n"].alias("turn"), a["kind"].alias("kind"),
                                          a["ref"].alias("ref"), a["n_tokens"].alias("n_tokens")))))
    return (grouped.select(
        "conv_id",
        F.array_join(F.transform("_rows", lambda r: r["_s"]), "").alias("formatted"),
        F.transform(F.filter("_rows", lambda r: r["role"] == LOSS_ROLE),
                    lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))).alias("loss_spans"),
        attachments.alias("attachments"))
        .withColumn("expanded_tokens", F.aggregate(
            "attachments", F.lit(0).cast("long"), lambda n, a: n + a["n_tokens"])))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse formatted conversations: conv_id, formatted, turns (role, text), loss_texts.

    Placeholders of attachments stay in the text as they are.
    """
    pieces = F.split("formatted", TURN_END)
    bodies = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, ROLE_END, 1)
        text = F.substr(piece, F.length(role) + len(ROLE_END) + 1)
        return F.struct(unescape(F.substr(role, F.lit(len(OPEN) + 1))).alias("role"),
                        unescape(text).alias("text"))

    return formatted.select(
        "conv_id", "formatted", F.transform(bodies, turn).alias("turns"),
        F.transform("loss_spans", lambda s: unescape(F.substr(
            F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))).alias("loss_texts"))
