"""Chat template with a deterministic parser: render, reparse, escape until both agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template: header mark, turn end, and the control strings escaped inside texts.
HEADER = "### "
END = "\n</turn>\n"
CONTROL = r"\\*+(?:###|</turn>)"
BEGIN = r"(?<!\\)"  # a match begins where its run of backslashes does, so a long run is gone through once
DEEPEST = 2


def escape(text: Column) -> Column:
    """One more backslash before each control string and the backslashes that lead it."""
    return F.regexp_replace(text, f"{BEGIN}({CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"{BEGIN}\\({CONTROL})", "$1")


def _pack_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n"))


def _unpack_role(packed: Column) -> Column:
    return F.replace(F.replace(packed, F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def head_of(role: Column) -> Column:
    return F.concat(F.lit(HEADER), _pack_role(role), F.lit(":\n"))


def parse(formatted: Column) -> Column:
    """Turns ``array<struct<role, text>>`` of a rendered text; an element is null where the grammar is broken.

    conversation := turn*; turn := "### " role ":\\n" body END; a body is in canonical form, that is, escaping
    its unescaped text gives the body again, so a bare control string inside is an error.
    """
    # The last piece is what follows the last end mark: empty in a well-formed text.
    pieces = F.split(formatted, r"\n</turn>\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - F.when(F.element_at(pieces, -1) == "", 1).otherwise(0))

    def turn(piece: Column) -> Column:
        line = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(line) + 2, F.length(piece))
        good = line.startswith(HEADER) & line.endswith(":") & piece.contains("\n") & (F.length(line) > len(HEADER)) & (escape(unescape(body)) == body)
        return F.when(good, F.struct(_unpack_role(F.substring(line, F.lit(len(HEADER) + 1), F.length(line) - len(HEADER) - 1)).alias("role"),
                                     unescape(body).alias("text")))
    return F.transform(pieces, turn)


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 trained: str = "assistant") -> DataFrame:
    """One row per conversation: ``(conv, formatted, loss_mask, escapes, agrees)``.

    Each turn is rendered plainly, reparsed, and escaped one level deeper until the parser gives back its source;
    a parser result that never agrees fails the job. ``loss_mask`` lists (start, length) in code points of the
    bodies of ``trained`` turns; ``escapes`` counts turns that needed escaping; ``agrees`` tells that the whole
    text reparses to the source. Turns are ordered by (turn, role, text), a null turn first; a null role or text
    is empty, a null conversation id is one conversation; repeated rows are turns of their own; an empty table gives no rows; texts of any length are
    gone through a fixed number of times. Other columns are not read. The one exchange is by conversation, which is the unit of output.
    """
    source = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
                          F.coalesce(text, F.lit("")).alias("text"))
    wanted = F.array(F.struct("role", "text"))
    body, tries = F.col("text"), []
    for level in range(DEEPEST + 1):
        tries.append(F.when(parse(F.concat(head_of(F.col("role")), body, F.lit(END))) == wanted,
                            F.struct(F.lit(level).alias("level"), body.alias("body"))))
        body = escape(body)
    agreed = F.coalesce(*tries, F.struct(F.raise_error(F.lit("turn has no rendering that reparses")).cast("int").alias("level"), body.alias("body")))
    by_turn = Window.partitionBy("conv").orderBy("turn", "role", "text")
    spans = (source.withColumn("agreed", agreed)
             .select("conv", "turn", "role", "text", F.col("agreed.level").alias("level"), F.col("agreed.body").alias("body"))
             .withColumn("head", head_of(F.col("role")))
             .withColumn("nth", F.row_number().over(by_turn))
             .withColumn("until", F.sum(F.length("head") + F.length("body") + len(END)).over(by_turn.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("start", F.col("until") - len(END) - F.length("body")))
    gathered = spans.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("nth", "role", "text", "head", "body", "start"))).alias("turns"),
        F.sum((F.col("level") > 0).cast("bigint")).alias("escapes"))
    mask = F.transform(F.filter("turns", lambda t: t["role"] == trained),
                       lambda t: F.struct(t["start"].alias("start"), F.length(t["body"]).cast("bigint").alias("length")))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    return (gathered.select("conv", "turns", formatted.alias("formatted"), mask.alias("loss_mask"), "escapes")
            .select(F.col("conv").alias(conv), "formatted", "loss_mask", "escapes",
                    (parse(F.col("formatted")) == F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))).alias("agrees")))


def masked_text(formatted: Column, mask: Column) -> Column:
    """Texts under the mask, unescaped and joined."""
    return F.array_join(F.transform(mask, lambda m: unescape(F.substring(formatted, (m["start"] + 1).cast("int"), m["length"].cast("int")))), "")
