"""Chat formatting as a grammar round trip, in DataFrame functions.

    conversation := turn*
    turn         := "<s>[INST]" role "\\n" text "[/INST]</s>"     a prompt
                  | "<s>" role "\\n" text "</s>"                  an answer, under the loss mask

A text goes into the template as it is, the turn is parsed again, and if the
parser does not give back the same role and text, the conflicting content is
escaped: first the control strings and escape marks, then, if that does not
help, every character that can begin one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template, as fixed values.
BEGIN, END, ASK, ASKED = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = r"(<s>|</s>|\[INST\]|\[/INST\])"
# What an escape stands for; "%" begins an escape.
ESCAPES = {"%": "%25", "<": "%3C", "[": "%5B"}


@dataclass(frozen=True)
class Template:
    answers: tuple[str, ...] = ("assistant",)


def _escape_marks(c: Column) -> Column:
    """Escape marks and the first character of control strings."""
    c = F.regexp_replace(c, "%(?=25|3C|5B|0A)", "%25")
    return F.regexp_replace(F.regexp_replace(c, "<(?=/?s>)", "%3C"), r"\[(?=/?INST\])", "%5B")


def _escape_all(c: Column) -> Column:
    for plain, code in ESCAPES.items():
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    c = F.replace(F.replace(c, F.lit("%3C"), F.lit("<")), F.lit("%5B"), F.lit("["))
    return F.replace(F.replace(c, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _render(role: Column, text: Column, template: Template) -> Column:
    answer = role.isin(*template.answers)
    open_, close = F.when(answer, F.lit(BEGIN)).otherwise(F.lit(BEGIN + ASK)), F.when(answer, F.lit(END)).otherwise(F.lit(ASKED + END))
    return F.concat(open_, role, F.lit("\n"), text, close)


def parse_turns(formatted: Column) -> Column:
    """Array of ``(role, text, masked)`` of a formatted conversation, text
    unescaped.  Splits at the end marks, then at the first line break."""
    inner = F.filter(F.split(formatted, END), lambda x: x != "")
    def turn(x: Column) -> Column:
        asked = x.startswith(F.lit(BEGIN + ASK)) & x.endswith(F.lit(ASKED))
        body = F.when(asked, F.substr(x, F.lit(len(BEGIN + ASK) + 1), F.length(x) - len(BEGIN + ASK + ASKED))).otherwise(
            F.substr(x, F.lit(len(BEGIN) + 1)))
        role = F.substring_index(body, "\n", 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substr(body, F.length(role) + 2)).alias("text"), (~asked).alias("masked"))
    return F.transform(inner, turn)


def _settle(df: DataFrame, template: Template) -> DataFrame:
    """Add ``turn_text``, the rendered turn, escaped as far as its round trip
    needs, and ``escaped``, 0, 1 or 2."""
    role = F.replace(_escape_all(F.col("role")), F.lit("\n"), F.lit("%0A"))
    levels = [F.col("text"), _escape_marks(F.col("text")), _escape_all(F.col("text"))]
    d = df.withColumns({f"_r{i}": _render(role, c, template) for i, c in enumerate(levels)})
    def same(i: int) -> Column:
        parsed = parse_turns(F.col(f"_r{i}"))
        first = F.get(parsed, 0)
        # The string must also split into one turn only.
        return (F.size(parsed) == 1) & (first["role"] == F.col("role")) & (first["text"] == F.col("text")) & (
            F.regexp_count(f"_r{i}", F.lit(CONTROL)) == F.regexp_count(_render(role, F.lit(""), template), F.lit(CONTROL)))
    level = F.when(same(0), 0).when(same(1), 1).otherwise(2)
    d = d.withColumn("escaped", level)
    text = F.when(F.col("escaped") == 0, F.col("_r0")).when(F.col("escaped") == 1, F.col("_r1")).otherwise(F.col("_r2"))
    return d.withColumn("turn_text", text).drop("_r0", "_r1", "_r2")


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """``(conv_id, formatted, loss_spans, n_escaped)``, one row per conv_id of
    ``turns(conv_id, turn, role, text, ...)``.

    Turns are ordered by ``turn`` (null first), ties by role and text; repeated
    rows are turns each.  A null role or text is an empty one.  Rows with a
    null conv_id are one conversation.  ``loss_spans`` are ``(start, length)``
    in code points of the answers inside ``formatted``.  A conversation is one
    value and has to fit in one; nothing larger is gathered.
    """
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = _settle(t, template)
    head = F.lit(len(BEGIN)) + F.length(F.replace(_escape_all(F.col("role")), F.lit("\n"), F.lit("%0A"))) + 1
    answer = F.col("role").isin(*template.answers)
    t = t.select("conv_id", F.struct("turn", "role", "text", "turn_text", (F.col("escaped") > 0).cast("int").alias("escaped"), F.when(
        answer, F.struct(head.alias("at"), (F.length("turn_text") - head - len(END)).alias("length"))).alias("mask")).alias("x"))
    g = t.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    place = F.aggregate(
        "x", F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start: int, length: int>>)").alias("spans")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["turn_text"])).alias("at"),
            F.when(x["mask"].isNotNull(), F.concat(a["spans"], F.array(F.struct(
                (a["at"] + x["mask"]["at"]).alias("start"), x["mask"]["length"].alias("length"))))).otherwise(a["spans"]).alias("spans")))
    return g.select("conv_id", F.array_join("x.turn_text", "").alias("formatted"), place["spans"].alias("loss_spans"),
                    F.aggregate("x.escaped", F.lit(0), lambda a, x: a + x).cast("long").alias("n_escaped"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted``, the parsed ``turns`` and ``loss_text``, the
    unescaped answers cut out by ``loss_spans``."""
    loss = F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["length"])))
    return formatted.withColumns({"turns": parse_turns(F.col("formatted")), "loss_text": F.array_join(loss, "")})
