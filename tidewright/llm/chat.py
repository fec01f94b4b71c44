"""Chat formatting by a grammar round trip, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Strings that chat models take as control strings.
CONTROL_STRINGS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


@dataclass(frozen=True)
class Template:
    """A conversation is the concatenation of its turns: ``start role \\n text end``.

    Inside roles and texts each control string loses its first character to a code
    (``~1``, ``~2``, ...), ``~`` itself is written ``~0`` and, in roles, a line break ``~n``; so no
    control string is left inside them, and the markers cannot be built across a border,
    as none begins with what another ends with.
    """

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    controls: tuple[str, ...] = field(default=CONTROL_STRINGS)
    loss_roles: tuple[str, ...] = ("assistant",)

    def codes(self) -> dict[str, str]:
        """Code of each first character, in a fixed order."""
        return {c: f"~{i + 1}" for i, c in enumerate(sorted({x[0] for x in (*self.controls, self.start, self.end)}))}

    def escape(self, text: Column) -> Column:
        out = F.replace(text, F.lit("~"), F.lit("~0"))
        codes = self.codes()
        # Longer ones first: "<<SYS>>" before what may lie inside it. Codes hold no first character, so a pass never undoes another.
        for control in sorted({*self.controls, self.start, self.end}, key=lambda x: (-len(x), x)):
            out = F.replace(out, F.lit(control), F.lit(codes[control[0]] + control[1:]))
        return out

    def escape_fully(self, text: Column) -> Column:
        """The second level: every character that begins a control string."""
        out = F.replace(text, F.lit("~"), F.lit("~0"))
        for char, code in self.codes().items():
            out = F.replace(out, F.lit(char), F.lit(code))
        return out

    def unescape(self, text: Column) -> Column:
        out = text
        for char, code in self.codes().items():
            out = F.replace(out, F.lit(code), F.lit(char))
        return F.replace(out, F.lit("~0"), F.lit("~"))

    def render(self, turns: Column, escape) -> Column:
        line = lambda t: F.concat(
            F.lit(self.start), F.replace(escape(t["role"]), F.lit("\n"), F.lit("~n")), F.lit("\n"), escape(t["text"]), F.lit(self.end)
        )
        return F.array_join(F.transform(turns, line), "")

    def parse(self, formatted: Column) -> Column:
        """Turns, each with the place of its (escaped) text in ``formatted``; null where the text isn't of the grammar."""
        head = len(self.start)
        pieces = F.split(formatted, "\\Q" + self.end + "\\E")
        bodies = F.slice(pieces, 1, F.size(pieces) - 1)
        good = F.forall(bodies, lambda b: F.startswith(b, F.lit(self.start)) & b.contains("\n")) & (F.element_at(pieces, -1) == "")
        raw_role = lambda b: F.substring_index(F.substr(b, F.lit(head + 1)), "\n", 1)
        role_of = lambda b: self.unescape(F.replace(raw_role(b), F.lit("~n"), F.lit("\n")))
        begins = lambda b: F.lit(head + 1) + F.char_length(raw_role(b))
        turn = lambda b: F.struct(role_of(b).alias("role"), self.unescape(F.substr(b, begins(b) + 1)).alias("text"), begins(b).alias("at"), (F.char_length(b) - begins(b)).alias("length"), F.char_length(b).alias("size"))
        return F.when(good, F.transform(bodies, turn))


def format_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    template: Template = Template(),
) -> DataFrame:
    """One row per conversation: id, formatted, turns (read back), loss_spans, level, round_trip.

    The source turns are rendered and parsed again. Level 0 leaves texts as they are and holds only where
    the parsed turns equal the source; else level 1 codes whole control strings, else level 2
    every character that begins one. ``~`` is coded at every level, so all three are read by one parser.
    ``loss_spans`` are (start, length) in code points of ``formatted``, from 0: the assistants' texts.

    A null text or role is empty. Turns are in order of turn, role and text, null turns first; repeated rows
    are turns of their own. A row with a null conversation id is a conversation of its own. A conversation is one
    row of the result, so its turns meet in one task; nothing larger does. Other columns are not read.
    """
    turns = rows.select(
        F.col(conv_col).alias("_conv"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("_turn"),
    )
    alone = F.when(F.col("_conv").isNull(), F.monotonically_increasing_id())
    convs = turns.withColumn("_alone", alone).groupBy("_conv", "_alone").agg(F.sort_array(F.collect_list("_turn")).alias("_rows"))
    pairs = lambda c: F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    plain = lambda x: F.replace(x, F.lit("~"), F.lit("~0"))
    out = convs.select("_conv", pairs(F.col("_rows")).alias("_source"))
    # One level at a time, so a row pays for the next only when the one before failed.
    same = lambda text: pairs(template.parse(text)).eqNullSafe(F.col("_source"))
    out = out.withColumn("_f0", template.render(F.col("_source"), plain)).withColumn("_ok0", same(F.col("_f0")) & ~_has_control(F.col("_source"), template))
    out = out.withColumn("_f1", F.when(F.col("_ok0"), F.col("_f0")).otherwise(template.render(F.col("_source"), template.escape))).withColumn("_ok1", F.col("_ok0") | same(F.col("_f1")))
    out = out.withColumn("formatted", F.when(F.col("_ok1"), F.col("_f1")).otherwise(template.render(F.col("_source"), template.escape_fully)))
    out = out.withColumn("_parsed", template.parse(F.col("formatted")))
    step = len(template.end)
    spans = F.aggregate(
        "_parsed",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + t["size"] + step).alias("at"),
            F.when(t["role"].isin(*template.loss_roles), F.concat(acc["spans"], F.array(F.struct((acc["at"] + t["at"]).cast("long").alias("start"), t["length"].cast("long").alias("length"))))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return out.select(
        F.col("_conv").alias(conv_col),
        "formatted",
        pairs(F.col("_parsed")).alias("turns"),
        spans.alias("loss_spans"),
        F.when(F.col("_ok0"), 0).when(F.col("_ok1"), 1).otherwise(2).alias("level"),
        pairs(F.col("_parsed")).eqNullSafe(F.col("_source")).alias("round_trip"),
    )


def _has_control(turns: Column, template: Template) -> Column:
    """Whether a text holds a control string of any model, even one that this template doesn't use."""
    held = lambda x: [x.contains(c) for c in (*template.controls, template.start, template.end)]

    def any_of(conditions):
        out = conditions[0]
        for c in conditions[1:]:
            out = out | c
        return out

    return F.exists(turns, lambda t: any_of(held(t["text"]) + held(t["role"])))


def loss_text(template: Template = Template()) -> Column:
    """All text under the loss mask of ``format_conversations``, unescaped, with nothing between."""
    return F.array_join(F.transform("loss_spans", lambda s: template.unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
