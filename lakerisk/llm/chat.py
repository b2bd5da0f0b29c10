"""Chat formatting: a state machine over roles, and segments with loss flags from a template."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerisk.llm.text import let, whole

START = "start"
#: (state, role) -> next state. The state is the role that spoke last.
TURN_ORDER = {
    (START, "system"): "system",
    (START, "user"): "user",
    ("system", "user"): "user",
    ("user", "assistant"): "assistant",
    ("assistant", "user"): "user",
}


@dataclass(frozen=True)
class Template:
    """A turn reads: begin, role, after_role, text, end. Roles in ``loss_roles`` are learned."""

    begin: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>\n"
    control: str = "<|"
    loss_roles: tuple[str, ...] = ("assistant",)
    order: dict = field(default_factory=lambda: dict(TURN_ORDER))


CHATML = Template()


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def _marked(template: Template) -> str:
    return f"&lt;{template.control[1:]}"


def escape(text: Column, template: Template) -> Column:
    """No control string is left: ``<|`` becomes ``&lt;|``. ``&`` becomes ``&amp;`` first, so
    that what looks like an escape in the text is told from a real one."""
    return _replace(_replace(text, "&", "&amp;"), template.control, _marked(template))


def unescape(text: Column, template: Template) -> Column:
    return _replace(_replace(text, _marked(template), template.control), "&amp;", "&")


def _escape_role(role: Column, template: Template) -> Column:
    return _replace(escape(role, template), "\n", "&#10;")


def _unescape_role(role: Column, template: Template) -> Column:
    return unescape(_replace(role, "&#10;", "\n"), template)


def first_error(roles: Column, template: Template = CHATML) -> Column:
    """Position (from 0) of the first turn the machine refuses; null if it takes all of them."""
    steps = F.create_map(*[F.lit(x) for (state, role), then in template.order.items() for x in (f"{state}\n{role}", then)])
    begin = F.struct(F.lit(START).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("error"))

    def step(machine: Column, role: Column) -> Column:
        then = F.element_at(steps, F.concat(machine["state"], F.lit("\n"), role))
        refused = machine["error"].isNull() & then.isNull()
        return F.struct(
            F.coalesce(then, machine["state"]).alias("state"),
            (machine["at"] + 1).alias("at"),
            F.when(refused, machine["at"]).otherwise(machine["error"]).alias("error"),
        )

    return F.aggregate(roles, begin, step, lambda machine: machine["error"])


def segments(turns: Column, template: Template = CHATML) -> Column:
    """array<struct<text, loss>>: header, text and end mark of each turn, in order."""

    def of(turn: Column) -> Column:
        head = F.concat(F.lit(template.begin), _escape_role(turn["role"], template), F.lit(template.after_role))
        parts = [
            (head, F.lit(False)),
            (escape(turn["text"], template), turn["role"].isin(*template.loss_roles)),
            (F.lit(template.end), F.lit(False)),
        ]
        return F.array(*[F.struct(text.alias("text"), loss.alias("loss")) for text, loss in parts])

    return F.flatten(F.transform(turns, of))


def format_conversations(rows: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conv_id: n_turns, segments, formatted and order_error.

    Turns are sorted by (turn, role, text), nulls first, so repeated turn numbers
    have one order; repeated rows are turns of their own. Null text and null role
    are empty strings; rows without conv_id form one conversation. Conversations
    whose order the machine refuses are formatted too and carry the position of
    the refused turn in order_error. Other columns are ignored; no rows give no
    rows. A conversation is one training text and so one row.
    """
    turn = F.struct("turn", whole("role").alias("role"), whole("text").alias("text"))
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    return held.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        segments(F.col("_turns"), template).alias("segments"),
        first_error(F.transform("_turns", lambda t: t["role"]), template).alias("order_error"),
    ).select("*", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_turns(formatted: Column, template: Template = CHATML) -> Column:
    """array<struct<role, text>> parsed from a formatted conversation."""
    pieces = let(F.split(formatted, rf"\Q{template.begin}\E"), lambda p: F.slice(p, F.lit(2), F.size(p)))

    def of(piece: Column) -> Column:
        head = F.substring_index(piece, template.after_role, 1)
        skip = F.length(head) + len(template.after_role)
        body = F.substring(piece, skip + 1, F.length(piece) - skip - len(template.end))
        return F.struct(_unescape_role(head, template).alias("role"), unescape(body, template).alias("text"))

    return F.transform(pieces, of)


def loss_text(parts: Column, template: Template = CHATML) -> Column:
    """All text under the loss mask, unescaped."""
    learned = F.filter(parts, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescape(s["text"], template)), "")


def digest(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """What the output says, read back from it."""
    turns = F.transform(
        read_turns(F.col("formatted"), template), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    learned = let(
        loss_text(F.col("segments"), template),
        lambda t: F.struct(F.length(t).cast("long").alias("chars"), F.sha2(t, 256).alias("sha")),
    )
    return formatted.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        learned.alias("_loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("order_error").isNull().alias("order_ok"),
    ).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.col("_loss.chars").alias("loss_chars"),
        F.col("_loss.sha").alias("loss_sha256"),
        "formatted_chars",
        "order_ok",
    )
