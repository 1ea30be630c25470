"""Chat formatting: a finite-state machine over roles and a declarative template.

The template says per role which marks open and close a turn and whether its
text counts for the loss; the transitions say which role may follow which.  A
turn becomes three segments (open mark, text, close mark), each with a loss
flag; only the text of a trained role has it set.  Control strings inside texts
are escaped by one more backslash, which ``read_back`` takes off again.

Everything is DataFrame functions.  Segments need only the turn before
(a window over the conversation); the formatted conversation is one value, so
its turns meet in one row, as the result demands.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

START, END = "^", "$"


@dataclass(frozen=True)
class Role:
    """Marks around a turn; ``control`` are the strings that must not occur in texts."""

    open: str
    close: str
    loss: bool = False


# Marks of the template: every control string stands between spaces or line
# ends, so text and marks can never run together into another control string.
TEMPLATE: dict[str, Role] = {
    "system": Role("<s>[SYS] ", " [/SYS]</s>\n"),
    "user": Role("<s>[INST] ", " [/INST]</s>\n"),
    "assistant": Role("<s>[REPLY] ", " [/REPLY]</s>\n", loss=True),
}
# Any other role keeps its name inside the marks.
OTHER = Role("<s>[TURN:", " [/TURN]</s>\n")
CONTROL = r"</?s>|\[/?(?:SYS|INST|REPLY|TURN)[:\]]"
TRANSITIONS: dict[str, tuple[str, ...]] = {
    START: ("system", "user"),
    "system": ("user",),
    "user": ("assistant",),
    "assistant": ("user",),
}
ENDS: tuple[str, ...] = ("assistant",)


def escape(text: Column) -> Column:
    """One backslash more before every control string."""
    return F.regexp_replace(text, rf"(\\*)({CONTROL})", r"\\$1$2")


def unescape(text: Column) -> Column:
    """Takes the backslash of ``escape`` off again."""
    return F.regexp_replace(text, rf"\\(\\*)({CONTROL})", "$1$2")


def _by_role(role: Column, value, other) -> Column:
    out = None
    for name, r in TEMPLATE.items():
        out = F.when(role == name, value(r)) if out is None else out.when(role == name, value(r))
    return out.otherwise(other)


def opening(role: Column) -> Column:
    return _by_role(role, lambda r: F.lit(r.open), F.concat(F.lit(OTHER.open), F.hex(role), F.lit("] ")))


def closing(role: Column) -> Column:
    return _by_role(role, lambda r: F.lit(r.close), F.lit(OTHER.close))


def trained(role: Column) -> Column:
    return _by_role(role, lambda r: F.lit(r.loss), F.lit(OTHER.loss))


def allowed(before: Column, role: Column) -> Column:
    """Whether the machine has the step ``before`` -> ``role``."""
    steps = [F.lit(f"{a}>{b}") for a, next_roles in TRANSITIONS.items() for b in next_roles]
    return F.array_contains(F.array(*steps), F.concat(before, F.lit(">"), role))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without NULL roles and texts (empty instead);
    other columns are left out."""
    return conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def segments(conversations: DataFrame) -> DataFrame:
    """One row per segment: conv_id, position of the turn, part (0 open mark,
    1 text, 2 close mark), role, text, loss, step_ok.

    ``step_ok`` tells whether the machine allows this turn after the one before
    it.  Turns are taken by (turn, role, text), NULL turns first; equal rows
    follow each other.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = (turns(conversations)
                .withColumn("position", F.row_number().over(order))
                .withColumn("step_ok", allowed(F.coalesce(F.lag("role").over(order), F.lit(START)), F.col("role"))))
    role = F.col("role")
    parts = F.array(
        F.struct(F.lit(0).alias("part"), opening(role).alias("text"), F.lit(False).alias("loss")),
        F.struct(F.lit(1).alias("part"), escape(F.col("text")).alias("text"), trained(role).alias("loss")),
        F.struct(F.lit(2).alias("part"), closing(role).alias("text"), F.lit(False).alias("loss")))
    return (numbered.select("conv_id", "position", "role", "step_ok", F.explode(parts).alias("s"))
            .select("conv_id", "position", "s.part", "role", "s.text", "s.loss", "step_ok"))


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, n_rows, valid: one row per conversation.

    ``valid``: the machine accepts the whole order of roles and may end there.
    An order that it does not accept is formatted all the same.
    """
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    whole = turns(conversations).groupBy("conv_id").agg(ordered.alias("t"))
    piece = F.transform("t", lambda x: F.concat(opening(x["role"]), escape(x["text"]), closing(x["role"])))
    state = F.aggregate(
        "t", F.lit(START),
        lambda s, x: F.when((s != END) & allowed(s, x["role"]), x["role"]).otherwise(F.lit(END)))
    return whole.select("conv_id", F.array_join(piece, "").alias("formatted"), F.size("t").alias("n_rows"),
                        state.isin(*ENDS).alias("valid"))


def read_back(formatted_rows: DataFrame) -> DataFrame:
    """conv_id and ``turns``: array of (role, text, loss) parsed from ``formatted``."""
    mark = r"(?<!\\)<s>\[(SYS|INST|REPLY|TURN:[0-9A-F]*)\] (?s:(.*?)) (?<!\\)\[/(?:SYS|INST|REPLY|TURN)\]</s>\n"
    names = F.regexp_extract_all("formatted", F.lit(mark), F.lit(1))
    texts = F.regexp_extract_all("formatted", F.lit(mark), F.lit(2))
    known = {r.open.split("[")[1].split("]")[0]: name for name, r in TEMPLATE.items()}

    def role_of(tag: Column) -> Column:
        out = None
        for t, name in known.items():
            out = F.when(tag == t, F.lit(name)) if out is None else out.when(tag == t, F.lit(name))
        return out.otherwise(F.decode(F.unhex(F.substring(tag, 6, 1 << 20)), "UTF-8"))

    pair = F.arrays_zip(names.alias("tag"), texts.alias("text"))
    return formatted_rows.withColumn("_p", pair).select(
        "conv_id", "formatted", "valid",
        F.transform("_p", lambda p: F.struct(
            role_of(p["tag"]).alias("role"), unescape(p["text"]).alias("text"),
            trained(role_of(p["tag"])).alias("loss"))).alias("turns"))


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid."""
    said = read_back(formatted(conversations)).withColumn(
        "_loss", F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), ""))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return said.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid")
