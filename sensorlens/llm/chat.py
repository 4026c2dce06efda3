"""Chat formatting with Spark expressions only.

A template of marks wraps each run of turns of one role. Control strings inside roles and texts
are escaped with a backslash behind their first character, one more for each that stands there, so
that texts can hold anything and are read back exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``start`` role ``sep`` text (``join`` text)* ``end``: a run of turns of one role. Marks look
    like ``<|name|>``; ``others`` are further control strings that texts must not hold bare, each
    beginning with ``<`` or ``[`` and holding neither behind it but for a doubled ``<``."""

    start: str = "<|im_start|>"
    sep: str = "<|im_sep|>"
    join: str = "<|im_turn|>"
    end: str = "<|im_end|>"
    others: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    trained: str = "assistant"

    def rest(self) -> str:
        """A pattern of what stands behind the first character of a control string."""
        return "|".join([r"\|[A-Za-z0-9_]+\|>", *(rf"\Q{c[1:]}\E" for c in self.others)])


TEMPLATE = Template()


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({template.rest()})", r"$1\\$2$3")


def unescape(text: Column, template: Template = TEMPLATE) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({template.rest()})", "$1$2$3")


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``, its (turn, role, text) structs sorted; nulls of role and text are
    empty, a null turn comes first, rows of one turn follow by role and text, repeated rows stay."""
    row = F.struct(
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(row)).alias("turns")
    )


def format_conversations(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``segments``.

    ``segments`` are (text, loss) pieces that give ``formatted`` when put together; those under
    the loss mask are the texts of the trained role, one per turn. Adjacent turns of one role are
    merged into a run, their texts behind each other with the join mark between. A null
    ``conv_id`` is a conversation of its own; an empty table gives no rows. A conversation's turns
    meet in one task, as they make one text.
    """
    neighbours = conversations(turns).withColumn("roles", F.expr("transform(turns, t -> t.role)"))
    zipped = F.arrays_zip(
        "turns",
        F.expr("concat(array(cast(null as string)), slice(roles, 1, size(roles) - 1))").alias("before"),
        F.expr("concat(slice(roles, 2, size(roles)), array(cast(null as string)))").alias("after"),
    )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def wrap(item: Column) -> Column:
        turn, role = item["turns"], item["turns"]["role"]
        goes_on = role.eqNullSafe(item["before"])
        opens = F.concat(F.lit(template.start), escape(role, template), F.lit(template.sep))
        closes = F.when(role.eqNullSafe(item["after"]), "").otherwise(template.end)
        no = F.lit(False)
        return F.array(
            segment(F.when(goes_on, template.join).otherwise(opens), no),
            segment(escape(turn["text"], template), role == template.trained),
            segment(closes, no),
        )

    wrapped = neighbours.select("conv_id", F.flatten(F.transform(zipped, wrap)).alias("segments"))
    joined = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return wrapped.select("conv_id", joined.alias("formatted"), "segments")


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The (role, text) turns of a formatted conversation, in order."""
    runs = F.filter(F.split(formatted, rf"\Q{template.end}\E"), lambda run: run != "")

    def turns(run: Column) -> Column:
        parts = F.split(run, rf"\Q{template.sep}\E", 2)
        role = unescape(F.substr(parts[0], F.lit(len(template.start) + 1)), template)
        texts = F.split(parts[1], rf"\Q{template.join}\E")
        return F.transform(texts, lambda text: F.struct(role.alias("role"), unescape(text, template).alias("text")))

    return F.flatten(F.transform(runs, turns))


def loss_text(segments: Column, template: Template = TEMPLATE) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: unescape(s["text"], template)), "")


def digests(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """What is read back from the output: turns, their digest, the masked text's size and digest."""
    read = formatted.select(
        "conv_id", "formatted", read_turns(F.col("formatted"), template).alias("read"),
        loss_text(F.col("segments"), template).alias("loss"),
    )
    turns = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
