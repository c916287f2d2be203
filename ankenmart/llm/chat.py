"""Chat texts for training, reconstructed from a log of events.

A log has, for each conversation, events in the order of their sequence numbers. ``open`` begins a message of a
role, ``delta`` adds a piece of streamed text, ``edit`` puts a text in place of all before, ``regenerate``
empties the message and discards what all later messages had by then. Messages are numbered in their order.

The log is partitioned by conversation once. The events of a message are sorted by sequence and folded: what
counts of them is what comes after the last edit, and after the last regeneration of the message or one before
it, a running maximum. Messages are then rendered and read back, all with DataFrame functions. A conversation
ends as one text, so its final messages meet in one row; that row, of 2 GB at most, bounds a conversation.

The template marks turns as ``<s>text</s>`` for the role that is learnt and ``[INST]role, line end, text[/INST]``
for others, the role URL-encoded. Inside texts a control string gets a backslash after its first sign, one more
if it has some, so the escape can be undone. The loss mask gives for each turn the characters before, inside
and after the loss; they add up to the text.

Cases: a null text or role is empty; a null conversation is one of its own; an event that comes again under its
sequence number counts once, events of one number that differ count in the order of their kinds and texts; events without a number
come first and go with the first edit or regeneration; an empty log gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, DELTA, EDIT, REGENERATE = "open", "delta", "edit", "regenerate"
LEARNT = "assistant"

# The template. A control string, as it stands and with backslashes in it.
_CONTROL = r"(<)(\\*/?s>)|(\[)(\\*/?INST\])"
_ESCAPED = r"(<)\\(\\*/?s>)|(\[)\\(\\*/?INST\])"
_TURN = r"(?s)<s>.*?</s>|\[INST\].*?\[/INST\]"
_BEFORE, _AFTER = ("<s>", "</s>"), ("[INST]", "[/INST]")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1$3\\$2$4")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"$1$3$2$4")


def reconstruct(log: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """conversation, message, role and text of each final message, from the columns conversation, sequence,
    message, kind, role and text of a log."""
    seq, kind = F.col("sequence"), F.col("kind")
    event = F.struct("sequence", "kind", F.coalesce("text", F.lit("")).alias("text"))
    messages = (
        log.repartition(F.col(conversation))
        .groupBy(conversation, "message")
        .agg(
            F.max(F.when(kind == REGENERATE, seq)).alias("_regenerated"),
            F.max(F.when(kind == EDIT, seq)).alias("_edited"),
            F.max(F.when(F.col("role").isNotNull(), F.struct("sequence", "role"))).alias("_role"),
            F.array_sort(F.collect_set(event)).alias("_events"),
        )
    )
    so_far = Window.partitionBy(conversation).orderBy("message").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cut = F.greatest("_edited", F.max("_regenerated").over(so_far))
    counting = F.filter("_events", lambda e: F.col("_cut").isNull() | (e["sequence"] >= F.col("_cut")))
    text = F.array_join(F.transform("_counting", lambda e: F.when(e["kind"].isin(DELTA, EDIT), e["text"]).otherwise("")), "")
    return (
        messages.withColumn("_cut", cut)
        .withColumn("_counting", counting)
        .where(F.size("_counting") > 0)
        .select(conversation, "message", F.coalesce("_role.role", F.lit("")).alias("role"), text.alias("text"))
    )


def render(messages: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """conversation, formatted and mask (before, inside and after the loss, of each turn) of each conversation."""
    learnt, body = F.col("role") == LEARNT, escaped(F.col("text"))
    before = F.when(learnt, F.lit(_BEFORE[0])).otherwise(F.concat(F.lit(_AFTER[0]), F.url_encode("role"), F.lit("\n")))
    after = F.when(learnt, F.lit(_BEFORE[1])).otherwise(F.lit(_AFTER[1]))
    rows = messages.select(conversation, "message", before.alias("before"), body.alias("body"), after.alias("after"), learnt.alias("learnt"))
    lengths = [F.char_length(c).cast("long") for c in ("before", "body", "after")]
    # All of a turn that is not learnt lies before a loss of no characters.
    mask = F.when(F.col("learnt"), F.struct(*[n.alias(c) for n, c in zip(lengths, ("before", "inside", "after"))])).otherwise(
        F.struct(sum(lengths[1:], lengths[0]).alias("before"), F.lit(0).cast("long").alias("inside"), F.lit(0).cast("long").alias("after"))
    )
    turn = F.struct("message", F.concat("before", "body", "after").alias("part"), mask.alias("mask"))
    grouped = rows.groupBy(conversation).agg(F.array_sort(F.collect_list(turn)).alias("_turns"))
    return grouped.select(
        conversation,
        F.array_join(F.transform("_turns", lambda t: t["part"]), "").alias("formatted"),
        F.transform("_turns", lambda t: t["mask"]).alias("mask"),
    )


def read_back(rendered: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """conversation, formatted, turns (role and text of each) and loss (the texts under the mask, in order), from
    the formatted text and its mask alone. A mask that does not fit the turns is an error."""

    def fits(part: Column, mask: Column) -> Column:
        return F.char_length(part) == mask["before"] + mask["inside"] + mask["after"]

    def turn(part: Column) -> Column:
        inner = F.substring(part, F.lit(len(_AFTER[0]) + 1), F.char_length(part) - sum(map(len, _AFTER)))
        role = F.substring_index(inner, "\n", 1)
        text = F.substring(inner, F.char_length(role) + 2, F.char_length(inner))
        body = F.substring(part, F.lit(len(_BEFORE[0]) + 1), F.char_length(part) - sum(map(len, _BEFORE)))
        learnt = part.startswith(_BEFORE[0])
        return F.struct(
            F.when(learnt, F.lit(LEARNT)).otherwise(F.url_decode(role)).alias("role"),
            unescaped(F.when(learnt, body).otherwise(text)).alias("text"),
        )

    parts = rendered.withColumn("_parts", F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(0)))
    fit = (F.size("_parts") == F.size("mask")) & F.forall(F.zip_with("_parts", "mask", fits), lambda x: x)
    inside = F.zip_with(
        "_parts", "mask", lambda p, m: unescaped(F.substring(p, (m["before"] + 1).cast("int"), m["inside"].cast("int")))
    )
    return parts.select(
        conversation,
        "formatted",
        F.transform("_parts", turn).alias("turns"),
        F.when(fit, F.array_join(inside, "")).otherwise(F.raise_error(F.lit("the loss mask does not fit the turns"))).alias("loss"),
    )
