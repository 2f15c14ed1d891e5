"""Multi-party perspective rotation of conversations, with DataFrame functions only.

For every participant of a conversation - every role that speaks but ``system`` -
the dialogue is rendered with that speaker as the assistant and all others as
users with their names; system turns stay.  The mask has the spans of characters
that the speaker said, end mark included, and nothing else.

Names and texts cannot forge a mark: between ``<`` and ``|``, and in names between
``|`` and ``>``, one backslash is added, however many stand there, so a reader
takes one away.

A rendering is one sequence of characters, whatever its length.  It is returned in
pieces, because a row cannot hold a conversation of any length: turns that begin
within the same ``PIECE_CHARS`` characters (as if all were users) form a piece, and
nearly every conversation is one piece.  Pieces in order, joined, are the
rendering; ``start`` and the spans count characters from its beginning, so a piece
neither repeats nor restarts anything.  Turns are put into order by a range
partitioning of all rows, and each range's characters and turns are summed before
they are carried onward, so no task sorts or holds a conversation.

Defined results: turns are ordered by number, then role, then text, with nulls
first, whatever the numbers are; a null role is the speaker ``unknown``; a null
text is empty; a very long text is in one piece with the turns before it; repeated
turns are rendered each; a null conv_id is a conversation; a conversation with
system turns only has no participant and so no row; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

PIECE_CHARS = 1 << 18
SYSTEM = "system"
BEGIN, END = "<|", "<|end|>\n"


def escaped_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_name(name: Column) -> Column:
    return F.regexp_replace(escaped_text(name), r"\|(\\*)>", r"|\\$1>")


def _own_head() -> Column:
    return F.lit(BEGIN + "assistant|>\n")


def _other_head(role: Column) -> Column:
    """The line before a turn of one who is not the assistant: ``<|system|>`` or ``<|user name=...|>``."""
    return F.when(role == SYSTEM, F.lit(BEGIN + "system|>\n")).otherwise(F.concat(F.lit(BEGIN + "user name="), escaped_name(role), F.lit("|>\n")))


def placed(conversations: DataFrame) -> DataFrame:
    """Every turn with its number ``k`` in its conversation, and ``at``, the characters before it if all were users."""
    role = F.coalesce(F.col("role").cast("string"), F.lit("unknown"))
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = turns.withColumn("head", _other_head(F.col("role"))).withColumn("said", F.concat(escaped_text(F.col("text")), F.lit(END)))
    turns = turns.withColumn("copy", F.monotonically_increasing_id())  # so that a turn that is repeated without end is spread, too
    order = ["conv_id", "turn", "role", "text", "copy"]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    sized = ranged.select("conv_id", "role", "head", "said", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("place"), (F.length("head") + F.length("said")).cast("long").alias("size"))
    sized = stored(sized, "turns")
    # The last range of a conversation and the first of the next may be one partition: both are keys here.
    ranges = sized.groupBy("conv_id", "range").agg(F.sum("size").alias("chars"), F.count("*").alias("n"))
    onward = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("conv_id").alias("__conv"), F.col("range").alias("__range"), F.coalesce(F.sum("chars").over(onward), F.lit(0)).alias("chars"), F.coalesce(F.sum("n").over(onward), F.lit(0)).alias("n"))
    inside = Window.partitionBy("conv_id", "range").orderBy("place")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    counted = sized.select("conv_id", "range", "role", "head", "said", (F.row_number().over(inside) - 1).alias("own_k"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("own_at"))
    joined = counted.join(ranges, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("range") == F.col("__range")))
    return joined.select("conv_id", "role", "head", "said", (F.col("own_k") + F.col("n")).cast("long").alias("k"), (F.col("own_at") + F.col("chars")).cast("long").alias("at"))


def rotated(conversations: DataFrame, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """conv_id, speaker, piece, start, n_turns, n_own, rendered and mask_spans (start and end of each own turn's text) of every participant's pieces."""
    turns = stored(placed(conversations).withColumn("piece", F.floor(F.col("at") / piece_chars).cast("long")), "placed")
    pieces = turns.groupBy("conv_id", "piece").agg(F.sort_array(F.collect_list(F.struct("k", "at", "role", "head", "said"))).alias("turns"))
    # A speaker's own turns before a piece, as counts by piece, shift what follows them by the difference of the two heads.
    said = turns.filter(F.col("role") != SYSTEM).groupBy("conv_id", "role", "piece").agg(F.count("*").alias("n"), F.first("head").alias("head"))
    speakers = said.groupBy("conv_id", F.col("role").alias("speaker")).agg((F.length(_own_head()) - F.length(F.first("head"))).cast("long").alias("shift"), F.map_from_entries(F.collect_list(F.struct("piece", "n"))).alias("by_piece"))
    speakers = speakers.select(F.col("conv_id").alias("__conv"), "speaker", "shift", "by_piece")
    each = pieces.join(speakers, F.col("conv_id").eqNullSafe(F.col("__conv")))
    speaker, zero = F.col("speaker"), F.lit(0).cast("long")
    earlier = F.aggregate(F.map_values(F.map_filter("by_piece", lambda p, _: p < F.col("piece"))), zero, lambda a, n: a + n)
    shown = each.select("conv_id", "speaker", "piece", "shift", earlier.alias("earlier"), F.transform("turns", lambda t: F.struct((t["role"] == speaker).alias("own"), t["at"].alias("at"), F.when(t["role"] == speaker, _own_head()).otherwise(t["head"]).alias("head"), t["said"].alias("said"))).alias("turns"))
    own = F.filter("turns", lambda t: t["own"])
    shifted = lambda at, n: at + F.col("shift") * (F.col("earlier") + n)
    text_at = lambda t, i: shifted(t["at"], i) + F.length(t["head"])  # noqa: E731  i own turns of the piece come before
    spans = F.transform(own, lambda t, i: F.struct(text_at(t, i).cast("long").alias("start"), (text_at(t, i) + F.length(t["said"])).cast("long").alias("end")))
    rendered = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["said"])), "")
    return shown.select(
        "conv_id", "speaker", "piece", shifted(F.get("turns", F.lit(0))["at"], zero).cast("long").alias("start"),
        F.size("turns").cast("long").alias("n_turns"), F.size(own).cast("long").alias("n_own"), rendered.alias("rendered"), spans.alias("mask_spans"),
    )


def flat(rotations: DataFrame) -> DataFrame:
    """Rotations with the spans as text: ``start:end`` joined by commas."""
    shown = F.array_join(F.transform("mask_spans", lambda s: F.concat(s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")
    return rotations.withColumn("mask_spans", shown)
