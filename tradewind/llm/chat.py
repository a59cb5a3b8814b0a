"""Chat formatting with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.rows import stored

START, END, NEXT, BREAK = "<|im_start|>", "<|im_end|>", "<|im_next|>", "<|im_break|>"
LEARNED = "assistant"
# Turns of one part; conversations of more are formatted in several.
PART_TURNS = 128


def escaped(text: Column) -> Column:
    """No control string is left: each ``<``, backslashes, ``|`` gets one more backslash."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    """The inverse of :func:`escaped`."""
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _split(text: Column, control: str) -> Column:
    return F.split(text, control.replace("|", "\\|"), -1)


def _joined(parts: Column) -> Column:
    return F.array_join(parts, "")


def merged_turns(turns: Column) -> Column:
    """Sorted turns with adjacent ones of a role made one: array of (role, texts)."""
    kind = "array<struct<role:string,texts:array<string>>>"

    def add(done: Column, turn: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        rest = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        grown = F.struct(
            last["role"].alias("role"),
            F.concat(last["texts"], F.array(turn["text"])).alias("texts"),
        )
        fresh = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        goes_on = (F.size(done) > 0) & (last["role"] == turn["role"])
        return F.when(goes_on, F.concat(rest, F.array(grown))).otherwise(
            F.concat(done, F.array(fresh))
        )

    return F.aggregate(turns, F.array().cast(kind), add)


def _pieces(merged: Column, goes_on: Column) -> Column:
    """Every text with the marks before it: array of (mark, body, learned).

    ``goes_on`` says that the first turn was opened by the part before.
    """

    def of_turn(turn: Column, i: Column) -> Column:
        head = F.concat(F.lit(START), turn["role"], F.lit("\n"))
        opening = (
            F.when((i == 0) & goes_on, F.lit(NEXT))
            .when(i == 0, head)
            .otherwise(F.concat(F.lit(END + "\n"), head))
        )
        return F.transform(
            turn["texts"],
            lambda text, j: F.struct(
                F.when(j == 0, opening).otherwise(F.lit(NEXT)).alias("mark"),
                text.alias("body"),
                (turn["role"] == LEARNED).alias("learned"),
            ),
        )

    return F.flatten(F.transform(merged, of_turn))


def _learned_spans(pieces: Column) -> Column:
    """Code point spans of the learned texts, end exclusive."""
    kind = "struct<at:long,spans:array<struct<start:long,end:long>>>"

    def add(done: Column, piece: Column) -> Column:
        start = done["at"] + F.length(piece["mark"])
        end = start + F.length(piece["body"])
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(
            end.alias("at"),
            F.when(piece["learned"], F.concat(done["spans"], F.array(span)))
            .otherwise(done["spans"])
            .alias("spans"),
        )

    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().alias("spans")).cast(kind)
    return F.aggregate(pieces, nothing, add, lambda done: done["spans"])


def formatted(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Conversations as marked text with a loss mask, in parts of bounded length.

    One row per part: ``conv_id``, ``part`` (ascending, from 0 where there is one only),
    ``parts`` (false where the conversation has this one only), ``role_before`` (the role
    whose turn this part goes on with; null if it opens a turn), ``text``, and ``loss``: the code point
    spans of ``text`` that are learned, one for every assistant text. The texts of a
    conversation's parts, one behind the other, are the conversation's.

    Turns stand in order of ``turn``, nulls first; of equal ones by role and text. Adjacent turns
    of one role become one turn whose texts are divided by a control string, so that they can be
    told apart again. A null text or role is empty; rows without conv_id form one conversation;
    repeated rows stay. Control strings within texts and roles are escaped, line breaks in roles
    too; :func:`read_back` undoes it. Columns other than conv_id, turn, role and text are not
    carried, so none clashes. An empty table gives an empty table. Very long texts are kept
    whole.

    Rows are shuffled once, to the tasks that sort and join the texts of a part. A conversation
    of more than ``part_turns`` turns, such as one with a third of all rows, is dealt by ranges
    of the turn number, so that only equal turn numbers have to meet. Where the parts meet
    in a turn is found from roles alone.
    """
    turns = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        "text",
    ).withColumn("range", F.floor(F.col("turn") / part_turns).cast("long"))
    edges = stored(_edges(turns, part_turns), "chat-edges")
    of_part = F.col("conv_id").eqNullSafe(F.col("edge_conv")) & F.col("range").eqNullSafe(
        F.col("edge_range")
    )
    placed = turns.join(edges, of_part, "left").select(
        "conv_id",
        F.coalesce("part", F.lit(0).cast("long")).alias("part"),
        F.col("part").isNotNull().alias("parts"),
        "role_before",
        "role_after",
        F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text")).alias("one"),
    )
    sorted_turns = placed.groupBy("conv_id", "part", "parts", "role_before", "role_after").agg(
        F.sort_array(F.collect_list("one")).alias("turns")
    )
    escaped_turns = F.transform(
        "turns",
        lambda t: F.struct(
            F.replace(escaped(t["role"]), F.lit("\n"), F.lit(BREAK)).alias("role"),
            escaped(t["text"]).alias("text"),
        ),
    )
    first, last = F.element_at("turns", 1)["role"], F.element_at("turns", -1)["role"]
    goes_on = F.col("role_before").eqNullSafe(first)
    left_open = F.col("role_after").eqNullSafe(last)
    return (
        sorted_turns.withColumn("before", F.when(goes_on, F.col("role_before")))
        .withColumn("closing", F.when(left_open, "").otherwise(END + "\n"))
        .withColumn("merged", merged_turns(escaped_turns))
        .withColumn("pieces", _pieces(F.col("merged"), F.col("before").isNotNull()))
        .select(
            "conv_id",
            "part",
            "parts",
            F.col("before").alias("role_before"),
            F.concat(
                _joined(F.transform("pieces", lambda p: F.concat(p["mark"], p["body"]))),
                "closing",
            ).alias("text"),
            _learned_spans(F.col("pieces")).alias("loss"),
        )
    )


def _edges(turns: DataFrame, part_turns: int) -> DataFrame:
    """The ranges of long conversations, with the roles just before and behind each.

    Texts are not read. A long conversation gives one row per range to the ordering, not its turns.
    """
    long_ones = (
        turns.groupBy("conv_id")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > part_turns)
        .select(F.col("conv_id").alias("edge_conv"))
    )
    at = F.struct("turn", "role")
    ranges = (
        turns.select("conv_id", "turn", "role", "range")
        .groupBy("conv_id", "range")
        .agg(F.min(at)["role"].alias("first"), F.max(at)["role"].alias("last"))
        .join(long_ones, F.col("conv_id").eqNullSafe(F.col("edge_conv")))
    )
    in_order = Window.partitionBy("conv_id").orderBy(F.col("range").asc_nulls_first())
    return ranges.select(
        "edge_conv",
        F.col("range").alias("edge_range"),
        (F.row_number().over(in_order) - 1).cast("long").alias("part"),
        F.lag("last").over(in_order).alias("role_before"),
        F.lead("first").over(in_order).alias("role_after"),
    )


def read_back(parts: DataFrame) -> DataFrame:
    """Parts of :func:`formatted` with ``turns``, array of (role, text), and ``learned``, the
    texts under the loss mask, both unescaped and read from ``text`` and ``loss``."""
    blocks = _split(F.col("text"), START)

    def of_block(block: Column, i: Column) -> Column:
        marked = F.substring_index(block, "\n", 1)
        # What stands before the first mark goes on with a turn: a divider, then its texts.
        body = F.when(i == 0, F.substr(block, F.lit(len(NEXT) + 1))).otherwise(
            F.substr(block, F.length(marked) + 2)
        )
        role = unescaped(F.replace(marked, F.lit(BREAK), F.lit("\n")))
        plain = F.when(i == 0, F.col("role_before")).otherwise(role)
        return F.transform(
            _split(F.substring_index(body, END, 1), NEXT),
            lambda text: F.struct(plain.alias("role"), unescaped(text).alias("text")),
        )

    opened = F.when(
        F.col("role_before").isNull(), F.slice(F.transform(blocks, of_block), 2, F.size(blocks))
    ).otherwise(F.transform(blocks, of_block))
    learned = F.transform(
        "loss",
        lambda s: unescaped(
            F.substr(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        ),
    )
    return parts.withColumns({"turns": F.flatten(opened), "learned": learned})


def digests(read: DataFrame) -> DataFrame:
    """One row per conversation: counts and digests over its turns, learned texts and marked text.

    Parts of :func:`read_back`. A conversation in one part is digested where it is; only the texts of those in
    several are brought together, as a digest takes the whole text.
    """
    told = _joined(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    )
    learned = _joined(F.col("learned"))
    whole = F.struct(
        "part",
        F.size("turns").cast("long").alias("n"),
        F.length(learned).cast("long").alias("loss"),
        F.length("text").cast("long").alias("chars"),
        F.when(F.col("parts"), told).otherwise(F.sha2(told, 256)).alias("told"),
        F.when(F.col("parts"), learned).otherwise(F.sha2(learned, 256)).alias("learned"),
    )

    def total(name: str) -> Column:
        return F.aggregate(
            F.col("all")[name], F.lit(0).cast("long"), lambda done, n: done + n
        )

    def digest(name: str) -> Column:
        joined = _joined(F.col("all")[name])
        return F.when(F.col("parts"), F.sha2(joined, 256)).otherwise(joined)

    return (
        read.select("conv_id", "parts", whole.alias("one"))
        .groupBy("conv_id", "parts")
        .agg(F.sort_array(F.collect_list("one")).alias("all"))
        .select(
            "conv_id",
            total("n").alias("n_turns"),
            digest("told").alias("turns_sha256"),
            total("loss").alias("loss_chars"),
            digest("learned").alias("loss_sha256"),
            total("chars").alias("formatted_chars"),
        )
    )
