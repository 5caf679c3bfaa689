"""Chat formatting with prefix-target expansion, in built-in functions only.

Every assistant turn becomes an example of its own: all turns before it are
context, and only that reply is trainable. Control strings inside texts are
escaped reversibly, so turns and replies can be read back from the formatted
text alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the markers of the template
START, END = "<|im_start|>", "<|im_end|>"
#: Escaping doubles backslashes and puts one inside every ``<|``, so escaped
#: text never holds a marker, and one pass of ``\\x -> x`` undoes it.
_UNESCAPE = r"(?s)\\(.)"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1")


def format_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escape(role), F.lit("\n"), escape(text), F.lit(f"{END}\n"))


def conversations_of(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row for each conversation: conv_id and its turns in order.

    Turns are sorted by number, ties by role, then text; null numbers come
    first; null roles and texts count as empty.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def expand(turns: DataFrame, **columns: str) -> DataFrame:
    """Examples of all conversations: conv_id, example, trainable, text, loss_start, loss_end.

    ``text`` is the formatted context with the target turn; the escaped reply at
    code points ``[loss_start, loss_end)`` is what trains. Turns after the last
    reply, or a conversation without one, give one more example with
    ``trainable`` false and an empty loss range, so that no turn is lost.
    Repeated rows are turns of their own; a null conv_id is a conversation;
    empty tables give no examples; other columns are ignored.
    """
    spoken = conversations_of(turns, **columns).select("conv_id", F.col("turns.role").alias("roles__"), F.transform("turns", lambda t: format_turn(t["role"], t["text"])).alias("pieces__"))
    places = F.filter(F.sequence(F.lit(1), F.size("roles__")), lambda i: (F.get("roles__", i - 1) == "assistant") | (i == F.size("roles__")))
    exploded = spoken.select("conv_id", "roles__", "pieces__", F.posexplode(places).alias("example", "upto__"))
    target = F.get("pieces__", F.col("upto__") - 1)
    role = F.get("roles__", F.col("upto__") - 1)
    context = F.array_join(F.slice("pieces__", 1, F.col("upto__") - 1), "")
    trainable = role == "assistant"
    made = exploded.select("conv_id", "example", trainable.alias("trainable"), context.alias("context__"), target.alias("target__"), (F.length(escape(role)) + len(START) + 1).alias("head__"))
    start = F.length("context__") + F.col("head__")
    stop = F.length("context__") + F.length("target__") - len(END) - 1
    return made.select("conv_id", "example", "trainable", F.concat("context__", "target__").alias("text"), F.when(F.col("trainable"), start).otherwise(F.lit(0)).alias("loss_start"), F.when(F.col("trainable"), stop).otherwise(F.lit(0)).alias("loss_end"))


def read_turns(text: Column) -> Column:
    """The turns in a formatted text, as an array of (role, text)."""
    bodies = F.transform(F.split(text, r"<\|im_start\|>", -1), lambda x: F.substring_index(x, END, 1))
    return F.transform(F.slice(bodies, 2, F.size(bodies) - 1), lambda x: F.struct(unescape(F.substring_index(x, "\n", 1)).alias("role"), unescape(F.substr(x, F.instr(x, "\n") + 1)).alias("text")))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, what the formatted examples hold.

    Turns are read from the longest example, replies from the loss ranges.
    Examples carry their digest parts on, not their texts, so the shuffle moves
    each conversation once.
    """
    loss = F.when(F.col("trainable"), unescape(F.substr("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))).otherwise(F.lit(""))
    per = examples.select("conv_id", "example", F.length("text").alias("chars"), loss.alias("loss"), "text")
    whole = F.transform(read_turns(F.col("text__")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    grouped = per.groupBy("conv_id").agg(F.sum("chars").alias("formatted_chars"), F.count(F.lit(1)).alias("n_examples"), F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("losses__"), F.max_by("text", "example").alias("text__"))
    joined = grouped.select("conv_id", "formatted_chars", "n_examples", whole.alias("whole__"), F.array_join("losses__.loss", "").alias("loss__"))
    return joined.select(
        "conv_id", F.size("whole__").cast("long").alias("n_turns"), F.sha2(F.encode(F.array_join("whole__", ""), "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss__").cast("long").alias("loss_chars"), F.sha2(F.encode("loss__", "UTF-8"), 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"), "n_examples",
    )
