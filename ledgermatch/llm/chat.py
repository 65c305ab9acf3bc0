"""Chat formatting with a grammar round trip, in DataFrame operations only.

Grammar (marks are the control strings):

    conversation := turn*
    turn         := "<s>" text "</s>"                  role ``assistant``
                  | "[INST]" role "\\n" text "[/INST]"  any other role, URL-encoded

Inside texts a control string gets a backslash after its first character, and
one more if it has backslashes there already, so unescaping is exact.

Each turn is first rendered as it is and reparsed by the strict parser, which
allows no control string (plain or escaped) inside a text. A turn whose
recovered text is not its source is escaped. The assembled conversation is
then reparsed as a whole and compared with the source turns; a conversation
that still differed would end the job with an error instead of being written.

Defined results: null texts and null roles are empty; turns are ordered by
(turn, role, text) with nulls first, so ties and repeated rows have one order
and every row is a turn. A null conversation id is a conversation of its own.
Empty tables give empty tables; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template.
USER_OPEN, USER_CLOSE, LOSS_OPEN, LOSS_CLOSE = "[INST]", "[/INST]", "<s>", "</s>"
CONTROL = r"(<|\[)(\\*)(/?s>|/?INST\])"             # plain or escaped control string
MARK = r"</?s>|\[/?INST\]"
ESCAPED = r"(<|\[)\\(\\*)(/?s>|/?INST\])"
TURN = r"(?s)\[INST\]([^\n]*)\n(.*?)\[/INST\]|<s>(.*?)</s>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _render(role: Column, body: Column) -> Column:
    return F.when(role == LOSS_ROLE, F.concat(F.lit(LOSS_OPEN), body, F.lit(LOSS_CLOSE))).otherwise(
        F.concat(F.lit(USER_OPEN), F.url_encode(role), F.lit("\n"), body, F.lit(USER_CLOSE)))


def _parsed(formatted: str) -> Column:
    """Strict parse of a formatted column: array of (role, body, raw); null
    where marks and turns do not pair up or something is left over."""
    whole = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))
    roles = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(1))
    plain = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(2))
    loss = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(3))
    turns = F.transform(F.arrays_zip(whole.alias("raw"), roles.alias("role"), plain.alias("plain"), loss.alias("loss")),
                        lambda t: F.struct(
                            F.when(F.startswith(t["raw"], F.lit(LOSS_OPEN)), F.lit(LOSS_ROLE))
                             .otherwise(F.url_decode(t["role"])).alias("role"),
                            F.when(F.startswith(t["raw"], F.lit(LOSS_OPEN)), t["loss"]).otherwise(t["plain"]).alias("body"),
                            t["raw"].alias("raw")))
    strict = ((F.regexp_count(F.col(formatted), F.lit(MARK)) == 2 * F.size(whole))
              & (F.array_join(whole, "") == F.col(formatted)))
    return F.when(strict, turns)


def render(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(``conv_col``, formatted string): one row per conversation."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    turns = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    # A turn alone: raw, reparsed, and escaped where it does not come back.
    raw = turns.withColumn("raw", _render(F.col("role"), F.col("text")))
    back = raw.withColumn("back", _parsed("raw"))
    same = ((F.size("back") == 1) & (F.col("back")[0]["role"] == F.col("role"))
            & (unescape(F.col("back")[0]["body"]) == F.col("text")))
    turn = back.select("conv", "turn", "role", "text",
                       F.when(F.coalesce(same, F.lit(False)), F.col("raw"))
                       .otherwise(_render(F.col("role"), escape(F.col("text")))).alias("out"))
    # One group is one conversation: it becomes one text in any case.
    whole = (turn.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "out"))).alias("turns"))
             .withColumn("formatted", F.array_join("turns.out", ""))
             .withColumn("back", _parsed("formatted")))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    again = F.transform("back", lambda t: F.struct(t["role"].alias("role"), unescape(t["body"]).alias("text")))
    checked = F.when(F.coalesce(again == source, F.lit(False)), F.col("formatted")).otherwise(
        F.raise_error(F.lit("a formatted conversation does not read back as its source")))
    return whole.select(F.col("conv").alias(conv_col), checked.alias("formatted"))


def read_back(rendered: DataFrame, formatted_col: str = "formatted") -> DataFrame:
    """``rendered`` with ``turns`` array<(role, text, loss, start, length)>:
    the parsed turns, whether they are under the loss mask, and where their
    (escaped) body lies in the formatted text, in code points from 0."""
    parsed = rendered.withColumn("__p", _parsed(formatted_col))
    # Offsets: running sum of the raw lengths.
    ends = F.aggregate(F.col("__p"), F.array(F.lit(0)),
                       lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + F.char_length(t["raw"]))))
    placed = parsed.withColumn("__e", ends)
    turns = F.transform("__p", lambda t, i: F.struct(
        t["role"].alias("role"), unescape(t["body"]).alias("text"),
        F.startswith(t["raw"], F.lit(LOSS_OPEN)).alias("loss"),
        (F.get(F.col("__e"), i) + F.char_length(t["raw"]) - F.char_length(t["body"])
         - F.when(F.startswith(t["raw"], F.lit(LOSS_OPEN)), len(LOSS_CLOSE)).otherwise(len(USER_CLOSE))).alias("start"),
        F.char_length(t["body"]).alias("length")))
    return placed.withColumn("turns", turns).drop("__p", "__e")


def digests(conversations: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from the formatted text: n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    back = read_back(render(conversations, conv_col))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    # The text under the mask, cut out of the formatted text by its spans.
    masked = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: unescape(
        F.substring(F.col("formatted"), t["start"] + 1, t["length"]))), "")
    return (back.withColumn("loss_text", masked).select(
        conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars")))
