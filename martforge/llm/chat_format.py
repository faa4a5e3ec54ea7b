"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of a formatted conversation (``role`` and ``text`` contain none of the four control
strings):

    conversation := turn*
    turn         := "<s>[INST]" role "[/INST]" text "</s>"

A turn is first rendered with its content as it is, reparsed with the same deterministic parser
that reads the output, and compared with its source. Content that does not come back is escaped
(one backslash is put after the first character of every control string in it) and the turn is
rendered and compared again. One escape always suffices: it leaves no control string in the
content, the parser takes one backslash out of each such place, and no control string can arise
across a border, because every marker starts with a character that ends none of the control
strings' proper prefixes and ends with one that starts none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, HEAD, CLOSE = "<s>[INST]", "[/INST]", "</s>"

#: Control strings with escape marks (backslashes) inside: any number, or at least one.
_TAGGED = (r"(<)(\\*)(/?s>)", r"(\[)(\\*)(/?INST\])")
_MARKED = (r"(<)\\(\\*)(/?s>)", r"(\[)\\(\\*)(/?INST\])")


def escape(content: Column) -> Column:
    """Put one more backslash into every control string, escaped ones included."""
    for pattern in _TAGGED:
        content = F.regexp_replace(content, pattern, r"$1\\$2$3")
    return content


def unescape(content: Column) -> Column:
    """Inverse of :func:`escape`; leaves content without escape marks as it is."""
    for pattern in _MARKED:
        content = F.regexp_replace(content, pattern, "$1$2$3")
    return content


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(HEAD), text, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation: array of (role, text), unescaped. Null if it breaks the grammar.

    The closing marker splits the text, and in each piece the first header marker ends the role.
    """
    pieces = F.split(formatted, CLOSE, -1)
    body = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, len(OPEN) + 1, 2147483647)
        role = F.substring_index(inner, HEAD, 1)
        text = F.substring(inner, F.length(role) + len(HEAD) + 1, F.lit(2147483647))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    def sound(piece: Column) -> Column:
        return (piece.startswith(OPEN)
                & (F.size(F.split(piece, r"<s>|\[INST\]", -1)) == 3)
                & (F.size(F.split(piece, r"\[/INST\]", -1)) == 2))

    ok = (F.element_at(pieces, -1) == "") & F.forall(body, sound)
    return F.when(ok, F.transform(body, turn))


def render_checked(role: Column, text: Column) -> Column:
    """Rendered turn that parses back to (role, text): as it is where that works, else escaped."""
    wanted = F.array(F.struct(role.alias("role"), text.alias("text")))
    plain = render(role, text)
    return F.when(F.coalesce(parse(plain) == wanted, F.lit(False)), plain).otherwise(render(escape(role), escape(text)))


def format_conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted (string), turns (array of (role, text) as given).

    Rows are ordered by turn, then role and text (nulls first), so that ties and repeated rows give
    one result; a repeated row is a repeated turn. Null role and null text are empty; a null conv_id
    is a conversation of its own; an empty table gives no rows. Only the four columns are read.
    A conversation is one string by definition, so its rows meet in one row; turns are rendered and
    checked before that.
    """
    r = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                    F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    r = r.withColumn("out", render_checked(F.col("role"), F.col("text")))
    one = r.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "out"))).alias("t"))
    return one.select(
        "conv_id",
        F.array_join(F.transform("t", lambda x: x["out"]), "").alias("formatted"),
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def read_back(formatted: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """Reparse ``formatted`` and digest what the parser recovers.

    Returns conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, same_turns
    (whether the parser's turns equal ``turns``). The loss mask covers the texts of ``learn_role``.
    """
    turns, loss = F.col("_parsed"), F.col("_loss")
    return (formatted.withColumn("_parsed", parse(F.col("formatted")))
            .withColumn("_loss", F.array_join(F.transform(F.filter(turns, lambda x: x["role"] == learn_role), lambda x: x["text"]), ""))
            .select("conv_id", F.size(turns).cast("long").alias("n_turns"),
                    F.sha2(F.array_join(F.transform(turns, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
                    F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"),
                    F.coalesce(turns == F.col("turns"), F.lit(False)).alias("same_turns")))
