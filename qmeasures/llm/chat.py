r"""Operator 12: chat formatting with a grammar round trip (DataFrame functions only).

Template, one text per conversation:

    conversation = "<s>" turn*
    turn         = "<<SYS>>" body "<</SYS>>"                system
                 | "[INST] " body " [/INST]"                user
                 | " " body "</s>"                          assistant
                 | "[ROLE]" body "[/ROLE] " body "</s>"     any other role

A body holds no bare control string (``<s> </s> [INST] [/INST] [ROLE] [/ROLE] <<SYS>>
<</SYS>>``).  A control string with backslashes after its first character stands for
the one with a backslash less.  The parser cuts the text behind every closing string and
reads each piece by its ends; a piece that fits no rule, or a body with a bare
control string, has no reading.

Turns are first rendered as they are and read back.  Where the reading differs from the
source, the control strings of the turn's text and role get a backslash more.  No bare
one is left then and reading takes the backslash away again, so this second rendering
is always identical and the repetition ends.  The assembled conversation is read back as a
whole; a difference there would end the job.

The loss mask is a list of code point ranges of the formatted text, one for each
turn: ``loss_start`` and ``loss_end`` are null except for assistant bodies.

Defined results: a null text or role is read as empty; an empty role is another role
like any; turns are ordered by turn, then role, then text (nulls first), so ties and
repeated rows keep one order; a null conversation id is a conversation of its own;
an empty table gives no rows; extra columns are ignored.  A conversation is one
string and one row of the result, so it must fit Spark's limit of 2 GB a string;
conversations are formatted side by side, the escapes turn by turn before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BOS = "<s>"
#: Opening and closing string of each known role.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>")}
OTHER = ("[ROLE]", "[/ROLE] ", "</s>")

#: A control string, its backslashes included, from behind its first character on.
_REST = r"(?:\[(?=%s/?(?:INST|ROLE)\])|<(?=%s(?:/?s>|</?SYS>>)))"
_BARE, _ANY, _ESCAPED = _REST % ("", ""), _REST % (r"\\*", r"\\*"), _REST % (r"\\+", r"\\+")
_CLOSINGS = ("<</SYS>>", "[/INST]", "</s>")
_PIECE = r"(?s).*?(?:<</SYS>>|\[/INST\]|</s>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"({_ANY})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, f"({_ESCAPED})" + r"\\", "$1")


def render(role: Column, text: Column, told: Column | None = None) -> Column:
    """One turn by the grammar; ``told`` is the role as it is written, if it isn't a known one."""
    told = role if told is None else told
    out = F.concat(F.lit(OTHER[0]), told, F.lit(OTHER[1]), text, F.lit(OTHER[2]))
    for name, (start, end) in MARKS.items():
        out = F.when(role == name, F.concat(F.lit(start), text, F.lit(end))).otherwise(out)
    return out


def _body(text: Column) -> Column:
    return F.when(~F.rlike(text, F.lit(_BARE)), unescape(text))


def _within(piece: Column, start: str, end: str) -> Column:
    """What lies between two marks, which do not overlap; else null."""
    fits = piece.startswith(start) & piece.endswith(end) & (F.length(piece) >= len(start) + len(end))
    return F.when(fits, F.substring(piece, F.lit(len(start) + 1), F.length(piece) - (len(start) + len(end))))


def parse_turn(piece: Column) -> Column:
    """struct(role, text) of one piece; either is null where the piece has no reading."""
    pair = lambda role, text: F.struct(role.alias("role"), text.alias("text"))
    other = _within(piece, OTHER[0], OTHER[2])
    cut = F.instr(other, OTHER[1])
    role = _body(F.substring(other, F.lit(1), cut - 1))
    out = pair(F.when((cut > 0) & ~role.isin(*MARKS), role), _body(F.substring(other, cut + len(OTHER[1]), F.length(other))))
    for name, (start, end) in reversed(MARKS.items()):
        inner = _within(piece, start, end)
        out = F.when(inner.isNotNull(), pair(F.lit(name), _body(inner))).otherwise(out)
    return out


def pieces(formatted: Column) -> Column:
    """The turns of a formatted conversation as text; null if the text does not open or close as it must."""
    inner = F.substring(formatted, F.lit(len(BOS) + 1), F.length(formatted))
    whole = inner == ""
    for closing in _CLOSINGS:
        whole |= inner.endswith(closing)
    # every piece starts where the one before ends, so with a closing at the end nothing is left over
    return F.when(formatted.startswith(BOS) & whole, F.regexp_extract_all(inner, F.lit(_PIECE), F.lit(0)))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    return F.transform(pieces(formatted), parse_turn)


def format_chats(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """conv_id, formatted, spans: array of (start, end, loss_start, loss_end) of the turns."""
    col = lambda name: F.col(f"`{name}`")
    turns = rows.select(col(conv_col).alias("conv_id"), col(turn_col).alias("turn"),
                        F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    plain = render(F.col("role"), F.col("text"))
    escaped = render(F.col("role"), escape(F.col("text")), escape(F.col("role")))
    turns = turns.select("*", plain.alias("plain")).select("*", F.when(
        parse_turn(F.col("plain")) == F.struct("role", "text"), F.col("plain")).otherwise(escaped).alias("piece"))
    # one shuffle: places are a running sum over the rows that the next step gathers
    before = (Window.partitionBy("conv_id").orderBy("turn", "role", "text")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    end = F.sum(F.length("piece").cast("long")).over(before) + len(BOS)
    open_, close = (len(x) for x in MARKS["assistant"])
    learned = lambda at: F.when(F.col("role") == "assistant", at)
    placed = turns.select("conv_id", "role", "text", "piece", end.alias("end")).select(
        "*", (F.col("end") - F.length("piece")).alias("start")).select(
        "conv_id", F.struct("start", "role", "text", "piece", F.struct(
            "start", "end", learned(F.col("start") + open_).alias("loss_start"),
            learned(F.col("end") - close).alias("loss_end")).alias("span")).alias("turn"))
    chats = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")).select(
        "conv_id", "turns", F.concat(F.lit(BOS), F.array_join(F.col("turns.piece"), "")).alias("formatted"))
    source = F.transform("turns", lambda t: F.struct(t.role.alias("role"), t.text.alias("text")))
    return chats.select("conv_id", F.when(parse(F.col("formatted")).eqNullSafe(source), F.col("formatted")).otherwise(
        F.raise_error(F.lit("a formatted conversation does not read back as its source"))).alias("formatted"),
        F.col("turns.span").alias("spans"))


def read_chats(chats: DataFrame) -> DataFrame:
    """Counts and digests of formatted conversations, from their text and mask alone.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline of each turn), loss_chars and
    loss_sha256 (all text under the mask, unescaped), formatted_chars.  A text that
    the grammar does not read, or whose mask has another number of turns, has null digests.
    """
    def masked(piece: Column, span: Column) -> Column:
        at = span["loss_start"] - span["start"] + 1
        text = F.substring(piece, at.cast("int"), (span["loss_end"] - span["loss_start"]).cast("int"))
        return F.when(piece.isNull() | span.isNull(), F.lit(None)).otherwise(
            F.when(span["loss_start"].isNull(), F.lit("")).otherwise(unescape(text)))

    def joined(parts: Column) -> Column:  # null if a part is
        return F.when(~F.exists(parts, lambda x: x.isNull()), F.array_join(parts, ""))

    read = chats.select("conv_id", "formatted", "spans", pieces(F.col("formatted")).alias("pieces")).select(
        "conv_id", "formatted", F.transform("pieces", parse_turn).alias("turns"),
        F.zip_with("pieces", "spans", masked).alias("loss"))
    read = read.withColumn("loss", joined(F.col("loss")))
    told = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(joined(told), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
