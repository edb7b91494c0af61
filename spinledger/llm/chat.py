r"""Chat formatting by prefix-target expansion, in DataFrame operations only.

Every turn becomes ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end, and a
conversation is its turns in order. Every assistant turn is exploded into an example of its own:
all preceding turns are its context, and only the reply is trainable. The context of an example
is a prefix of the conversation. ``expanded`` writes every example with its prefix and its reply,
which the query reads back: n turns give up to n * n / 4 turns of text, by the method's nature.
Conversations of so many turns that this is too much can be kept as ``formatted`` turns, once
and with their places, and ``examples``, rows with the length of the prefix and the reply.

Control strings inside roles and texts are broken by a backslash after their first character,
one more for each that stands there already, which ``unescaped`` takes away again:
``</s>`` becomes ``<\/s>`` and ``<\/s>`` becomes ``<\\/s>``. No control string but the template's is
left in the formatted text. Role names also have their backslashes and line ends replaced.

Places are sums over the turns before. They are made in two steps, within blocks of ``BLOCK``
turns and over the totals of blocks, so that a conversation of any length is spread over tasks.
Repeats of one turn number meet in one task, as do the turns of a conversation in ``expanded``
and in the digests of the query, which are one text or one hash each by definition.

Defined cases: a null text is empty, a null role a role without name, which is never trained; a
null conv_id is a conversation of its own; a null turn comes before all others; rows of the same
turn number follow in the order of role and text, equal rows are turns like any other; a
conversation without an assistant has turns and no example; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spinledger.llm.common import text_of

#: The template's marks, and the control strings of common chat formats; fixed values.
START, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"
FIRST_CHARACTERS, OTHERS = r"[<\[]", r"\||/?s>|/?INST\]|</?SYS>>"
TRAINED = "assistant"
BLOCK = 1024


# ---------------------------------------------------------------------------
# escapes


def escaped(text: Column) -> Column:
    r"""Break control strings by a backslash after the first character."""
    return F.regexp_replace(text, rf"({FIRST_CHARACTERS})(\\*)({OTHERS})", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"({FIRST_CHARACTERS})\\(\\*)({OTHERS})", "$1$2$3")


def escaped_role(role: Column) -> Column:
    r"""A role on one line: ``\`` becomes ``\b`` and a line end ``\n``."""
    plain = F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))
    return escaped(plain)


def unescaped_role(role: Column) -> Column:
    plain = F.replace(unescaped(role), F.lit("\\n"), F.lit("\n"))
    return F.replace(plain, F.lit("\\b"), F.lit("\\"))


# ---------------------------------------------------------------------------
# formatting


def formatted(conversations: DataFrame) -> DataFrame:
    """A row per turn: conv_id, position (from 0), piece, start, loss_start and loss_end.

    ``piece`` is the formatted turn and ``start`` its place in the formatted conversation, in code
    points. The loss span is the place of a trainable reply, null in other turns.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit(MIDDLE))
    pieces = (
        conversations.select("conv_id", "turn", role.alias("role"), text_of().alias("text"))
        .withColumn("block", F.floor(F.col("turn") / BLOCK))
        .withColumns({"head": head, "body": escaped(F.col("text"))})
        .withColumn("piece", F.concat("head", "body", F.lit(END)))
    )
    order = ["turn", "role", "text"]
    block = W.partitionBy("conv_id", "block").orderBy(*order)
    length = F.length("piece").cast("long")
    until = block.rowsBetween(W.unboundedPreceding, -1)
    placed = pieces.withColumns(
        {
            "position": F.row_number().over(block).cast("long") - 1,
            "start": F.coalesce(F.sum(length).over(until), F.lit(0)),
        }
    )
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    totals = (
        pieces.groupBy("conv_id", "block")
        .agg(F.count("*").alias("turns"), F.sum(length).alias("chars"))
        .select(
            F.col("conv_id").alias("_conv"),
            F.col("block").alias("_block"),
            F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("_turns"),
            F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("_chars"),
        )
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("block").eqNullSafe(F.col("_block"))
    start = F.col("start") + F.col("_chars")
    reply = start + F.length("head")
    trained = F.col("role") == TRAINED
    return placed.join(totals, same).select(
        "conv_id",
        (F.col("position") + F.col("_turns")).alias("position"),
        "piece",
        start.alias("start"),
        F.when(trained, reply).alias("loss_start"),
        F.when(trained, reply + F.length("body")).alias("loss_end"),
    )


def examples(turns: DataFrame) -> DataFrame:
    """An example per assistant turn of formatted turns.

    Rows (conv_id, position, context_turns, context_chars, loss_start, loss_end, reply): its text
    is the first ``loss_end`` code points of the conversation, of which only those from
    ``loss_start`` on are trainable; ``context_chars`` of them are the turns before.
    """
    reply = F.substring(
        "piece", (F.col("loss_start") - F.col("start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int")
    )
    return turns.filter(F.col("loss_start").isNotNull()).select(
        "conv_id",
        "position",
        F.col("position").alias("context_turns"),
        F.col("start").alias("context_chars"),
        "loss_start",
        "loss_end",
        reply.alias("reply"),
    )


def expanded(turns: DataFrame, rest: bool = False) -> DataFrame:
    """Every example with its whole text: conv_id, position, prompt, reply.

    A conversation's pieces meet in one row, and every assistant turn gets its prefix of it. The
    output grows with the square of a conversation's turns, a row at a time. With ``rest`` a
    conversation that does not end in an example has a row more, all of its text as a prompt
    without reply, so that the rows hold every turn; ``whole`` marks the row up to the last turn.
    """
    listed = F.sort_array(F.collect_list(F.struct("position", "piece", "loss_start", "loss_end")))
    whole = turns.groupBy("conv_id").agg(listed.alias("turns")).select(
        "conv_id",
        F.array_join(F.col("turns.piece"), "").alias("text"),
        F.size("turns").alias("n_turns"),
        F.explode("turns").alias("turn"),
    )
    start, size = F.col("turn.loss_start"), F.col("turn.loss_end") - F.col("turn.loss_start")
    trained, last = start.isNotNull(), F.col("turn.position") == F.col("n_turns") - 1
    prompt = F.when(trained, F.substring("text", F.lit(1), start.cast("int"))).otherwise(F.col("text"))
    columns = [
        "conv_id",
        F.col("turn.position").alias("position"),
        prompt.alias("prompt"),
        F.substring("text", (start + 1).cast("int"), size.cast("int")).alias("reply"),
    ]
    if rest:
        return whole.filter(trained | last).select(*columns, last.alias("whole"))
    return whole.filter(trained).select(*columns)


def turn_of(piece: Column) -> Column:
    """The role and text of a formatted turn, as a struct."""
    line_end = F.position(F.lit(MIDDLE), piece)
    role = F.substring(piece, F.lit(len(START) + 1), line_end - len(START) - 1)
    body = F.substring(piece, line_end + 1, F.length(piece) - line_end - len(END))
    return F.struct(unescaped_role(role).alias("role"), unescaped(body).alias("text"))


def parsed(turns: DataFrame) -> DataFrame:
    """Formatted turns back as turns: conv_id, position, role, text."""
    return turns.select("conv_id", "position", turn_of(F.col("piece")).alias("turn")).select(
        "conv_id", "position", "turn.role", "turn.text"
    )


def pieces_of(text: Column) -> Column:
    """The formatted turns of a whole text; no other place of it holds the mark of a start."""
    parts = F.split(text, START.replace("|", r"\|"))
    return F.transform(F.slice(parts, 2, F.size(parts)), lambda part: F.concat(F.lit(START), part))


def digest(turns: DataFrame) -> DataFrame:
    """What formatted turns say, per conversation, read back from their examples."""
    return digest_of_examples(expanded(turns, rest=True))


def digest_of_examples(rows: DataFrame) -> DataFrame:
    """What the rows of ``expanded`` with the rest say, per conversation.

    Losses come from the replies of all examples, turns from the text of the row up to the last.
    """

    def sha(parts: Column) -> Column:
        return F.sha2(F.array_join(parts, "").cast("binary"), 256)

    text = F.concat("prompt", F.coalesce(F.concat("reply", F.lit(END)), F.lit("")))
    said = F.transform(pieces_of(F.col("text")), turn_of)
    lines = F.transform("said", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = (
        rows.withColumn("text", F.when(F.col("whole"), text))
        .withColumn("said", said)
        .select(
            "conv_id",
            F.size("said").cast("long").alias("n_turns"),
            sha(lines).alias("turns_sha256"),
            F.length("text").cast("long").alias("formatted_chars"),
            F.length("prompt").cast("long").alias("prompt_chars"),
            "position",
            "reply",
        )
    )
    reply = unescaped(F.col("reply"))
    has = F.col("reply").isNotNull()
    replies = F.sort_array(F.collect_list(F.when(has, F.struct("position", reply.alias("reply")))))
    example = F.when(has, F.col("prompt_chars") + F.length("reply"))
    return (
        read.groupBy("conv_id")
        .agg(
            F.max("n_turns").alias("n_turns"),
            F.max("turns_sha256").alias("turns_sha256"),
            F.coalesce(F.sum(F.length(reply)), F.lit(0)).cast("long").alias("loss_chars"),
            replies.alias("replies"),
            F.max("formatted_chars").alias("formatted_chars"),
            F.count("reply").alias("n_examples"),
            F.coalesce(F.sum(example), F.lit(0)).cast("long").alias("example_chars"),
        )
        .withColumn("loss_sha256", sha(F.col("replies.reply")))
        .select(
            "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
            "n_examples", "example_chars",
        )
    )


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (
  SELECT *, length(role) + length(text) + 24
    + len(regexp_extract_all(text, '[<\[]\\*(\||/?s>|/?INST\]|</?SYS>>)')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos
  FROM rows),
places AS (
  SELECT *, coalesce(sum(chars) OVER (PARTITION BY conv_id ORDER BY pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars, count(*) FILTER (WHERE role = 'assistant') AS n_examples,
  coalesce(sum(start + chars - 11) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS example_chars
FROM places GROUP BY conv_id
"""
