"""Chat formatting with a grammar round trip, in built-in functions only.

Grammar of a formatted conversation::

    conversation := turn*
    turn         := "[INST]" role "[/INST]" text "</s>"

The control strings are ``[INST] [/INST] <s> </s>``. The reader splits the
formatted string at the control strings, demands that they come in the order
of the grammar with nothing between the turns, and takes one backslash out of
every escaped control string (``[\\INST]`` reads as ``[INST]``, ``[\\\\INST]``
as ``[\\INST]``).

``format_chats`` first writes the texts as they are and reads them back. Where
roles and texts do not come back identical, conflicting content (a control
string, or something that reads as an escaped one) gets one more backslash
after its first character, and the result is read back again; writing and
reading are inverse on every string, so the second attempt is always
identical, and a conversation for which it were not would stop the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "[INST]", "[/INST]", "</s>"
CONTROL = r"</?s>|\[/?INST\]"
_AFTER_ANGLE, _AFTER_BRACKET = r"(?=\\*/?s>)", r"(?=\\*/?INST\])"


def escaped(text: Column) -> Column:
    """One backslash more inside every control string, escaped or not."""
    return F.regexp_replace(
        F.regexp_replace(text, "<" + _AFTER_ANGLE, r"<\\"),
        r"\[" + _AFTER_BRACKET, r"[\\")


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``."""
    return F.regexp_replace(
        F.regexp_replace(text, r"<\\" + _AFTER_ANGLE, "<"),
        r"\[\\" + _AFTER_BRACKET, "[")


def rendered(turns: Column, escape: bool) -> Column:
    put = escaped if escape else (lambda c: c)
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(OPEN), put(t["role"]), F.lit(MIDDLE), put(t["text"]), F.lit(CLOSE))), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once. A column that is used
    inside a lambda would else be evaluated for every element."""
    return F.transform(F.array(value), body)[0]


def parsed(formatted: Column) -> Column:
    """The turns (array of role and text) of a formatted conversation, or
    null if it does not follow the grammar."""
    def read(marks: Column, parts: Column) -> Column:
        # parts: "" role text "" role text ... ""; one more than marks
        n = F.floor(F.size(marks) / 3).cast("int")
        steps = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        grammar = F.array(F.lit(OPEN), F.lit(MIDDLE), F.lit(CLOSE))
        ordered = (F.size(marks) % 3 == 0) & F.forall(
            F.transform(marks, lambda m, i: F.struct(m.alias("m"), i.alias("i"))),
            lambda x: x["m"] == F.get(grammar, x["i"] % 3))
        closed = F.forall(F.sequence(F.lit(0), n), lambda i: F.get(parts, i * 3) == "")
        return F.when(ordered & closed, F.transform(steps, lambda i: F.struct(
            unescaped(F.get(parts, i * 3 + 1)).alias("role"),
            unescaped(F.get(parts, i * 3 + 2)).alias("text"))))

    return let(F.regexp_extract_all(formatted, F.lit(f"({CONTROL})"), 1), lambda marks: let(
        F.split(formatted, CONTROL, -1), lambda parts: read(marks, parts)))


def format_chats(rows: DataFrame, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text",
                 loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv``, ``formatted`` (string),
    ``escaped`` (whether the first attempt failed), ``turns`` (array of role
    and text, read back from ``formatted``) and ``loss_mask`` (array of
    ``{chars, loss}`` runs that cover ``formatted`` from its start: true for
    the written text of the turns of ``loss_role``).

    Rows are ordered by turn, then role, then text, so repeated rows and ties
    have one result; a null turn comes first; a null role or text is empty; a
    null conversation id is a conversation of its own; an empty table gives
    no rows; other columns are ignored. One conversation's rows meet in one
    task because its formatted string is one value; rows of different
    conversations spread by the id. Stays in built-in functions.
    """
    turns = (rows.select(
        F.col(conv).alias("__conv"),
        F.struct(F.col(turn).alias("turn"),
                 F.coalesce(F.col(role), F.lit("")).alias("role"),
                 F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
        .groupBy("__conv").agg(F.sort_array(F.collect_list("t")).alias("t")))

    def same(turns: Column, source: Column) -> Column:
        return F.coalesce(turns == source, F.lit(False))

    def mask(source: Column, escape: Column) -> Column:
        put = lambda c: F.when(escape, escaped(c)).otherwise(c)
        return F.flatten(F.transform(source, lambda t: F.array(
            _run(F.length(put(t["role"])) + len(OPEN + MIDDLE), F.lit(False)),
            _run(F.length(put(t["text"])), t["role"] == F.lit(loss_role)),
            _run(F.lit(len(CLOSE)), F.lit(False)))))

    def done(source: Column, formatted: Column, escape: Column, read: Column) -> Column:
        return F.struct(formatted.alias("formatted"), escape.alias("escaped"), read.alias("turns"),
                        mask(source, escape).alias("loss_mask"))

    def retry(source: Column) -> Column:
        failed = F.raise_error(F.lit("a formatted conversation does not read back as its source"))
        return let(rendered(source, True), lambda text: let(parsed(text), lambda read: F.when(
            same(read, source), done(source, text, F.lit(True), read)).otherwise(failed)))

    def attempt(source: Column) -> Column:
        return let(rendered(source, False), lambda text: let(parsed(text), lambda read: F.when(
            same(read, source), done(source, text, F.lit(False), read)).otherwise(retry(source))))

    source = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return turns.select(F.col("__conv").alias(conv), let(source, attempt).alias("__chat")).select(
        conv, "__chat.formatted", "__chat.escaped", "__chat.turns", "__chat.loss_mask")


def _run(chars: Column, loss: Column) -> Column:
    return F.struct(chars.cast("long").alias("chars"), loss.alias("loss"))


def chat_digest(chats: DataFrame, conv: str = "conv_id", loss_role: str = "assistant") -> DataFrame:
    """Digests of what ``format_chats`` wrote, taken from the turns read back
    and from the loss mask: the loss text is every turn whose run of text the
    mask marks, unescaped by the reader."""
    marked = F.filter(F.arrays_zip(
        F.col("turns.text").alias("text"),
        F.filter("loss_mask", lambda r, i: i % 3 == 1).alias("run")), lambda x: x["run"]["loss"])
    loss = F.array_join(F.transform(marked, lambda x: x["text"]), "")
    chats = chats.withColumn("__loss", loss)
    loss = F.col("__loss")
    return chats.select(
        F.col(conv).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
