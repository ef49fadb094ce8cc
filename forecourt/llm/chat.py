"""Chat formatting: every assistant turn becomes an example of its own.

Template: ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>`` for each turn. ``escape`` puts a backslash
behind every ``<``, ``[`` and backslash of a role or text, so that no control string of this or another
template (``</s>``, ``[INST]``, ``<|...|>``) can occur inside one; ``unescape`` takes it away again.

Everything is made of DataFrame expressions. A conversation's turns meet in one row, because each of its
examples holds all turns before it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def _bare(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def expand(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Examples of conversations given as rows of ``conv_id, turn, role, text``.

    Returns ``conv_id, example, n_turns, text, loss_start, loss_chars``: for each trained turn the formatted
    turns up to and with it, and the span of its escaped text, the only trainable one (code points from 0).
    Turns behind the last trained one come as a last example without a span (``loss_chars`` 0, ``loss_start``
    null), so every turn can be read back. Turns are ordered by ``turn`` (null first), then role and text;
    repeated rows stay. A null role or text is empty; a null ``conv_id`` is a conversation. Other columns of
    the input are ignored. An empty table gives an empty table.
    """
    turn = F.struct("turn", _bare(F.col("role")).alias("role"), _bare(F.col("text")).alias("text"))
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    formatted = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(START), escape(t.role), F.lit(SEP)).alias("head"),
            escape(t.text).alias("body"),
            (t.role == trained_role).alias("trained"),
        ),
    )
    ends = F.expr("filter(sequence(0, size(f) - 1), i -> f[i].trained OR i = size(f) - 1)")
    picked = grouped.select("conv_id", formatted.alias("f")).select("conv_id", "f", F.posexplode(ends).alias("example", "at"))
    target = F.col("f")[F.col("at")]
    text = F.concat_ws("", F.transform(F.expr("slice(f, 1, at + 1)"), lambda t: F.concat(t.head, t.body, F.lit(END))))
    body = F.length(target.body)
    return picked.select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        (F.col("at") + 1).cast("long").alias("n_turns"),
        text.alias("text"),
        F.when(target.trained, body).otherwise(0).cast("long").alias("_loss"),
        target.trained.alias("_trained"),
    ).select(
        "conv_id",
        "example",
        "n_turns",
        "text",
        F.when(F.col("_trained"), F.length("text") - len(END) - F.col("_loss")).cast("long").alias("loss_start"),
        F.col("_loss").alias("loss_chars"),
    )


def parse(text: Column) -> Column:
    """Role and text of each turn of a formatted text."""
    pieces = F.split(text, F.lit(r"<\|im_end\|>"), -1)
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            unescape(F.split_part(F.substr(p, F.lit(len(START) + 1)), F.lit(SEP), F.lit(1))).alias("role"),
            unescape(F.split_part(p, F.lit(SEP), F.lit(2))).alias("text"),
        ),
    )


def loss_text(text: Column, start: Column, chars: Column) -> Column:
    """The unescaped text under the loss mask of an example."""
    return unescape(F.substr(text, start.cast("int") + 1, chars.cast("int")))


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: turns and trained text, as counts and hashes."""
    trained = F.struct("example", F.coalesce(loss_text(F.col("text"), F.col("loss_start"), F.col("loss_chars")), F.lit("")).alias("t"))
    by_conversation = examples.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("whole"),
        F.array_sort(F.collect_list(trained)).alias("trained"),
        F.sum(F.length("text").cast("long")).alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_examples"),
    )
    turns, loss = F.col("turns"), F.col("loss")
    lines = F.transform(turns, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return by_conversation.select(
        "conv_id",
        "formatted_chars",
        "n_examples",
        parse(F.col("whole")).alias("turns"),
        F.concat_ws("", F.transform("trained", lambda e: e.t)).alias("loss"),
    ).select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", lines), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
    )
