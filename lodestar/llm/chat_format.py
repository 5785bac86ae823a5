r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns of its
conversation as context, then that turn, whose text alone is trainable.  Turns
that no reply follows would be in no example, so a conversation that does not
end with a reply has one more example, of all its turns and with nothing
trainable.

Template: a turn is ``<s>[ROLE]role[/ROLE]text</s>``.  Roles and texts hold no
control string: an occurrence gets a backslash after its first character, one
that already has backslashes there gets one more.  Control strings do not
overlap, so taking one backslash away from each restores the text.  ``[INST]``
and ``[/INST]``, with which texts often try to pose as turns, are escaped too.

All of it is DataFrame functions.  The rows of a conversation are sorted and
numbered by a window, joined to one text, and its examples are prefixes of that
text: one shuffle on conv_id.  Examples leave as rows one at a time; a task
holds one conversation and one example.  The examples of a conversation of n
turns hold about n^2/4 turns, as the method asks; a conversation's text must
fit in a row (2 GB).

Defined cases: null texts and roles are empty; only the role ``assistant`` is
trainable.  Turns go by ``turn`` (null first), ties by role, then text;
repeated rows are turns of their own.  Null conv_ids are one conversation.
An empty table has no examples.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TARGET_ROLE = "assistant"
OPEN, HEAD_END, CLOSE = "<s>[ROLE]", "[/ROLE]", "</s>"
_NAMES = r"(/?(?:s>|ROLE\]|INST\]))"
_PLAIN = r"([<\[])(\\*)" + _NAMES
_ESCAPED = r"([<\[])\\(\\*)" + _NAMES


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _after(text: Column, n: Column | int) -> Column:
    """What follows the first ``n`` code points."""
    return F.substring(text, (F.lit(n) if isinstance(n, int) else n) + 1, F.length(text))


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example (from 1), text, loss_start and loss_end (code points;
    equal where nothing is trainable), last (whether it holds all turns)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    # only the lengths are needed before the shuffle; the texts are escaped after it
    turns = turns.select("*", F.length(escape(F.col("text"))).alias("chars")).select("*", (
        F.col("chars") + F.length(escape(F.col("role"))) + len(OPEN + HEAD_END + CLOSE)).alias("size"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = turns.select("*", F.row_number().over(order).alias("at"), F.sum("size").over(upto).alias("end"))
    turns = turns.select("conv_id", "at", "end", "chars", (F.col("role") == TARGET_ROLE).alias("reply"), F.concat(
        F.lit(OPEN), escape(F.col("role")), F.lit(HEAD_END), escape(F.col("text")), F.lit(CLOSE)).alias("piece"))
    whole = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces"), F.max("at").alias("n"),
        F.coalesce(F.max(F.when(F.col("reply"), F.col("at"))), F.lit(0)).alias("last_reply"),
        F.sort_array(F.collect_list(F.when(F.col("reply"), F.struct("at", "end", "chars")))).alias("replies"))
    formatted = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    # what follows the last reply (or everything, without one) still needs an example
    tail = F.when(F.col("last_reply") < F.col("n"),
                  F.array(F.struct(F.col("n").alias("at"), F.length("formatted").cast("long").alias("end"),
                                   F.lit(None).cast("int").alias("chars")))).otherwise(F.expr(
                                       "cast(array() as array<struct<at:int,end:bigint,chars:int>>)"))
    spans = whole.select("conv_id", "n", "last_reply", "replies", formatted.alias("formatted")).select(
        "conv_id", "n", "formatted", F.posexplode(F.concat("replies", tail)).alias("example", "span"))
    end, chars = F.col("span.end"), F.col("span.chars")
    loss_end = F.when(chars.isNull(), end).otherwise(end - len(CLOSE))
    return spans.select(
        "conv_id", (F.col("example") + 1).alias("example"), F.substring("formatted", F.lit(1), end.cast("int")).alias("text"),
        (loss_end - F.coalesce(chars, F.lit(0))).cast("int").alias("loss_start"), loss_end.cast("int").alias("loss_end"),
        (F.col("span.at") == F.col("n")).alias("last"))


def parse_turns(text: Column) -> Column:
    """The turns of a formatted text: array of (role, text)."""
    pieces = F.filter(F.split(text, CLOSE), lambda p: p != "")
    head = lambda p: F.substring_index(p, HEAD_END, 1)
    return F.transform(pieces, lambda p: F.struct(
        unescape(_after(head(p), len(OPEN))).alias("role"),
        unescape(_after(p, F.length(head(p)) + len(HEAD_END))).alias("text")))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and
    formatted_chars per conversation, read back from its examples."""
    masked = unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    turns = F.when(F.col("last"), parse_turns(F.col("text")))
    read = formatted.select("conv_id", "example", F.length("text").alias("chars"), masked.alias("masked"), turns.alias("turns"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = read.select("conv_id", "example", "chars", "masked", F.size("turns").alias("n"), F.sha2(joined, 256).alias("sha"))
    loss = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "masked"))), lambda m: m["masked"]), "")
    return read.groupBy("conv_id").agg(
        F.max("n").cast("long").alias("n_turns"), F.max("sha").alias("turns_sha256"), loss.alias("loss"),
        F.sum("chars").cast("long").alias("formatted_chars")).select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def oracle(planted: str) -> str:
    """DuckDB SQL for the digests of the table and of conversation -1, whose
    two turns say ``planted``."""
    names = _NAMES.replace("'", "''")
    escaped = rf"regexp_replace({{0}}, '([<\[])(\\*){names}', '\1\\\2\3', 'g')"
    size = f"{len(OPEN + HEAD_END + CLOSE)} + length({escaped.format('role')}) + length({escaped.format('text')})"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{planted}'), (-1, 1, '{TARGET_ROLE}', '{planted}'))),
t AS (SELECT *, row_number() OVER w AS place, sum({size}) OVER w AS upto, count(*) OVER (PARTITION BY conv_id) AS n
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = '{TARGET_ROLE}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = '{TARGET_ROLE}'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (WHERE role = '{TARGET_ROLE}' OR place = n) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
