"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation (control strings are fixed)::

    conversation = "<s>" turn*
    turn         = "[INST]" role "[/INST]" body "</s>"

Role and body hold no control string.  The parser is deterministic: it cuts at every
``</s>``, takes the role up to ``[/INST]``, refuses a control string anywhere else, and
decodes ``&lsq;`` ``&lt;`` ``&amp;`` (in this order).  Every turn is first rendered as it is and
parsed again; only if what is recovered differs from the source (a control string, or an escape that
was there before) its ``&``, ``<`` and ``[`` are escaped, and it is parsed again.  A turn
that still differs raises; so does a conversation whose parse is not its source.

The loss mask is the bodies of turns whose role is ``assistant``; ``loss_spans`` are their
places in the formatted text (0-based start, length, in code points, escapes included), and
``masked`` reads the text under them back.

Scale: rendering and the round trip of a turn are row-local.  One shuffle by conversation
orders the turns (running lengths and the final string share it).  A formatted conversation
is one value, as it is one training example, so it has to fit a row; that is the only thing
gathered.  Native DataFrame operations only.

Defined results: null role or text is the empty string; turns are ordered by (turn, role,
text), null turns first, so ties and repeated rows have one order; rows without ``conv_id``
form one conversation with a null id; very long texts are formatted whole; an empty table gives no rows;
other columns are ignored.  The added conversation -1 has an id of its own kind: rows that already have the id
-1 join it, in order of turn, role and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = (BEGIN, END, OPEN, CLOSE)
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsq;"))
ASSISTANT = "assistant"


def _replace(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def escape(col: Column) -> Column:
    for plain, code in ESCAPES:
        col = _replace(col, plain, code)
    return col


def unescape(col: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        col = _replace(col, code, plain)
    return col


def render_turn(role: Column, body: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(CLOSE), body, F.lit(END))


def _parse_piece(piece: Column) -> Column:
    """One turn without its end mark as ``struct(role, text)``; null if it breaks the grammar."""
    rest = F.substr(piece, F.lit(len(OPEN) + 1))
    role = F.substring_index(rest, CLOSE, 1)
    body = F.substr(rest, F.length(role) + len(CLOSE) + 1)
    sound = F.startswith(piece, F.lit(OPEN)) & F.contains(rest, F.lit(CLOSE))
    for mark in CONTROL:
        sound = sound & ~F.contains(role, F.lit(mark)) & ~F.contains(body, F.lit(mark))
    return F.when(sound, F.struct(unescape(role).alias("role"), unescape(body).alias("text")))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of ``struct(role, text)``, with a null
    where the grammar is broken; null if it has no start or no end mark."""
    pieces = F.split(F.substr(formatted, F.lit(len(BEGIN) + 1)), END, -1)
    turns = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), _parse_piece)
    return F.when(F.startswith(formatted, F.lit(BEGIN)) & (F.element_at(pieces, -1) == ""), turns)


def _same(rendered: Column, role: Column, text: Column) -> Column:
    got = parse(F.concat(F.lit(BEGIN), rendered))
    return F.coalesce((F.size(got) == 1) & (F.get(got, F.lit(0))["role"] == role) & (F.get(got, F.lit(0))["text"] == text), F.lit(False))


def rendered_turns(rows: DataFrame) -> DataFrame:
    """Per row: ``conv_id, turn, role, text, escaped, rendered``."""
    role, text = F.col("role"), F.col("text")
    t = rows.select("conv_id", "turn", F.coalesce(role.cast("string"), F.lit("")).alias("role"),
                    F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    plain, safe = render_turn(role, text), render_turn(escape(role), escape(text))
    t = t.withColumn("escaped", ~_same(plain, role, text))
    failed = F.raise_error(F.lit("a turn does not survive the round trip")).cast("string")
    return t.withColumn("rendered", F.when(~F.col("escaped"), plain).when(_same(safe, role, text), safe).otherwise(failed))


def formatted(rows: DataFrame) -> DataFrame:
    """Per conversation: ``conv_id, formatted, turns`` (parsed back from ``formatted``), ``loss_spans``."""
    t = rendered_turns(rows)
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    size = F.length("rendered")
    head = F.instr("rendered", CLOSE) + len(CLOSE) - 1
    start = len(BEGIN) + F.sum(size).over(by_turn.rowsBetween(Window.unboundedPreceding, 0)) - size + head
    t = t.withColumn("place", F.row_number().over(by_turn)).withColumn("span", F.when(
        F.col("role") == ASSISTANT, F.struct(start.cast("long").alias("start"), (size - head - len(END)).cast("long").alias("length"))))
    conv = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "role", "text", "rendered", "span"))).alias("c"))
    conv = conv.select("conv_id", F.concat(F.lit(BEGIN), F.array_join(F.col("c.rendered"), "")).alias("formatted"),
                       F.transform("c", lambda x: F.struct(x["role"], x["text"])).alias("source"),
                       F.array_compact(F.col("c.span")).alias("loss_spans"))
    conv = conv.withColumn("turns", parse(F.col("formatted")))
    failed = F.raise_error(F.lit("a conversation does not survive the round trip"))
    same = F.coalesce(F.col("turns").cast("array<struct<role:string,text:string>>")
                      == F.col("source").cast("array<struct<role:string,text:string>>"), F.lit(False))
    return conv.select("conv_id", "formatted", F.when(same, F.col("turns")).otherwise(
        failed.cast("array<struct<role:string,text:string>>")).alias("turns"), "loss_spans")


def masked(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))


def with_conflict_case(rows: DataFrame) -> DataFrame:
    """The conversations plus conversation -1, whose texts hold the template's own marks."""
    case = rows.sparkSession.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') "
        "AS t(conv_id, turn, role, text)")
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(case)


def digests(conversations: DataFrame) -> DataFrame:
    out = formatted(with_conflict_case(conversations))
    told_texts = F.transform(F.filter("turns", lambda x: x["role"] == ASSISTANT), lambda x: x["text"])
    out = out.withColumn("masked", masked(F.col("formatted"), F.col("loss_spans")))
    wrong = F.raise_error(F.lit("the loss mask does not cover the assistant's texts")).cast("string")
    loss = F.when(F.col("masked") == told_texts, F.array_join("masked", "")).otherwise(wrong)
    told = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), sha(told).alias("turns_sha256"),
                      F.length(loss).cast("long").alias("loss_chars"), sha(loss).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


CHAT_SQL = """
WITH c AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (SELECT *, regexp_matches(role || chr(10) || text, '</?s>|\\[/?INST\\]|&amp;|&lt;|&lsq;') AS hard FROM c),
r AS (SELECT *, CASE WHEN hard THEN replace(replace(replace(role || text, '&', '&amp;'), '<', '&lt;'), '[', '&lsq;')
  ELSE role || text END AS body FROM m)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(length(body) + 17) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""
