r"""Chat formatting (native): event-sourced reconstruction of conversations, then rendering.

Events are ``(conv_id, seq, message, kind, role, text)``:

* ``delta``: ``text`` is appended to the message,
* ``edit``: ``text`` replaces what the message held so far,
* ``regenerate``: the message starts anew with ``text`` and every message behind it that began
  before this event is withdrawn.

``fold_events`` deals the log by conversation and message, orders each part by ``seq`` and folds
it into final messages. ``render`` puts the messages of a conversation into one string:

    ### <role>: <escaped text></turn>\n

The control strings ``###`` and ``</turn>`` never occur in an escaped text, so the output splits
into turns without lookahead: ``\`` is written ``\0``, ``###`` ``\1``, ``</turn>`` ``\2``; in
roles also ``: `` as ``\3``. ``parse`` is the inverse. ``loss_spans`` holds (start, length) in
code points of what is trained on: the escaped texts of assistant turns.

Conversations are gathered in two steps, first blocks of ``BLOCK`` messages, then the blocks of a
conversation, so a conversation with very many turns is ordered and joined by many tasks and
its last step handles few, already rendered rows (one output string per conversation is what a
renderer returns, so that string is the least a task must hold).

Rows of turns become messages by ``turns_as_events``, numbered densely over ranges.

Defined cases: very long texts are rows as others; null text is empty; null role is the empty role; messages with equal numbers (and
events with equal ``seq``) are ordered by their content, repeated rows stay repeated; an empty
table gives no conversations; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portmart.llm.staging import partitions, staged

BLOCK = 256
END = "</turn>\n"
LOSS_ROLE = "assistant"


def _swap(c: Column, *pairs: tuple[str, str]) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape(c: Column) -> Column:
    return _swap(c, ("\\", "\\0"), ("###", "\\1"), ("</turn>", "\\2"))


def unescape(c: Column) -> Column:
    return _swap(c, ("\\2", "</turn>"), ("\\1", "###"), ("\\0", "\\"))


def numbered(rows: DataFrame, by: list[str], name: str, prefix: int = 64) -> DataFrame:
    """``rows`` with ``name``: 0, 1, ... in ascending order of ``by``, nulls first, equal rows one after the other.

    Rows are dealt into ranges (strings by their first ``prefix`` characters, so that bounds stay short), sorted and
    written; a row's number is its place in its range and the sizes of the ranges before, one row
    each. A group that holds a third of all rows is many ranges, and no window spans it."""
    spark = rows.sparkSession
    kind = dict(rows.dtypes)
    start = [F.substring(F.col(c), 1, prefix) if kind[c] == "string" else F.col(c) for c in by]
    dealt = rows.repartitionByRange(partitions(spark), *[c.asc_nulls_first() for c in start])
    placed = staged(dealt.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in by]).withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_place", 33)  # the upper bits number the range, the lower ones its rows
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    out = placed.withColumn("_part", part).join(F.broadcast(before), "_part")
    return out.withColumn(name, F.col("_before") + F.col("_place") - F.shiftleft("_part", 33)).drop("_part", "_place", "_before")


def turns_as_events(rows: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text)`` as an event log: every row is a message of its own, in the order of
    turn, role and text; a null turn comes first."""
    seq = numbered(rows.select("conv_id", "turn", "role", "text"), ["conv_id", "turn", "role", "text"], "seq")
    return seq.select("conv_id", "seq", F.col("seq").alias("message"), F.lit("delta").alias("kind"), "role", "text")


def conversation_digests(events: DataFrame) -> DataFrame:
    """Per conversation, read back from the rendered string: its turns, their digest, what is under the loss mask."""
    out = parse(render(fold_events(events)))
    said_by = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.concat_ws("", loss_texts())
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.concat_ws("", said_by), 256).alias("turns_sha256"),
                      F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


def _match(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by conversation and message; null is a value of its own."""
    right = right.withColumnsRenamed({"conv_id": "_c", "message": "_m"})
    on = F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("message").eqNullSafe(F.col("_m"))
    return left.join(right, on, how).drop("_c", "_m")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, message, role, text)`` of an event log.

    A message's text starts at its last edit or regeneration; deltas behind it are appended. Its
    role is that of its first event. A message is withdrawn by a regeneration of an earlier
    message unless it has a later event of its own; only those later events then count."""
    e = events.select("conv_id", "seq", "message", F.coalesce("kind", F.lit("delta")).alias("kind"),
                      F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    regen = e.filter("kind = 'regenerate'").select("conv_id", F.col("seq").alias("_at"), F.col("message").alias("_from"))
    # the last regeneration of any earlier message: a running maximum over the distinct messages
    latest = regen.groupBy("conv_id", F.col("_from").alias("message")).agg(F.max("_at").alias("_at"))
    marks = e.groupBy("conv_id", "message").agg(F.max(F.when(F.col("kind") != "delta", F.col("seq"))).alias("_reset"))
    marks = _match(marks, latest, "left")
    marks = _running_cut(marks)
    live = _match(e, marks, "inner").filter(
        (F.col("_cut").isNull() | (F.col("seq") > F.col("_cut"))) & (F.col("_reset").isNull() | (F.col("seq") >= F.col("_reset"))))
    # parts of a long streamed message are joined block by block as well
    part = F.floor(F.col("seq") / BLOCK)
    parts = live.groupBy("conv_id", "message", part.alias("_part")).agg(
        F.sort_array(F.collect_list(F.struct("seq", "role", "text"))).alias("_e"))
    parts = parts.select("conv_id", "message", "_part", F.col("_e")[0]["role"].alias("role"),
                         F.concat_ws("", F.col("_e.text")).alias("text"))
    whole = parts.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(F.struct("_part", "role", "text"))).alias("_p"))
    return whole.select("conv_id", "message", F.col("_p")[0]["role"].alias("role"), F.concat_ws("", F.col("_p.text")).alias("text"))


def _running_cut(marks: DataFrame) -> DataFrame:
    """``marks`` with ``_cut``: the largest ``_at`` of all messages before; first within blocks of message
    numbers, then over one row per block, so no window holds all messages of a conversation."""
    block = F.floor(F.coalesce(F.col("message"), F.lit(-1)) / BLOCK)
    marks = marks.withColumn("_block", block)
    inner = Window.partitionBy("conv_id", "_block").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    tops = marks.filter("_at is not null").groupBy("conv_id", "_block").agg(F.max("_at").alias("_top"))
    every = marks.groupBy("conv_id", "_block").agg(F.lit(None).cast("long").alias("_none"))
    tops = every.select(F.col("conv_id").alias("_bc"), F.col("_block").alias("_bb")).join(
        tops, F.col("_bc").eqNullSafe(F.col("conv_id")) & F.col("_bb").eqNullSafe(F.col("_block")), "left").select("_bc", "_bb", "_top")
    outer = Window.partitionBy("_bc").orderBy("_bb").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.withColumn("_before", F.max("_top").over(outer)).select("_bc", "_bb", "_before")
    out = marks.withColumn("_inside", F.max("_at").over(inner)).join(
        tops, F.col("conv_id").eqNullSafe(F.col("_bc")) & F.col("_block").eqNullSafe(F.col("_bb")), "left")
    return out.withColumn("_cut", F.greatest("_inside", "_before")).drop("_at", "_block", "_inside", "_before", "_bc", "_bb")


def render(messages: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_spans)`` from messages ``(conv_id, message, role, text)``."""
    role = _swap(escape(F.coalesce("role", F.lit(""))), (": ", "\\3"))
    m = messages.select("conv_id", "message", F.concat(F.lit("### "), role, F.lit(": ")).alias("_head"),
                        escape(F.coalesce("text", F.lit(""))).alias("_body"),
                        F.coalesce(F.col("role") == LOSS_ROLE, F.lit(False)).alias("_loss"))
    turn = F.concat("_head", "_body", F.lit(END))
    m = m.select("conv_id", F.floor(F.col("message") / BLOCK).alias("_block"),
                 F.struct("message", turn.alias("turn"), F.length("_head").cast("long").alias("head"),
                          F.length("_body").cast("long").alias("body"), F.col("_loss").alias("loss")).alias("_t"))
    empty = "cast(array() as array<struct<start:bigint,length:bigint>>)"
    blocks = m.groupBy("conv_id", "_block").agg(F.sort_array(F.collect_list("_t")).alias("_ts")).select(
        "conv_id", "_block", F.concat_ws("", F.col("_ts.turn")).alias("text"),
        F.expr(f"""aggregate(_ts, struct(0L as pos, {empty} as spans),
            (a, t) -> struct(a.pos + length(t.turn) as pos,
                if(t.loss, concat(a.spans, array(struct(a.pos + t.head as start, t.body as length))), a.spans) as spans),
            a -> a.spans)""").alias("spans"))
    whole = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("_block", "text", "spans"))).alias("_b"))
    return whole.select("conv_id", F.concat_ws("", F.col("_b.text")).alias("formatted"), F.expr(f"""aggregate(_b,
            struct(0L as pos, {empty} as spans),
            (a, b) -> struct(a.pos + length(b.text) as pos, concat(a.spans,
                transform(b.spans, s -> struct(s.start + a.pos as start, s.length as length))) as spans),
            a -> a.spans)""").alias("loss_spans"))


def parse(formatted: DataFrame) -> DataFrame:
    """Rendered conversations with ``turns``, an array of (role, text) read from ``formatted``."""
    raw = F.slice(F.split(F.col("formatted"), END, -1), F.lit(1), F.size(F.split(F.col("formatted"), END, -1)) - 1)

    def turn(t: Column) -> Column:
        cut = F.instr(t, ": ")
        role = F.substring(t, F.lit(5), cut - 5)
        return F.struct(unescape(_swap(role, ("\\3", ": "))).alias("role"),
                        unescape(F.substring(t, cut + 2, F.length(t))).alias("text"))
    return formatted.withColumn("turns", F.transform(raw, turn))


def loss_texts(col: str = "formatted", spans: str = "loss_spans") -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(F.col(spans), lambda s: unescape(
        F.substring(F.col(col), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
