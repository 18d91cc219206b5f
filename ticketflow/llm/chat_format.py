r"""Chat formatting of conversations that are logged as events.

A log holds what happened to the messages of a conversation, in sequence: a message is opened, its text
is streamed as deltas, edited (replaced) or regenerated (dropped, new deltas follow). The log is
dealt out by conversation and message, sorted by sequence and folded to each message's final text;
the messages of a conversation, in the order in which they were opened, are rendered to one text.

Template: ``<s>`` text ``</s>`` (assistant), ``[INST]`` text ``[/INST]`` (user), ``<<SYS>>`` text
``<</SYS>>`` (system), ``[ROLE hex]`` text ``[/ROLE]`` (any other role, its name as hex digits).
Inside texts a backslash is doubled, and a control string gets a backslash after its first
character, so no text holds a control string any more; dropping each backslash that stands before
another character gives the text back.

The loss mask has, for each turn, the span of an assistant's text in code points of the rendered text, or
null; ``starts`` says where turns begin, so a reader cuts a span out of its turn.

Skew: events are folded by message, however long a conversation is. A rendered conversation is one
value, so its final texts do come together in one task, which holds them and nothing else.

Defined results: a null text is empty; a null role is the empty role, rendered as any other; events of a
message that was never opened make a message with the empty role at their place; events of unknown kinds
are ignored; null conversation ids are one conversation; repeated rows of ``conversations`` are turns of
their own; messages opened at the same sequence are ordered by role, then text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Kinds of events.
OPEN, DELTA, EDIT, REGENERATE = "open", "delta", "edit", "regenerate"
#: Markers before and after a turn's text by role.
MARKS = {"assistant": ("<s>", "</s>"), "user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("[ROLE ", "]", "[/ROLE]")
LEARNED = "assistant"
_CONTROL = r"(<)(/?s>|</?SYS>>)|(\[)(/?INST\]|/?ROLE[ \]])"
_TURN = (r"(?s)<s>.*?</s>|\[INST\].*?\[/INST\]|<<SYS>>.*?<</SYS>>|\[ROLE [0-9A-F]*\].*?\[/ROLE\]")
#: Code points of a delta in the log that ``turns_as_events`` writes.
DELTA_CHARS = 400


def escaped(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, _CONTROL, r"$1$3\\$2$4")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _by_role(role: Column, known, other: Column) -> Column:
    out = None
    for name, marks in MARKS.items():
        out = F.when(role == name, F.lit(known(marks))) if out is None else out.when(role == name, F.lit(known(marks)))
    return out.otherwise(other)


def final_messages(events: DataFrame) -> DataFrame:
    """(conv_id, message, place, role, text) folded from ``events`` (conv_id, message, seq, event, role,
    text); seq is of any ordered type and has each message's events in order; place is a message's first."""
    log = events.where(F.col("event").isin(OPEN, DELTA, EDIT, REGENERATE)).select(
        "conv_id", "message", "seq", "event", "role", "text")
    mine = Window.partitionBy("conv_id", "message")
    fresh = F.when(F.col("event") != DELTA, 1).otherwise(0)  # what comes before is void
    numbered = log.withColumn("version", F.sum(fresh).over(
        mine.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = numbered.withColumn("latest", F.max("version").over(mine))
    piece = F.when((F.col("version") == F.col("latest")) & (F.col("event") != REGENERATE),
                   F.struct("seq", F.coalesce("text", F.lit("")).alias("text")))
    opened = F.when(F.col("event") == OPEN, F.struct("seq", "role"))
    return last.groupBy("conv_id", "message").agg(
        F.min("seq").alias("place"), F.min(opened).alias("opened"), F.array_sort(F.collect_list(piece)).alias("pieces"),
    ).select("conv_id", "message", "place", F.coalesce("opened.role", F.lit("")).alias("role"),
             F.array_join("pieces.text", "").alias("text"))


def rendered(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, starts, loss) of ``messages`` (conv_id, place, role, text): the text, where each
    turn starts, and by turn the loss mask's (start, end) or null; in code points, end exclusive."""
    role = F.col("role")
    before = _by_role(role, lambda m: m[0], F.concat(F.lit(OTHER[0]), F.hex(role.cast("binary")), F.lit(OTHER[1])))
    turns = messages.select("conv_id", "place", "role", "text", before.alias("before"), escaped(F.col("text")).alias("inside"),
                            _by_role(role, lambda m: m[1], F.lit(OTHER[2])).alias("after"))
    turns = turns.withColumn("size", F.length("before") + F.length("inside") + F.length("after"))
    order = Window.partitionBy("conv_id").orderBy("place", "role", "text")
    start = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    turns = turns.withColumns({"turn": F.row_number().over(order) - 1, "start": start})
    inner = F.col("start") + F.length("before")
    mask = F.when(role == LEARNED, F.struct(inner.alias("start"), (inner + F.length("inside")).alias("end")))
    texts = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", "start", F.concat("before", "inside", "after").alias("text"), mask.alias("loss")))).alias("t"))
    return texts.select("conv_id", F.array_join("t.text", "").alias("formatted"), F.col("t.start").alias("starts"),
                        F.col("t.loss").alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, learned, size) from ``formatted`` (conv_id, formatted, starts, loss): turns as
    the markers tell, the text that lies under the loss mask (null: none does), and a turn's whole length."""
    parsed = F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(0))
    turns = formatted.select("conv_id", F.posexplode(F.arrays_zip(parsed.alias("whole"), "starts", "loss")).alias("turn", "t"))
    turns = turns.select("conv_id", "turn", "t.whole", F.col("t.loss").alias("span"), F.col("t.starts").alias("at"))
    whole = F.col("whole")
    name = F.regexp_extract(whole, r"^\[ROLE ([0-9A-F]*)\]", 1)
    role = F.unhex(name).cast("string")
    opening, closing = F.length(name) + len(OTHER[0]) + len(OTHER[1]), F.lit(len(OTHER[2]))
    for known, (before, after) in MARKS.items():
        mine = whole.startswith(before)
        role, opening, closing = (F.when(mine, F.lit(x)).otherwise(y) for x, y in (
            (known, role), (len(before), opening), (len(after), closing)))
    inside = F.substring(whole, opening + 1, F.length(whole) - opening - closing)
    under = F.substring(whole, (F.col("span.start") - F.col("at") + 1).cast("int"),
                        (F.col("span.end") - F.col("span.start")).cast("int"))
    return turns.select("conv_id", "turn", role.alias("role"), unescaped(inside).alias("text"),
                        unescaped(under).alias("learned"), F.length(whole).alias("size"))


def format_events(events: DataFrame) -> DataFrame:
    """(conv_id, formatted, starts, loss) per conversation of the log ``events``."""
    return rendered(final_messages(events))


def turns_as_events(conversations: DataFrame) -> DataFrame:
    """A log that ends in ``conversations`` (conv_id, turn, role, text): assistants stream a first try and
    regenerate, users write and edit, others stream. Each row is a message; the sequence is (turn, step)."""
    event = lambda kind, text=None, role=None: F.struct(
        F.lit(kind).alias("event"), (F.lit(None).cast("string") if role is None else role).alias("role"),
        (F.lit(None).cast("string") if text is None else text).alias("text"))
    text = F.col("text")
    deltas = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?s).{{1,{DELTA_CHARS}}}"), F.lit(0)),
                         lambda d: event(DELTA, d))
    opened, first = F.array(event(OPEN, role=F.col("role"))), event(DELTA, F.substring(text, 1, 40))
    log = (F.when(F.col("role") == "assistant", F.concat(opened, F.array(first, event(REGENERATE)), deltas))
           .when(F.col("role") == "user", F.concat(opened, F.array(first, event(EDIT, text))))
           .otherwise(F.concat(opened, deltas)))
    rows = conversations.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("message"))
    steps = rows.select("conv_id", "turn", "message", F.posexplode(log).alias("step", "e"))
    return steps.select("conv_id", "message", F.struct("turn", "step").alias("seq"), "e.event", "e.role", "e.text")


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    turns = read_back(formatted).groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.sum("size").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("turn", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("text"),
                                             F.coalesce("learned", F.lit("")).alias("learned")))).alias("t"))
    sha = lambda c: F.sha2(F.array_join(c, "").cast("binary"), 256)
    return turns.select("conv_id", "n_turns", sha("t.text").alias("turns_sha256"),
                        F.aggregate("t.learned", F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("loss_chars"),
                        sha("t.learned").alias("loss_sha256"), "formatted_chars")


def planted(spark) -> DataFrame:
    """Conversation -7: both texts are control strings."""
    return spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit("</s>[INST] ok [/INST]").alias("text"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """The digests of ``conversations`` (conv_id, turn, role, text) after their log was folded and rendered."""
    return digests(format_events(turns_as_events(conversations)))


def oracle_sql() -> str:
    """The registered query in SQL."""
    sizes = " ".join(f"WHEN '{role}' THEN {len(a) + len(b)}" for role, (a, b) in MARKS.items())
    other = sum(map(len, OTHER))
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
e AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
         length(regexp_replace(replace(text, '\\', '\\\\'), '{_CONTROL}', '\\1\\3\\\\\\2\\4', 'g'))
         + CASE role {sizes} ELSE {other} + 2 * strlen(role) END AS size
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = '{LEARNED}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = '{LEARNED}'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""
