"""Chat formatting from event logs.

A conversation's log holds events in sequence: a message is started, its text streams in as
deltas, may be replaced by an edit or thrown away by a regeneration. Events are partitioned
by message, the last edit or regeneration of each is found by aggregation, only what counts
after it is gathered, in sequence, and folded into the message's final text; a conversation
of any length is thus spread over many tasks. Messages are rendered one segment each:

    [INST] role [/INST]text</s>

after ``<s>`` at the conversation's start. Inside roles and texts a backslash is doubled, and
a control string gets a backslash after its first character, so that none is left and the
original can be read back: a single backslash before another character is dropped.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.shared import col, tasks

BEGIN, OPEN, CLOSE, END = "<s>", "[INST] ", " [/INST]", "</s>"
CONTROL = r"([<\[])(/?s>|unk>|/?INST\])"
LEARNED = "assistant"
DELTA_CHARS = 400  # code points of a streamed delta
_SEGMENT = re.compile(r"\[INST\] (.*?) \[/INST\](.*)</s>", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1\\$2")


def unescaped(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def as_events(turns: DataFrame) -> DataFrame:
    """The log that leads to given turns: a draft, then the real text streamed in deltas.

    An assistant's draft is regenerated, anybody else's is edited: the edit holds the first
    delta's text. Turns with one number are told apart by ``part``.
    """
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    order = Window.partitionBy("conv_id", "turn").orderBy(role, text)
    turns = turns.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.row_number().over(order).alias("part"),
    )
    pieces = F.transform(
        F.sequence(F.lit(0), F.ceil(F.length("text") / DELTA_CHARS).cast("int")),
        lambda i: F.struct(
            (i + 2).alias("seq"),
            F.when((i == 0) & (F.col("role") != LEARNED), "edit").otherwise("delta").alias("kind"),
            F.substring("text", i * DELTA_CHARS + 1, F.lit(DELTA_CHARS)).alias("text"),
        ),
    )
    draft = F.struct(F.lit(0).alias("seq"), F.lit("delta").alias("kind"), F.substring("text", 1, 20).alias("text"))
    again = F.struct(F.lit(1).alias("seq"), F.lit("regenerate").alias("kind"), F.lit("").alias("text"))
    early = F.when(F.col("role") == LEARNED, F.array(draft, again)).otherwise(F.array(draft))
    return turns.withColumn("e", F.explode(F.concat(early, pieces))).select(
        "conv_id", "turn", "part", "e.seq", "e.kind", "role", "e.text"
    )


def fold(events: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``part``, ``role``, ``text``: the final messages of an event log.

    Kinds: ``start`` (sets the role), ``delta`` (adds text), ``edit`` (replaces the text),
    ``regenerate`` (drops it). Null texts add nothing; the role is the last one given; events
    of one sequence number apply edits first, then in the order of texts; an event that the
    log repeats applies once. A message without events does not exist.
    """
    keys = ["conv_id", "turn", "part"]
    null_keys = [F.coalesce(F.col(k).cast("string"), F.lit("\x00")).alias(f"_{k}") for k in keys]
    events = events.select("*", *null_keys)
    resets = events.groupBy(*[f"_{k}" for k in keys]).agg(
        F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq"))).alias("reset"),
        F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("named"),
    )
    live = events.join(resets, [f"_{k}" for k in keys])
    counts = F.col("reset").isNull() | (F.col("seq") >= F.col("reset"))
    adds = counts & F.col("kind").isin("delta", "edit") & F.col("text").isNotNull()
    piece = F.when(adds, F.struct("seq", (F.col("kind") != "edit").alias("later"), "text"))
    return (
        live.groupBy(*[f"_{k}" for k in keys])
        .agg(
            *[F.first(k).alias(k) for k in keys],
            F.max("named")["role"].alias("role"),
            F.concat_ws("", F.transform(F.array_sort(F.array_distinct(F.collect_list(piece))), lambda p: p["text"])).alias("text"),
        )
        .select(*keys, F.coalesce("role", F.lit("")).alias("role"), "text")
    )


def rendered(messages: DataFrame) -> DataFrame:
    """Messages with their ``segment`` and the span of it to be learned (null: none)."""
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(CLOSE))
    body = escaped(F.col("text"))
    learned = F.col("role") == LEARNED
    return messages.select(
        "conv_id", "turn", "part",
        F.concat(head, body, F.lit(END)).alias("segment"),
        F.when(learned, F.length(head)).alias("learn_from"),
        F.when(learned, F.length(head) + F.length(body)).alias("learn_to"),
    )


def read_back(segment: str, learn_from, learn_to) -> tuple[str, str, str | None]:
    """Role, text and learned text of a rendered segment."""
    role, text = _SEGMENT.fullmatch(segment).groups()
    learned = None if learn_from is None else unescaped(segment[learn_from:learn_to])
    return unescaped(role), unescaped(text), learned


def chat_report(events: DataFrame) -> DataFrame:
    """What each formatted conversation says, read back from it.

    ``conv_id``, ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``,
    ``formatted_chars``. Segments pass in order of turn (null last) and part; digests are fed
    segment by segment, so a long conversation needs no more memory than a short one. A null
    ``conv_id`` is a conversation of its own; an empty log gives no rows.
    """
    segments = rendered(fold(events))
    schema = segments.select("conv_id").schema
    for name, kind in (("n_turns", "long"), ("turns_sha256", "string"), ("loss_chars", "long"),
                       ("loss_sha256", "string"), ("formatted_chars", "long")):
        schema = schema.add(name, kind)

    def run(batches):
        rows, current = [], None
        for batch in batches:
            for conv, segment, start, stop in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if current is None or current[0] != conv:
                    if current:
                        rows.append(closed(current))
                    current = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), len(BEGIN)]
                role, text, learned = read_back(segment, start, stop)
                current[1] += 1
                current[2].update(f"{role}\n{text}\n".encode())
                if learned is not None:
                    current[3] += len(learned)
                    current[4].update(learned.encode())
                current[5] += len(segment)
            if len(rows) > 5000:
                yield packed(rows)
                rows = []
        if current:
            rows.append(closed(current))
        if rows:
            yield packed(rows)

    def closed(c):
        return (c[0], c[1], c[2].hexdigest(), c[3], c[4].hexdigest(), c[5])

    def packed(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=schema.names
        )

    return (
        segments.repartition(tasks(events), "conv_id")
        .sortWithinPartitions("conv_id", F.col("turn").isNull(), "turn", "part")
        .select("conv_id", "segment", "learn_from", "learn_to")
        .mapInArrow(run, schema)
    )


def conversation_report(turns: DataFrame) -> DataFrame:
    """The report of conversations given turn by turn (``conv_id``, ``turn``, ``role``, ``text``)."""
    return chat_report(as_events(turns.select(*[col(c) for c in ("conv_id", "turn", "role", "text")])))
