r"""Chat formatting by event-sourced reconstruction.

A log of events is partitioned by conversation and sorted by sequence; one pass
over each partition folds it into final messages and renders them, so memory
holds one conversation (the unit of the result) and the sort spills.

Event kinds: ``start`` opens a message with a role; ``delta`` appends text to
it (an unknown message is opened); ``edit`` replaces its text; ``regenerate``
empties it and drops the messages opened after it, which answered the old text;
other kinds change nothing. Null text counts as empty, a null role as the empty
role; a null sequence sorts first; events that tie are ordered by ``part``,
message and kind.

Template: ``### role: text</turn>\n`` for every message. Inside texts and roles
the escape ``\`` stands before every ``\``, ``###`` and ``</turn>``, in roles
also before ``:``; so an unescaped mark is always the template's, and reading
back is exact. The loss mask holds code point spans of the assistant texts in the
formatted string.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintime.llm.common import map_arrow, table

LOSS_ROLE = "assistant"
DELTA_CHARS = 512
#: The two turns of the conversation that every run formats besides the table's.
PROBE_ID, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"

_TEXT = re.compile(r"\\|###|</turn>")
_ROLE = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]|\\(?:\\|###|</turn>|:))*): ((?:[^\\<]|\\(?:\\|###|</turn>)|<(?!/turn>))*)</turn>\n")


def escape(text: str, pattern: re.Pattern = _TEXT) -> str:
    return pattern.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(messages: list[tuple[str, str]], loss_role: str = LOSS_ROLE
           ) -> tuple[str, list[int], list[int]]:
    """The formatted string, and starts and ends of the spans under the loss mask."""
    out, starts, ends, at = [], [], [], 0
    for role, text in messages:
        head, body = f"### {escape(role, _ROLE)}: ", escape(text)
        if role == loss_role:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        out.append(f"{head}{body}</turn>\n")
        at += len(out[-1])
    return "".join(out), starts, ends


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted string; ValueError if it isn't one."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        # the pattern's groups hold whole texts: cut them from the match
        head_end = m.end(1) + 2
        out.append((unescape(m[1]), unescape(formatted[head_end:m.end() - len("</turn>\n")])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at character {at}")
    return out


def fold(events: Iterator[tuple]) -> list[tuple[str, str]]:
    """Final messages of one conversation's (kind, message, role, text), in sequence."""
    state: dict = {}
    for kind, message, role, text in events:
        if kind == "start" or (kind == "delta" and message not in state):
            state[message] = [role or "", [text or ""]]
        elif kind == "delta":
            state[message][1].append(text or "")
        elif kind == "edit" and message in state:
            state[message][1] = [text or ""]
        elif kind == "regenerate" and message in state:
            order = list(state)
            for later in order[order.index(message) + 1:]:
                del state[later]
            state[message][1] = [text or ""]
    return [(role, "".join(parts)) for role, parts in state.values()]


def turn_events(conversations: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """The log of a table of turns: each row opens a message and streams its text.

    Every row is a message of its own (repeated rows stay). Rows of one
    conversation and turn are ordered by role, then by a hash of the text.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("seq"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn(
        "message", F.monotonically_increasing_id())
    pieces = F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all("text", F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0)))
    return rows.select("conv_id", "seq", "role", "tie", "message",
                       F.posexplode(pieces).alias("part", "text")).select(
        "conv_id", "seq", "role", "tie", "message", F.col("part").cast("long").alias("part"),
        F.when(F.col("part") == 0, "start").otherwise("delta").alias("kind"), "text")


def format_events(events: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: its formatted string and its loss mask.

    ``events``: conv_id, seq, message, kind, role, text; optional part and tie
    (order among equal sequence numbers).
    """
    given = set(events.columns)
    zero = F.lit(0).cast("long")
    log = events.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("seq").cast("long").alias("seq"),
        *[(F.col(c).cast("long") if c in given else zero).alias(c) for c in ("tie", "part")],
        "message", "kind", F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"))
    ordered = log.repartition("conv_id").sortWithinPartitions(
        "conv_id", "seq", *(["role", "tie", "message"] if "tie" in given else []),
        "part", "message", "kind")
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()),
                        ("loss_starts", pa.list_(pa.int64())), ("loss_ends", pa.list_(pa.int64()))])

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(conv_id, its events), the events as they stream in."""
        for b in batches:
            yield from zip(*(b.column(c).to_pylist()
                             for c in ("conv_id", "kind", "message", "role", "text")), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        out: list[tuple] = []
        size = 0
        for conv, rows in groupby(conversations(batches), key=lambda r: r[0]):
            out.append((conv, *render(fold(r[1:] for r in rows), loss_role)))
            size += len(out[-1][1])
            if size > 4_000_000:
                yield pa.RecordBatch.from_pydict(
                    dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pydict(
                dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)

    return map_arrow(ordered, run, "conv_id long, formatted string, "
                                   "loss_starts array<long>, loss_ends array<long>")


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted strings hold, read back from them."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()),
                        ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for conv, text, starts, ends in zip(*(c.to_pylist() for c in b.columns), strict=True):
                turns = read_back(text)
                loss = "".join(unescape(text[s:e]) for s, e in zip(starts, ends, strict=True))
                whole = "".join(f"{r}\n{t}\n" for r, t in turns)
                rows.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(),
                             len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)],
                schema=schema)

    return map_arrow(formatted, run, "conv_id long, n_turns long, turns_sha256 string, "
                                     "loss_chars long, loss_sha256 string, formatted_chars long")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(format_events(turn_events(turns.unionByName(probe))))
