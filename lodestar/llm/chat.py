"""Chat formatting by event-sourced reconstruction.

A log holds events (conv_id, message, seq, kind, role, text) of conversations:
``message`` opens a message, ``delta`` appends to it, ``edit`` replaces its text,
``regenerate`` empties it for new deltas.  The log is partitioned by conversation
and sorted by message and sequence; each task folds its sorted events into final
messages and renders them one by one, so it holds a single message at a time
however long a conversation is.

A rendered turn is ``<|turn|>role<|text|>text<|end|>`` and a newline.  Inside roles
and texts a backslash is doubled and one is put behind the first character of every
control string (own or of other common templates), so none survives and the original
reads back.  The loss mask is the text of assistant turns.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: The first character of a control string, where it starts one.
CONTROL = re.compile(r"<(?=\||/?s>|/?SYS>|start_of_turn>|end_of_turn>)|\[(?=/?INST\]|/?SYSTEM_PROMPT\])")
DELTA = 1024


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, loss start, loss end); no loss: an empty span at the end."""
    head = TURN + escape(role) + TEXT
    body = escape(text)
    out = head + body + END
    return (out, len(head), len(head) + len(body)) if role == "assistant" else (out, len(out), len(out))


def parse(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    role, _, body = formatted.removeprefix(TURN).partition(TEXT)
    return unescape(role), unescape(body.removesuffix(END))


def events_of_rows(rows: DataFrame, delta: int = DELTA) -> DataFrame:
    """The log of a table of turns (conv_id, turn, role, text): each row is a message of
    its own whose text streams in as deltas.  Rows that repeat a turn stay, in order of
    role and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    message = F.struct(F.col("turn").alias("turn"), F.col("role").cast("string").alias("role"), F.xxhash64(text).alias("h"),
                       F.monotonically_increasing_id().alias("row"))
    named = rows.select("conv_id", message.alias("message"), F.col("role").cast("string").alias("role"), text.alias("text"))
    # one pass over the text, whatever its length: pieces of up to ``delta`` code points
    chunks = F.concat(F.array(F.lit("")), F.regexp_extract_all("text", F.lit(f"(?s).{{1,{delta}}}"), F.lit(0)))
    return (named.select("conv_id", "message", "role", F.posexplode(chunks).alias("seq", "piece"))
            .select("conv_id", "message", F.col("seq").cast("long").alias("seq"),
                    F.when(F.col("seq") == 0, "message").otherwise("delta").alias("kind"), "role", F.col("piece").alias("text")))


def format_conversations(events: DataFrame) -> DataFrame:
    """One row per final message, a conversation's rows in order and next to each other:
    conv_id, place (from 0), role, formatted, loss_start, loss_end (within formatted).

    Null roles and texts count as empty.  A delta, edit or regeneration without a
    message before it opens one with the event's role; events that repeat are applied
    again.  Null conversation ids are one conversation, null sequences come first."""
    conv = events.schema["conv_id"].dataType.simpleString()
    kind_order = F.when(F.col("kind") == "message", 0).otherwise(1)
    log = (events.select("conv_id", "message", "seq", kind_order.alias("_first"), "kind", "role", "text")
           .repartition("conv_id").sortWithinPartitions("conv_id", "message", "seq", "_first", "kind", "role", "text")
           .select("conv_id", F.xxhash64("message").alias("message"), "kind", "role", "text"))

    def run(batches):
        # the open message: key, role, pieces of text; place in its conversation
        conv_now, key, role, pieces, place = object(), None, "", None, 0
        out: list[tuple] = []
        held = 0

        def close():
            nonlocal place, held
            if pieces is not None:
                formatted, a, b = render(role, "".join(pieces))
                out.append((conv_now, place, role, formatted, a, b))
                held += len(formatted)
                place += 1

        def flush():
            nonlocal held
            made = pa.record_batch([pa.array(c, type=t) for c, t in zip(zip(*out), kinds)],
                                   names=["conv_id", "place", "role", "formatted", "loss_start", "loss_end"])
            out.clear()
            held = 0
            return made

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        for batch in batches:
            kinds[0] = batch.column("conv_id").type
            for c, m, kind, r, t in zip(*[col.to_pylist() for col in batch.columns]):
                if c != conv_now or m != key or kind == "message" or pieces is None:
                    close()
                    if c != conv_now:
                        conv_now, place = c, 0
                    key, role, pieces = m, r or "", [t or ""]
                elif kind == "delta":
                    pieces.append(t or "")
                else:                      # edit, regenerate
                    pieces = [t or ""]
                if held > 4_000_000:
                    yield flush()
        close()
        if out:
            yield flush()

    return log.mapInArrow(run, f"conv_id {conv}, place long, role string, formatted string, loss_start long, loss_end long")


def digest(formatted: DataFrame) -> DataFrame:
    """What reads back from the output of ``format_conversations``, one row per
    conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    Streams over the turns (a conversation's are next to each other), hash states only."""
    conv = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches):
        now, state, out = object(), None, []

        def close():
            if state is not None:
                n, turns, chars, loss, total = state
                out.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), total))

        for batch in batches:
            kind = batch.column("conv_id").type
            for c, text, a, b in zip(*[batch.column(x).to_pylist() for x in ("conv_id", "formatted", "loss_start", "loss_end")]):
                if state is None or c != now:
                    close()
                    now, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, said = parse(text)
                learned = unescape(text[a:b])
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(text)
            if out:
                yield made(out, kind)
                out.clear()
        close()
        if out:
            yield made(out, kind)

    def made(out, kind):
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.record_batch([pa.array(c, type=t) for c, t in zip(zip(*out), kinds)],
                               names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInArrow(run, f"conv_id {conv}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
