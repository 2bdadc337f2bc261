r"""Chat formatting with a grammar round trip.

A turn is ``### role: text</turn>`` and a line feed; a conversation is its turns one behind the
other. The parser is deterministic: a control string after an even number of backslashes is
one, half of the backslashes belong to the text before it; after an odd number it is text, with
half of the backslashes rounded down. Rendering is checked by parsing: a turn is rendered as it
is, parsed again, and only if the result differs, its conflicting control strings are escaped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tramline.llm.common import in_small_batches, parallelism, written

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>"
LEARNED_ROLE = "assistant"

_ROLE = re.compile(r"(\\*)(### |: |</turn>)")
_TEXT = re.compile(r"(\\*)(### |</turn>)")


class Conflict(ValueError):
    """The rendered text is not in the grammar."""


def _escaped(text: str, controls: re.Pattern) -> str:
    r"""n backslashes before a control string become 2n + 1, and before the end 2n."""
    text = controls.sub(lambda m: "\\" * (2 * len(m[1]) + 1) + m[2], text)
    tail = len(text) - len(text.rstrip("\\"))
    return text + "\\" * tail


def _until(text: str, at: int, controls: re.Pattern, end: str) -> tuple[str, int]:
    """The unescaped text from ``at`` to the control string ``end``, and the place behind it."""
    parts = []
    for m in controls.finditer(text, at):
        slashes = len(m[1])
        parts.append(text[at : m.start()] + "\\" * (slashes // 2))
        at = m.end()
        if slashes % 2:
            parts.append(m[2])
        elif m[2] == end:
            return "".join(parts), at
        else:
            raise Conflict(f"{m[2]!r} where {end!r} is due")
    raise Conflict(f"no {end!r}")


def parse_turn(text: str, at: int = 0) -> tuple[str, str, int]:
    """(role, text, place behind it) of the turn at ``at``."""
    if not text.startswith(OPEN, at):
        raise Conflict(f"no turn at {at}")
    role, at = _until(text, at + len(OPEN), _ROLE, MIDDLE)
    body, at = _until(text, at, _TEXT, CLOSE)
    if not text.startswith("\n", at):
        raise Conflict(f"no line end at {at}")
    return role, body, at + 1


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    turns, at = [], 0
    while at < len(text):
        role, body, at = parse_turn(text, at)
        turns.append((role, body))
    return turns


def render_turn(role: str, body: str) -> tuple[str, int, int]:
    """The rendered turn and the first and last place of its text there; proven by parsing it."""
    for spelled in ((role, body), (_escaped(role, _ROLE), _escaped(body, _TEXT))):
        start = len(OPEN) + len(spelled[0]) + len(MIDDLE)
        made = f"{OPEN}{spelled[0]}{MIDDLE}{spelled[1]}{CLOSE}\n"
        try:
            if parse_turn(made) == (role, body, len(made)):
                return made, start, start + len(spelled[1])
        except Conflict:
            pass
    raise Conflict(f"a turn of {role!r} cannot be rendered")


def format_conversations(turns: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """(conv_id, turn, formatted, loss_start, loss_end) of every row.

    A conversation is the ``formatted`` of its rows in the order of (turn, formatted), one behind
    the other, so none has to fit into one row. The loss mask of a turn is its text from
    ``loss_start`` to ``loss_end``; it is empty for other roles. Null role and text are empty;
    rows without a conversation share the null one; null turns come first; repeated rows are
    turns of their own; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                (*render_turn(role, text), role == learned_role)
                for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"), batch.column("turn"), pa.array([m[0] for m in made], pa.string()),
                    pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] if m[3] else m[1] for m in made], pa.int64()),
                ],
                ["conv_id", "turn", "formatted", "loss_start", "loss_end"],
            )

    rows = in_small_batches(turns).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(run, "conv_id long, turn long, formatted string, loss_start long, loss_end long")


def conversation_digest(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, parsed again.

    Turns stream through in order; a hash and counts are all that is kept of a conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_, out = None, False, []

        def close() -> None:
            out.append((now, turns, digest.hexdigest(), chars, loss.hexdigest(), formatted_chars))

        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("conv_id", "formatted", "loss_start", "loss_end"))
            for conv, text, start, end in zip(*columns):
                if not open_ or conv != now:
                    if open_:
                        close()
                    now, open_ = conv, True
                    turns = chars = formatted_chars = 0
                    digest, loss = hashlib.sha256(), hashlib.sha256()
                (role, body), = parse(text)
                digest.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                if end > start:
                    learned, _ = _until(text[start:end] + CLOSE, 0, _TEXT, CLOSE)
                    chars += len(learned)
                    loss.update(learned.encode("utf-8", "surrogatepass"))
                turns, formatted_chars = turns + 1, formatted_chars + len(text)
            yield _digest_batch(out)
            out.clear()
        if open_:
            close()
            yield _digest_batch(out)

    return (
        in_small_batches(formatted)
        .repartition(parallelism(formatted.sparkSession), "conv_id")
        .sortWithinPartitions("conv_id", "turn", "formatted")
        .mapInArrow(run, _DIGEST_DDL)
    )


_DIGEST_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ]
)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(_DIGEST.names, row)) for row in rows], schema=_DIGEST)


def formatted_digest(turns: DataFrame) -> DataFrame:
    """Format, write, read back, and tell what the output holds."""
    return conversation_digest(written(format_conversations(turns), "chat"))
