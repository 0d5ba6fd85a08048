"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string. Successive prefixes of a conversation are
rendered; as long as each output starts with the one before it, what it adds is the span of the new turn. A template
that rewrites its history is detected by the first output that doesn't, and the conversation is flagged; its turns
then have no spans and nothing of it enters the loss mask.

The loss mask covers the texts of assistant turns: inside a span, it is what stands between the template's own
opening and closing, which two renderings of the same prefix with one-letter texts tell apart from the text.

Rows stream through a task in order of conversation and turn; a task holds one conversation at a time, which is also
one row of the result. Null text and null role are empty strings, null turns come first, rows that tie on turn are
ordered by role and text, rows with a null conv_id form one conversation with that id. Repeated rows are turns of
their own. Extra columns are ignored. An empty table gives no conversation.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turns = list[tuple[str, str]]
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Control strings of common chat formats; a backslash after their first character disarms them.
CONTROL = re.compile(r"([<\[])(\\*)(?=\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|/?SYS>>)")
_DISARMED = re.compile(r"([<\[])\\(\\*)(?=\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|/?SYS>>)")


def escape(text: str) -> str:
    """No control string remains; reversible for every text, as runs of backslashes grow by one."""
    return CONTROL.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _DISARMED.sub(r"\1\2", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _plain_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: Turns) -> str:
    """The default template: marked turns, escaped texts."""
    return "".join([f"{OPEN}{_role(role)}\n{escape(text)}{CLOSE}\n" for role, text in turns])


def parse(formatted: str) -> Turns:
    """Turns read back from the output of :func:`render`."""
    turns = []
    for part in formatted.split(OPEN)[1:]:
        role, _, rest = part.partition("\n")
        turns.append((_plain_role(role), unescape(rest.removesuffix(f"{CLOSE}\n"))))
    return turns


class CachedRender:
    """:func:`render` for growing prefixes: the pieces of turns rendered before are kept."""

    def __init__(self) -> None:
        self.pieces: dict[tuple[str, str], str] = {}

    def __call__(self, turns: Turns) -> str:
        pieces, out = self.pieces, []
        if len(pieces) > 50_000:
            pieces.clear()
        for turn in turns:
            piece = pieces.get(turn)
            if piece is None:
                piece = pieces[turn] = render([turn])
            out.append(piece)
        return "".join(out)


def spans(turns: Turns, template: Callable[[Turns], str], loss_roles: tuple[str, ...] = ("assistant",)) -> tuple[str, list[tuple[int, int, int, int]] | None]:
    """(output, spans): each turn's span and the part of it under the loss mask (empty for other roles).

    None instead of spans if the template rewrites history or wraps a turn in a way that depends on its text.
    """
    before, found = "", []
    for i, (role, text) in enumerate(turns, 1):
        now = template(turns[:i])
        start = len(before)
        if not now.startswith(before):
            return template(turns), None
        masked = (start, start)
        if role in loss_roles and text:
            # Two texts that differ in their only character part exactly where the template puts the text.
            one, two = (template([*turns[: i - 1], (role, probe)]) for probe in "AB")
            head = next((k for k, (x, y) in enumerate(zip(one[start:], two[start:], strict=False), start) if x != y), None)
            if head is None or not (one.startswith(now[:head]) and now.endswith(one[head + 1 :])):
                return template(turns), None
            masked = (head, len(now) - (len(one) - head - 1))
        found.append((start, len(now), *masked))
        before = now
    return before, found


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def format_conversations(rows: DataFrame, template: Callable[[], Callable[[Turns], str]] = CachedRender, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row a conversation: conv_id, n_turns, formatted, rewrites, turn_spans, loss_spans (code points, end exclusive).

    ``template`` makes a template; one is made for each task.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("rewrites", pa.bool_()), ("turn_spans", kind), ("loss_spans", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, out, held = template(), [], 0
        for conv, turns in groupby(_rows(batches), key=lambda r: r[0]):
            turns = [(role, text) for _, role, text in turns]
            text, found = spans(turns, make, loss_roles)
            mask = [(s, e) for _, _, s, e in found or [] if e > s]
            out.append({"conv_id": conv, "n_turns": len(turns), "formatted": text, "rewrites": found is None, "turn_spans": [{"start": s, "end": e} for s, e, _, _ in found or []], "loss_spans": [{"start": s, "end": e} for s, e in mask]})
            held += len(text)
            if len(out) >= 1000 or held > 1 << 23:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    empty = F.lit("")
    plain = rows.select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    ordered = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, formatted string, rewrites boolean, turn_spans array<struct<start:long,end:long>>, loss_spans array<struct<start:long,end:long>>")
