"""Chat formatting by rendering successive prefixes of a conversation.

The template is a black box: a function from turns to text. Rendering a prefix with and
without its last turn and comparing the two outputs gives that turn's span. A template that
changes what it wrote before is found by the same comparison.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]  # role, text
Template = Callable[[list[Turn], str | None], str]

BLOCK_TURNS = 16
CHECK_CHARS = 8 << 20  # of a conversation, up to which a declared template is held to it


def context_free(template: Template) -> Template:
    """Declare that a turn's text depends on that turn only, so rendering may start anew."""
    template.context_free = True
    return template


_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str, marks: str = "#<") -> str:
    """Put a backslash before each mark and backslash, so that no control string is left."""
    for mark in "\\" + marks:
        text = text.replace(mark, "\\" + mark)
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@context_free
def marked_turns(turns: list[Turn], opening: str | None = None) -> str:
    """The built-in template: ``### role: text </turn>`` and a line end for each turn.

    ``opening`` adds the start of a further turn of that role, as a prompt for generation.
    """
    out = [f"### {escape(role, '#<:')}: {escape(text)} </turn>\n" for role, text in turns]
    if opening is not None:
        out.append(f"### {escape(opening, '#<:')}: ")
    return "".join(out)


def read_marked(piece: str) -> Turn:
    """Role and text of one turn that :func:`marked_turns` wrote."""
    end = re.match(r"### ((?:[^\\:]|\\.)*): ", piece, re.S)
    return unescape(end[1]), unescape(piece[end.end() : -len(" </turn>\n")])


class Prefixes:
    """Spans of a conversation's turns, by rendering ever longer prefixes.

    Every prefix is rendered from the first turn on: a template may number turns, or change or
    drop old ones, at any length. The work for a turn then grows with the turns before it.

    With ``block``, for templates declared :func:`context_free`, rendering starts anew after so
    many turns, from the last turn on, so that neither work nor memory grow. The shared turn
    must get the same span in both blocks, else it is reported like rewritten history. So is a
    declaration that is not true: at doubling lengths, while the turns so far are short enough
    to be kept, all of them are rendered and compared with the spans, at a linear cost.
    """

    def __init__(self, template: Template, block: int | None = None):
        self.template, self.block = template, block
        self.turns: list[Turn] = []
        self.before = template([], None)
        self.prefix = self.before
        self.last: str | None = None
        self.all: list[Turn] | None = None if block is None else []
        self.kept_chars = 0
        self.check_at = 2 * (block or 1)
        self.written = hashlib.sha256(self.before.encode())

    def _declared_rightly(self, role: str, text: str, span: str | None) -> bool:
        """Compare a rendering of all turns with the spans where its length has doubled."""
        if self.all is None or span is None:
            return True
        self.all.append((role, text))
        self.written.update(span.encode())
        self.kept_chars += len(role) + len(text)
        if self.kept_chars > CHECK_CHARS:
            self.all = None
        elif len(self.all) == self.check_at:
            self.check_at *= 2
            whole = hashlib.sha256(self.template(self.all, None).encode())
            return whole.digest() == self.written.digest()
        return True

    def add(self, role: str, text: str) -> tuple[str | None, int, int]:
        """The turn's span, and start and length of its text in it; no span if rewritten."""
        checked = True
        if self.block is not None and len(self.turns) >= self.block:
            self.turns = self.turns[-1:]
            self.before = self.template(self.turns, None)
            if self.last is not None:
                checked = self.before.endswith(self.last)
        after = self.template([*self.turns, (role, text)], None)
        empty = self.template([*self.turns, (role, "")], None)
        opened = self.template(self.turns, role)
        self.turns.append((role, text))
        known = checked and all(x.startswith(self.before) for x in (after, empty, opened))
        span = after[len(self.before) :] if known else None
        start = len(opened) - len(self.before)
        length = len(after) - len(empty)
        self.before, self.last = after, span
        if not self._declared_rightly(role, text, span):
            span = None
        return span, start, length


def _text(value: object) -> str:
    return value if isinstance(value, str) else ""


def format_turns(
    conversations: DataFrame,
    template: Template = marked_turns,
    loss_role: str = "assistant",
    key: str = "conv_id",
) -> DataFrame:
    """Format conversations; one row per turn, with its span of the formatted text.

    Input: ``conv_id, turn, role, text``; other columns are dropped. Output: ``conv_id, turn,
    span_start`` (characters of the conversation before the span), ``span`` (formatted text),
    ``loss_start, loss_length`` (characters of the span under the loss mask, nothing for other
    roles), ``rewritten``. A conversation is the spans of its turns in order, after what the
    template writes for no turns, which counts in ``span_start``.

    Null texts and roles are empty. Turns are ordered by number, null first, then by role and
    text, so ties and repeated rows have a fixed order and stay. Rows with a null key form one
    conversation. If the template rewrites history, ``span`` is null and ``rewritten`` is true
    from the turn at which it did. An empty table gives no rows.

    Rows of a conversation are sorted by Spark and streamed through a task. With a template
    declared :func:`context_free` no more than ``CHECK_CHARS`` of a conversation are held,
    however long it is, to hold the template to that; any other template is given each prefix
    whole.
    """
    block = BLOCK_TURNS if getattr(template, "context_free", False) else None
    rows = conversations.select(
        F.col(key).alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: object = run  # no key is equal to it
        for frame in frames:
            out = []
            for conv, turn, role, text in zip(frame.conv_id, frame.turn, frame.role, frame.text):
                conv = None if pd.isna(conv) else int(conv)
                if conv != now:
                    now, prefixes, broken = conv, Prefixes(template, block), False
                    place = len(prefixes.before)
                span, start, length = prefixes.add(_text(role), _text(text))
                broken = broken or span is None
                lossy = role == loss_role and not broken
                out.append(
                    (
                        conv,
                        None if pd.isna(turn) else int(turn),
                        role,
                        place,
                        None if broken else span,
                        start if lossy else 0,
                        length if lossy else 0,
                        broken,
                    )
                )
                place += len(span or "")
            result = pd.DataFrame(out, columns=_COLUMNS)
            yield result.astype({"conv_id": "Int64", "turn": "Int64"})

    return ordered.mapInPandas(run, SCHEMA)


_COLUMNS = ["conv_id", "turn", "role", "span_start", "span"]
_COLUMNS += ["loss_start", "loss_length", "rewritten"]
SCHEMA = (
    "conv_id bigint, turn bigint, role string, span_start bigint, span string, "
    "loss_start bigint, loss_length bigint, rewritten boolean"
)


class Digest:
    """What is read back from the formatted turns of one conversation."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, start: int, span: str, loss_start: int, loss_length: int) -> None:
        role, text = read_marked(span)
        self.turns += 1
        self.all.update(f"{role}\n{text}\n".encode())
        masked = unescape(span[loss_start : loss_start + loss_length])
        self.loss.update(masked.encode())
        self.loss_chars += len(masked)
        self.chars = start + len(span)

    def row(self) -> tuple:
        return (
            self.conv,
            self.turns,
            self.all.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.chars,
        )


_DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read from the spans that :func:`format_turns` returned.

    Works on its output as it comes: ordered within partitions. For the built-in template.
    """

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest: Digest | None = None

        def table(done: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(done, columns=_DIGEST).astype({"conv_id": "Int64"})

        for frame in frames:
            done = []
            columns = (frame.conv_id, frame.span_start, frame.span, frame.loss_start)
            for conv, start, span, loss_start, loss in zip(*columns, frame.loss_length):
                conv = None if pd.isna(conv) else int(conv)
                if digest is None or digest.conv != conv:
                    if digest is not None:
                        done.append(digest.row())
                    digest = Digest(conv)
                digest.add(start, span, loss_start, loss)
            yield table(done)
        if digest is not None:
            yield table([digest.row()])

    schema = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint"
    )
    return formatted.mapInPandas(run, schema)
