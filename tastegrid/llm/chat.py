"""Chat formatting with any template: spans are found by rendering, not by knowing the template.

A template is a function from a list of (role, text) to one string. The turns of a conversation are
rendered as growing prefixes; where one output continues the one before, the rest is the span of the
new turn. A template that changes what it wrote before is detected, turn by turn. Prefixes are whole, so a
conversation is held and rendered again for each turn; only a template that is declared ``local`` gets its latest turns alone.

``render`` is the default template. It marks turns and escapes, reversibly, what could be read as a mark.

Null roles and texts count as empty, a null conversation id is an id of its own. Turns are ordered by number,
nulls first, ties by role and text; repeated rows are turns of their own. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turns = Sequence[tuple[str, str]]

# Fixed values of the default template. A mark begins with "<|"; texts never hold an unescaped "<".
OPEN, MIDDLE, CLOSE = "<|turn|>", "<|text|>", "<|end|>\n"
WINDOW = 64  # earlier turns that are rendered before a turn, for local templates


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l").replace("[", "\\b")


def unescape(text: str) -> str:
    out, parts = [], text.split("\\\\")
    for part in parts:
        out.append(part.replace("\\l", "<").replace("\\b", "["))
    return "\\".join(out)


def local(template: Callable[[Turns], str]) -> Callable[[Turns], str]:
    """Declares that a template writes its turns one after the other, each as if it stood alone."""
    template.local = True
    return template


@local
def render(turns: Turns) -> str:
    """The default template; an assistant text's place is what follows the middle mark."""
    return "".join(f"{OPEN}{escape(role)}{MIDDLE}{escape(text)}{CLOSE}" for role, text in turns)


def read_turn(span: str) -> tuple[str, str, int, int]:
    """(role, text, start, end) read back from one rendered turn; start and end bound the escaped text."""
    if not span.startswith(OPEN) or not span.endswith(CLOSE):
        raise ValueError("not one rendered turn")
    start = span.index(MIDDLE) + len(MIDDLE)
    end = len(span) - len(CLOSE)
    return unescape(span[len(OPEN):start - len(MIDDLE)]), unescape(span[start:end]), start, end


class Incremental:
    """Feeds turns one by one to a black-box template and reports each turn's span.

    Every prefix is the whole conversation so far, which takes memory in proportion to it and time to its square.
    Of a template that is declared ``local``, at most ``window`` turns are rendered at a time, so that a conversation of
    any length takes bounded memory and time in proportion to its turns; a declaration that does not
    hold where turns are dropped is an error. Other templates have no window.
    """

    def __init__(self, template: Callable[[Turns], str], window: int = WINDOW):
        self.template = template
        self.window = window if getattr(template, "local", False) else None
        self.turns: list[tuple[str, str]] = []
        self.output = ""

    def add(self, role: str, text: str) -> tuple[str, bool]:
        """(rendered span, whether the template rewrote earlier output)."""
        if self.window is not None and len(self.turns) >= self.window:
            self.turns = self.turns[len(self.turns) // 2:]
            output, before = self.template(self.turns), self.output
            if not before.endswith(output):
                raise ValueError("the template is declared local, but renders late turns otherwise without the early ones")
            self.output = output
        self.turns.append((role, text))
        output, before = self.template(self.turns), self.output
        self.output = output
        if output.startswith(before):
            return output[len(before):], False
        low, high = 0, min(len(before), len(output))  # the longest prefix that stayed
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if before[:middle] == output[:middle] else (low, middle - 1)
        return output[low:], True


def in_order(conversations: DataFrame, conv="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    table = conversations.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"),
                                 F.coalesce(F.col(role), F.lit("")).alias("_role"),
                                 F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return table.repartition("_conv").sortWithinPartitions("_conv", "_turn", "_role", "_text")


def format_turns(conversations: DataFrame, template: Callable[[Turns], str] = render, window: int = WINDOW,
                 conv="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """(conv, n, start, rendered, rewrote) per turn: its number from 0, where its span begins, and the span.

    For a template that rewrites history (``rewrote``) the span is what follows the part that stayed.
    A conversation stays in one task, since a prefix is needed for each of its turns. With a ``local`` template it
    streams through it and only the latest turns are held, ``window`` at most; with any other all its turns are.
    """
    def run(batches):
        state, key, n, start = None, object(), 0, 0
        for batch in batches:
            rows = []
            ids, _, roles, texts = (batch.column(k).to_pylist() for k in range(4))
            for c, r, x in zip(ids, roles, texts):
                if state is None or c != key:
                    state, key, n, start = Incremental(template, window), c, 0, 0
                span, rewrote = state.add(r, x)
                rows.append((c, n, start, span, rewrote))
                n, start = n + 1, start + len(span)
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             ["_conv", "n", "start", "rendered", "rewrote"])

    return in_order(conversations, conv, turn, role, text).mapInArrow(
        run, "_conv bigint, n bigint, start bigint, rendered string, rewrote boolean").withColumnRenamed("_conv", conv)


def conversation_digests(turns: DataFrame, conv="conv_id", learn_from: str = "assistant") -> DataFrame:
    """One row per conversation, read back from spans that the default template made.

    Digests stream over the turns in order, so a task holds one turn and two hash states.
    """
    names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches):
        key, held = None, None
        done = []

        def close():
            done.append((key, held[0], held[1].hexdigest(), held[2], held[3].hexdigest(), held[4], held[5]))

        for batch in batches:
            for c, _, _, span, rewrote in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if held is None or c != key:
                    if held is not None:
                        close()
                    key, held = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                role, text, _, _ = read_turn(span)
                held[0] += 1
                held[1].update(f"{role}\n{text}\n".encode())
                if role == learn_from:
                    held[2] += len(text)
                    held[3].update(text.encode())
                held[4] += len(span)
                held[5] += rewrote
            yield flush(done)
        if held is not None:
            close()
        yield flush(done)

    def flush(done):
        columns = list(zip(*done)) if done else [[]] * len(kinds)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    ordered = turns.select(conv, "n", "start", "rendered", "rewrote").repartition(conv).sortWithinPartitions(conv, "n")
    return ordered.mapInArrow(run, f"`{conv}` bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                   "loss_sha256 string, formatted_chars bigint, rewrites bigint")
