"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string.  Successive
turn prefixes are rendered and compared with the output before: where the old output is a
prefix of the new one, the new tail is the span of the added turn; where it is not, the
template rewrites history, which the result reports.  The loss mask covers the text of assistant turns,
without the markers around it.  The default template's turns are parsed for it; of any other
template the output is compared with one in which a probe stands for the text: what is equal before and
after the probe encloses the text.

Conversations are shuffled by id and streamed turn by turn in order; a task holds the one
conversation it renders, as any template must.

Defined cases: a null text or role is empty; turns sort by (turn, role, text), nulls first;
repeated rows are turns of their own; a null conversation id is one conversation; an empty
table gives no rows.  A turn whose text the template leaves out has no mask; where the probe does not tell
where a text lies (the template repeats it, or changes what is around it), the mask of the
conversation is null, never silently empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import map_arrow

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# The markers of the default template.
START, END, ESCAPE = "<|im_start|>", "<|im_end|>", "\\"


def escape(text: str) -> str:
    """Make control strings in a text harmless: a backslash goes into each ``<|`` and before each backslash."""
    return text.replace(ESCAPE, ESCAPE * 2).replace("<|", f"<{ESCAPE}|")


def unescape(text: str) -> str:
    """The exact inverse of :func:`escape`."""
    out, at = [], 0
    while (cut := text.find(ESCAPE, at)) >= 0:
        out += (text[at:cut], text[cut + 1 : cut + 2])
        at = cut + 2
    return "".join((*out, text[at:]))


def marked_turns(turns: list[Turn]) -> str:
    """The default template: start marker, role, newline, text, end marker, newline."""
    return "".join(f"{START}{escape(role).replace(chr(10), ESCAPE + chr(10))}\n{escape(text)}{END}\n" for role, text in turns)


@dataclass
class Rendered:
    text: str
    spans: list[tuple[int, int]]  # of each turn in ``text``
    rewrites: list[int] = field(default_factory=list)  # turns whose addition changed earlier output


def render(turns: list[Turn], template: Template = marked_turns) -> Rendered:
    """Render prefix after prefix and locate each turn by what it adds."""
    # what stands before any turn is found by rendering none; a template may refuse that
    try:
        before = template([])
    except (ValueError, IndexError):
        before = ""
    spans, rewrites = [], []
    for k in range(len(turns)):
        now = template(turns[: k + 1])
        start = len(before)
        if not now.startswith(before):
            start = len(commonprefix([before, now]))
            rewrites.append(k)
            # spans that reach into the rewritten part are cut where the outputs part
            spans = [(min(a, start), min(b, start)) for a, b in spans]
        spans.append((start, len(now)))
        before = now
    return Rendered(before, spans, rewrites)


def read_turn(span: str) -> tuple[Turn, tuple[int, int]]:
    """Parse one turn of the default template: (role, text) and where its escaped text lies in the span."""
    if not (span.startswith(START) and span.endswith(END + "\n")):
        raise ValueError("not a marked turn")
    at = len(START)
    while span[at] != "\n":
        at += 2 if span[at] == ESCAPE else 1
    body = (at + 1, len(span) - len(END) - 1)
    return (unescape(span[len(START) : at]), unescape(span[slice(*body)])), body


def read_back(rendered: Rendered) -> tuple[list[Turn], list[tuple[int, int]]]:
    """All turns read from the output, and the loss mask: spans of the assistant texts."""
    turns, mask = [], []
    for start, end in rendered.spans:
        turn, (a, b) = read_turn(rendered.text[start:end])
        turns.append(turn)
        if turn[0] == "assistant":
            mask.append((start + a, start + b))
    return turns, mask


# A character of the private use area, which a template has no reason to write itself.
PROBE = "\ue0f0"


def located_texts(turns: list[Turn], template: Template, rendered: str, role: str = "assistant") -> list[tuple[int, int]] | None:
    """Spans in ``rendered`` of the texts of one role under any template; None where a text cannot be located."""
    spans = []
    for k, (own, _) in enumerate(turns):
        if own != role:
            continue
        probed = template([*turns[:k], (own, PROBE), *turns[k + 1 :]])
        marks = probed.count(PROBE) - sum(text.count(PROBE) for j, (_, text) in enumerate(turns) if j != k)
        if marks == 0:
            continue  # left out
        before, _, after = probed.partition(PROBE)
        if marks > 1 or probed.count(PROBE) > 1 or len(before) + len(after) > len(rendered) or not (rendered.startswith(before) and rendered.endswith(after)):
            return None
        spans.append((len(before), len(rendered) - len(after)))
    return spans


FORMAT_SCHEMA = "conv_id bigint, formatted string, spans array<struct<start:int,end:int>>, mask array<struct<start:int,end:int>>, rewrites array<int>"
DIGEST_SCHEMA = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Turn]]]:
    key, turns = None, []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("_key", "conv_id", "role", "text"))
        for own, conv, role, text in zip(*columns, strict=True):
            if turns and (own, conv) != key:
                yield key[1], turns
                turns = []
            key = (own, conv)
            turns.append((role or "", text or ""))
    if turns:
        yield key[1], turns


def _ordered(conversations: DataFrame, part: str | None) -> DataFrame:
    own = F.lit(0) if part is None else F.col(part).cast("int")
    rows = conversations.select(own.alias("_key"), F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.repartition("_key", "conv_id").sortWithinPartitions("_key", "conv_id", "turn", "role", "text")


def format_conversations(conversations: DataFrame, template: Template = marked_turns, part: str | None = None) -> DataFrame:
    """One row a conversation: the text, each turn's span, the loss mask (null if it is not known) and turns that rewrote history.

    ``part`` names a column that keeps conversations of equal id apart.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for conv, turns in _conversations(batches):
            done = render(turns, template)
            mask = read_back(done)[1] if template is marked_turns else located_texts(turns, template, done.text)
            as_pairs = lambda x: pa.array([x if x is None else [{"start": a, "end": b} for a, b in x]], pair)
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([done.text]), as_pairs(done.spans), as_pairs(mask), pa.array([done.rewrites], pa.list_(pa.int32()))],
                ["conv_id", "formatted", "spans", "mask", "rewrites"],
            )

    return map_arrow(_ordered(conversations, part), apply, FORMAT_SCHEMA)


def _digest(conv: int | None, text: str, spans: list[tuple[int, int]], mask: list[tuple[int, int]]) -> tuple:
    turns, _ = read_back(Rendered(text, spans))
    told = "".join(f"{role}\n{said}\n" for role, said in turns)
    learnt = "".join(unescape(text[a:b]) for a, b in mask)
    digest = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
    return conv, len(turns), digest(told), len(learnt), digest(learnt), len(text)


def digests(formatted: DataFrame) -> DataFrame:
    """Read turns and loss texts back from formatted conversations and digest them."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in DIGEST_SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                rows.append(_digest(r["conv_id"], r["formatted"], [(s["start"], s["end"]) for s in r["spans"]], [(s["start"], s["end"]) for s in r["mask"]]))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], names)

    return map_arrow(formatted, apply, DIGEST_SCHEMA)
