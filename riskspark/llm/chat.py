"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to a string.  Successive
turn prefixes are rendered and consecutive outputs compared: what a turn appends is
its span.  Inside it, the place of the turn's text is found by rendering probe texts in
its stead; what was found for a pair of roles is tried again on a probe in each
later turn, and a turn whose text can't be located is reported.  If adding a turn changes what was rendered before, the template
rewrites history; the turns at which that happens are reported, and the conversation
then has no spans, as no loss mask would be right.

Rows of a conversation go by turn, a null turn first, ties by role and text; null
roles and texts are empty; rows may repeat.  Rows with a null conv_id are one
conversation.  Conversations are handled one after another from sorted partitions,
so a task holds one of them at a time.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import column, map_batches

Turns = list[tuple[str, str]]
#: Texts without a common beginning or end, of characters that templates leave alone.
PROBES = ("aQ7x", "Zk3", "9mB")
SPANS = "array<struct<role: string, start: long, text_start: long, text_end: long, end: long, loss: boolean>>"


class Instruct:
    """A template of bracketed turns.  A control string inside a text gets a
    backslash more than it has before it, so it can't be taken for a mark, and
    `unescape` takes that one away again."""

    marks = {"system": ("<s>[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[ANS] ", " </s>")}
    other = ("[ROLE ", "] ", " [/ROLE]")
    controls = ("<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[ANS]", "[ROLE ", "[/ROLE]")
    _inside = re.compile("(" + "|".join(map(re.escape, controls)) + ")")
    _escaped = re.compile(r"\\(" + "|".join(map(re.escape, controls)) + ")")

    @classmethod
    def escape(cls, text: str) -> str:
        return cls._inside.sub(r"\\\1", text)

    @classmethod
    def unescape(cls, text: str) -> str:
        return cls._escaped.sub(r"\1", text)

    def __call__(self, turns: Turns) -> str:
        out = []
        for role, text in turns:
            head, foot = self.marks.get(role) or (f"{self.other[0]}{self.escape(role)}{self.other[1]}", self.other[2])
            out.append(f"{head}{self.escape(text)}{foot}")
        return "".join(out)

    def role(self, head: str) -> str:
        """The role that a turn's head names."""
        for role, (own, _) in self.marks.items():
            if own == head:
                return role
        return self.unescape(head[len(self.other[0]) : -len(self.other[1])])


def locate(turns: Turns, render: Callable[[Turns], str]) -> tuple[str, list[dict], list[int]]:
    """The whole output, each turn's span and text span, and the turns at whose
    addition earlier output changed (then there are no spans).  A text that can't be
    located has null offsets and no loss."""
    before, spans, rewrites = render([]), [], []
    frames: dict[tuple, tuple[str, str, str] | None] = {}
    for k, (role, text) in enumerate(turns):
        out = render(turns[: k + 1])
        if not out.startswith(before):
            rewrites.append(k)
        elif not rewrites:
            key = (role, turns[k - 1][0] if k else None)
            known = frames.get(key)
            # what held for an earlier turn of these roles is tried on a probe in this one's place
            if known is None or render([*turns[:k], (role, PROBES[0])]) != before + "".join(known):
                frames[key] = _frame([render([*turns[:k], (role, p)]) for p in PROBES], before)
            span = {"role": role, "start": len(before), "text_start": None, "text_end": None, "end": len(out), "loss": False}
            if frames[key] is not None:
                head, _, foot = frames[key]
                added = out[len(before) :]
                if len(added) >= len(head) + len(foot) and added.startswith(head) and added.endswith(foot):
                    span |= {"text_start": len(before) + len(head), "text_end": len(out) - len(foot), "loss": role == "assistant"}
            spans.append(span)
        before = out
    return before, [] if rewrites else spans, rewrites


def _frame(outs: list[str], before: str) -> tuple[str, str, str] | None:
    """What a turn puts before its text, the first probe as it is rendered, and what comes
    after; None if the probes change what was rendered before, or leave no trace."""
    if not all(o.startswith(before) for o in outs):
        return None
    added = [o[len(before) :] for o in outs]
    head = os.path.commonprefix(added)
    rest = [a[len(head) :] for a in added]
    foot = os.path.commonprefix([r[::-1] for r in rest])[::-1]
    text = rest[0][: len(rest[0]) - len(foot)]
    return (head, text, foot) if text else None


def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Turns]]:
    """Conversations of a partition sorted by conv_id and turn."""
    rows = (r for b in batches for r in zip(*(column(b, c).to_pylist() for c in ("conv_id", "role", "text"))))
    for conv, own in groupby(rows, key=lambda r: r[0]):
        yield conv, [(role, text) for _, role, text in own]


def format_conversations(convs: DataFrame, render: Callable[[Turns], str]) -> DataFrame:
    """One row per conversation: conv_id, formatted, spans (with the turns under the
    loss mask marked), rewrites (turns at which the template changed history), unlocated
    (turns whose text was not found in the output; they carry no loss)."""
    names = ["conv_id", "formatted", "spans", "rewrites", "unlocated"]
    span = pa.struct([("role", pa.string()), *((n, pa.int64()) for n in ("start", "text_start", "text_end", "end")), ("loss", pa.bool_())])
    kinds = [pa.int64(), pa.string(), pa.list_(span), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for conv, turns in ordered(batches):
            out, spans, rewrites = locate(turns, render)
            held.append((conv, out, spans, rewrites, [k for k, s in enumerate(spans) if s["text_start"] is None]))
            size += len(out)
            if size > 4 << 20:
                yield _batch(held, names, kinds)
                held, size = [], 0
        yield _batch(held, names, kinds)

    rows = convs.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_batches(rows, run, f"conv_id long, formatted string, spans {SPANS}, rewrites array<long>, unlocated array<long>")


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def read_back(formatted: DataFrame, template: Instruct) -> DataFrame:
    """Digests of what the formatted texts hold: all turns, and the text under the
    loss mask, both unescaped from the output."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def digest(conv: int | None, out: str, spans: list[dict]) -> tuple:
        every, loss, n = hashlib.sha256(), hashlib.sha256(), 0
        for s in spans:
            text = template.unescape(out[s["text_start"] : s["text_end"]])
            every.update(f"{template.role(out[s['start'] : s['text_start']])}\n{text}\n".encode())
            if s["loss"]:
                loss.update(text.encode())
                n += len(text)
        return conv, len(spans), every.hexdigest(), n, loss.hexdigest(), len(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _batch([digest(*r) for r in zip(*(column(b, c).to_pylist() for c in ("conv_id", "formatted", "spans")))], names, kinds)

    return map_batches(formatted, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _sql() -> str:
    q = "'" + "(" + "|".join(re.escape(c).replace("\\ ", " ") for c in Instruct.controls) + ")" + "'"
    marks = " ".join(f"when '{r}' then {len(a) + len(b)}" for r, (a, b) in Instruct.marks.items())
    extra = sum(map(len, Instruct.other))
    return rf"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t as (
  select *, length(text) + len(regexp_extract_all(text, {q})) + case role {marks} else {extra} + length(role) + len(regexp_extract_all(role, {q})) end as n from c)
select cast(conv_id as bigint) as conv_id, cast(count(*) as bigint) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(n) as bigint) as formatted_chars
from t group by conv_id
"""


SQL = _sql()
