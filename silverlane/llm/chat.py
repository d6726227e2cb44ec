"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as one text and encoded once, with the offsets of all tokens. The places of
the turns are known from rendering; a binary search in the sorted token offsets finds the tokens that
meet a turn, and what a token shares with a turn that counts for the loss is its part of the mask.

The marks of turns are single tokens that split a text before anything else, so a conversation can be
encoded in segments of whole turns with the same result. That bounds memory: rows are dealt out by
ranges of (conversation, turn), and one huge conversation is spread over many tasks. Only a digest of
a whole conversation has to see its segments one after the other.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from silverlane.llm.store import pick

#: A segment ends with the turn that brings it to so many characters.
SEGMENT_CHARS = 500_000


@dataclass(frozen=True)
class Template:
    """`turn` role `text` what was said `end`, for each turn; no mark or control string is left inside a turn."""

    turn: str = "<|turn|>"
    text: str = "<|text|>"
    end: str = "<|end|>"
    controls: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")

    @property
    def marks(self) -> list[str]:
        return [self.turn, self.text, self.end]

    def escape(self, text: str) -> str:
        """A backslash goes into each control string after its first character; backslashes are doubled."""
        text = text.replace("\\", "\\\\")
        for control in (*self.marks, *self.controls):
            text = text.replace(control, f"{control[0]}\\{control[1:]}")
        return text

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def render(self, role: str, text: str) -> tuple[str, int, int]:
        """A turn, and where in it its text begins and ends."""
        before, inside = f"{self.turn}{self.escape(role)}{self.text}", self.escape(text)
        return before + inside + self.end, len(before), len(before) + len(inside)

    def parse(self, formatted: str) -> Iterator[tuple[str, str]]:
        """Role and text of each turn, read back."""
        turn, text, end = map(re.escape, self.marks)
        for match in re.finditer(f"{turn}(.*?){text}(.*?){end}", formatted, re.DOTALL):
            yield self.unescape(match[1]), self.unescape(match[2])


def covered(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which tokens meet a span, and the parts of the spans they cover, joined where they touch.

    Token offsets and spans are both sorted; the tokens of a span are found by binary search.
    """
    mask = np.zeros(len(starts), bool)
    parts: list[tuple[int, int]] = []
    first = np.searchsorted(ends, [s for s, _ in spans], side="right")
    last = np.searchsorted(starts, [e for _, e in spans], side="left")
    for (start, end), low, high in zip(spans, first.tolist(), last.tolist()):
        if start == end or low >= high:
            continue
        mask[low:high] = True
        begin, until = np.maximum(starts[low:high], start), np.minimum(ends[low:high], end)
        reached = np.maximum.accumulate(until)  # several tokens may share a character
        new = np.flatnonzero(np.concatenate([[True], begin[1:] > reached[:-1]]))
        parts += zip(begin[new].tolist(), reached[np.append(new[1:], len(reached)) - 1].tolist())
    return mask, parts


SEGMENT = T.StructType(
    [
        T.StructField("place", T.LongType()),  # orders the segments of a conversation
        T.StructField("formatted", T.StringType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("loss_mask", T.ArrayType(T.BooleanType())),  # of the ids
        T.StructField("loss_spans", T.ArrayType(T.ArrayType(T.LongType()))),  # of characters of `formatted`
    ]
)


def format_conversations(
    rows: DataFrame,
    tokenizer: str,
    template: Template = Template(),
    learned: tuple[str, ...] = ("assistant",),
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, place, formatted, ids, loss_mask, loss_spans): segments of rendered and encoded conversations.

    Turns go by turn, then role and text, null first. A null text or role is empty; rows without conv_id are
    one conversation. Repeated rows are turns of their own. The texts of turns whose role is in `learned` are
    under the mask. Other columns are not looked at.
    """
    turns = pick(rows, conv_id=conv_id, turn=turn, role=role, text=text)
    schema = T.StructType([turns.schema["conv_id"], *SEGMENT.fields])
    kind = turns.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        from tokenizers import AddedToken, Tokenizer

        encoder = Tokenizer.from_file(tokenizer)
        encoder.no_padding()
        encoder.no_truncation()
        encoder.add_special_tokens([AddedToken(m, normalized=False, special=True) for m in template.marks])
        place = TaskContext.get().partitionId() << 32
        texts: list[str] = []
        spans: list[tuple[int, int]] = []
        size, current, out = 0, None, []

        def segment() -> None:
            nonlocal size, place
            whole = "".join(texts)
            coded = encoder.encode(whole, add_special_tokens=False)
            flat = np.fromiter(chain.from_iterable(coded.offsets), np.int64)
            mask, parts = covered(flat[0::2], flat[1::2], spans)
            out.append((current, place, whole, np.array(coded.ids, np.int32), mask, parts))
            texts.clear()
            spans.clear()
            size, place = 0, place + 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            kinds = [to_arrow_type(f.dataType) for f in SEGMENT.fields]
            arrays = [pa.array(c, k) for c, k in zip(columns, [to_arrow_type(kind), *kinds])]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        for batch in batches:
            for conv, role, text in zip(*(batch.column(c) for c in ("conv_id", "role", "text"))):
                conv, role = conv.as_py(), role.as_py() or ""
                if texts and (conv != current or size >= SEGMENT_CHARS):
                    segment()
                current = conv
                turn, start, end = template.render(role, text.as_py() or "")
                if role in learned:
                    spans.append((size + start, size + end))
                texts.append(turn)
                size += len(turn)
                if len(out) >= 500:
                    yield flush()
        if texts:
            segment()
        if out:
            yield flush()

    dealt = turns.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, schema)


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """What the formatted segments of each conversation say, as digests; one row for each conversation."""
    key = segments.schema["conv_id"]
    schema = T.StructType(
        [
            key,
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_loss_tokens", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, current, state, done = to_arrow_schema(schema), None, None, []

        def close() -> None:
            n, turns, chars, loss, formatted, tokens, learned = state
            done.append((current, n, turns.hexdigest(), chars, loss.hexdigest(), formatted, tokens, learned))

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*done), arrow)]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        for batch in batches:
            masks = batch.column("loss_mask")
            sizes = masks.value_lengths().to_numpy()
            kept = np.concatenate([[0], np.cumsum(masks.flatten().to_numpy(zero_copy_only=False))])
            ends = np.cumsum(sizes)
            learned = kept[ends] - kept[ends - sizes]
            rows = zip(*(batch.column(c) for c in ("conv_id", "formatted", "loss_spans")), sizes.tolist(), learned.tolist())
            for conv, formatted, spans, n_tokens, n_learned in rows:
                conv, formatted = conv.as_py(), formatted.as_py()
                if state is not None and conv != current:
                    close()
                    state = None
                state = state or [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                current = conv
                for role, text in template.parse(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for a, b in spans.as_py():
                    text = template.unescape(formatted[a:b])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(formatted)
                state[5] += n_tokens
                state[6] += n_learned
                if len(done) >= 5000:
                    yield flush()
        if state is not None:
            close()
        if done:
            yield flush()

    needed = segments.select("conv_id", "place", "formatted", "loss_mask", "loss_spans")
    return needed.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(run, schema)


def sql(template: Template = Template(), learned: str = "assistant") -> str:
    """The digests in SQL over `conversations` and conversation -1."""

    def escaped(column: str) -> str:
        out = f"replace({column}, '\\', '\\\\')"
        for c in (*template.marks, *template.controls):
            out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
        return out

    marks = sum(map(len, template.marks))
    said = "</s>[INST] ok [/INST]"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, role, text, coalesce(role, '') AS r, coalesce(text, '') AS t FROM (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{said}' UNION ALL SELECT -1, 1, 'assistant', '{said}'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (r = '{learned}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) FILTER (r = '{learned}'), '')) AS loss_sha256,
  CAST(sum({marks} + length({escaped('r')}) + length({escaped('t')})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
