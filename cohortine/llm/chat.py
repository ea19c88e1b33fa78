"""Chat formatting by columnar byte assembly.

The turns of a conversation become one text: for each turn a header, the text and a
footer. Control strings inside texts are escaped reversibly, so the turns can be read
back. For a whole slice of rows at once NumPy computes the lengths of all segments,
their offsets by running totals, and the place of every byte; headers and contents are
then scattered into one preallocated Arrow buffer.

Rows are sorted by conversation and turn after one shuffle, and streamed: a conversation
longer than a slice comes out in several chunks, so memory is bounded by a slice.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .base import code_points, ranges, slices, utf8

#: Rows assembled at a time.
_ROWS = 256


@dataclass(frozen=True)
class ChatTemplate:
    """Header and footer by role; any other role is written out in ``other``.

    Every control string begins with ``<`` or ``[`` and has no backslash. A text is escaped
    by a backslash after the first character of what would read as a control string, or
    as one already escaped.
    """

    roles: tuple[tuple[str, str, str], ...] = (
        ("system", "<<SYS>> ", " <</SYS>>"),
        ("user", "[INST] ", " [/INST]"),
        ("assistant", "<s>", "</s>"),
    )
    other: tuple[str, str, str] = ("[ROLE] ", " [TEXT] ", " [/TEXT]")
    learned_role: str = "assistant"

    def controls(self) -> list[bytes]:
        marks = [mark for _, *pair in self.roles for mark in pair] + list(self.other)
        return sorted({mark.strip().encode() for mark in marks}, key=lambda m: (-len(m), m))

    def escapes(self, least: int) -> re.Pattern[bytes]:
        """Where a backslash goes in (``least`` 0) or is taken out (1)."""
        tails = b"|".join(re.escape(mark[1:]) for mark in self.controls())
        return re.compile(rb"[<\[](?=(\\{%d,}(?:%s)))" % (least, tails))

    def escape(self, text: bytes) -> bytes:
        return self.escapes(0).sub(lambda m: m[0] + b"\\", text)

    def unescape(self, text: bytes) -> bytes:
        cuts = [m.end() for m in self.escapes(1).finditer(text)]
        return b"".join(text[a:b] for a, b in zip([0, *[c + 1 for c in cuts]], [*cuts, len(text)]))


def assemble(
    template: ChatTemplate, roles: list[bytes], data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all formatted turns, where each turn ends, and (start, end) of each text.

    ``data`` and ``offsets`` are the buffers of a string column with the turns' texts.
    """
    n = len(roles)
    # Headers and footers of the roles at hand, one after another in a pool.
    marks = {role.encode(): (head.encode(), foot.encode()) for role, head, foot in template.roles}
    named, between, foot = (part.encode() for part in template.other)
    distinct = {role: k for k, role in enumerate(dict.fromkeys(roles))}
    kinds = np.fromiter((distinct[role] for role in roles), np.int64, n)
    pairs = [marks.get(r) or (named + template.escape(r) + between, foot) for r in distinct]
    pool = np.frombuffer(b"".join(head + foot for head, foot in pairs), np.uint8)
    heads = np.array([len(head) for head, _ in pairs], np.int64)
    feet = np.array([len(foot) for _, foot in pairs], np.int64)
    pool_starts = np.cumsum(heads + feet) - heads - feet

    # Places inside one text after which a backslash is put in.
    first = int(offsets[0])
    content = data[first : int(offsets[-1])]
    bounds = offsets - first
    found = [(m.end(), m.end(1)) for m in template.escapes(0).finditer(content.tobytes())]
    at = np.array(found, np.int64).reshape(-1, 2)
    inside = np.searchsorted(bounds, at[:, 0], "left") == np.searchsorted(bounds, at[:, 1], "left")
    cuts = at[inside, 0]
    row_of_cut = np.searchsorted(bounds, cuts, "left") - 1
    plain = np.diff(bounds)
    lengths = plain + np.bincount(row_of_cut, minlength=n)

    turn_lengths = heads[kinds] + lengths + feet[kinds]
    ends = np.cumsum(turn_lengths)
    starts = ends - turn_lengths
    text_starts = starts + heads[kinds]
    text_ends = text_starts + lengths
    out = np.frombuffer(pa.allocate_buffer(int(ends[-1]) if n else 0), np.uint8)
    out[ranges(starts, heads[kinds])] = pool[ranges(pool_starts[kinds], heads[kinds])]
    out[ranges(text_ends, feet[kinds])] = pool[
        ranges((pool_starts + heads)[kinds], feet[kinds])
    ]
    # A byte moves by its text's shift and by the backslashes before it in its text.
    moved = np.zeros(len(content) + 1, np.int64)
    moved[cuts] = 1
    moved = np.cumsum(moved)
    earlier = np.concatenate([[0], moved])[bounds[:-1]]  # those at or before the text's start
    target = np.arange(len(content)) + moved[:-1] + np.repeat(
        text_starts - bounds[:-1] - earlier, plain
    )
    out[target] = content
    slashes = cuts + moved[cuts] - 1 + (text_starts - bounds[:-1] - earlier)[row_of_cut]
    out[slashes] = ord("\\")
    return out, ends, np.stack([text_starts, text_ends], axis=1)


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data bytes and offsets of a text column; nulls become empty."""
    column = column.fill_null("").cast(pa.large_binary())
    column = pa.concat_arrays([column])  # a slice gets buffers of its own
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at


def format_conversations(
    turns: DataFrame,
    template: ChatTemplate = ChatTemplate(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Formatted conversations in chunks, in order within each partition.

    Columns: id, ``chunk`` (from 0), ``n_turns`` of the chunk, ``formatted``, and
    ``loss_spans``: (start, end) in bytes of ``formatted`` for each text under the loss mask,
    which is each text of the learned role. A conversation's chunks, joined in order,
    are its formatted text; all but very long conversations have one.

    Null texts and roles count as empty. Rows of a null id form one conversation. Turns
    with the same number are ordered by role, then text; repeated rows stay. Other columns
    are not read. An empty table gives no rows.
    """
    schema = T.StructType(
        [
            T.StructField(conv_col, turns.schema[conv_col].dataType),
            T.StructField("chunk", T.LongType()),
            T.StructField("n_turns", T.LongType()),
            T.StructField("formatted", T.StringType()),
            T.StructField("loss_spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        ]
    )
    learned = template.learned_role.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, chunk = object(), 0
        for batch in slices(batches, _ROWS):
            ids = batch.column(0).to_pylist()
            roles = utf8(batch.column(1))
            out, ends, texts = assemble(template, roles, *_buffers(batch.column(2)))
            firsts = [i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]]
            stops = [*firsts[1:], len(ids)]
            byte_starts = np.concatenate([[0], ends])[firsts]
            chunks, spans = [], []
            for first, stop, start in zip(firsts, stops, byte_starts.tolist()):
                chunk = chunk + 1 if ids[first] == last else 0
                last = ids[first]
                chunks.append(chunk)
                mine = [i for i in range(first, stop) if roles[i] == learned]
                spans.append((texts[mine] - start).astype(np.int32).tolist())
            formatted = pa.LargeStringArray.from_buffers(
                len(firsts),
                pa.py_buffer(np.append(byte_starts, len(out)).astype(np.int64)),
                pa.py_buffer(out),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(firsts, pa.int64())),
                    pa.array(chunks, pa.int64()),
                    pa.array([b - a for a, b in zip(firsts, stops)], pa.int64()),
                    formatted.cast(pa.string()),
                    pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                ],
                names=schema.names,
            )

    return (
        turns.select(conv_col, turn_col, role_col, text_col)
        .repartition(conv_col)
        .sortWithinPartitions(conv_col, turn_col, role_col, text_col)
        .select(conv_col, role_col, text_col)
        .mapInArrow(run, schema)
    )


def read_turns(template: ChatTemplate, formatted: bytes) -> Iterator[tuple[bytes, bytes]]:
    """The (role, text) pairs of a formatted text, unescaped."""
    marks = {h.strip().encode(): (r.encode(), h, f) for r, h, f in template.roles}
    named, between, foot = (part.encode() for part in template.other)
    control = re.compile(b"|".join(map(re.escape, template.controls())))
    at = 0
    while at < len(formatted):
        opened = control.match(formatted, at)
        if opened is None:
            raise ValueError(f"no turn begins at byte {at}")
        if opened[0] == named.strip():
            stop = control.search(formatted, opened.end())
            end = stop.start() - len(between) + len(between.lstrip())
            role = template.unescape(formatted[at + len(named) : end])
            start, footer = end + len(between), foot
        else:
            role, header, closing = marks[opened[0]]
            start, footer = at + len(header.encode()), closing.encode()
        stop = control.search(formatted, start)
        end = stop.start() - len(footer) + len(footer.lstrip())
        yield role, template.unescape(formatted[start:end])
        at = stop.end()


def conversation_digests(
    formatted: DataFrame, template: ChatTemplate = ChatTemplate(), conv_col: str = "conv_id"
) -> DataFrame:
    """What reading :func:`format_conversations` back gives, one row per conversation.

    Works through the chunks in the order they come, so it must follow the formatting
    directly. ``turns_sha256`` covers role, newline, text, newline of every turn;
    ``loss_chars`` and ``loss_sha256`` the unescaped text under the loss mask;
    ``formatted_chars`` counts the formatted text.
    """
    schema = T.StructType(
        [
            T.StructField(conv_col, formatted.schema[conv_col].dataType),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )

    def points(text: bytes) -> int:
        return int(code_points(np.frombuffer(text, np.uint8)).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        state = None

        def close() -> None:
            if state is not None:
                conv, n, turns, chars, loss, size = state
                done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done))
            done.clear()
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names
            )

        for batch in slices(batches, _ROWS):
            id_type = batch.column(0).type
            texts = utf8(batch.column(2))
            spans = batch.column(3).to_pylist()
            for conv, chunk, text, masked in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, spans
            ):
                if chunk == 0:
                    close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_turns(template, text):
                    state[1] += 1
                    state[2].update(role + b"\n" + said + b"\n")
                for start, end in masked:
                    learned = template.unescape(text[start:end])
                    state[3] += points(learned)
                    state[4].update(learned)
                state[5] += points(text)
            if done:
                yield flush()
        close()
        if done:
            yield flush()

    return formatted.select(conv_col, "chunk", "formatted", "loss_spans").mapInArrow(run, schema)
