"""Order-preserving packing of documents into token sequences.

Within a partition the documents keep their order and form one stream of token ids. A
dynamic program cuts the stream into windows of at most ``capacity`` tokens so that
padding plus cut penalties are least: f(j) = min over i of f(i) + capacity - (j - i) +
penalty(j), over allowed cut places i with j - i <= capacity. f(i) + i does not depend on
j, so a monotone queue gives the minimum in constant time on average.

A partition is worked through in blocks; the last windows of a block are cut anew with
the next one, so memory is bounded by the block and the longest text. Every partition
stands alone: no shuffle, and a lost task is simply run again.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .base import Numbered, Ragged, code_points, ranges, sized_slices, utf8

#: Distinct words a worker remembers before it thins them out.
REMEMBERED = 500_000
_FIRST = itemgetter(0)
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[list(b".!?")] = True


@dataclass(frozen=True)
class PackingCosts:
    """Cut penalties in tokens of padding; a cut between documents is free."""

    sentence: float = 4.0
    word: float = 24.0
    #: Only the first sentence end in each stretch of so many tokens is a cut place.
    closest: int = 24
    #: Spans without a sentence end of more than this many tokens get word cuts inside.
    longest_span: int = 64
    word_step: int = 16
    #: What one more sequence costs where a rest is split into powers of two.
    sequence: float = 16.0


def cut_windows(
    places: list[int],
    penalties: list[float],
    capacity: int,
    rest_cost: Callable[[int], float] | None = None,
) -> tuple[list[int], float]:
    """Indices of the chosen places, from first to last, and the total cost.

    ``places`` grow strictly, and no two neighbours are further apart than ``capacity``.
    ``rest_cost`` gives the cost of the last window by its length, in place of its padding.
    """
    best = [0.0] * len(places)
    back = [0] * len(places)
    # The monotone queue: indices whose f(i) + i grows, and those values.
    queue, values = deque([0]), deque([float(places[0])])
    cost = 0.0
    for k in range(1, len(places)):
        at = places[k]
        lowest = at - capacity
        while places[queue[0]] < lowest:
            queue.popleft()
            values.popleft()
        back[k] = queue[0]
        best[k] = cost = values[0] - lowest + penalties[k]
        value = cost + at
        while values and values[-1] > value:
            values.pop()
            queue.pop()
        queue.append(k)
        values.append(value)
    if rest_cost is not None:
        first = bisect_left(places, places[-1] - capacity)
        last_costs = [
            best[i] + rest_cost(places[-1] - places[i]) for i in range(first, len(places) - 1)
        ]
        cost = min(last_costs)
        back[-1] = first + last_costs.index(cost)
        cost += penalties[-1]
    path, k = [len(places) - 1], len(places) - 1
    while k:
        k = back[k]
        path.append(k)
    return path[::-1], cost


def cut_places(
    doc_ends: np.ndarray, sentence_ends: np.ndarray, costs: PackingCosts
) -> tuple[np.ndarray, np.ndarray]:
    """Allowed cut places of a stream that starts at 0, with their penalties."""
    # Of the sentence ends in each stretch of ``closest`` tokens, the first stays.
    stretch = sentence_ends // costs.closest
    sentence_ends = sentence_ends[np.flatnonzero(np.diff(stretch, prepend=-1))]
    natural = np.unique(np.concatenate([[0], doc_ends, sentence_ends]))
    gaps = np.diff(natural)
    extra = [
        np.arange(start + costs.word_step, start + gap, costs.word_step)
        for start, gap in zip(
            natural[:-1][gaps > costs.longest_span].tolist(),
            gaps[gaps > costs.longest_span].tolist(),
        )
    ]
    places = np.unique(np.concatenate([natural, *extra])).astype(np.int64)
    penalties = np.full(len(places), costs.word)
    penalties[np.searchsorted(places, sentence_ends)] = costs.sentence
    penalties[np.searchsorted(places, doc_ends)] = 0.0
    penalties[0] = 0.0
    return places, penalties


def split_rest(length: int, capacity: int, costs: PackingCosts) -> tuple[list[int], float]:
    """Lengths of the sequences for a last window, padded whole or powers of two, and the cost.

    A sequence whose length is a power of two is not padded.
    """
    powers = [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]
    whole = 0 if len(powers) == 1 else capacity - length
    split = (len(powers) - 1) * (costs.sequence + costs.word)
    return (powers, split) if split < whole else ([length], float(whole))


class WordEncoder:
    """Ids of whole texts from a tokenizer that never looks across white space.

    The tokenizer lower-cases and drops white space before its merges. So words are
    encoded once each, in ASCII lower case, and remembered; new words are encoded many at
    a time, as one text. When too many are remembered, those met in few slices go.
    """

    def __init__(self, tokenizer_json: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        # Words of ASCII letters in lower case: the normalizer would change nothing.
        self.plain = Tokenizer.from_str(
            json.dumps(json.loads(tokenizer_json) | {"normalizer": None})
        )
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.number = Numbered()
        self.ids = Ragged()
        self.stops = np.zeros(0, bool)
        self.slices_seen = np.zeros(0, np.int64)

    def _thin_out(self) -> None:
        seen = self.slices_seen
        half = REMEMBERED // 2
        least = max(1, int(np.partition(seen, -half)[-half])) if len(seen) > half else 1
        again = seen > least
        words = [word for word, keep in zip(self.number, again.tolist()) if keep]
        at = np.flatnonzero(again)
        values, lengths = self.ids.gather(at), self.ids.lengths[at]
        self.number, self.ids = Numbered(), Ragged()
        self.number.update(zip(words, range(len(words))))
        self.ids.extend_flat(values, lengths)
        self.stops, self.slices_seen = self.stops[at], np.zeros(len(at), np.int64)

    def _encode_letters(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of ASCII letters, one after another, and how many each has.

        Such a word is one unit for the merges, and its last token is marked as closing.
        """
        text = b" ".join(words).decode()
        ids = np.array(self.plain.encode(text, add_special_tokens=False).ids, np.int64)
        ends = np.flatnonzero(self.closes[ids]) + 1
        return ids, np.diff(ends, prepend=0)

    def _encode_any(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text = b" ".join(words).decode("utf-8", "replace")
        data = np.frombuffer(text.encode(), np.uint8)
        ends = np.append(np.cumsum(code_points(data))[data == ord(" ")] - 1, len(text))
        coded = self.tokenizer.encode(text, add_special_tokens=False)
        places = np.fromiter(map(_FIRST, coded.offsets), np.int64, len(coded))
        stops = np.searchsorted(places, ends)
        return np.array(coded.ids, np.int64), np.diff(stops, prepend=0)

    def _learn(self, words: list[bytes], at_once: int = 500) -> None:
        letters = np.fromiter(map(bytes.isalpha, words), bool, len(words))
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for encode, some in (
            (self._encode_letters, [w for w in words if w.isalpha()]),
            (self._encode_any, [w for w in words if not w.isalpha()]),
        ):
            parts += [encode(some[i : i + at_once]) for i in range(0, len(some), at_once)]
        values, lengths = (np.concatenate(x) for x in zip(*parts))
        # Back into the order in which the words got their numbers.
        order = np.empty(len(words), np.int64)
        order[letters] = np.arange(letters.sum())
        order[~letters] = np.arange(letters.sum(), len(words))
        starts = np.cumsum(lengths) - lengths
        self.ids.extend_flat(values[ranges(starts[order], lengths[order])], lengths[order])
        final = np.fromiter((w[-1] for w in words), np.uint8, len(words))
        self.stops = np.concatenate([self.stops, _SENTENCE_END[final]])
        self.slices_seen = np.concatenate([self.slices_seen, np.zeros(len(words), np.int64)])

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of each text, and the number of ids up to each sentence end."""
        if len(self.number) > REMEMBERED:
            self._thin_out()
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
        words = split.flatten()
        # Blanks at either end of a text leave empty words.
        real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(pc.list_value_length(split).to_numpy())
        ends = np.concatenate([[0], np.cumsum(real)])[ends].tolist()
        # Words are told apart within the slice first; only its distinct ones are looked up.
        here = words.filter(pa.array(real)).dictionary_encode()
        everywhere = self.number.numbers(utf8(here.dictionary))
        self._learn(self.number.fresh)
        self.number.fresh = []
        self.slices_seen[everywhere] += 1
        numbers = everywhere[here.indices.to_numpy()]
        for start, end in zip([0, *ends[:-1]], ends):
            at = numbers[start:end]
            upto = np.cumsum(self.ids.lengths[at])
            yield self.ids.gather(at), upto[self.stops[at]]


@lru_cache(maxsize=2)
def word_encoder(tokenizer_json: str) -> WordEncoder:
    return WordEncoder(tokenizer_json)


@dataclass
class _Stream:
    """Documents that wait to be cut; each with its id and what of it is already out."""

    rows: list = field(default_factory=list)  # [id, ids, sentence ends, ids before]
    tokens: int = 0


def _windows(
    stream: _Stream, capacity: int, costs: PackingCosts, last: bool, keep: int
) -> Iterator[tuple[int, int]]:
    """Windows (start, end) of the stream; unless ``last``, without the final ``keep``."""
    lengths = np.array([len(ids) for _, ids, _, _ in stream.rows])
    ends = np.cumsum(lengths)
    starts = ends - lengths
    sentence_ends = np.concatenate([s + at for (_, _, s, _), at in zip(stream.rows, starts)])
    places, penalties = cut_places(ends, sentence_ends, costs)
    rest_cost = (lambda length: split_rest(length, capacity, costs)[1]) if last else None
    path, _ = cut_windows(places.tolist(), penalties.tolist(), capacity, rest_cost)
    bounds = places[path].tolist()
    if not last:
        bounds = bounds[: max(len(bounds) - keep, 1)]
    windows = list(zip(bounds[:-1], bounds[1:]))
    if last:
        start, end = windows.pop()
        for length in split_rest(end - start, capacity, costs)[0]:
            windows.append((start, start + length))
            start += length
    yield from windows


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 2,
    costs: PackingCosts = PackingCosts(),
    id_col: str = "doc_id",
    text_col: str = "text",
    block_tokens: int = 1 << 20,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents with their place in a packed sequence.

    Every document is its ids and then ``end_id``, so a null or empty text is one id.
    Columns: id, ``start`` (ids of the document before the piece), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``; with ``with_ids`` also
    ``ids``. Repeated rows and null ids are packed as documents of their own. An
    empty table gives no rows. ``capacity`` must be a power of two.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    longs = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    fields = [T.StructField(id_col, docs.schema[id_col].dataType)]
    fields += [T.StructField(name, T.LongType()) for name in longs]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)
    id_type = None

    def pieces(stream: _Stream, windows, first_id: int):
        """Rows of the windows; cuts what they cover off the front of the stream."""
        out, cut, row, rows = [], 0, 0, stream.rows
        sequence = first_id
        begin = 0  # stream place where document ``row`` starts
        for start, end in windows:
            at = start
            while at < end:
                doc, ids, _, done = rows[row]
                inside = at - begin
                length = min(len(ids) - inside, end - at)
                part = ids[inside : inside + length]
                crc = zlib.crc32(part.astype("<u4").tobytes())
                out.append(
                    (doc, done + inside, length, crc, done + len(ids), sequence, at - start, part)
                )
                at += length
                if inside + length == len(ids):
                    begin += len(ids)
                    row += 1
            cut = end
            sequence += 1
        rest = rows[row:]
        if rest and cut > begin:
            doc, ids, sentences, done = rest[0]
            gone = cut - begin
            rest[0] = (doc, ids[gone:], sentences[sentences > gone] - gone, done + gone)
        stream.rows, stream.tokens = rest, stream.tokens - cut
        return out, sequence

    def batch_of(rows: list, kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows))
        arrays = [pa.array(columns[0], kind)] + [pa.array(c, pa.int64()) for c in columns[1:7]]
        if with_ids:
            arrays.append(pa.array([p.astype(np.int32) for p in columns[7]], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(shared.value)
        sequence = TaskContext.get().partitionId() << 33
        stream, kind = _Stream(), id_type
        for batch in sized_slices(batches, 1, 2048, 1 << 23):
            kind = batch.column(0).type
            coded = encoder.encode(batch.column(1))
            for doc, (ids, sentences) in zip(batch.column(0).to_pylist(), coded):
                ids = np.append(ids, end_id)
                stream.rows.append((doc, ids, sentences, 0))
                stream.tokens += len(ids)
            if stream.tokens >= block_tokens:
                windows = _windows(stream, capacity, costs, False, 3)
                rows, sequence = pieces(stream, windows, sequence)
                if rows:
                    yield batch_of(rows, kind)
        if stream.rows:
            rows, sequence = pieces(stream, _windows(stream, capacity, costs, True, 0), sequence)
            yield batch_of(rows, kind)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
