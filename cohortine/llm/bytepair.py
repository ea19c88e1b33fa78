"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves a whole pre-token that is
itself a vocabulary entry. Tier two: any other pre-token starts as linked bytes, and a
heap of adjacent pairs merges the lowest rank first, leftmost on a tie.

The vocabulary is read once on the driver and sent to the executors; its size does not
depend on the data. Texts are encoded whole, one slice of a batch at a time.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .base import Numbered, Ragged, ranges, slices, utf8

#: Distinct pre-tokens a worker remembers before it starts afresh.
REMEMBERED = 400_000


class PerfectHash:
    """Minimal perfect hash over byte strings: every key has its own slot in 0..n-1.

    Keys fall into buckets; from the largest bucket on, a displacement is searched that
    sends all keys of the bucket to free slots.
    """

    #: Displacements tried at a time.
    TRIES = 256

    def __init__(self, keys: Sequence[bytes], keys_per_bucket: int = 4):
        self.n = len(keys)
        self.buckets = max(1, self.n // keys_per_bucket)
        hashes = self._hashes(keys)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        self.shift = np.zeros(self.buckets, np.int64)
        free = np.ones(self.n, bool)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        firsts = np.cumsum(sizes) - sizes
        by_size = np.argsort(-sizes, kind="stable")
        for b in by_size[sizes[by_size] > 1].tolist():
            mine = hashes[order[firsts[b] : firsts[b] + sizes[b]]]
            for first in range(0, 1 << 40, self.TRIES):
                shifts = np.arange(first, first + self.TRIES, dtype=np.uint64)
                slots = np.sort(self._slots(mine[None, :], shifts[:, None]).astype(np.int64), 1)
                fits = free[slots].all(axis=1) & (np.diff(slots, axis=1) > 0).all(axis=1)
                if fits.any():
                    break
            self.shift[b] = first + int(fits.argmax())
            free[slots[fits.argmax()]] = False
        # A bucket of one key takes a slot that is left, written as its complement.
        single = by_size[sizes[by_size] == 1]
        self.shift[single] = ~np.flatnonzero(free)
        self.keys: list[bytes] = [b""] * self.n
        self.index = np.zeros(self.n, np.int64)
        for i, slot in enumerate(self._locate(hashes).tolist()):
            self.keys[slot], self.index[slot] = keys[i], i

    @staticmethod
    def _hashes(keys: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _slots(self, hashes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        x = (hashes ^ (shift * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        return ((x * np.uint64(0x94D049BB133111EB)) >> np.uint64(16)) % np.uint64(self.n)

    def _locate(self, hashes: np.ndarray) -> np.ndarray:
        shift = self.shift[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        slots = self._slots(hashes, shift.astype(np.uint64)).astype(np.int64)
        return np.where(shift < 0, ~shift, slots)

    def find(self, keys: Sequence[bytes]) -> list[int]:
        """The number of every key as given to the constructor, -1 for a stranger."""
        if not self.n or not len(keys):
            return [-1] * len(keys)
        slots = self._locate(self._hashes(keys))
        numbers = self.index[slots].tolist()
        return [
            number if self.keys[slot] == key else -1
            for key, slot, number in zip(keys, slots.tolist(), numbers)
        ]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token by merging the adjacent pair of lowest rank first."""
    n = len(piece)
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        rank, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] == stop:
            continue
        j = end[i]  # the node after i starts where i ends
        if j >= n or end[j] != stop:
            continue
        alive[j] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            again = ranks.get(piece[i : end[stop]])
            if again is not None:
                heapq.heappush(heap, (again, i, end[stop]))
        if i > 0:
            h = before[i]
            again = ranks.get(piece[h:stop])
            if again is not None:
                heapq.heappush(heap, (again, h, stop))
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


class BytePairCodec:
    """Encodes and decodes with the ranks of a vocabulary and a pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        entries = sorted(ranks.items(), key=lambda item: item[1])
        self.known = PerfectHash([token for token, _ in entries])
        self.known_ids = [rank for _, rank in entries]
        size = max(self.known_ids, default=-1) + 1
        lengths = np.zeros(size, np.int64)
        lengths[self.known_ids] = [len(token) for token, _ in entries]
        self.token_lengths = lengths
        self.token_starts = np.cumsum(lengths) - lengths
        self.token_bytes = np.frombuffer(b"".join(token for token, _ in entries), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.number = Numbered()
        self.ids = Ragged()
        self.texts: list[str] = []

    def _learn(self, pieces: list[str]) -> None:
        raw = [piece.encode() for piece in pieces]
        found = [
            [self.known_ids[at]] if at >= 0 else merge(data, self.ranks)
            for data, at in zip(raw, self.known.find(raw))
        ]
        self.ids.extend(found)
        self.texts.extend(",".join(map(str, ids)) for ids in found)

    def encode(self, texts: Sequence[str]) -> list[tuple[np.ndarray, str]]:
        """The ids of every text, as an array and as decimal numbers with commas."""
        if len(self.number) > REMEMBERED:
            self._forget()
        numbered = [self.number.numbers(self.split(text)) for text in texts]
        self._learn(self.number.fresh)
        self.number.fresh = []
        said = self.texts.__getitem__
        return [(self.ids.gather(at), ",".join(map(said, at.tolist()))) for at in numbered]

    def decode(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        at = ranges(self.token_starts[ids], self.token_lengths[ids])
        return self.token_bytes[at].tobytes()


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=2)
def codec(rank_file: bytes, pattern: str) -> BytePairCodec:
    """The codec of a rank file (base64 token, space, rank on each line)."""
    lines = map(bytes.split, rank_file.splitlines())
    return BytePairCodec({base64.b64decode(x[0]): int(x[1]) for x in lines if x}, pattern)


def encode_documents(
    docs: DataFrame,
    rank_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Token ids of every whole text, and digests of the ids and of their decoding.

    A null text counts as empty: no ids, digests of nothing. Bytes that are no UTF-8
    are read as U+FFFD. Repeated rows and null ids give a row each; other columns are not
    read. ``rank_path`` must be readable by the driver.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    fields = [
        T.StructField(id_col, docs.schema[id_col].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(shared.value, pattern)
        for batch in slices(batches, 128):
            texts = [text.decode("utf-8", "replace") for text in utf8(batch.column(1))]
            encoded = tool.encode(texts)
            columns = [
                batch.column(0),
                pa.array([len(ids) for ids, _ in encoded], pa.int64()),
                pa.array([hashlib.sha256(said.encode()).hexdigest() for _, said in encoded]),
                pa.array([hashlib.sha256(tool.decode(ids)).hexdigest() for ids, _ in encoded]),
            ]
            if with_ids:
                columns.append(
                    pa.array([ids.astype(np.int32) for ids, _ in encoded], pa.list_(pa.int32()))
                )
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
