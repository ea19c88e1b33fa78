"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Rows handled at a time inside a task, so that few texts are held as Python objects.
SLICE = 512


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def sized_slices(
    batches: Iterator[pa.RecordBatch], column: int, rows: int, size: int
) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows that begin anew after ``size`` bytes of a text column."""
    for batch in slices(batches, rows):
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy()
        begins = np.flatnonzero(np.diff(np.cumsum(lengths, dtype=np.int64) // size)) + 1
        for start, end in zip([0, *begins.tolist()], [*begins.tolist(), batch.num_rows]):
            yield batch.slice(start, end - start)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a column as UTF-8 bytes; null becomes the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(kind).to_pylist()]


def code_points(data: np.ndarray) -> np.ndarray:
    """1 where a code point starts in UTF-8 bytes, else 0."""
    return (data & 0xC0) != 0x80


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after another."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


class Ragged:
    """A growing table of integer lists in flat arrays."""

    def __init__(self) -> None:
        self.n = self.used = 0
        self.flat = np.zeros(1 << 12, np.int64)
        self.starts = np.zeros(1 << 10, np.int64)
        self.lengths = np.zeros(1 << 10, np.int64)

    @staticmethod
    def _room(array: np.ndarray, needed: int) -> np.ndarray:
        if needed <= len(array):
            return array
        return np.concatenate([array, np.zeros(max(needed, 2 * len(array)) - len(array), np.int64)])

    def extend(self, lists: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        values = np.fromiter((v for one in lists for v in one), np.int64, int(lengths.sum()))
        self.extend_flat(values, lengths)

    def extend_flat(self, values: np.ndarray, lengths: np.ndarray) -> None:
        """Append lists that stand one after another in ``values``."""
        used, n = self.used + len(values), self.n + len(lengths)
        self.flat = self._room(self.flat, used)
        self.starts = self._room(self.starts, n)
        self.lengths = self._room(self.lengths, n)
        self.flat[self.used : used] = values
        self.starts[self.n : n] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.n : n] = lengths
        self.used, self.n = used, n

    def gather(self, at: np.ndarray) -> np.ndarray:
        """The lists with numbers ``at``, one after another."""
        return self.flat[ranges(self.starts[at], self.lengths[at])]


class Numbered(dict):
    """Numbers keys in order of first sight; ``fresh`` holds those not yet looked after."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key):
        number = self[key] = len(self)
        self.fresh.append(key)
        return number

    def numbers(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))
