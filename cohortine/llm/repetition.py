"""Quality rules on repetition: share of characters inside repeated n-grams and lines.

Word n-grams of several lengths get rolling hashes in NumPy, one array operation per
length. Equal hashes are confirmed on the words themselves, so the counts are exact.
Each text is measured alone and whole: no shuffle, memory of one text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .base import code_points, slices, utf8

SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(SYMBOLS)] = 1
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class RepetitionRules:
    """Limits on shares of the characters in words (lines: of the lines with a word)."""

    base_window: int = 5
    min_words: int = 10
    max_base_percent: int = 20
    #: n-gram length -> largest share of the single most frequent n-gram
    top: tuple[tuple[int, float], ...] = ((2, 0.20), (3, 0.18), (4, 0.16))
    #: n-gram length -> largest share covered by n-grams that occur more than once
    #: (a fifth, like the base rule: one repeated sentence is no junk; longer n-grams cover
    #: less, so at this limit they could decide nothing and are not hashed)
    duplicated: tuple[tuple[int, float], ...] = ((5, 0.20),)
    max_line_share: float = 0.30
    max_line_chars: float = 0.20


def _scramble(ids: np.ndarray) -> np.ndarray:
    """A fixed well-mixed 64-bit value for each word number."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * _BASE
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Rolling:
    """Rolling hashes of the n-grams of one text, for growing n."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.words = ids, _scramble(ids)
        self.n, self.hash = 1, self.words

    def grow(self, n: int) -> None:
        while self.n < n:
            self.hash = self.hash[:-1] * _BASE + self.words[self.n :]
            self.n += 1

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """n-gram starts in hash order, and whether each equals the one before it."""
        order = np.argsort(self.hash, kind="stable")
        ranked = self.hash[order]
        same = np.zeros(len(order), bool)
        same[1:] = ranked[1:] == ranked[:-1]
        at = np.flatnonzero(same)
        for k in range(self.n):
            at = at[self.ids[order[at] + k] == self.ids[order[at - 1] + k]]
        same[:] = False
        same[at] = True
        return order, same

    def repeated(self) -> np.ndarray:
        """For each word, whether it lies in an n-gram that occurs more than once."""
        order, same = self.groups()
        twice = same.copy()
        twice[:-1] |= same[1:]
        edge = np.zeros(len(self.ids) + 1, np.int64)
        starts = order[twice]
        edge[starts] += 1
        np.subtract.at(edge, starts + self.n, 1)
        return np.cumsum(edge[:-1]) > 0


def measure(text: bytes, rules: RepetitionRules) -> tuple:
    """The values of one text, in the order of :data:`FIELDS`."""
    words = text.split()
    n_words = len(words)
    joined = np.frombuffer(b"".join(words), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, n_words)
    ends = np.cumsum(lengths)
    points = np.concatenate([[0], np.cumsum(code_points(joined))])
    chars = points[ends] - points[ends - lengths]
    word_chars = int(points[-1])
    n_symbols = int(_SYMBOL[np.frombuffer(text, np.uint8)].sum())

    lines = [line for line in text.split(b"\n") if line.strip()]
    seen: set[bytes] = set()
    n_dup_lines = dup_line_chars = all_line_chars = 0
    for line in lines:
        size = len(line.decode("utf-8", "replace"))
        all_line_chars += size
        if line in seen:
            n_dup_lines += 1
            dup_line_chars += size
        seen.add(line)
    line_share = n_dup_lines / max(len(lines), 1)
    line_chars = dup_line_chars / max(all_line_chars, 1)

    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n_words)
    rolling = _Rolling(ids)
    passed = line_share <= rules.max_line_share and line_chars <= rules.max_line_chars
    top_share = dup_share = 0.0
    n_repeat_words = 0
    limits = dict(rules.top)
    covered = dict(rules.duplicated)
    for n in sorted({*limits, *covered, rules.base_window}):
        if n > n_words:
            break
        rolling.grow(n)
        if n in limits:
            order, same = rolling.groups()
            firsts = np.flatnonzero(~same)
            counts = np.diff(np.append(firsts, len(order)))
            sums = np.concatenate([[0], np.cumsum(chars)])
            starts = order[firsts]
            share = np.where(counts > 1, counts * (sums[starts + n] - sums[starts]), 0).max()
            share = float(share) / max(word_chars, 1)
            top_share = max(top_share, share)
            passed &= share <= limits[n]
        if n in covered or n == rules.base_window:
            inside = rolling.repeated()
            if n == rules.base_window:
                n_repeat_words = int(inside.sum())
            if n in covered:
                share = float(chars[inside].sum()) / max(word_chars, 1)
                dup_share = max(dup_share, share)
                passed &= share <= covered[n]
            if n >= rules.base_window and not inside.any():
                break  # no longer n-gram can repeat either
    base_failed = (
        n_words < rules.min_words or 100 * n_repeat_words > rules.max_base_percent * n_words
    )
    return (
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        bool(passed and not base_failed), top_share, dup_share, line_share, line_chars,
    )


FIELDS = (
    ("n_words", T.LongType()),
    ("word_chars", T.LongType()),
    ("n_symbols", T.LongType()),
    ("n_dup_lines", T.LongType()),
    ("n_repeat_words", T.LongType()),
    ("base_failed", T.BooleanType()),
    ("kept", T.BooleanType()),
    ("top_ngram_share", T.DoubleType()),
    ("dup_ngram_share", T.DoubleType()),
    ("dup_line_share", T.DoubleType()),
    ("dup_line_chars", T.DoubleType()),
)


def repetition_quality(
    docs: DataFrame,
    rules: RepetitionRules = RepetitionRules(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of repetition measures and the verdict for every row of ``docs``.

    A null or empty text has no words, so ``base_failed`` is true and ``kept`` false.
    Repeated rows and null ids give a row each. Other columns of ``docs`` are not read,
    so their names cannot clash. An empty table gives no rows.
    """
    schema = T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType)]
        + [T.StructField(name, kind) for name, kind in FIELDS]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [measure(text, rules) for text in utf8(batch.column(1))]
            columns = [batch.column(0), *map(pa.array, zip(*rows))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
