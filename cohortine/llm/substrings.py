"""Removal of passages that an earlier document has too, behind a count-min prefilter.

1. Each task hashes the windows of its texts and counts them in a sketch of its own; the
   sketches are merged by adding. A window is counted under its anchor, the least hash among
   the half-length grams inside it. Neighbouring windows share anchors, so there are an
   order of magnitude fewer of them than windows, while equal windows always have equal
   anchors. The count of an anchor in the merged sketch is therefore never below the number of
   documents that hold the window: a window estimated at one is unique, and none is lost.
2. A second pass over the texts keeps the runs of windows whose anchor is estimated at two or
   more. Equal runs, by 128 bits of hash over all their words, are grouped exactly: those of
   larger ids are covered, and the run of the smallest id speaks for them.
3. Where different runs that remain have one anchor, they share some of their windows only, and
   those windows are grouped exactly, again by 128 bits, for the smallest id of each.

The sketch has a fixed size, so what is broadcast does not grow. When the corpus outgrows it,
more runs pass to the exact grouping of step 2, whose rows are a small part of the text,
and nothing else changes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .base import Numbered, ranges, sized_slices, utf8

#: Counters of a sketch row are handled in segments of so many cells.
SEGMENT = 1 << 20
#: Anchors that a task gathers before it hands on a part of its sketch.
_GATHERED = 1 << 21
#: Different words remembered by a task, and bytes of text handled at a time.
_WORDS, _BYTES = 1 << 20, 1 << 22
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: A key is hot when it has more than this share of all rows; so there are at most 1/share.
HOT_SHARE = 1e-4


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """128-bit hashes of words, remembered by word."""

    def __init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.table = Numbered(), np.zeros((0, 2), np.uint64)

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.numbers) > _WORDS:
            self._forget()
        at = self.numbers.numbers(words)
        fresh = self.numbers.fresh
        if fresh:
            digests = b"".join(xxhash.xxh3_128_digest(word) for word in fresh)
            new = np.frombuffer(digests, np.uint64).reshape(-1, 2)
            self.table = np.concatenate([self.table, new])
            fresh.clear()
        return self.table[at]


def _running(values: np.ndarray, odd: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of values times powers of ``odd``, and what takes the powers back."""
    steps = np.full(len(values), odd, np.uint64)
    steps[0] = 1
    powers = np.multiply.accumulate(steps)
    steps[1:] = np.uint64(pow(int(odd), -1, 1 << 64))
    back = np.multiply.accumulate(steps)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers, dtype=np.uint64)])
    return sums, back


def rolling(values: np.ndarray, k: int, odd: np.uint64) -> np.ndarray:
    """Hash of every ``k`` consecutive values, from running sums modulo 2^64."""
    n = len(values)
    if n < k:
        return np.zeros(0, np.uint64)
    sums, back = _running(values, odd)
    return mix((sums[k:] - sums[: n - k + 1]) * back[: n - k + 1])


def span_hashes(values: np.ndarray, begins: np.ndarray, ends: np.ndarray, odd: np.uint64) -> np.ndarray:
    """Hash of the values from each begin to its end, as :func:`rolling` makes them."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    sums, back = _running(values, odd)
    return mix((sums[ends] - sums[begins]) * back[begins] + (ends - begins).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values."""
    least, done = values, 1
    while done < width:
        step = min(done, width - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    return least


class Windows:
    """The words of a slice of texts, with the windows that lie within one text."""

    def __init__(self, texts: list[bytes], hashes: WordHashes, window: int):
        self.words = [text.split() for text in texts]  # bytes: only ASCII space separates
        self.sizes = np.fromiter(map(len, self.words), np.int64, len(texts))
        self.ends = np.cumsum(self.sizes)
        self.window = window
        self.hashes = hashes.of([word for words in self.words for word in words])
        counts = np.maximum(self.sizes - window + 1, 0)
        #: Place of the first word, and number of the text, of every window.
        self.places = ranges(self.ends - self.sizes, counts)
        self.docs = np.repeat(np.arange(len(texts)), counts)

    def anchors(self) -> np.ndarray:
        gram = max(self.window // 2, 1)
        least = sliding_min(rolling(self.hashes[:, 0], gram, _ODD[0]), self.window - gram + 1)
        return least[self.places]

    def digests(self, column: int) -> np.ndarray:
        return rolling(self.hashes[:, column], self.window, _ODD[column])[self.places]


def _cells(anchors: np.ndarray, row: int, cells: int) -> np.ndarray:
    seed = np.uint64((row + 1) * int(_ODD[1]) % (1 << 64))
    return mix(anchors + seed) & np.uint64(cells - 1)


def merged_sketch(texts: DataFrame, window: int, cells: int, rows: int) -> list[np.ndarray]:
    """For every row of the count-min sketch, one bit per cell: counted at least twice.

    Tasks send their sketches by segment, a cell at most twice; counts beyond two do not
    matter. The bits, ``cells * rows / 8`` bytes whatever the corpus, reach the driver.
    """
    segments = max(cells // SEGMENT, 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, gathered, n = WordHashes(), [], 0
        for batch in sized_slices(batches, 0, 512, _BYTES):
            found = Windows(utf8(batch.column(0)), hashes, window)
            anchors = found.anchors()
            # Once per text, however often it stands there.
            order = np.lexsort((anchors, found.docs))
            anchors, docs = anchors[order], found.docs[order]
            new = np.append(True, (anchors[1:] != anchors[:-1]) | (docs[1:] != docs[:-1]))
            gathered.append(anchors[new[: len(anchors)]])
            n += len(gathered[-1])
            if n >= _GATHERED:
                yield from parts(np.concatenate(gathered))
                gathered, n = [], 0
        if n:
            yield from parts(np.concatenate(gathered))

    def parts(anchors: np.ndarray) -> Iterator[pa.RecordBatch]:
        for row in range(rows):
            cell, counts = np.unique(_cells(anchors, row, cells), return_counts=True)
            cell = np.repeat(cell, np.minimum(counts, 2)).astype(np.int64)
            bounds = np.searchsorted(cell, np.arange(segments + 1) * SEGMENT)
            inside = (cell % SEGMENT).astype(np.uint32)
            for i in np.flatnonzero(np.diff(bounds)).tolist():
                piece = inside[bounds[i] : bounds[i + 1]].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row * segments + i], pa.int32()), pa.array([piece], pa.binary())],
                    names=["segment", "piece"],
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, piece in zip(batch.column(0).to_pylist(), batch.column(1)):
                held = counts.setdefault(number, np.zeros(min(SEGMENT, cells), np.uint8))
                inside = np.frombuffer(piece.as_buffer(), np.uint32)
                twice = inside[1:][inside[1:] == inside[:-1]]
                held[inside] = np.minimum(held[inside] + 1, 2)
                held[twice] = 2
        for number, held in counts.items():
            bits = np.packbits(held == 2, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([bits], pa.binary())],
                names=["segment", "piece"],
            )

    schema = "segment int, piece binary"
    bits = (
        texts.mapInArrow(count, schema)
        .repartition("segment")
        .mapInArrow(add, schema)
        .toArrow()
    )
    sketch = [np.zeros(max(cells // 8, 1), np.uint8) for _ in range(rows)]
    for number, piece in zip(bits["segment"].to_pylist(), bits["piece"]):
        row, at = divmod(number, segments)
        part = np.frombuffer(piece.as_buffer(), np.uint8)
        sketch[row][at * SEGMENT // 8 :][: len(part)] = part
    return sketch


def estimated_repeated(anchors: np.ndarray, sketch: list[np.ndarray]) -> np.ndarray:
    """Whether the sketch's estimate, the least over its rows, is two or more."""
    repeated = np.ones(len(anchors), bool)
    for row, bits in enumerate(sketch):
        cell = _cells(anchors, row, 8 * len(bits))
        repeated &= (bits[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return repeated


def with_owner(rows: DataFrame, keys: list[str], wanted: Column) -> DataFrame:
    """``rows`` with the ``first`` and ``last`` id of their key, for keys that are ``wanted``.

    Keys with more than ``HOT_SHARE`` of the rows, of which there cannot be many, come to the
    rows by broadcast; the others by a shuffle in which no key is large.
    """
    # Null ids count as larger than any.
    owners = materialise(
        rows.groupBy(*keys)
        .agg(
            F.min("id").alias("first"),
            F.max("id").alias("last"),
            F.count_if(F.col("id").isNull()).alias("nulls"),
            F.count(F.lit(1)).alias("n"),
        )
        .where(wanted)
    )
    total = owners.agg(F.sum("n")).first()[0] or 0
    # Not a matter of results: every wanted key is on one side or the other.
    is_hot = F.col("n") > max(total * HOT_SHARE, 1000)
    hot = owners.where(is_hot).select(*keys, "first", "last", F.lit(True).alias("hot"))
    cold = owners.where(~is_hot).select(*keys, "first", "last")
    marked = rows.join(F.broadcast(hot), keys, "left")
    rare = marked.where(F.col("hot").isNull()).select(*rows.columns).join(cold, keys)
    common = marked.where(F.col("hot")).drop("hot")
    return common.unionByName(rare)


def _with_lists(texts: DataFrame, lists: DataFrame, column: str, how: str) -> DataFrame:
    """Texts with the list that ``lists`` has for the same row."""
    lists = lists.select(F.col("row").alias("l_row"), column)
    return texts.join(lists, F.col("row") == F.col("l_row"), how).drop("l_row")


def remove_repeated_passages(
    docs: DataFrame,
    window: int = 50,
    cells: int = 1 << 26,
    rows: int = 3,
    with_text: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every document without the words that lie in a window an earlier document has.

    A window is ``window`` consecutive words of one document; it is earlier where a row with a
    smaller id has the same words anywhere. Windows are judged on the input. Returns for every
    row ``id_col``, ``n_words``, ``n_removed`` and ``kept``, the words that stay, joined by one
    space; without ``with_text`` ``kept_sha256``, the digest of ``kept``, in its place.

    Words are separated by ASCII white space. Null texts have none. Texts shorter than a window
    stay whole, whatever others hold. Rows of one id never take words from each other, so
    repeated rows are alike in the result. A null id counts as larger than any. Other
    columns are not read. An empty table gives no rows. ``cells`` (a power of two) and
    ``rows`` set the size of the sketch, 24 MB by default; they change the work, never the result.
    """
    if window < 2 or cells & (cells - 1) or cells < 8:
        raise ValueError("a window has two words at least; cells is a power of two over 4")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = texts.schema["id"].dataType
    spark = docs.sparkSession
    sketch = spark.sparkContext.broadcast(merged_sketch(texts.select("text"), window, cells, rows))
    field = T.StructField
    runs_type = T.StructType(
        [
            field("anchor", T.LongType()),
            field("begin", T.IntegerType()),
            field("end", T.IntegerType()),
            field("r1", T.LongType()),
            field("r2", T.LongType()),
        ]
    )
    marked_schema = T.StructType(
        [
            field("id", id_type),
            field("n_words", T.LongType()),
            field("kept", T.StringType()),
            field("runs", T.ArrayType(runs_type)),
        ]
    )

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in sized_slices(batches, 1, 512, _BYTES):
            found = Windows(utf8(batch.column(1)), hashes, window)
            anchors = found.anchors()
            # Runs of windows with one anchor.
            new = np.append(
                True, (anchors[1:] != anchors[:-1]) | (found.docs[1:] != found.docs[:-1])
            )[: len(anchors)]
            begins = np.flatnonzero(new)
            ends = np.append(begins[1:], len(anchors))
            keep = estimated_repeated(anchors[begins], sketch.value)
            begins, ends = begins[keep], ends[keep]
            doc = found.docs[begins]
            first = (found.ends - found.sizes)[doc]
            anchor = anchors[begins]
            begins, ends = found.places[begins], found.places[ends - 1] + 1
            n_runs = np.bincount(doc, minlength=batch.num_rows)
            whole = [
                span_hashes(found.hashes[:, i], begins, ends + window - 1, odd).view(np.int64)
                for i, odd in enumerate(_ODD)
            ]
            runs = pa.StructArray.from_arrays(
                [
                    pa.array(anchor.view(np.int64)),
                    pa.array((begins - first).astype(np.int32)),
                    pa.array((ends - first).astype(np.int32)),
                    *map(pa.array, whole),
                ],
                names=runs_type.names,
            )
            offsets = np.append(0, np.cumsum(n_runs)).astype(np.int32)
            joined = [b" ".join(words) for words in found.words]
            if not with_text:  # without a repeated anchor the digest is all that is asked for
                joined = [
                    text if n else hashlib.sha256(text).hexdigest().encode()
                    for text, n in zip(joined, n_runs.tolist())
                ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(found.sizes),
                    pa.array(joined, pa.binary()).cast(pa.string()),
                    pa.ListArray.from_arrays(pa.array(offsets), runs),
                ],
                names=marked_schema.names,
            )

    marked = materialise(
        texts.mapInArrow(mark, marked_schema).withColumn("row", F.monotonically_increasing_id())
    )
    sketch.unpersist()
    suspects = marked.where(F.size("runs") > 0)
    bare = suspects.select("row", "id", "n_words", "kept")

    # Equal runs: the smallest id has them, the others lose all their windows.
    has_two = (F.col("first") < F.col("last")) | ((F.col("nulls") > 0) & F.col("first").isNotNull())
    later = F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("first")))
    runs = suspects.select("row", "id", F.inline("runs"))
    run_key = ["anchor", "r1", "r2"]
    judged = materialise(
        with_owner(runs, run_key, F.lit(True))
        .withColumn("covered", F.coalesce(later, F.lit(False)))
        .select("row", "id", "anchor", "begin", "end", "covered")
    )
    whole_runs = judged.where("covered").select("row", "begin", "end")

    # Different runs of one anchor: their windows one by one.
    mixed = (
        with_owner(judged.where("NOT covered").drop("covered"), ["anchor"], has_two)
        .groupBy("row")
        .agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    )
    windows_schema = T.StructType(
        [
            field("row", T.LongType()),
            field("id", id_type),
            field("begin", T.IntegerType()),
            field("h1", T.LongType()),
            field("h2", T.LongType()),
        ]
    )

    def hash_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in sized_slices(batches, 2, 512, _BYTES):
            found = Windows(utf8(batch.column(2)), hashes, window)
            first = found.ends - found.sizes
            lists = batch.column(3)
            spans = lists.flatten()
            doc = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            begin = spans.field(0).to_numpy().astype(np.int64)
            lengths = spans.field(1).to_numpy().astype(np.int64) - begin
            # One flag per word: a window that starts here is wanted.
            wanted = np.zeros(int(found.sizes.sum()), bool)
            wanted[ranges(first[doc] + begin, lengths)] = True
            at = np.flatnonzero(wanted[found.places])
            doc = found.docs[at]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(doc)),
                    batch.column(1).take(pa.array(doc)),
                    pa.array((found.places[at] - first[doc]).astype(np.int32)),
                    pa.array(found.digests(0)[at].view(np.int64)),
                    pa.array(found.digests(1)[at].view(np.int64)),
                ],
                names=windows_schema.names,
            )

    windows = materialise(
        _with_lists(bare.drop("n_words"), mixed, "spans", "inner").mapInArrow(
            hash_windows, windows_schema
        )
    )
    single = (
        with_owner(windows, ["h1", "h2"], has_two)
        .where(later)
        .select("row", "begin", (F.col("begin") + 1).alias("end"))
    )
    covered = (
        whole_runs.unionByName(single)
        .groupBy("row")
        .agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    )
    out_schema = T.StructType(
        [
            field(id_col, id_type),
            field("n_words", T.LongType()),
            field("n_removed", T.LongType()),
            field("kept" if with_text else "kept_sha256", T.StringType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_slices(batches, 2, 512, _BYTES):
            kept, removed = [], []
            for text, spans in zip(utf8(batch.column(2)), batch.column(3)):
                words = text.split()
                gone = np.zeros(len(words) + 1, np.int32)
                if spans.is_valid:
                    np.add.at(gone, spans.values.field(0).to_numpy(), 1)
                    np.add.at(gone, spans.values.field(1).to_numpy() + (window - 1), -1)
                gone = np.cumsum(gone[:-1]) > 0
                removed.append(int(gone.sum()))
                if removed[-1]:
                    text = b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])
                kept.append(text if with_text else hashlib.sha256(text).hexdigest().encode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=out_schema.names,
            )

    cut_texts = _with_lists(bare, covered, "spans", "left").drop("row")
    clean = marked.where(F.size("runs") == 0).select(
        F.col("id").alias(id_col),
        "n_words",
        F.lit(0).cast("bigint").alias("n_removed"),
        F.col("kept").alias(out_schema.names[3]),
    )
    return clean.unionByName(cut_texts.mapInArrow(cut, out_schema))
