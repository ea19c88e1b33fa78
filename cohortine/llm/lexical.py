"""Ranked lexical search in an index whose strata hold documents of one length normaliser.

The impact of a term in a document depends on its count ``tf`` and the document's normaliser
``m`` alone. Documents of equal ``m`` form a stratum, and the postings of a term in a stratum
stand by ``tf``, so an impact is computed once per (``m``, ``tf``) and the largest ``tf`` of a
term bounds what it can give in the stratum. A query visits strata by falling bound and stops
when no bound is left above the score of its k-th document.

1. One pass over the texts counts all terms and keeps the counts of the terms asked for.
2. Those counts are range-partitioned by ``m``, so a shard of the index holds few strata. All
   rows are indexed.
3. Each shard answers all queries; the best ``k`` per query and shard are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, release
from .base import ranges, sized_slices, utf8

#: Documents of one shard of the index; queries and their terms handled in one round.
SHARD, ROUND_TERMS = 1 << 14, 1 << 18
#: Documents that the first strata visited should hold.
_FIRST = 512
_BYTES = 1 << 22
#: Characters that separate terms. Everything else, A-Z as a-z, is part of one.
_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def query_terms(text: Column) -> Column:
    """The terms of a text as an array, repeats included."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    pieces = F.split(F.translate(F.coalesce(text, F.lit("")), upper, lower), _SEPARATOR)
    return F.filter(pieces, lambda piece: piece != "")


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Shard:
    """Postings of some documents by (term, stratum, tf)."""

    def __init__(self, m: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray):
        self.strata, stratum = np.unique(m, return_inverse=True)
        #: Documents of stratum ``s``: ``members`` from ``begin[s]`` to ``begin[s + 1]``.
        self.members = np.argsort(stratum, kind="stable")
        self.begin = np.searchsorted(stratum[self.members], np.arange(len(self.strata) + 1))
        doc = np.repeat(np.arange(len(m)), sizes)
        order = np.lexsort((-tfs, stratum[doc], terms))
        self.doc, terms, tfs = doc[order], terms[order], tfs[order]
        stratum = stratum[self.doc]
        # Impacts once per (stratum, tf).
        most = int(tfs.max(initial=0)) + 1
        pairs, at = np.unique(stratum * most + tfs, return_inverse=True)
        self.impact = impacts(pairs % most, self.strata[pairs // most])[at]
        # A group is one term in one stratum; its first posting has the largest tf.
        group = terms * len(self.strata) + stratum
        self.first = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
        self.length = np.diff(np.append(self.first, len(group)))
        self.group_stratum, self.bound = stratum[self.first], self.impact[self.first]
        self.terms, starts = np.unique(terms[self.first], return_index=True)
        self.term_begin = np.append(starts, len(self.first))

    def best(
        self, terms: np.ndarray, weights: np.ndarray, tie: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the ``k`` best of one query."""
        nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(self.terms, terms)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == terms[known]
        at, weights = at[known], weights[known]
        if not len(at):
            return nothing
        counts = self.term_begin[at + 1] - self.term_begin[at]
        groups = ranges(self.term_begin[at], counts)
        weight = np.repeat(weights, counts)
        bounds = np.zeros(len(self.strata), np.int64)
        np.add.at(bounds, self.group_stratum[groups], weight * self.bound[groups])
        visits = np.argsort(-bounds, kind="stable")
        visits = visits[bounds[visits] > 0]
        rank = np.full(len(self.strata), len(self.strata), np.int64)
        rank[visits] = np.arange(len(visits))
        # Groups in the order of the visits.
        order = np.argsort(rank[self.group_stratum[groups]], kind="stable")
        groups, weight = groups[order], weight[order]
        visited = rank[self.group_stratum[groups]]
        held = np.cumsum((self.begin[1:] - self.begin[:-1])[visits])
        score = np.zeros(len(self.members), np.int64)
        docs, done, size, kth = nothing[0], 0, _FIRST, 0
        while done < len(visits) and bounds[visits[done]] >= max(kth, 1):
            upto = int(np.searchsorted(held, (held[done - 1] if done else 0) + size)) + 1
            upto = min(upto, int(np.searchsorted(-bounds[visits], -max(kth, 1), "right")))
            a, b = np.searchsorted(visited, [done, upto])
            now, sizes = groups[a:b], self.length[groups[a:b]]
            postings = ranges(self.first[now], sizes)
            np.add.at(
                score, self.doc[postings], np.repeat(weight[a:b], sizes) * self.impact[postings]
            )
            inside = visits[done:upto]
            fresh = self.members[ranges(self.begin[inside], (self.begin[1:] - self.begin[:-1])[inside])]
            fresh = fresh[score[fresh] >= max(kth, 1)]
            docs = np.concatenate([docs, fresh])
            docs = docs[np.lexsort((tie[docs], -score[docs]))[:k]]
            if len(docs) == k:
                kth = int(score[docs[-1]])
            done, size = upto, 4 * size
        return docs, score[docs]


def _counts(docs: DataFrame, vocabulary: list[bytes], id_type: T.DataType) -> DataFrame:
    """Of every row its id, its number of terms, and numbers and counts of the terms asked for."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast({term: i for i, term in enumerate(vocabulary)})
    field = T.StructField
    schema = T.StructType(
        [
            field("id", id_type),
            field("n", T.LongType()),
            field("terms", T.ArrayType(T.IntegerType())),
            field("tfs", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        width = len(shared.value) + 1
        for batch in sized_slices(batches, 1, 512, _BYTES):
            found = [terms_of(text) for text in utf8(batch.column(1))]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            total = int(sizes.sum())
            every = (number(term, -1) for terms in found for term in terms)
            every = np.fromiter(every, np.int64, total)
            doc = np.repeat(np.arange(len(found)), sizes)[every >= 0]
            keys, tfs = np.unique(doc * width + every[every >= 0], return_counts=True)
            offsets = np.searchsorted(keys, np.arange(len(found) + 1) * width).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array((keys % width).astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(tfs.astype(np.int32))),
                ],
                names=schema.names,
            )

    return docs.mapInArrow(run, schema)


def _answer(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents of every item of one round: ``item``, ``score``, ``id``."""
    spark = docs.sparkSession
    wanted = items.select("item", F.explode("terms").alias("term")).groupBy("item", "term").count()
    asked = wanted.groupBy("item").agg(F.collect_list(F.struct("term", "count")).alias("terms"))
    packed = asked.toArrow()  # bounded by the round
    names = [[x["term"].encode() for x in one] for one in packed["terms"].to_pylist()]
    vocabulary = sorted({term for one in names for term in one})
    id_type = docs.schema["id"].dataType
    counts = materialise(_counts(docs, vocabulary, id_type))
    n_docs, n_terms = counts.agg(
        F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    seen = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df")
    )
    # One number per term asked for.
    rare = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1)
    weight = F.floor(1000 * F.log(rare)).cast("bigint")
    weights = np.zeros(len(vocabulary), np.int64)
    table = seen.select("term", weight.alias("w")).toArrow()
    weights[table["term"].to_numpy()] = table["w"].to_numpy()
    place = {term: i for i, term in enumerate(vocabulary)}
    queries = []
    for item, terms, one in zip(packed["item"].to_pylist(), names, packed["terms"].to_pylist()):
        at = np.array([place[term] for term in terms], np.int64)
        repeats = np.array([x["count"] for x in one], np.int64)
        kept = weights[at] > 0
        queries.append((item, at[kept], (weights[at] * repeats)[kept]))
    shared = spark.sparkContext.broadcast(queries)

    m = F.expr(f"100 - 25 + ((25 * n * {n_docs}) div {max(n_terms, 1)})")
    indexed = counts.where("size(terms) > 0").select("id", m.alias("m"), "terms", "tfs")
    shards = max(1, -(-n_docs // SHARD))
    sharded = indexed.repartitionByRange(shards, "m", F.xxhash64("id", "terms", "tfs"))
    schema = T.StructType(
        [
            T.StructField("item", items.schema["item"].dataType),
            T.StructField("score", T.LongType()),
            T.StructField("id", id_type),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, SHARD - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == SHARD:
                    yield from search(held)
                    held, n = [], 0
        if n:
            yield from search(held)

    def search(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        terms, tfs = table["terms"].chunk(0), table["tfs"].chunk(0)
        shard = Shard(
            table["m"].to_numpy(),
            np.diff(terms.offsets.to_numpy()),
            terms.flatten().to_numpy().astype(np.int64),
            tfs.flatten().to_numpy().astype(np.int64),
        )
        ids = table["id"].combine_chunks()
        # Places of the documents in the order of their ids, null last.
        tie = np.empty(len(ids), np.int64)
        tie[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        numbers, scores, docs = [], [], []
        for i, (_, at, weights) in enumerate(shared.value):
            found, score = shard.best(at, weights, tie, k)
            numbers.append(np.full(len(found), i, np.int64))
            scores.append(score)
            docs.append(found)
        if numbers:
            items = pa.array([item for item, _, _ in shared.value], packed_type)
            yield pa.RecordBatch.from_arrays(
                [
                    items.take(pa.array(np.concatenate(numbers))),
                    pa.array(np.concatenate(scores)),
                    ids.take(pa.array(np.concatenate(docs))),
                ],
                names=schema.names,
            )

    packed_type = packed["item"].type
    answers = materialise(sharded.mapInArrow(run, schema))
    release(counts)
    shared.unpersist()
    return answers


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    round_terms: int = ROUND_TERMS,
) -> DataFrame:
    """The ``k`` highest-scoring rows of ``docs`` for every row of ``items``.

    Returns the item's id, ``rank`` (from 1), ``id_col`` and ``score``; higher scores first, the
    smaller id on a tie, a null id last. Only scores above 0 count, so an item without terms, or
    whose terms stand in no document, gives no rows.

    Null texts have no term. Each row of ``docs`` is a document of its own, repeated rows included.
    Repeated rows of ``items`` count once; different texts under one id are ranked separately and
    both give rows. Other columns are not read. Empty tables give no rows. Items are answered in
    rounds of about ``round_terms`` terms, which bounds what is sent to the tasks; each round
    is a pass over ``docs``.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = materialise(
        items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"))
        .distinct()
        .select("item_id", query_terms(F.col("text")).alias("terms"))
        .where(F.size("terms") > 0)
        # Names the row, as ids may be repeated or null.
        .withColumn("item", F.monotonically_increasing_id())
    )
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    rounds = max(1, -(-total // round_terms))
    part = F.pmod(F.xxhash64("item"), F.lit(rounds))
    answers = None
    for i in range(rounds):
        now = _answer(texts, asked.where(part == i), k)
        answers = now if answers is None else answers.unionByName(now)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (
        answers.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .join(asked.select("item", "item_id"), "item")
        .select(
            F.col("item_id").alias(item_id_col),
            "rank",
            F.col("id").alias(id_col),
            "score",
        )
    )
