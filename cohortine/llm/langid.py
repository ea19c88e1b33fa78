"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent n-grams (one to three characters, words
padded with a blank) of a language, counted over all training documents. A document is
given to the language whose ranks are least out of place: the sum, over the document's
own most frequent n-grams, of the difference between the two ranks, or the largest
possible one where the profile lacks the n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import slices, utf8
from .ranking import held_out, keep_rows

#: Stands for the blank between words; no letter has this code point.
_BLANK = 1
_BITS = 21
#: Distinct n-gram counts a task holds before it adds them up.
_HELD = 1 << 20
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: bytes) -> np.ndarray:
    """The 1- to 3-grams of a whole text as integers, repeats included; empty without a letter."""
    lowered = text.decode("utf-8", "replace").lower()
    points = np.frombuffer(lowered.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.int64)
    points = np.where(letter, points, _BLANK)
    points = np.concatenate([[_BLANK], points, [_BLANK]])
    points = points[np.append(True, (points[1:] != _BLANK) | (points[:-1] != _BLANK))]
    one = points[points != _BLANK]
    two = points[:-1] << _BITS | points[1:]
    middle = points[1:-1] != _BLANK
    three = (two[:-1] << _BITS | points[2:])[middle]
    return np.concatenate([one, two, three])


def _ranked(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Keys by falling count, the smaller key first on a tie; at most ``size``."""
    return keys[np.lexsort((keys, -counts))[:size]]


def learn_profiles(
    docs: DataFrame,
    size: int = 400,
    lang_col: str = "lang",
    text_col: str = "text",
    max_languages: int = 2_000,
) -> dict[str, np.ndarray]:
    """Language to its n-grams by rank, counted over all rows with a language.

    Every task adds up its own counts before they are shuffled, so a hot language is no
    hot key. The driver gets ``size`` n-grams for each language; more than
    ``max_languages`` languages are an error, since the profiles are sent to every task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting: dict[str, int] = {}

        def add_up(lang: str) -> None:
            keys = np.concatenate([k for k, _ in held[lang]])
            counts = np.concatenate([c for _, c in held[lang]])
            distinct, at = np.unique(keys, return_inverse=True)
            held[lang] = [(distinct, np.bincount(at, weights=counts).astype(np.int64))]
            waiting[lang] = 0

        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                keys, counts = np.unique(grams(text), return_counts=True)
                held.setdefault(lang, []).append((keys, counts))
                waiting[lang] = waiting.get(lang, 0) + len(keys)
                if waiting[lang] > _HELD:
                    add_up(lang)
        for lang in held:
            add_up(lang)
            keys, counts = held[lang][0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)],
                names=["__lang", "__gram", "__n"],
            )

    schema = "__lang string, __gram bigint, __n bigint"
    best = Window.partitionBy("__lang").orderBy(F.desc("__n"), "__gram")
    top = (
        docs.where(F.col(lang_col).isNotNull())
        .select(F.col(lang_col).cast("string"), text_col)
        .mapInArrow(run, schema)
        .groupBy("__lang", "__gram")
        .agg(F.sum("__n").alias("__n"))
        .withColumn("__rank", F.row_number().over(best))
        .where(F.col("__rank") <= size)
        .select("__lang", "__gram", "__rank")
        .limit(max_languages * size + 1)
        .toArrow()
    )
    if top.num_rows > max_languages * size:
        raise ValueError(f"more than {max_languages} languages to learn")
    rows = sorted(zip(*(top[c].to_pylist() for c in ("__lang", "__rank", "__gram"))))
    profiles: dict[str, list[int]] = {}
    for lang, _, gram in rows:
        profiles.setdefault(lang, []).append(gram)
    return {lang: np.array(ranked, np.int64) for lang, ranked in profiles.items()}


@dataclass(frozen=True)
class LanguageModel:
    profiles: dict[str, np.ndarray]
    size: int = 400

    def predict(self, text: bytes) -> tuple[str, float]:
        """Language and closeness: 1 when all ranks agree, 0 when no n-gram is known.

        On a tie the first language in text order wins. A text without a letter, or a
        model without a language, gives ``und`` and 0.
        """
        keys = grams(text)
        if not len(keys) or not self.profiles:
            return UNKNOWN, 0.0
        ranked = _ranked(*np.unique(keys, return_counts=True), self.size)
        places = np.arange(len(ranked))
        best, best_lang = np.inf, UNKNOWN
        for lang, (known, ranks) in self.lookups().items():
            at = np.minimum(np.searchsorted(known, ranked), len(known) - 1)
            away = np.where(known[at] == ranked, np.abs(ranks[at] - places), self.size)
            if away.sum() < best:
                best, best_lang = float(away.sum()), lang
        return best_lang, 1.0 - best / (self.size * len(ranked))

    def lookups(self) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        """Per language the n-grams in order of value, and their ranks."""
        if "_lookups" not in self.__dict__:
            made = {}
            for lang in sorted(self.profiles):
                order = np.argsort(self.profiles[lang])
                made[lang] = (self.profiles[lang][order], order)
            object.__setattr__(self, "_lookups", made)
        return self.__dict__["_lookups"]


def learn_languages(
    docs: DataFrame,
    size: int = 400,
    id_col: str = "doc_id",
    lang_col: str = "lang",
    text_col: str = "text",
) -> LanguageModel:
    """A model from the documents outside the held-out third that have a language."""
    return LanguageModel(
        learn_profiles(docs.where(~held_out(id_col, 3, 1)), size, lang_col, text_col), size
    )


def predict_language(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``held_out``, ``lang_pred``, ``score`` for every row of ``docs``.

    A text that is null, empty or without a letter gives ``und`` and 0. Repeated rows and
    null ids give a row each; other columns are not read.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs, scores = zip(*map(model.predict, utf8(batch.column(2))))
            columns = [batch.column(0), batch.column(1), pa.array(langs), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(id_col, held_out(id_col, 3, 1).alias("__held_out"), text_col).mapInArrow(
        run, schema
    )


def filter_language(
    docs: DataFrame,
    model: LanguageModel,
    languages: frozenset[str] | None = None,
    min_score: float = 0.0,
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with a recognised language, with all their columns.

    ``languages`` limits them to some languages. Rows go whose language is ``und``
    or whose closeness is below ``min_score``.
    """

    def keep(texts: list[bytes]) -> np.ndarray:
        guesses = [model.predict(text) for text in texts]
        return np.array(
            [
                lang != UNKNOWN and score >= min_score and (not languages or lang in languages)
                for lang, score in guesses
            ],
            bool,
        )

    place = docs.columns.index(text_col)
    return docs.mapInArrow(partial(keep_rows, place=place, keep=keep), docs.schema)
