"""Language ID by rank-order profiles of letter n-grams.

A profile lists a language's most frequent n-grams (one to three letters, words padded with a separator) by rank. A
document's own most frequent n-grams are ranked in the same way, and each language's distance is the sum of
how far out of place they are in its profile. Profiles count all training texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalfold.llm.tokens import decoded

UNKNOWN = "und"
GAP = 1  # stands for what lies between words; no letter has this code
HELD_GRAMS = 1 << 20


@dataclass(frozen=True)
class Profiles:
    """``ranks[l, g]``: the rank of n-gram ``grams[g]`` in language ``l``; ``size`` where it isn't in the profile."""

    languages: tuple[str, ...]
    grams: np.ndarray
    ranks: np.ndarray
    size: int


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([not 0xD800 <= c <= 0xDFFF and chr(c).isalpha() for c in range(0x110000)])


def gram_codes(text: str) -> np.ndarray:
    """Every n-gram of the lower-cased text, 21 bits a letter; empty if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, dtype=np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one gap after each word
    own = np.where(letter, points, GAP)[keep].astype(np.uint64)
    own = np.concatenate([[np.uint64(GAP)], own] if own[-1] == GAP else [[np.uint64(GAP)], own, [np.uint64(GAP)]])
    two = own[:-1] << np.uint64(21) | own[1:]
    three = two[:-1] << np.uint64(21) | own[2:]
    return np.concatenate([own[own != GAP], two, three[own[1:-1] != GAP]])


def _counted(codes: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weights is None:
        codes = np.sort(codes)
        at = np.flatnonzero(np.diff(codes, prepend=codes[:1] + np.uint64(1)))
        return codes[at], np.diff(np.append(at, len(codes)))
    order = np.argsort(codes, kind="stable")
    codes, weights = codes[order], weights[order]
    at = np.flatnonzero(np.diff(codes, prepend=codes[:1] + np.uint64(1)))
    return codes[at], np.add.reduceat(weights, at) if len(at) else weights


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, lang): (lang, gram, n), counted over the task's texts."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def table() -> Iterator[pa.RecordBatch]:
        for lang, (grams, n) in held.items():
            yield pa.record_batch([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), dtype=object)
        for row, texts, _ in decoded(batch.column(0), 1 << 17):
            own = langs[row : row + len(texts)]
            for lang in sorted(set(own)):
                grams, n = _counted(np.concatenate([gram_codes(t) for t, o in zip(texts, own, strict=True) if o == lang]))
                if lang in held:
                    grams, n = _counted(np.concatenate([held[lang][0], grams]), np.concatenate([held[lang][1], n]))
                held[lang] = grams, n
            if sum(len(g) for g, _ in held.values()) > HELD_GRAMS:
                yield from table()
    yield from table()


def learn_profiles(docs: DataFrame, size: int = 400, text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles of the languages in ``docs``; ``size`` n-grams each, ties by code, are all that the driver gets."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place).where(F.col("place") <= size).select("lang", "gram", "place").collect()
    languages = tuple(sorted({r["lang"] for r in top}))
    grams = np.array(sorted({r["gram"] for r in top}), dtype=np.uint64)
    ranks = np.full((len(languages), len(grams)), size, dtype=np.int64)
    for r in top:
        ranks[languages.index(r["lang"]), np.searchsorted(grams, np.uint64(r["gram"]))] = r["place"] - 1
    return Profiles(languages, grams, ranks, size)


def classify(text: str, profiles: Profiles) -> tuple[str, float]:
    """(language, score): the score is the runner-up's share of the two least distances, 1 if there is one language only."""
    codes = gram_codes(text)
    if not len(codes) or not profiles.languages:
        return UNKNOWN, 0.0
    grams, n = _counted(codes)
    own = grams[np.argsort(-n, kind="stable")[: profiles.size]]
    at = np.minimum(np.searchsorted(profiles.grams, own), len(profiles.grams) - 1)
    known = profiles.grams[at] == own
    theirs = np.where(known, profiles.ranks[:, at], profiles.size)
    apart = np.where(theirs == profiles.size, profiles.size, np.abs(theirs - np.arange(len(own)))).sum(axis=1)
    order = np.argsort(apart, kind="stable")
    if len(order) == 1:
        return profiles.languages[0], 1.0
    best, second = int(apart[order[0]]), int(apart[order[1]])
    return profiles.languages[order[0]], second / (best + second) if second else 0.5


def language_column(text: Column, profiles: Profiles) -> Column:
    """A struct (lang_pred, score) for each text; the texts are all that the Python workers see of the rows."""

    @F.arrow_udf("lang_pred string, score double")
    def told(texts: pa.Array) -> pa.Array:
        found = [classify(t, profiles) for _, some, _ in decoded(texts, 1 << 17) for t in some]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang_pred", "score"]
        )

    return told(text)


def fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(id_column.cast("string").cast("binary")) % folds


def predict_language(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for each row. ``und`` with score 0: null, empty or without a letter, or nothing was
    learned. Equal distances go to the first language by code point. Whole texts of any length; repeated rows
    and null ids are rows like any other; no other column is read."""
    return docs.select(id_col, language_column(F.col(text_col), profiles).alias("_told")).select(id_col, "_told.*")
