"""Rule statistics of whole texts, and features derived from them as Spark columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalfold.llm.text import Words, find_words, mix, sliced, window_hashes

WINDOW = 8  # words of a repeated passage

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_bangs", "n_bars", "n_short")

_KINDS = {name: np.zeros(256, dtype=bool) for name in ("symbols", "upper", "digits", "marks", "bangs", "bars")}
_KINDS["symbols"][list(b"#*$%&|<>")] = True
_KINDS["upper"][65:91] = True
_KINDS["digits"][48:58] = True
_KINDS["marks"][list(b".,;:?!")] = True
_KINDS["bangs"][ord("!")] = True
_KINDS["bars"][ord("|")] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set within each text."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def _lines(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each line that has a word; a hash is over all bytes between two line feeds."""
    if not len(words.starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    feeds = np.flatnonzero(words.data == 10)
    edges = np.unique(np.concatenate([feeds, feeds + 1, words.offsets]))
    lo, hi = edges[:-1], edges[1:]
    real = words.data[np.minimum(lo, len(words.data) - 1)] != 10
    lo, hi = lo[real], hi[real]
    held = np.searchsorted(words.starts, hi) > np.searchsorted(words.starts, lo)
    lo, hi = lo[held], hi[held]
    size = hi - lo
    at = np.cumsum(size) - size
    where = np.arange(int(size.sum())) - np.repeat(at, size)
    letters = words.data[np.repeat(lo, size) + where].astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(letters * mix(where.astype(np.uint64) + np.uint64(1)), at)
    return np.searchsorted(words.offsets, lo, side="right") - 1, mix(sums ^ size.astype(np.uint64))


def _again(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by (text, hash), and in it whether an entry equals the one before."""
    order = np.lexsort((hashes, text))
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (text[order][1:] == text[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    return order, same


def count_words(words: Words) -> dict[str, np.ndarray]:
    """The statistics of ``COUNTS``, per text."""
    n, offsets = len(words), words.offsets
    out = {"n_words": words.counts}
    lengths = np.zeros(len(words.data) + 1, dtype=np.int64)
    np.cumsum((words.data & 0xC0) != 0x80, out=lengths[1:])
    chars = lengths[words.ends] - lengths[words.starts]
    total = np.concatenate([[0], np.cumsum(chars)])
    out["word_chars"] = np.diff(total[words.first])
    for name, kind in _KINDS.items():
        out[f"n_{name}"] = _per_text(kind[words.data], offsets)
    out["n_short"] = np.diff(np.concatenate([[0], np.cumsum(chars <= 3)])[words.first])
    text, hashes = _lines(words)
    order, same = _again(text, hashes)
    out["n_lines"] = np.bincount(text, minlength=n)
    out["n_dup_lines"] = np.bincount(text[order][same], minlength=n)
    windows = window_hashes(words.hashes, WINDOW)
    per = np.maximum(words.counts - WINDOW + 1, 0)
    text = np.repeat(np.arange(n), per)
    at = words.first[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    order, same = _again(text, windows[at])
    twice = same.copy()
    twice[:-1] |= same[1:]
    edge = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    found = at[order][twice]
    edge[found] += 1
    edge[found + WINDOW if len(found) else found] -= 1
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    out["n_repeat_words"] = np.diff(covered[words.first])
    return out


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in sliced(batch.column(0)):
            counts = count_words(find_words(data, offsets))
            yield pa.record_batch(
                [*(c.slice(row, len(offsets) - 1) for c in batch.columns[1:]), *(pa.array(counts[c], pa.int64()) for c in COUNTS)],
                names=[*batch.schema.names[1:], *COUNTS],
            )


def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the statistics of ``COUNTS``) for each row of ``docs``.

    Null texts have none of anything. Texts of any length are measured whole; repeated rows and null ids are rows
    like any other; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    schema = ", ".join([f"id {kind}", *(f"{c} long" for c in COUNTS)])
    return rows.mapInArrow(_measure, schema).withColumnRenamed("id", id_col)


def _share(part: str, whole: str) -> str:
    return f"if({whole} > 0, {part} / {whole}, 0D)"


FORMULAS = {
    "log_words": "ln(1 + n_words)",
    "word_length": _share("word_chars", "n_words"),
    "symbols": _share("n_symbols", "n_words"),
    "dup_lines": _share("n_dup_lines", "n_lines"),
    "repeats": _share("n_repeat_words", "n_words"),
    "line_words": f"ln(1 + {_share('n_words', 'n_lines')})",
    "upper": _share("n_upper", "word_chars"),
    "digits": _share("n_digits", "word_chars"),
    "marks": _share("n_marks", "n_words"),
    "bangs": _share("n_bangs", "n_words"),
    "bars": _share("n_bars", "n_words"),
    "short": _share("n_short", "n_words"),
}
FEATURES = tuple(FORMULAS)


def features() -> dict[str, Column]:
    """What the models look at, by name, as columns over the statistics; 0 where there are no words."""
    return {name: F.expr(formula) for name, formula in FORMULAS.items()}


def bounded_sample(frame: DataFrame, key: Column, most: int, seed: int) -> DataFrame:
    """``most`` rows of ``frame`` (all, if it has fewer), drawn by a hash of ``key``; the same rows on every run.

    Only rows whose hash is in a share of the range that holds a few more than ``most`` are put in order, so the driver gets
    about ``most`` rows from all tasks together.
    """
    draw = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 40))
    wanted = 1.2 * most + 200
    n = max(frame.count(), 1)
    return frame.where(draw < int(min(1.0, wanted / n) * (1 << 40))).orderBy(draw).limit(most)
