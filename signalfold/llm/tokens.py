"""Token counts and token ids of whole texts by public tokenizers."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalfold.llm.text import sliced

PIECE = 1 << 16  # characters; longer texts are encoded in pieces cut at safe boundaries

# --- fixed value: the pattern by which byte-level BPE splits text before its merges ---
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level BPE writes for each byte: printable bytes stand for themselves, others for 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in plain):
        letters[chr(256 + k)] = b
    return letters


def _same_as_ranks(model: dict) -> bool:
    """Whether the file is plain byte-level BPE with merges in id order, so that ids are merge ranks."""
    bpe, split = model["model"], model["pre_tokenizer"] or {}
    plain = bpe["type"] == "BPE" and not any(bpe.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    level = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    if not plain or not level or model["normalizer"] or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in model["added_tokens"]):
        return False
    pairs = (m.split(" ") if isinstance(m, str) else m for m in bpe["merges"])
    made = [bpe["vocab"][a + b] for a, b in pairs]
    return made == list(range(256, 256 + len(made)))


class Encoder:
    """Ids as the file's own library gives them, without begin, end or padding.

    The library of a ``.json`` file encodes about 1 MB a second here. Where the file is plain byte-level BPE, the
    same merges run in the rank-based encoder, five times as fast; both agree on every code point
    (tests/llm/test_tokens.py). Special strings in a text become their ids, as is that library's default.
    """

    def __init__(self, path: str):
        self.rank = self.pieces = None
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.path = path
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {a["content"]: a["id"] for a in model["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.cuts = not any(" " in s for s in special)
        if _same_as_ranks(model):
            import tiktoken

            letters = _byte_letters()
            ranks = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
            self.rank = tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=special)

    @cached_property
    def full(self):
        """The file's own library; only loaded where a text needs it."""
        from tokenizers import Tokenizer

        full = Tokenizer.from_file(self.path)
        full.no_truncation()
        full.no_padding()
        return full

    def parts(self, text: str) -> Iterator[str]:
        """The text in pieces that are encoded alike alone: byte-level words never reach over a space that follows a
        character which isn't white space."""
        if self.pieces or not self.rank or not self.cuts:
            yield text
            return
        lo = 0
        while len(text) - lo > PIECE:
            cut = text.rfind(" ", lo + 1, lo + PIECE)
            while cut > lo and text[cut - 1].isspace():
                cut = text.rfind(" ", lo + 1, cut)
            if cut <= lo:
                found = re.compile(r"(?<=\S) ").search(text, lo + PIECE)
                if not found:
                    break
                cut = found.start()
            yield text[lo:cut]
            lo = cut
        yield text[lo:]

    def _encode(self, part: str) -> np.ndarray:
        if self.pieces:
            return np.array(self.pieces.encode(part, num_threads=1), dtype="<u4")
        if not self.rank or len(part) > 4 * PIECE:  # one unbroken run of letters or spaces
            return np.array(self.full.encode(part, add_special_tokens=False).ids, dtype="<u4")
        if self.special and self.special.search(part):
            return np.array(self.rank.encode(part, allowed_special="all"), dtype="<u4")
        return np.array(self.rank.encode_ordinary(part), dtype="<u4")

    def ids(self, text: str) -> np.ndarray:
        """Little-endian unsigned 32-bit ids."""
        parts = [self._encode(p) for p in self.parts(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)


def decoded(column: pa.Array, most: int = 1 << 18) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """(first row, texts, UTF-8 lengths) of runs of rows of about ``most`` bytes; null is empty."""
    for row, data, offsets in sliced(column, most):
        raw = data.tobytes()
        bounds = offsets.tolist()
        yield row, [raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:], strict=False)], np.diff(offsets)


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path)
        for batch in batches:
            for row, texts, sizes in decoded(batch.column(0)):
                counts = [len(codec.ids(t)) for t in texts]
                yield pa.record_batch(
                    [*(c.slice(row, len(texts)) for c in batch.columns[1:]), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                    names=[*batch.schema.names[1:], "n_bytes", "n_tokens"],
                )

    return run


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for each row of ``docs``, by the tokenizer file at the path ``tokenizer``.

    Only lengths leave the Python workers. Batches hold about the same number of bytes, and a long text is
    encoded in pieces, but counted whole. Null counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids
    are rows like any other; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    return rows.mapInArrow(_counts(tokenizer), f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
