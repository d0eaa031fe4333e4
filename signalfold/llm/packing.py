"""Cost-balanced packing of documents into token sequences of one length.

Each task packs the documents of its own part of the table, shard by shard, so no document is shuffled. In a
shard, the tokens of a document are first cut into full sequences. The remainders, longest first, each go to the
sequence with the lowest estimated attention cost (linear plus quadratic in the piece's length) that has room for
it. The room of a shard's sequences is exactly the number of its tokens, so when nothing fits, the document is
cut. What is left over goes to the task's next shard, and in its last one into sequences whose lengths are
powers of two; no sequence needs padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalfold.llm.tokens import decoded, encoder


@dataclass(frozen=True)
class Packing:
    length: int = 2048
    end_id: int = 1  # put after each document
    linear: float = 1.0
    quadratic: float = 1.0 / 1024  # attention cost of a token pair against the cost of a token
    shard_tokens: int = 1 << 20


@dataclass
class Piece:
    doc: int  # index in the task's open documents
    start: int
    length: int
    sequence: int = -1
    offset: int = -1


def assign(pieces: list[Piece], rooms: np.ndarray, rule: Packing) -> tuple[list[Piece], list[Piece]]:
    """Put pieces into sequences with the given rooms: (placed, left over). Pieces are cut where none has room."""
    room, cost = rooms.astype(np.int64), np.zeros(len(rooms))
    placed, left = [], []
    for piece in sorted(pieces, key=lambda p: -p.length):
        while piece.length:
            fits = room >= piece.length
            if not fits.any():
                fits = room > 0
                if not fits.any():
                    left.append(piece)
                    break
            k = int(np.where(fits, cost, np.inf).argmin())
            part = Piece(piece.doc, piece.start, min(piece.length, int(room[k])), k, int(rooms[k] - room[k]))
            placed.append(part)
            room[k] -= part.length
            cost[k] += rule.linear * part.length + rule.quadratic * part.length**2
            piece = Piece(piece.doc, piece.start + part.length, piece.length - part.length)
    return placed, left


def pack(pieces: list[Piece], rule: Packing, last: bool) -> tuple[list[Piece], list[Piece], int]:
    """(placed, left over, number of sequences) of one shard."""
    placed, rests, n = [], [], 0
    for p in pieces:
        full = p.length // rule.length
        placed += [Piece(p.doc, p.start + k * rule.length, rule.length, n + k, 0) for k in range(full)]
        n += full
        if p.length > full * rule.length:
            rests.append(Piece(p.doc, p.start + full * rule.length, p.length - full * rule.length))
    total = sum(p.length for p in rests)
    rooms = [rule.length] * (total // rule.length)
    if last:
        rest = total % rule.length
        rooms += [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    more, left = assign(rests, np.array(rooms, dtype=np.int64), rule)
    for p in more:
        p.sequence += n
    return placed + more, left, n + len(rooms)


def _packer(tokenizer: str, rule: Packing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, base, end = encoder(tokenizer), TaskContext.get().partitionId() << 32, np.array([rule.end_id], dtype="<u4")
        names, tokens, pieces, held = [], [], [], 0

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal names, tokens, pieces, held, base
            placed, left, used = pack(pieces, rule, last)
            placed.sort(key=lambda p: (p.sequence, p.offset))
            batch = pa.record_batch(
                [
                    pa.array([names[p.doc] for p in placed], pa.int64()),
                    pa.array([p.start for p in placed], pa.int64()),
                    pa.array([p.length for p in placed], pa.int64()),
                    pa.array([tokens[p.doc][p.start : p.start + p.length].tobytes() for p in placed], pa.binary()),
                    pa.array([len(tokens[p.doc]) for p in placed], pa.int64()),
                    pa.array([base + p.sequence for p in placed], pa.int64()),
                    pa.array([p.offset for p in placed], pa.int64()),
                ],
                names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )
            open_docs = sorted({p.doc for p in left})
            new = {d: k for k, d in enumerate(open_docs)}
            names, tokens = [names[d] for d in open_docs], [tokens[d] for d in open_docs]
            pieces = [Piece(new[p.doc], p.start, p.length) for p in left]
            held, base = sum(p.length for p in left), base + used
            return batch

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, texts, _ in decoded(batch.column(1)):
                for k, text in enumerate(texts):
                    own = np.concatenate([codec.ids(text), end])
                    names.append(ids[row + k])
                    tokens.append(own)
                    pieces.append(Piece(len(tokens) - 1, 0, len(own)))
                    held += len(own)
                    if held >= rule.shard_tokens:
                        yield flush(False)
        if pieces:
            yield flush(True)
        encoder.cache_clear()  # the worker lives on, and other stages need the memory

    return run


def pack_documents(docs: DataFrame, tokenizer: str, rule: Packing = Packing(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: (id, start, length, ids, doc_tokens, sequence_id, offset).

    ``ids`` are the piece's tokens as little-endian unsigned 32-bit numbers; ``start`` counts the document's
    tokens before it, ``doc_tokens`` all of them with the end id. A sequence's pieces follow each other without
    gaps from ``offset`` 0. Null texts are empty: one piece with the end id. Repeated rows and null ids are
    documents like any other, a very long one fills sequences of its own, an empty table has no rows, and other
    columns are not read.

    Sequence ids count up from the task's number, so a task that runs again on the same part of its input gives
    the same rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    packed = rows.mapInArrow(
        _packer(tokenizer, rule), "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    return packed.withColumnRenamed("id", id_col)
