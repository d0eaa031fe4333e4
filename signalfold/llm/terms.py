"""Terms of whole texts: maximal runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased.

The lower-casing touches no other letter, so it works on bytes: every byte from 128 on belongs to a term.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from signalfold.llm.text import sliced

MARK = b"\x01"  # between two texts; no term has it
_KEPT = np.full(256, 32, dtype=np.uint8)
for _lo, _hi, _to in ((48, 58, 48), (65, 91, 97), (97, 123, 97), (128, 256, 128)):
    _KEPT[_lo:_hi] = np.arange(_to, _to + _hi - _lo)
_RUNS = re.compile(rb"  +")


def term_lines(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, bytes]]:
    """(first row, number of texts, line) of runs of texts. In a line every term stands between two single spaces, and
    so does the ``MARK`` after each text but the last; null is empty."""
    for row, data, offsets in sliced(column):
        letters = _KEPT[data].tobytes()
        bounds = offsets.tolist()
        line = (b" " + MARK + b" ").join(letters[a:b] for a, b in zip(bounds, bounds[1:], strict=False))
        yield row, len(bounds) - 1, _RUNS.sub(b" ", b" " + line + b" ")
