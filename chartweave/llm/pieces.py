"""Splitting oversized texts at natural boundaries.

Method: prefix sums of the unit lengths turn the size limit into positions; for every kind of boundary a sorted
array of positions is searched for the last one under the limit; the next piece steps back by the overlap; where
no boundary lies in the window, the cut is hard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LF, CR, BLANK, TAB = 10, 13, 32, 9


def boundaries(codes: np.ndarray) -> list[np.ndarray]:
    """Sorted end positions by kind, best kind first: after an empty line, after LF, after a blank behind
    ``.``, ``!`` or ``?``, after a blank or tab."""
    lf = np.flatnonzero(codes == LF) + 1
    one = lf[lf >= 2]
    before = codes[one - 2]
    two = one[before == LF]
    cr = one[(before == CR) & (one >= 3)]
    empty = np.sort(np.concatenate([two, cr[codes[cr - 3] == LF]]))
    blank = np.flatnonzero(codes == BLANK) + 1
    behind = blank[blank >= 2]
    ends = behind[np.isin(codes[behind - 2], (46, 33, 63))]
    white = np.flatnonzero((codes == BLANK) | (codes == TAB)) + 1
    return [empty, lf, ends, white]


def cut(text: str, limit: int, least: int, overlap: int, offsets: np.ndarray | None = None) -> list[tuple[int, int]]:
    """``(char_start, char_end)`` of the pieces of a text.

    ``offsets``: prefix sums of the sizes of the characters (n + 1 entries); without it every code point counts 1.
    A piece from s ends at the last boundary e of the best kind with size(s..e) in (least, limit], else hard at the limit.
    """
    if not 0 <= overlap <= least < limit:
        raise ValueError("0 <= overlap <= least < limit must hold")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    sizes = np.arange(n + 1) if offsets is None else offsets
    kinds = boundaries(codes)
    out, s = [], 0
    while sizes[n] - sizes[s] > limit:
        lo = int(np.searchsorted(sizes, sizes[s] + least, "right"))
        hi = max(int(np.searchsorted(sizes, sizes[s] + limit, "right")) - 1, s + 1)
        e = hi
        for kind in kinds:
            k = int(np.searchsorted(kind, hi, "right")) - 1
            if k >= 0 and kind[k] >= lo:
                e = int(kind[k])
                break
        out.append((s, e))
        s = max(int(np.searchsorted(sizes, sizes[e] - overlap, "left")), s + 1)
    out.append((s, n))
    return out


def split_oversized(df: DataFrame, key: str, text: str, limit: int = 2000, least: int = 1000, overlap: int = 200) -> DataFrame:
    """``(key, char_start, char_end)`` of every piece of every text longer than ``limit`` code points.

    Null, blank and short texts give no row.  The first piece starts at 0, the last ends with the text.
    Only the long texts leave the JVM; no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, a, z = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for s, e in cut(t, limit, least, overlap):
                    ids.append(i)
                    a.append(s)
                    z.append(e)
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(a, pa.int64()), pa.array(z, pa.int64())], names=[key, "char_start", "char_end"])

    long = df.select(key, text).where(F.length(text) > limit)
    return long.mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, char_start long, char_end long")
