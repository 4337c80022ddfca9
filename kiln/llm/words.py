"""Words, word hashes and rolling n-gram hashes of a batch of texts, in numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D, the same as
the pattern ``[^\\x20\\x09-\\x0D]+`` on the decoded text, because no byte of
a multi-byte UTF-8 character lies in that range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text hashed at once; bounds the working arrays, not the result.
BLOCK = 1 << 20
#: Odd multipliers of the polynomial hashes (over bytes, over words).
BYTE_BASE = np.uint64(0xD6E8FEB86659FD93)
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * WORD_BASE)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    _, off, data = col.buffers()
    if off is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offs


def with_doc(df, text_col: str, carry: list[str] | None):
    """``df`` as ``doc``, a struct of the carried columns (default: all), and
    ``text`` only where ``doc`` does not hold it: texts travel once."""
    names = df.columns if carry is None else carry
    doc = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(None).cast("boolean").alias("none"))
    return df.select(doc.alias("doc"), *([] if text_col in names else [F.col(text_col).alias("text")]))


def text_of(batch: pa.RecordBatch, text_col: str) -> pa.Array:
    """The texts of a batch of ``with_doc``."""
    if "text" in batch.schema.names:
        return batch.column("text")
    doc = batch.column("doc")
    return doc.flatten()[doc.type.get_field_index(text_col)]


def slices(offs: np.ndarray, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes (or one row, however long)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Words of a few texts: byte ranges, 64-bit hashes, and the range of
    words of each text (``first[d]:first[d + 1]``)."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, hashes: bool = True):
        base = int(offs[0])
        self.offs = offs - base
        self.data = data[base:int(offs[-1])]
        n = len(self.data)
        self.space = SPACE[self.data]
        ink = ~self.space
        before = np.ones(n + 1, bool)          # is the byte before i a space or another text?
        before[1:] = self.space
        before[self.offs] = True
        self.starts = np.flatnonzero(ink & before[:n])
        after = np.ones(n + 1, bool)
        after[:n] = self.space
        after[self.offs] = True
        self.ends = np.flatnonzero(ink & after[1:]) + 1
        self.first = np.searchsorted(self.starts, self.offs)
        self.n_words = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offs) - 1), self.n_words)
        self.hash = self._hashes() if hashes else None

    def _hashes(self) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        size = self.ends - self.starts
        longest = int(size.max()) if len(size) else 0
        power = np.full(longest + 1, BYTE_BASE, np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        i, n = 0, len(out)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + BLOCK, "right")))
            j = min(j, n)
            s, length = self.starts[i:j], size[i:j]
            heads = np.concatenate(([0], np.cumsum(length)))
            pos = np.arange(heads[-1]) - np.repeat(heads[:-1], length)
            at = pos + np.repeat(s, length)
            value = BYTE_VALUE[self.data[at]] * power[pos]
            out[i:j] = np.add.reduceat(value, heads[:-1])
            i = j
        return mix(out)


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive values (``len(h) - n + 1`` of them), built
    from hashes of half the length."""
    total = len(h)
    if total < n:
        return np.zeros(0, np.uint64)

    def power(k):
        return np.uint64(pow(int(WORD_BASE), k, 1 << 64))

    def join(a, la, b, lb):
        m = total - la - lb + 1
        return a[:m] * power(lb) + b[la:la + m]

    out, size, part, length = None, 0, h, 1
    while n:
        if n & 1:
            out, size = (part, length) if out is None else (join(out, size, part, length), size + length)
        n >>= 1
        if n and total >= 2 * length:
            part, length = join(part, length, part, length), 2 * length
    return out


def whole(words_first: np.ndarray, n_windows: int, n: int) -> np.ndarray:
    """Which of the ``n_windows`` windows of ``n`` words lie in one text."""
    keep = np.zeros(n_windows + 1, np.int64)
    lo, hi = words_first[:-1], words_first[1:] - n + 1
    some = hi > lo
    np.add.at(keep, lo[some], 1)
    np.add.at(keep, hi[some], -1)
    return np.cumsum(keep[:-1]) > 0


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n consecutive values."""
    if len(x) < n:
        return x[:0]
    part, length = x, 1
    while 2 * length <= n:
        part = np.minimum(part[:-length], part[length:])
        length *= 2
    m = len(x) - n + 1
    return np.minimum(part[:m], part[n - length:n - length + m])
